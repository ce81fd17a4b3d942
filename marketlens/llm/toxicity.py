"""Toxicity by a weighted grammar of clauses.

Words become symbols: insult (learned, with a weight), threat, target, negation, reported
speech, quotation mark, other. Five small transducers read a clause's symbols side by side;
their composition, whose states are tuples of theirs, is built as it is met. Insults count by
their weight, more when aimed at a target; a threat counts when a target follows; negation
just before lowers both, reported or quoted speech halves them. A document's evidence is the
sum over its matched clauses, turned into a probability by a logistic curve.

Insult weights and the curve are fitted on labelled rows, nothing else is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.workers import give_back, start_afresh
from marketlens.session import stored

# fixed values: function words of the four languages
TARGETS = "you your yourself he she him her they them we us du dich dir euch ihr sie er tu te toi vous il elle lui eux tú ti usted ustedes él ella ellos".split()
NEGATIONS = "not no never isn't aren't wasn't nicht kein keine nie ne pas jamais nunca jamás ni".split()
REPORTS = "said says quoted reported wrote called claimed sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó".split()
THREATS = "kill hurt destroy beat shoot attack töten umbringen schlagen tuer frapper détruire matar golpear destruir".split()

SAMPLE_ROWS = 20_000
LEXICON_ROWS = 20_000
PREFIXES = (4, 5, 6)
LEAST_SHARE = 0.5
CLAUSE_CAP = 12.0

_WORD = re.compile(r"[^\W_][\w']*")
_CLAUSE_END = re.compile(r"[.,;:!?\n|]")
_TOKEN = re.compile(r"[^\W_][\w']*|[\"«»“”„]")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept for measuring: crc32 of the id as text leaves 1 modulo 3 (a null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def features(word: str) -> Iterator[str]:
    """The word itself, and beginnings of longer words (marked by a star)."""
    yield word
    for size in PREFIXES:
        if len(word) > size:
            yield word[:size] + "*"


# --- transducers: (state, symbol) -> (state, effect) ---------------------------------


def _insult(state, symbol):
    return state, 1.0 if symbol == "I" else 0.0


def _target(state, symbol):
    """Aimed insults: half as much again, whichever of the two comes first."""
    if symbol == "Y":
        return "target", 0.5 if state == "insult" else 0.0
    if symbol == "I":
        return ("target", 0.5) if state == "target" else ("insult", 0.0)
    return state, 0.0


def _threat(state, symbol):
    """A target at most three words after a threat."""
    if symbol == "T":
        return 3, 0.0
    if symbol == "Y" and state:
        return 0, 1.0
    return max(0, state - 1), 0.0


def _negation(state, symbol):
    return (3, 1.0) if symbol == "N" else (max(0, state - 1), 0.25 if state else 1.0)


def _report(state, symbol):
    said, quoted = state
    said, quoted = said or symbol == "R", quoted != (symbol == "Q")
    return (said, quoted), 0.5 if said or quoted else 1.0


_START = (0, "none", 0, 0, (False, False))


class Grammar:
    """The composition of the five transducers and a lexicon of weighted insults."""

    def __init__(self, lexicon: dict[str, float]):
        import ahocorasick

        self.lexicon = lexicon
        self.threat_weight = float(np.median(list(lexicon.values()))) if lexicon else 1.0
        self.classes = {w: c for c, ws in (("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in ws}
        self.classes |= {w: "T" for w in THREATS} | {q: "Q" for q in '"«»“”„'}
        self.steps: dict = {}
        self.finder = ahocorasick.Automaton()
        for feature in {f.rstrip("*") for f in lexicon} | set(THREATS):
            self.finder.add_word(feature, len(feature))
        self.finder.make_automaton()

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(f, 0.0) for f in features(word)), default=0.0)

    def step(self, state, symbol):
        """(next state, share of the word's weight, share of a threat's weight)"""
        known = self.steps.get((state, symbol))
        if known is None:
            s0, insult = _insult(state[0], symbol)
            s1, aimed = _target(state[1], symbol)
            s2, threat = _threat(state[2], symbol)
            s3, negated = _negation(state[3], symbol)
            s4, reported = _report(state[4], symbol)
            factor = negated * reported
            known = self.steps[state, symbol] = ((s0, s1, s2, s3, s4), (insult + aimed) * factor, threat * factor)
        return known

    def clause(self, clause: str) -> float:
        state, total, last = _START, 0.0, 0.0
        for word in _TOKEN.findall(clause):
            weight = self.weight(word)
            symbol = "I" if weight else self.classes.get(word, "W")
            last = weight or last
            state, share, threat = self.step(state, symbol)
            total += share * last + threat * self.threat_weight
        return min(total, CLAUSE_CAP)

    def evidence(self, text: str) -> float:
        """The sum over clauses in which an insult or threat begins a word."""
        text = text.lower()
        total, done = 0.0, -1
        for last, size in self.finder.iter(text):
            start = last - size + 1
            if start <= done or start and (text[start - 1].isalnum() or text[start - 1] == "_"):
                continue
            begin = max(text.rfind(c, 0, start) for c in ".,;:!?\n|") + 1
            end = _CLAUSE_END.search(text, start)
            done = end.start() if end else len(text)
            total += self.clause(text[begin:done])
        return total


class Model:
    """Probability that a text is toxic. `bias` and `slope` act on the log of the evidence."""

    def __init__(self, lexicon: dict[str, float], bias: float = -20.0, slope: float = 0.0):
        self.lexicon, self.bias, self.slope = lexicon, bias, slope

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.slope * np.log1p(evidence), -30, 30)))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from labelled rows outside the held-out part, at most `sample_rows` of them,
    chosen by a hash of the id. Without such rows, or without both classes among them, the
    model gives every text the same probability (the share of toxic rows, or 0)."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    rows = stored(rows.repartition(docs.sparkSession.sparkContext.defaultParallelism), "labelled")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model({}, 30.0 if toxic else -30.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_afresh()
        for batch in batches:
            hits, misses = Counter(), Counter()
            for text, label in zip(_texts(batch), batch.column("toxic").to_pylist(), strict=True):
                words = set(_WORD.findall(text.lower()))
                (hits if label else misses).update({f for w in words for f in features(w)})
            names = [*hits, *(f for f in misses if f not in hits)]
            for at in range(0, len(names), 200_000):
                part = names[at : at + 200_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.string()),
                        pa.array([hits[f] for f in part], pa.int64()),
                        pa.array([misses[f] for f in part], pa.int64()),
                    ],
                    names=["feature", "hits", "misses"],
                )
            del hits, misses, names
            give_back()

    counts = rows.mapInArrow(count, "feature string, hits long, misses long").groupBy("feature")
    odds = F.log((F.col("hits") + 0.5) / (toxic + 1)) - F.log((F.col("misses") + 0.5) / (clean + 1))
    spread = F.sqrt(1 / (F.col("hits") + 0.5) + 1 / (F.col("misses") + 0.5))
    # the lower end of the log odds, so that rare words weigh little
    weights = (
        counts.agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
        .where("hits >= 3")
        .select("feature", (odds - 2 * spread).alias("weight"))
        .where("weight > 0.8")
        .orderBy(F.desc("weight"), "feature")
        .limit(LEXICON_ROWS)
    )
    lexicon = {r["feature"]: r["weight"] for r in weights.collect()}
    # words that only keep company with insults, in copies of toxic texts say, weigh far less
    least = LEAST_SHARE * max(lexicon.values(), default=0.0)
    lexicon = {f: w for f, w in lexicon.items() if w >= least}

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            found = [grammar.evidence(t) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.float64()), batch.column("toxic").cast(pa.int32())], names=["x", "y"]
            )

    pairs = rows.mapInArrow(evidence, "x double, y int").collect()
    return Model(lexicon, *_logistic(np.array([r.x for r in pairs]), np.array([r.y for r in pairs])))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope of the curve over log(1 + x), by Newton steps with a small ridge."""
    design = np.stack([np.ones(len(x)), np.log1p(x)], axis=1)
    ridge = np.diag([1e-3, 1e-2])
    beta = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - ridge @ beta
        change = np.linalg.solve(design.T @ (design * (p * (1 - p) + 1e-9)[:, None]) + ridge, gradient)
        beta = beta + change / max(1.0, np.abs(change).max())
        if np.abs(change).max() < 1e-6:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with a column `score`, the probability that the text is toxic.

    A null text counts as empty. Every row is kept, in any number of copies; a column named
    `score` is replaced.
    """
    docs = docs.drop("score")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_afresh()
        grammar = Grammar(model.lexicon)
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            found = np.array([grammar.evidence(t or "") for t in texts], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.probability(found))], names=[*batch.schema.names, "score"]
            )
            del texts
            give_back()

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted (1 from `threshold` on).

    Fitted by `fit` on `labels(doc_id, toxic)`. Ids and other columns play no part in the
    score: equal texts score alike, null or empty texts get the curve's value at no evidence.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, sample_rows))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
