"""Document fingerprints by improved consistent weighted sampling.

A text's terms are its words (A-Z lower-cased) weighted by how often they occur. For every
term and each of the signature's places two gamma variates and one uniform number are drawn,
always the same for the same term; they yield a quantised weight and a rank, and the term of
least rank is the place's sample. Two signatures agree in a place with the probability of the
generalised Jaccard similarity: the sum of the lesser over the sum of the greater weights.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.ordering import range_bounds, range_of
from marketlens.llm.shingles import mixed, text_chunks, word_numbers

PLACES = 128
RANGE_BYTES = 16 << 20
_ROWS = 1 << 13


class Sampler:
    """Draws signatures. The variates of a term come from three tables, each entered at a
    different part of the term's number, so that only equal terms share all three."""

    def __init__(self, places: int = PLACES):
        random = np.random.Generator(np.random.PCG64(11))
        shape = (_ROWS, places)
        self.places = places
        self.scale = random.gamma(2.0, 1.0, shape).astype(np.float32)
        self.rank = np.log(random.gamma(2.0, 1.0, shape)).astype(np.float32)
        self.shift = random.random(shape, dtype=np.float32)
        self.salt = random.integers(1, 2**63, places, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def signature(self, words: np.ndarray) -> np.ndarray:
        """16 bits per place; `words` are the numbers of all words of a text, in any order."""
        terms, weights = np.unique(words, return_counts=True)
        if not len(terms):
            return np.zeros(self.places, dtype=np.uint16)
        best = np.full(self.places, np.inf, dtype=np.float32)
        chosen = np.zeros(self.places, dtype=np.uint64)
        places = np.arange(self.places)
        for at in range(0, len(terms), 2048):
            term = terms[at : at + 2048]
            index = [((term >> np.uint64(s)) % np.uint64(_ROWS)).astype(np.intp) for s in (0, 20, 40)]
            scale, shift = self.scale[index[0]], self.shift[index[2]]
            level = np.log(weights[at : at + 2048]).astype(np.float32)[:, None]
            step = np.floor(level / scale + shift)
            rank = self.rank[index[1]] - scale * (step - shift) - scale
            least = rank.argmin(axis=0)
            value = rank[least, places]
            better = value < best
            best = np.where(better, value, best)
            sample = term[least] + step[least, places].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            chosen = np.where(better, sample, chosen)
        return (mixed(chosen * self.salt) >> np.uint64(48)).astype(np.uint16)

    def signatures(self, texts: list[str]) -> list[np.ndarray]:
        """Texts without words have the signature of zeros."""
        coded = [t.encode() for t in texts]
        out = []
        for first, last in text_chunks(coded):
            words, offsets = word_numbers(coded[first:last])
            cuts = offsets.tolist()
            out += [self.signature(words[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of places in which two signatures agree: 1 for two texts without words."""
    return float((a == b).mean())


def fingerprint(docs: DataFrame, text_col: str = "text", places: int = PLACES) -> DataFrame:
    """`docs` with `fingerprint`, four hexadecimal digits per place (null texts as empty)."""
    docs = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(places)
        for batch in batches:
            found = sampler.signatures([t or "" for t in batch.column(text_col).to_pylist()])
            yield batch.append_column("fingerprint", pa.array([s.tobytes().hex() for s in found], pa.string()))

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{columns}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of another text."""
    count = len(text) // 3
    return text[: len(text) - count] + following[:count] if count else text


def edited_fingerprints(docs: DataFrame, places: int = PLACES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per row of `docs(doc_id, text)`: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The next document of a row is the one after it by descending doc_id (equal ids by text,
    null ids last); after the last comes the first, so a single row follows itself. Null texts
    count as empty. Ids are cut into ranges; every range is sorted by itself and gets a copy
    of the first row of the range after it, so no more than a range is in order at once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = range_bounds(rows, "id", "text", range_bytes)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            yield pa.RecordBatch.from_arrays([pa.array(_down(ids, bounds)), ids], names=["range", "id"])

    heads = rows.select("id").mapInArrow(numbers, "range long, id long").groupBy("range").agg(F.max("id").alias("id"))
    first = dict(sorted((r["range"], r["id"]) for r in heads.collect()))  # one number per range
    order = list(first)
    before = {r: order[i - 1] for i, r in enumerate(order)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            ranges = _down(ids, bounds)
            ahead = [i for i, (r, x) in enumerate(zip(ranges.tolist(), ids.to_pylist(), strict=True)) if x == first[r]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges), pa.array(np.zeros(len(ranges), np.int32)), *batch.columns], names=_PLACED
            )
            if ahead:
                part = batch.take(pa.array(ahead))
                to = [before[int(ranges[i])] for i in ahead]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int64()), pa.array(np.ones(len(to), np.int32)), *part.columns], names=_PLACED
                )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(places)
        held: tuple | None = None  # the row that waits for the one after it
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("range", "ahead", "id", "text")]
            own = sampler.signatures(columns[3])
            pairs = []
            for row in zip(*columns, own, strict=True):
                if held is not None and held[0] == row[0]:
                    pairs.append((held, row))
                held = None if row[1] else row
            changed = [edited(a[3], b[3]) for a, b in pairs]
            others = sampler.signatures(changed)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([a[2] for a, _ in pairs], pa.int64()),
                    "n_chars": pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    "fingerprint": pa.array([a[4].tobytes().hex() for a, _ in pairs], pa.string()),
                    "edited_fingerprint": pa.array([s.tobytes().hex() for s in others], pa.string()),
                    "near_edited": pa.array(
                        [likeness(a[4], s) for (a, _), s in zip(pairs, others, strict=True)], pa.float64()
                    ),
                    "near_next": pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
                }
            )

    placed = rows.mapInArrow(place, "range long, ahead int, id long, text string")
    placed = placed.repartition(len(bounds) + 1, "range")
    placed = placed.sortWithinPartitions("range", "ahead", F.col("id").desc_nulls_last(), "text")
    return placed.mapInArrow(
        follow,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


_PLACED = ["range", "ahead", "id", "text"]


def _down(ids: pa.Array, bounds: list[int]) -> np.ndarray:
    """Range numbers that rise with falling ids; null ids come last."""
    up = range_of(ids.fill_null(np.iinfo(np.int64).min), bounds)
    return (len(bounds) - up).astype(np.int64)
