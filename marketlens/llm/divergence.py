"""How far the sources of a language differ in their terms, by a frequent-pattern tree.

Every language keeps the terms of at least ten of its documents; a kept term's row is the
list of sources that hold it, with how often, the sources with most terms first. Rows are
inserted into a tree whose paths carry multiplicities, so that terms beginning alike share
nodes. Two sources' divergence is a sum over all kept terms; it is split into what both give
for a term neither has, what each gives alone, and a correction for terms that both have. A
node's correction with each of its ancestors is computed once, times the node's multiplicity,
whatever number of terms the node stands for. All numbers are whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.sizes import small_side
from marketlens.session import stored

LEAST_DOCUMENTS = 10
TERM_RANKS = 10
SCALE = 1_000_000_000
# (term, count) entries a task holds before it hands them on, nodes of one tree
MOST_ENTRIES = 500_000
MOST_NODES = 1_000_000
# rows of one line per (lang, source); beyond this their joins shuffle
BROADCAST_GROUPS = 100_000


def _letters() -> bytes:
    """Lower-cases A-Z and turns what is no part of a term into spaces: all of ASCII but letters."""
    table = bytearray(range(256))
    table[:128] = b" " * 128
    for upper, lower in zip(range(0x41, 0x5B), range(0x61, 0x7B), strict=True):
        table[upper] = table[lower] = lower
    return bytes(table)


_TERMS = _letters()


def term_counts(docs: DataFrame) -> DataFrame:
    """Per lang, source and term: count, and docs, the number of documents it occurs in."""
    rows = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (counts, seen) in held.items():
                if counts:
                    terms = list(counts)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": pa.array([lang] * len(terms), pa.string()),
                            "source": pa.array([source] * len(terms), pa.string()),
                            "term": pa.array(terms, pa.binary()).cast(pa.string()),
                            "count": pa.array(counts.values(), pa.int64()),
                            "docs": pa.array([seen[t] for t in terms], pa.int64()),
                        }
                    )
            held.clear()

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, texts, strict=True):
                terms = text.translate(_TERMS).split()
                counts, seen = held.setdefault((lang, source), (Counter(), Counter()))
                counts.update(terms)
                seen.update(set(terms))
            if sum(len(c) for c, _ in held.values()) > MOST_ENTRIES:
                yield from handed()
        yield from handed()

    counted = rows.mapInArrow(count, "lang string, source string, term string, count long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), without overflow; 1 without terms."""
    above = f"cast({SCALE} as decimal(38, 0)) * cast({count} + 2 as decimal(20, 0))"
    return F.expr(f"if({terms} = 0, 1L, 1L + ({above}) div cast({total} + 2 * {terms} as decimal(20, 0)))")


def gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def kept_terms(counts: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Per lang and kept term: total, and row, its sources with their counts."""
    rows = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"),
        F.sum("count").alias("total"),
        F.collect_list(F.struct("source", "count")).alias("row"),
    )
    return rows.where(F.col("docs") >= least_documents).select("lang", "term", "total", "row")


def group_shares(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Per lang and source, whether or not they have kept terms: n, terms (the lang's), lang_n,
    base (the share of a kept term that the source lacks) and place in the lang, the source
    with most kept terms first."""
    known = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    sums = (
        terms.select("lang", F.inline("row"))
        .groupBy("lang", "source")
        .agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("own"))
    )
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    joined = known.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    joined = joined.na.fill(0, ["n", "own", "terms", "lang_n"])
    order = Window.partitionBy("lang").orderBy(F.col("own").desc(), "source")
    return joined.withColumn("base", share("0L", "n", "terms")).withColumn("place", F.row_number().over(order).cast("long"))


class PatternTree:
    """Rows of (place, p, base) with multiplicities, shared from the front."""

    def __init__(self):
        self.children: dict[tuple[int, int, int], int] = {}
        self.parent, self.place, self.p, self.base, self.many = [-1], [-1], [0], [0], [0]

    def insert(self, row: list[tuple[int, int, int]], times: int) -> None:
        at = 0
        for place, p, base in row:
            key = (at, place, p)
            at = self.children.get(key, 0)
            if not at:
                at = self.children[key] = len(self.many)
                self.parent.append(key[0])
                self.place.append(place)
                self.p.append(p)
                self.base.append(base)
                self.many.append(0)
            self.many[at] += times

    def corrections(self) -> dict[tuple[int, int], int]:
        """Per pair of places (ancestor, node): the sum over the node-ancestor combinations of
        the node's multiplicity times what having the term in both changes."""
        parent, place, p, base, many = (
            np.array(c, dtype=np.int64) for c in (self.parent, self.place, self.p, self.base, self.many)
        )
        sums: Counter = Counter()
        node = np.arange(1, len(parent))
        above = parent[node]
        while len(node):
            deep = above > 0
            node, above = node[deep], above[deep]
            change = _gap(p[node], p[above]) - _gap(p[node], base[above])
            change += _gap(base[node], base[above]) - _gap(base[node], p[above])
            pairs = np.stack((place[above], place[node]))
            order = np.lexsort(pairs)
            pairs, change = pairs[:, order], (many[node] * change)[order]
            first = np.flatnonzero(np.concatenate(([True], (np.diff(pairs) != 0).any(axis=0)))[: len(order)])
            added = np.add.reduceat(change, first).tolist() if len(first) else []
            for a, b, value in zip(*pairs[:, first].tolist(), added, strict=True):
                sums[a, b] += value
            above = parent[above]
        return sums


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def pair_corrections(paths: DataFrame) -> DataFrame:
    """(lang, a, b, value) from `paths(lang, path, times)`: a tree per lang and task, and more
    than one if it has many nodes; values of several trees add up. a and b are places."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, PatternTree] = {}

        def settled() -> Iterator[pa.RecordBatch]:
            for lang, tree in trees.items():
                found = tree.corrections()
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(found), pa.string()),
                        "a": pa.array([a for a, _ in found], pa.int64()),
                        "b": pa.array([b for _, b in found], pa.int64()),
                        "value": pa.array(found.values(), pa.int64()),
                    }
                )
            trees.clear()

        for batch in batches:
            lists = batch.column("path")
            ends = np.asarray(lists.offsets).tolist()
            flat = lists.values
            nodes = list(zip(*(flat.field(c).to_pylist() for c in ("place", "p", "base")), strict=True))
            langs, times = batch.column("lang").to_pylist(), batch.column("times").to_pylist()
            for lang, many, start, end in zip(langs, times, ends[:-1], ends[1:], strict=True):
                tree = trees.get(lang) or trees.setdefault(lang, PatternTree())
                tree.insert(nodes[start:end], many)
                if len(tree.many) > MOST_NODES:
                    yield from settled()
        yield from settled()

    # paths that begin alike go to one task, whose tree shares their nodes
    ranged = paths.repartitionByRange("lang", F.slice("path", 1, 3))
    return _summed(ranged.mapInArrow(grow, "lang string, a long, b long, value long"))


def _summed(values: DataFrame) -> DataFrame:
    return values.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, term_ranks: int = TERM_RANKS
) -> DataFrame:
    """lang, source, part, item, value, rank of `docs(lang, source, text)`.

    Part `pair` has a row per ordered pair of sources of a lang: their divergence summed over
    the lang's kept terms. Part `term` has a source's kept terms whose share is above the
    lang's, the `term_ranks` with most divergence from it. Ranks go by value, then item in
    the order of its bytes. Null text, lang and source count as empty; repeated rows count
    each; documents without terms make their group known; a lang without kept terms has pairs
    of value 0; a single source has none; an empty table gives no rows; other columns are not used.
    """
    terms = stored(kept_terms(term_counts(docs), least_documents), "terms")
    groups = stored(group_shares(docs, terms), "groups")
    side = small_side(groups.drop("own"), BROADCAST_GROUPS, "shares")
    entries = terms.select("lang", "term", "total", F.inline("row")).join(side, ["lang", "source"])
    entries = entries.withColumn("p", share("count", "n", "terms")).withColumn("q", share("total", "lang_n", "terms"))
    entries = stored(entries.select("lang", "source", "term", "place", "p", "q", "base"), "entries")

    node = F.struct("place", "p", "base")
    paths = entries.groupBy("lang", "term").agg(F.array_sort(F.collect_list(node)).alias("path"))
    paths = stored(paths.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times")), "paths")
    both = pair_corrections(paths)

    # one line per source and distinct share, against the other sources of the lang
    shares = entries.groupBy("lang", "place", "p", "base").agg(F.count(F.lit(1)).alias("times"))
    other = side.select("lang", F.col("place").alias("b"), F.col("base").alias("other"))
    more = F.col("times") * (gap("p", "other") - gap("base", "other"))
    alone = shares.join(other, "lang").where("place <> b")
    alone = _summed(alone.select("lang", F.col("place").alias("a"), "b", more.alias("value")))
    pairs = groups.select("lang", F.col("place").alias("a"), "base", "terms").join(other, "lang").where("a <> b")
    neither = pairs.select("lang", "a", "b", (F.col("terms") * gap("base", "other")).alias("value"))

    def turned(one_way: DataFrame) -> DataFrame:
        return one_way.unionByName(one_way.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))

    summed = _summed(neither.unionByName(turned(alone)).unionByName(turned(both)))
    names = side.select("lang", "place", "source")
    first = names.withColumnRenamed("place", "a")
    second = names.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    named = summed.join(first, ["lang", "a"]).join(second, ["lang", "b"])
    pair_rows = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    above = entries.where("p > q").withColumn("value", gap("p", "q"))
    term_rows = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pair_rows.withColumn("rank", F.row_number().over(order))
    best = term_rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= term_ranks)
    return ranked.unionByName(best)
