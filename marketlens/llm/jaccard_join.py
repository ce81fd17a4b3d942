"""N-gram Jaccard join: all documents whose shingle sets are alike, by T-occurrence search.

1. Every scan batch (a few thousand documents) turns its texts into sets of shingles.
   Shingles found in two documents of the batch are known to be shared at once; the rest
   goes out once, packed by hash bucket, and the bucket answers which of them another batch
   has too. Only a set with at least the required share of shared shingles can link; all
   others are settled here, which is most of a corpus.
2. Equal sets become one representative. Representatives that have a shingle in common
   among their rarest (those that a partner cannot do without) fall into one cluster; every
   linked pair lies within one.
3. A cluster is cut into blocks of bounded size, and each pair of blocks is one task's
   search: inverted lists over one block, the sets of the other as queries. As in DivideSkip
   the longest lists of a query are put aside, the short ones are merged, and candidates with
   enough occurrences probe the long ones by binary search, giving up as soon as the required
   overlap is out of reach. A block pair returns links counted per set and a spanning forest,
   never all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.components import components
from marketlens.llm.shingles import shingle_sets, text_chunks
from marketlens.llm.workers import give_back, start_afresh
from marketlens.session import stored

# rows of the exchanges: a batch's documents, shingles known to be shared, shingles that ask
_DOCS, _SHARED, _ASKED = 0, 1, 2
_PACKED = "kind int, bucket long, batch long, tokens binary, places binary, extra binary"
_NAMES = ["kind", "bucket", "batch", "tokens", "places", "extra"]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
BUCKET_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
_NOBODY = 65535  # the place of a shingle that asks without waiting for an answer
BLOCK = 1024


def required(size: np.ndarray | int, percent: int):
    """The least overlap of a set of this size with any set it links to."""
    return -(-size * percent // 100)


def _packed_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _planes(tokens: np.ndarray) -> bytes:
    """Seven bytes of each number, byte by byte: the bucket tells the eighth, and the upper
    ones of sorted numbers compress well."""
    return tokens.view(np.uint8).reshape(-1, 8)[:, :7].T.tobytes()


def _from_planes(data: bytes, top: int) -> np.ndarray:
    out = np.full((len(data) // 7, 8), top, dtype=np.uint8)
    out[:, :7] = np.frombuffer(data, dtype=np.uint8).reshape(7, -1).T
    return out.reshape(-1).view(np.uint64)


def _asked(tokens: np.ndarray, places: np.ndarray, batch: int, bits: int) -> list[tuple]:
    """Sorted shingles as rows by bucket, the upper `bits` bits."""
    bucket = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(tokens)]))
    places = places.astype(np.uint16)
    return [
        (_ASKED, int(bucket[lo]), batch, _planes(tokens[lo:hi]), places[lo:hi].tobytes(), None)
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        if hi > lo
    ]


def _bucket_bits(volume: int | None) -> int:
    return max(8, math.ceil(math.log2(max(1, (volume or 0) / BUCKET_BYTES))))


def _answered(table: pa.Table, bits: int, numbered: bool) -> pa.Table:
    """For a bucket: its shingles found in several batches or places, back to these batches;
    with how often each occurs if `numbered`. Rows of other kinds pass."""
    if table.column("kind")[0].as_py() != _ASKED:
        return table
    top = table.column("bucket")[0].as_py() >> (bits - 8)
    parts = [_from_planes(x, top) for x in table.column("tokens").to_pylist()]
    tokens = np.concatenate(parts)
    places = np.frombuffer(b"".join(table.column("places").to_pylist()), dtype=np.uint16)
    batch = np.repeat(table.column("batch").to_numpy(), [len(x) for x in parts])
    order = np.argsort(tokens, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], np.diff(tokens[order]) != 0)))
    often = np.diff(np.concatenate((first, [len(order)])))
    count = np.empty(len(order), dtype=np.uint32)
    count[order] = np.repeat(often, often)
    chosen = np.flatnonzero((count > 1) & (places != _NOBODY))
    chosen = chosen[np.argsort(batch[chosen], kind="stable")]
    tokens, places, batch, count = tokens[chosen], places[chosen], batch[chosen], count[chosen]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(batch)) + 1, [len(batch)]))
    rows = [
        (
            _SHARED, -1 - int(batch[lo]), int(batch[lo]), tokens[lo:hi].tobytes(), places[lo:hi].tobytes(),
            count[lo:hi].tobytes() if numbered else None,
        )
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        if hi > lo
    ]
    return pa.Table.from_batches([_packed_rows(rows)])


def _gathered(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray, list[int]]:
    """Of a batch's rows: where its documents are, shared shingles and their places, and the
    rows these come from."""
    kind = table.column("kind").to_numpy()
    at = int(np.flatnonzero(kind == _DOCS)[0])
    more = [i for i in range(len(kind)) if i != at]
    tokens, places = table.column("tokens").take(pa.array(more, pa.int64())), table.column("places").take(pa.array(more, pa.int64()))
    found = np.frombuffer(b"".join(tokens.to_pylist()), dtype=np.uint64)
    return at, found, np.frombuffer(b"".join(places.to_pylist()), dtype=np.uint16), more


def _number(ordinal: int) -> int:
    """A batch's number, the same when its task is run again."""
    return (TaskContext.get().partitionId() << 24) + ordinal


def shared_shingles(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """One row per row of `docs`: id, n (set size), key (of the set) and, where enough of its
    shingles occur in another row, these as packed sorted numbers; else null."""
    from_rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bits = _bucket_bits(docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0])

    def pack_batch(ids: pa.Array, texts: list[bytes], number: int) -> pa.RecordBatch:
        sets = list(shingle_sets(texts, size))
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        keys = b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets)
        known = np.array([x is not None for x in ids.to_pylist()], dtype=np.uint8)
        id_bytes = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
        rows = [(_DOCS, -1 - number, number, id_bytes + sizes.tobytes(), known.tobytes(), keys)]
        tokens = np.concatenate(sets)
        places = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, places = tokens[order], places[order]
        same = tokens[1:] == tokens[:-1]
        again = np.concatenate((np.zeros(min(1, len(tokens)), bool), same))
        several = again | np.concatenate((same, np.zeros(min(1, len(tokens)), bool)))
        if several.any():
            rows.append((_SHARED, -1 - number, number, tokens[several].tobytes(), places[several].tobytes(), None))
        # one of each shingle asks the buckets; for a shared one no answer is needed
        places = np.where(several, np.uint16(_NOBODY), places)[~again]
        return _packed_rows(rows + _asked(tokens[~again], places, number, bits))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_afresh()
        ordinal = 0
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for lo, hi in text_chunks(texts, BATCH_BYTES, 50_000):
                yield pack_batch(batch.column("id").slice(lo, hi - lo), texts[lo:hi], _number(ordinal))
                ordinal += 1
            del texts
            give_back()

    def settle(table: pa.Table) -> pa.Table:
        at, found, place, _ = _gathered(table)
        known = np.frombuffer(table.column("places")[at].as_py(), dtype=np.uint8).astype(bool)
        head = np.frombuffer(table.column("tokens")[at].as_py(), dtype=np.int64)
        ids, sizes = head[: len(known)], head[len(known) :]
        extra = table.column("extra")[at].as_py()
        keys = [extra[i * 16 : i * 16 + 16] for i in range(len(known))]
        shared = np.bincount(place, minlength=len(known))
        enough = (shared >= required(sizes, percent)) & (sizes > 0)
        found, place = found[enough[place]], place[enough[place]]
        found = found[np.lexsort((found, place))]
        ends = np.cumsum(np.where(enough, shared, 0))
        packed = [
            found[e - s : e].tobytes() if ok else None
            for e, s, ok in zip(ends.tolist(), shared.tolist(), enough.tolist(), strict=True)
        ]
        give_back()
        return pa.table(
            {
                "id": pa.array(ids, mask=~known),
                "n": pa.array(sizes),
                "key": pa.array(keys, pa.binary()),
                "tokens": pa.array(packed, pa.binary()),
            }
        )

    packed = from_rows.mapInArrow(pack, _PACKED)
    packed = packed.groupBy("bucket").applyInArrow(lambda t: _answered(t, bits, False), _PACKED)
    return packed.groupBy("batch").applyInArrow(settle, "id long, n long, key binary, tokens binary")


def postings(sets: DataFrame, percent: int) -> DataFrame:
    """(key, token) of the rarest shingles of `sets(key, n, tokens)`.

    Shingles are ordered by how many sets have them. Of its rarest n - required + 1, a set
    shares one with every set it links to; those that no other set has are not given.
    """
    bits = _bucket_bits(sets.agg(F.sum(F.octet_length("tokens"))).first()[0])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal = 0
        for batch in batches:
            packed, keys = batch.column("tokens").to_pylist(), batch.column("key").to_pylist()
            sizes = batch.column("n").to_numpy()
            for lo, hi in text_chunks(packed, BATCH_BYTES, 50_000):
                number = _number(ordinal)
                ordinal += 1
                tokens = np.frombuffer(b"".join(packed[lo:hi]), dtype=np.uint64)
                places = np.repeat(np.arange(hi - lo), [len(x) // 8 for x in packed[lo:hi]])
                order = np.argsort(tokens, kind="stable")
                head = (_DOCS, -1 - number, number, sizes[lo:hi].astype(np.int64).tobytes(), None, b"".join(keys[lo:hi]))
                yield _packed_rows([head, *_asked(tokens[order], places[order], number, bits)])
            del packed, keys
            give_back()

    def choose(table: pa.Table) -> pa.Table:
        at, found, place, more = _gathered(table)
        sizes = np.frombuffer(table.column("tokens")[at].as_py(), dtype=np.int64)
        keys = table.column("extra")[at].as_py()
        count = np.frombuffer(b"".join(table.column("extra").take(pa.array(more, pa.int64())).to_pylist()), dtype=np.uint32)
        shared = np.bincount(place, minlength=len(sizes))
        order = np.lexsort((found, count, place))
        found, place = found[order], place[order]
        rank = np.arange(len(place)) - (np.cumsum(shared) - shared)[place]
        # shingles of one set only come first in the order, so what they leave is given
        kept = rank <= (shared - required(sizes, percent))[place]
        return pa.table(
            {
                "key": pa.array([keys[i * 16 : i * 16 + 16] for i in place[kept].tolist()], pa.binary()),
                "token": pa.array(found[kept].view(np.int64)),
            }
        )

    packed = sets.select("key", "n", "tokens").mapInArrow(pack, _PACKED)
    packed = packed.groupBy("bucket").applyInArrow(lambda t: _answered(t, bits, True), _PACKED)
    return packed.groupBy("batch").applyInArrow(choose, "key binary, token long")


def clusters(sets: DataFrame, percent: int) -> DataFrame:
    """(key, cluster) of the sets that have a possible partner among `sets(key, n, tokens)`:
    those connected by shingles that both have among their rarest."""
    posted = stored(postings(sets, percent), "postings")
    hubs = posted.groupBy("token").agg(F.min("key").alias("hub"), F.count("*").alias("df")).where("df > 1")
    edges = posted.join(hubs, "token").select(F.col("key").alias("a"), F.col("hub").alias("b")).where("a <> b")
    return components(edges.distinct()).select(F.col("node").alias("key"), F.col("root").alias("cluster"))


class InvertedLists:
    """Lists of the sets of a block, by shingle."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        flat = np.concatenate(sets)
        which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        flat, self.which = flat[order], which[order]
        first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
        self.tokens, self.first = flat[first], first
        self.last = np.concatenate((first[1:], [len(flat)]))
        self.sizes = sizes

    def search(self, query: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Members linked to the query and their overlaps (DivideSkip)."""
        at = np.searchsorted(self.tokens, query)
        at = at[self.tokens[np.minimum(at, len(self.tokens) - 1)] == query]
        need = int(required(size, percent))
        if len(at) < need:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lengths = self.last[at] - self.first[at]
        at = at[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        aside = min(need - 1, int(need / (0.01 * math.log2(longest + 1) + 1)))
        short, long = at[: len(at) - aside], at[len(at) - aside :][::-1]
        runs = [self.which[self.first[i] : self.last[i]] for i in short.tolist()]
        merged = np.sort(np.concatenate(runs), kind="stable")  # merges the sorted runs
        begin = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
        members, hits = merged[begin], np.diff(np.concatenate((begin, [len(merged)])))
        other = self.sizes[members]
        # overlap needed with a member of this size: percent of the union
        wanted = -(-percent * (size + other) // (100 + percent))
        alive = (hits + len(long) >= wanted) & (other * 100 >= size * percent) & (size * 100 >= other * percent)
        members, hits, wanted = members[alive], hits[alive], wanted[alive]
        for left, i in zip(range(len(long) - 1, -1, -1), long.tolist(), strict=True):
            if not len(members):
                break
            run = self.which[self.first[i] : self.last[i]]
            place = np.searchsorted(run, members)
            hits = hits + (run[np.minimum(place, len(run) - 1)] == members)
            alive = hits + left >= wanted
            if not alive.all():
                members, hits, wanted = members[alive], hits[alive], wanted[alive]
        return members, hits


def links(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of `sets(cluster, key, n, copies, tokens)`: a spanning forest (a, b) of the links and,
    per set, how many copies of other sets it links to (key, linked)."""
    counted = sets.groupBy("cluster").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    cells = (
        sets.join(counted, "cluster")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "cluster",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "key",
            "n",
            "copies",
            "tokens",
        )
    )

    def search(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        keys = table.column("key").to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys = [keys[x] for x in order]
        table = table.take(pa.array(order))
        block = table.column("block").to_numpy()
        sizes, copies = table.column("n").to_numpy(), table.column("copies").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("tokens").to_pylist()]
        inner = np.flatnonzero(block == j)
        out: list[tuple] = []
        linked = np.zeros(len(keys), dtype=np.int64)
        if len(inner):
            lists = InvertedLists([sets[x] for x in inner.tolist()], sizes[inner])
            parent = list(range(len(keys)))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for q in np.flatnonzero(block == i).tolist():
                members, _ = lists.search(sets[q], int(sizes[q]), percent)
                members = inner[members]
                if i == j:
                    members = members[members > q]
                linked[q] += copies[members].sum()
                linked[members] += copies[q]
                for m in members.tolist():
                    a, b = root(q), root(m)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        out.append((keys[q], keys[m], 0))
        out += [(keys[x], None, int(linked[x])) for x in np.flatnonzero(linked).tolist()]
        del sets
        give_back()
        return pa.table(
            {
                "a": pa.array([r[0] for r in out], pa.binary()),
                "b": pa.array([r[1] for r in out], pa.binary()),
                "linked": pa.array([r[2] for r in out], pa.int64()),
            }
        )

    found = cells.groupBy("cluster", "i", "j").applyInArrow(search, "a binary, b binary, linked long")
    found = stored(found, "links")
    degree = found.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("linked").alias("linked"))
    return found.where("b is not null").select("a", "b"), degree


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75
) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, n_links.

    Two rows link when the intersection of their sets of `size`-word shingles is at least
    `percent` per cent of the union; component_id is the smallest id reachable by links.
    Texts that are null or without words have an empty set and link with nothing; texts of
    fewer words have one shingle, their whole sequence. Repeated rows are copies of each
    other. A null id is kept and is never a component's smallest unless all are null. Other
    columns of `docs` are not used; an empty table gives no rows. Texts of any length are
    taken whole.
    """
    rows = stored(shared_shingles(docs, id_col, text_col, size, percent), "shingles")
    maybe = rows.where("tokens is not null")
    # equal sets pack equal shingles, so any row's will do
    sets = maybe.groupBy("key").agg(
        F.first("n").alias("n"), F.count("*").alias("copies"), F.min("id").alias("least"), F.first("tokens").alias("tokens")
    )
    sets = stored(sets, "sets")
    members = clusters(sets.select("key", "n", "tokens"), percent)
    forest, degree = links(sets.join(members, "key"), percent)
    roots = components(forest)
    labelled = (
        sets.select("key", "copies", "least")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .join(degree, "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    classes = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = stored(
        labelled.join(classes, "root").select(
            "key", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "classes",
    )
    linked = maybe.select("id", "n", "key").join(labelled, "key")
    columns = [F.col("id").alias("doc_id"), F.col("n").alias("n_shingles")]
    alone = rows.where("tokens is null").select(*columns, F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return alone.union(linked.select(*columns, "component_id", F.col("n_links").cast("long")))
