"""Token ids in binary shards, compressed by Re-Pair grammars.

Documents are put in order of their ids by ranges; a range is encoded by one task and cut
into shards. Each shard has its own grammar: all pairs of neighbouring symbols (never across
a document's end) are counted, the most frequent ones are replaced by new symbols, and so
on, until no pair occurs `LEAST_COUNT` times or the 16-bit symbols run out.

A shard is one binary value, little-endian:

    "RPG1", number of documents, symbols, rules           4 bytes each
    document ids, then 1 where the id is null              8 and 1 per document
    symbols per document, tokens per document              4 and 4 per document
    rules: left and right symbol                           2 + 2 per rule
    expansion lengths of the rules                         4 per rule
    symbols                                                2 each

Symbols below 50,257 are token ids, 65535 is a document's end, the others are rules in order. The expansion
lengths let a reader skip to any token of a document without expanding what comes before. Shards are stored as rows of a table, so that every
file system works and a task that is run again leaves nothing behind.
"""

from __future__ import annotations

import math
import os
import struct
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.ordering import running_start
from marketlens.llm.workers import give_back, kept
from marketlens.session import arrow_batches, scratch_path

END_ID = 2
END = 65535
FIRST_RULE = 50_257
# text of one task, of one call of the encoder, and tokens of a shard
RANGE_BYTES = 32 << 20
SLICE_BYTES = 3 << 20
SHARD_TOKENS = 1_000_000
# parts of text after which an encoder forgets those it met only once
MOST_PARTS = 300_000
# a pair is replaced from this count on; a round takes pairs down to this share of the best
LEAST_COUNT = 8
ROUND_SHARE = 1000
_SLOT_BITS = 19
_HEAD = "<4sIII"
_MARKS = ".,;:!?%&*$#\"'()"


class Encoder:
    """Ids of whole texts by a tokenizer of the library as loaded, each distinct part once.

    A text is cut before every single space between two other characters; byte-level
    tokenizers cut there too, so the ids of the pieces in a row are those of the text. A
    piece is cut once more, between letters and marks and around single line ends (see
    `_parts`). Parts that the tokenizer would not cut go to its model directly. How many
    parts are remembered is bounded: when full, those not met again are forgotten, and all
    if that is not enough.
    """

    def __init__(self, path: str):
        # a task has one core; the library's own threads would only hold memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        give_back()  # the file's text and what was read of it
        # byte-level tokenizers spell bytes that are no printable character by those from 256 on
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in plain]
        spelled = {b: chr(256 + i) for i, b in enumerate(rest)}
        self.letters = "".join(spelled.get(b, chr(b)) for b in range(256))
        self.tokenize = self.tokenizer.model.tokenize
        # parts that a space precedes; others are told apart by a space of their own
        self.number: dict[str, int] = {}
        self.ids = np.empty(0, dtype=np.uint16)
        self.start = np.zeros(1, dtype=np.int64)
        self.again = np.zeros(0, dtype=bool)  # parts met in several calls

    def _forget(self) -> None:
        keep = self.again if self.again.sum() < MOST_PARTS * 3 // 4 else np.zeros(len(self.again), dtype=bool)
        sizes = np.diff(self.start)
        self.ids = self.ids[np.repeat(keep, sizes)]
        self.start = np.concatenate(([0], np.cumsum(sizes[keep])))
        self.number = {p: i for i, p in enumerate(compress(self.number, keep.tolist()))}
        self.again = np.zeros(len(self.number), dtype=bool)

    def _by_model(self, text: str, space: str) -> bytes:
        """Ids of a string that the tokenizer does not cut: letters after a space, or marks."""
        spelled = text if text.isascii() else charmap_decode(text.encode(), "strict", self.letters)[0]
        return array("H", [t.id for t in self.tokenize(space + spelled)]).tobytes()

    def _learn(self, parts: list[str]) -> None:
        space, ids, whole = self.letters[32], [], {}
        for i, part in enumerate(parts):
            if part.isalpha():
                ids.append(self._by_model(part, space))
                continue
            own = part[1:] if part[0] == " " else " " + part
            if own.isalpha() or not own.strip(_MARKS):
                ids.append(self._by_model(own, ""))
            else:
                whole[i] = own
                ids.append(b"")
        encoded = self.tokenizer.encode_batch_fast(list(whole.values()), add_special_tokens=False) if whole else []
        for i, found in zip(whole, encoded, strict=True):
            ids[i] = array("H", found.ids).tobytes()
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 2
        self.number.update(zip(parts, range(len(self.number), len(self.number) + len(parts)), strict=True))
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(ids), dtype=np.uint16)))
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(sizes)))
        self.again = np.concatenate((self.again, np.zeros(len(parts), dtype=bool)))

    def _numbers(self, parts: list[str]) -> np.ndarray:
        """The parts' numbers; new ones are learned."""
        known = np.fromiter(map(self.number.get, parts, repeat(-1)), dtype=np.int64, count=len(parts))
        self.again[known[known >= 0]] = True
        fresh = np.flatnonzero(known < 0).tolist()
        if fresh:
            self._learn(list(dict.fromkeys(parts[i] for i in fresh)))
            known[fresh] = [self.number[parts[i]] for i in fresh]
        return known

    def _spelled(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in a row and how many each piece has."""
        coded = pc.utf8_rtrim(pieces, characters=_MARKS).dictionary_encode()
        # by way of numpy, as a list made from the array itself takes a step in Python for each word
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        letters = np.fromiter(map(str.isalpha, words), dtype=bool, count=len(words))
        marks = pc.binary_length(pieces).to_numpy(zero_copy_only=False)
        marks = marks - pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[which]
        # letters with one mark at most; all others are cut one by one
        plain = letters[which] & (marks < 2)
        marked = np.flatnonzero(plain & (marks == 1))
        others = np.flatnonzero(~plain)
        cuts = [_parts(p) for p in pieces.take(pa.array(others)).to_pylist()]
        ends = pc.binary_join_element_wise(" ", pc.utf8_slice_codeunits(pieces.take(pa.array(marked)), -1), "")
        ends = ends.dictionary_encode()
        used = np.zeros(len(words), dtype=bool)
        used[which[plain]] = True
        word = np.zeros(len(words), dtype=np.int64)
        word[used] = self._numbers(list(compress(words, used.tolist())))
        end = self._numbers(ends.dictionary.to_pylist())[ends.indices.to_numpy(zero_copy_only=False)]
        count = 1 + (plain & (marks == 1)).astype(np.int64)
        count[others] = np.fromiter(map(len, cuts), dtype=np.int64, count=len(cuts))
        upto = np.cumsum(count)
        first = upto - count
        part = np.full(int(upto[-1]) if len(upto) else 0, -1, dtype=np.int64)
        part[first[plain]] = word[which[plain]]
        part[first[marked] + 1] = end
        part[part < 0] = self._numbers([p for cut in cuts for p in cut])
        ids, sizes = _gathered(self.ids, self.start, part)
        return ids, np.diff(np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], upto))])

    def __call__(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and how many each text has."""
        if len(self.number) > MOST_PARTS:
            self._forget()
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return np.empty(0, dtype=np.uint16), np.empty(0, dtype=np.int64)
        cut = pc.split_pattern(texts, " ")
        flat, bounds = cut.flatten(), np.asarray(cut.offsets).astype(np.int64)
        bounds -= bounds[0]
        # a text's first piece, which no space precedes, is told apart by a space of its own
        marked = pc.binary_join_element_wise("", flat.take(pa.array(bounds[:-1])), " ")
        coded = pa.concat_arrays([flat, marked]).dictionary_encode()
        pieces = coded.dictionary
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        which[bounds[:-1]] = which[len(flat) :]
        which = which[: len(flat)]
        odd = _odd(pieces)
        if odd.any():
            pieces, which, bounds = _with_care(texts, pieces, which, bounds, odd)
        used = np.zeros(len(pieces), dtype=bool)
        used[which] = True
        place = np.cumsum(used) - 1
        ids, sizes = self._spelled(pieces.filter(pa.array(used)))
        ids, sizes = _gathered(ids, np.concatenate(([0], np.cumsum(sizes))), place[which])
        return ids, np.diff(np.concatenate(([0], np.cumsum(sizes)))[bounds])


def _gathered(ids: np.ndarray, start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of `ids`, which begin at `start`, one after another, and the size of each."""
    sizes = start[which + 1] - start[which]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.arange(total, dtype=np.int64) + np.repeat(start[which] - (ends - sizes), sizes)], sizes


def _odd(pieces: pa.Array) -> np.ndarray:
    """Whether a piece is empty, or white space other than its mark begins or ends it."""
    # printable ASCII at both ends, letters or digits only: the cheap ways to see that it is not
    ends = np.asarray(pc.binary_length(pieces)).astype(np.int64)
    held = ends > 0
    begins = np.frombuffer(pieces.buffers()[1], dtype=np.int32)[pieces.offset : pieces.offset + len(pieces)]
    data = np.frombuffer(pieces.buffers()[2] or b"", dtype=np.uint8)
    ends, begins = begins[held] + ends[held] - 1, begins[held]
    sure = np.zeros(len(pieces), dtype=bool)
    sure[held] = (data[begins] > 32) & (data[begins] < 127) & (data[ends] > 32) & (data[ends] < 127)
    sure |= pc.utf8_is_alnum(pieces).to_numpy(zero_copy_only=False)
    odd = np.zeros(len(pieces), dtype=bool)
    rest = np.flatnonzero(~sure)
    odd[rest] = [_is_odd(p) for p in pieces.take(pa.array(rest)).to_pylist()]
    return odd


def _with_care(
    texts: pa.Array, pieces: pa.Array, which: np.ndarray, bounds: np.ndarray, odd: np.ndarray
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts that hold an odd piece are cut once more, with care; `pieces` with theirs."""
    place: dict[str, int] = {}
    careful = np.logical_or.reduceat(odd[which], bounds[:-1])
    parts = []
    for i, again in enumerate(careful.tolist()):
        if again:
            own = _careful(texts[i].as_py())
            parts.append(np.array([place.setdefault(p, len(pieces) + len(place)) for p in own], dtype=np.int64))
        else:
            parts.append(which[bounds[i] : bounds[i + 1]])
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    pieces = pa.concat_arrays([pieces, pa.array(list(place), pieces.type)])
    return pieces, np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))


def _parts(piece: str) -> list[str]:
    """A piece cut around single line ends and before the marks that end a run of letters.

    A tokenizer takes a line end between two characters that are no white space by itself,
    and letters apart from marks. Parts that no space precedes begin with one.
    """
    space, lines = (" ", piece[1:].split("\n")) if piece[0] == " " else ("", piece.split("\n"))
    if len(lines) > 1 and any(not line or line[0].isspace() or line[-1].isspace() for line in lines):
        return [piece]
    out = []
    for i, line in enumerate(lines):
        if i:
            out.append(" \n")
            space = " "
        word = line.rstrip(_MARKS)
        if word.isalpha():
            out.append(space + word)
            if len(word) < len(line):
                out.append(" " + line[len(word) :])
        else:
            out.append(space + line)
    return out


def encoder_of(path: str) -> Encoder:
    """The encoder of this process: loading a tokenizer takes time and memory, and what one
    task has learned serves the next."""
    return kept(path, lambda: Encoder(path))


def _is_odd(piece: str) -> bool:
    """Whether the piece is empty, or white space other than its mark begins or ends it."""
    text = piece.removeprefix(" ")
    return not text or text[0].isspace() or text[-1].isspace()


def _careful(text: str) -> list[str]:
    """Cut only before spaces that stand alone between two characters that are no white space."""
    if not text:
        return []
    out, start = [], 0
    at = text.find(" ", 1)
    while at != -1 and at < len(text) - 1:
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            out.append(" " + text[:at] if not start else text[start + 1 : at])
            start = at
        at = text.find(" ", at + 1)
    out.append(" " + text if not start else text[start + 1 :])
    return out


# --- grammar ---------------------------------------------------------------------------


def grammar(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): pairs of neighbours replaced, rules as rows of left and right.

    Every round counts all pairs exactly and replaces those that occur at least
    `LEAST_COUNT` times and at least `1 / ROUND_SHARE` as often as the most frequent one; it
    ends when there is none, or no symbol is left.
    """
    symbols = symbols.astype(np.uint32)
    rules: list[np.ndarray] = []
    made = 0
    while made < END - FIRST_RULE and len(symbols) >= 2 * LEAST_COUNT:
        left, right = symbols[:-1], symbols[1:]
        pair = (left << np.uint32(16)) | right
        ranked = pair[(left != END) & (right != END)]
        ranked.sort()
        first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))[: len(ranked)]
        counts = np.diff(np.append(first, len(ranked)))
        if not len(counts) or counts.max() < LEAST_COUNT:
            break
        likely = np.flatnonzero(counts >= max(LEAST_COUNT, int(counts.max()) // ROUND_SHARE))
        likely = likely[np.argsort(-counts[likely], kind="stable")[: END - FIRST_RULE - made]]
        best = np.sort(ranked[first[likely]])
        del ranked, first
        place = _places(best, pair)
        at = np.flatnonzero(best[place] == pair)
        rule = place[at]
        del pair, place
        # of pairs that overlap, every other one is replaced, from the left
        begins = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1)))
        sizes = np.diff(np.append(begins, len(at)))
        taken = (np.arange(len(at), dtype=np.int32) - np.repeat(begins.astype(np.int32), sizes)) & 1 == 0
        at, rule = at[taken], rule[taken]
        symbols[at] = (FIRST_RULE + made + rule).astype(np.uint32)
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        symbols = symbols[keep]
        rules.append(np.stack((best >> np.uint32(16), best & np.uint32(0xFFFF)), axis=1))
        made += len(best)
    table = np.concatenate(rules) if rules else np.empty((0, 2), dtype=np.uint32)
    return symbols.astype(np.uint16), table.astype(np.uint16)


def _places(best: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """For each pair its place in `best`, which are distinct and ascending, or any place if it
    is not there. Looked up by a hash; pairs that share a slot with one of `best` are searched."""
    slot = np.zeros(1 << _SLOT_BITS, dtype=np.uint16)
    numbers = np.arange(len(best), dtype=np.uint16)
    own = _slots(best)
    slot[own] = numbers
    shared = np.zeros(1 << _SLOT_BITS, dtype=bool)
    shared[own[slot[own] != numbers]] = True
    at = _slots(pair)
    place = slot[at]
    if shared.any():
        again = np.flatnonzero(shared[at])
        place[again] = np.minimum(np.searchsorted(best, pair[again]), len(best) - 1)
    return place


def _slots(pair: np.ndarray) -> np.ndarray:
    return (pair * np.uint32(2_654_435_761)) >> np.uint32(32 - _SLOT_BITS)


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """Tokens per symbol, for all 65,536 symbols."""
    lengths = np.ones(65536, dtype=np.uint32)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[FIRST_RULE + i] = lengths[a] + lengths[b]
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """Ids below the rules, ends kept. Rules are spelled out once, then symbols are replaced
    by slices of these."""
    lengths = expansion_lengths(rules).astype(np.int64)
    used = lengths[FIRST_RULE : FIRST_RULE + len(rules)]
    spelled: list[bytes] = []
    for a, b in rules.tolist():
        spelled.append(
            b"".join(spelled[x - FIRST_RULE] if FIRST_RULE <= x < END else x.to_bytes(2, "little") for x in (a, b))
        )
    table = np.concatenate((np.arange(65536, dtype=np.uint16), np.frombuffer(b"".join(spelled), dtype="<u2")))
    start = np.arange(65536, dtype=np.int64)
    start[FIRST_RULE : FIRST_RULE + len(rules)] = 65536 + np.cumsum(used) - used
    sizes = lengths[symbols]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return table[np.arange(total, dtype=np.int64) + np.repeat(start[symbols] - (ends - sizes), sizes)]


def write_shard(ids: list[int | None], counts: np.ndarray, tokens: np.ndarray) -> bytes:
    """A shard of documents with these ids and numbers of tokens, ends not among `tokens`."""
    ends = np.cumsum(counts)
    symbols, rules = grammar(np.insert(tokens.astype(np.uint16), ends, END))
    borders = np.flatnonzero(symbols == END) + 1
    per_doc = np.diff(np.concatenate(([0], borders))).astype(np.uint32)
    known = np.array([0 if i is None else i for i in ids], dtype=np.int64)
    null = np.array([i is None for i in ids], dtype=np.uint8)
    lengths = expansion_lengths(rules)[FIRST_RULE : FIRST_RULE + len(rules)].astype(np.uint32)
    return b"".join(
        (
            struct.pack(_HEAD, b"RPG1", len(ids), len(symbols), len(rules)),
            known.tobytes(), null.tobytes(), per_doc.tobytes(), (counts + 1).astype(np.uint32).tobytes(),
            rules.tobytes(), lengths.tobytes(), symbols.tobytes(),
        )
    )


class Shard:
    """Reads a shard: `document(i)` and `tokens(i, start, count)` need no other document."""

    def __init__(self, data: bytes):
        magic, docs, symbols, rules = struct.unpack_from(_HEAD, data)
        if magic != b"RPG1":
            raise ValueError("not a shard")
        at = struct.calcsize(_HEAD)

        def take(kind, count):
            nonlocal at
            part = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += part.nbytes
            return part

        self.known, self.null = take("<i8", docs), take("u1", docs)
        self.per_doc, self.counts = take("<u4", docs), take("<u4", docs)
        self.rules, self.lengths = take("<u2", 2 * rules).reshape(-1, 2), take("<u4", rules)
        self.symbols = take("<u2", symbols)
        self.first = np.concatenate(([0], np.cumsum(self.per_doc, dtype=np.int64)))

    @property
    def ids(self) -> list[int | None]:
        return [None if n else int(i) for i, n in zip(self.known, self.null, strict=True)]

    def all_tokens(self) -> np.ndarray:
        """The ids of all documents, each with its end id."""
        out = expand(self.symbols, self.rules)
        out[out == END] = END_ID
        return out

    def document(self, i: int) -> np.ndarray:
        out = expand(self.symbols[self.first[i] : self.first[i + 1]], self.rules)
        out[out == END] = END_ID
        return out

    def tokens(self, i: int, start: int, count: int) -> np.ndarray:
        """`count` ids of a document from its id number `start` on."""
        own = self.symbols[self.first[i] : self.first[i + 1]]
        size = np.ones(65536, dtype=np.int64)
        size[FIRST_RULE : FIRST_RULE + len(self.lengths)] = self.lengths
        ends = np.cumsum(size[own])
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, start + count, side="left") + 1
        part = expand(own[a:b], self.rules)
        part[part == END] = END_ID
        skip = start - (int(ends[a - 1]) if a else 0)
        return part[skip : skip + count]


# --- jobs ------------------------------------------------------------------------------


def in_order(rows: DataFrame, range_bytes: int) -> DataFrame:
    """`rows(id, text)` in partitions that are ranges of (id, text), null ids last, of about
    `range_bytes` of text each, and sorted within. Rows of one id are parted by how their
    texts begin; rows that agree in that stay together."""
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [F.col("id").asc_nulls_last(), F.substring("text", 1, 64)]
    ranges = rows.repartitionByRange(max(1, math.ceil(volume / range_bytes)), *order)
    return ranges.sortWithinPartitions(F.col("id").asc_nulls_last(), "text")


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes each, one row at least."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        held = int(upto[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(upto, held + most, side="right")))
        yield start, end
        start = end


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    range_bytes: int = RANGE_BYTES, shard_tokens: int = SHARD_TOKENS, slice_bytes: int = SLICE_BYTES,
) -> None:
    """Writes the shards of `docs` to `path`, in ascending order of ids (null last, equal
    ids by text). `tokenizer` is a file of the tokenizers library with ids below 50,257."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, tokens = [], [], []
        held, number, current = 0, 0, TaskContext.get().partitionId()

        def shard() -> pa.RecordBatch:
            nonlocal ids, counts, tokens, held, number
            data = write_shard(ids, np.concatenate(counts), np.concatenate(tokens))
            row = (current, number, len(ids), held + len(ids), data)
            ids, counts, tokens, held, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _SHARD_TYPES, strict=True)], names=_SHARD)

        for batch in batches:
            encoder = encoder_of(tokenizer)
            for a, b in _slices(batch.column("text"), slice_bytes):
                part = batch.slice(a, b - a)
                found, sizes = encoder(part.column("text"))
                known, ends = part.column("id").to_pylist(), np.cumsum(sizes)
                start = 0
                while start < len(known):
                    # documents until the shard is full, one at least
                    before = int(ends[start - 1]) if start else 0
                    full = int(np.searchsorted(ends, before + shard_tokens - held, side="left")) + 1
                    end = min(max(full, start + 1), len(known))
                    ids += known[start:end]
                    counts.append(sizes[start:end])
                    tokens.append(found[before : int(ends[end - 1])])
                    held += len(tokens[-1])
                    start = end
                    if held >= shard_tokens:
                        yield shard()
                        give_back()
        if ids:
            yield shard()
        give_back()

    shards = in_order(rows, range_bytes).mapInArrow(
        encode, "range long, shard int, documents long, tokens long, data binary"
    )
    # a batch is a slice, with room for the row that fills it
    with arrow_batches(docs.sparkSession, slice_bytes * 15 // 16):
        shards.write.parquet(path)


_SHARD = ["range", "shard", "documents", "tokens", "data"]
_SHARD_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def read_tokens(spark: SparkSession, path: str, with_tokens: bool = True) -> DataFrame:
    """Per document in the shards at `path`: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit numbers), tokens (these,
    null unless asked for)."""
    shards = spark.read.parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for range_, number, data in zip(*(batch.column(c).to_pylist() for c in ("range", "shard", "data")), strict=True):
                shard = Shard(data)
                tokens = shard.all_tokens().astype("<u4")
                ends = np.cumsum(shard.counts, dtype=np.int64)
                starts = ends - shard.counts
                raw = tokens.tobytes()
                parts = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "range": pa.array([range_] * len(parts), pa.int64()),
                        "shard": pa.array([number] * len(parts), pa.int32()),
                        "doc_id": pa.array(shard.ids, pa.int64()),
                        "place": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(shard.counts.astype(np.int64)),
                        "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        "tokens": pa.array(parts if with_tokens else [None] * len(parts), pa.binary()),
                    }
                )

    docs = shards.select("range", "shard", "data").mapInArrow(
        decode, "range long, shard int, doc_id long, place long, n_tokens long, ids_crc32 long, tokens binary"
    )
    begins = running_start(shards.select("range", "shard", F.col("tokens").alias("held")), "range", "shard", "held")
    joined = docs.join(begins.drop("held"), ["range", "shard"])
    return joined.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "tokens")


def token_digests(docs: DataFrame, tokenizer: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per row of `docs(doc_id, text)`, read back from its shards: doc_id, start, n_tokens,
    ids_crc32. Null and empty texts hold the end id only; repeated rows are stored each; an
    empty table gives no rows; other columns are not used."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, slice_bytes=slice_bytes)
    return read_tokens(docs.sparkSession, path, with_tokens=False).drop("tokens")
