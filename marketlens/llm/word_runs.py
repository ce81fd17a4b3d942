"""Periodic runs of words: a suffix automaton whose suffix links are kept in a link-cut tree.

Words are appended one by one. The prefix just read is a state of the automaton, and the
states on its way to the root along suffix links are its suffixes; every path of the link-cut
tree carries the place where its suffixes ended last. Reading a word makes the way from the
new state to the root one path (access). Each earlier path met on that way gives, by its
deepest state, the longest suffix that ended last at place j; if that suffix is at least as
long as i - j, its two occurrences touch or overlap: a square of period i - j, which begins
i - j before the suffix. While a run goes on, its begin and period stay and its end moves, so
the last end seen is the run's.

What a run holds is decided before: of a run of the wanted length and exponent every window
of `window_size` words occurs once more in the text. Only stretches of such windows are given
to the automaton; every run lies whole in one of them, its neighbouring words included or at
the stretch's end, so none is lost, cut or lengthened.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.shingles import mixed, text_chunks, word_numbers

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
_RANDOM = np.random.Generator(np.random.PCG64(13))
_PLACES = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs(words: list, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run with length >= max(least_length, least_exponent *
    period), by start, then period. `least_exponent` is 2 or more."""
    follow: list[dict] = [{}]  # state 0 is the empty suffix, which no path includes
    size = [0]  # of a state's longest suffix
    link = [-1]
    # link-cut tree: parent in the path's splay tree or, from its root, the path above
    up, left, right = [0], [0], [0]
    ended = [-1]  # valid at roots of splay trees
    ends: dict[tuple[int, int], int] = {}
    factor = least_exponent - 1

    def to_root(x: int) -> None:
        """Makes x the root of its path's splay tree."""
        while True:
            p = up[x]
            if not p:
                return
            if left[p] == x:
                g = up[p]
                if g and left[g] == p:
                    top, ended[x] = up[g], ended[g]
                    a, b = right[p], right[x]
                    left[g], right[p] = a, g
                    if a:
                        up[a] = g
                    up[g] = p
                    left[p], right[x] = b, p
                    if b:
                        up[b] = p
                    up[p] = x
                elif g and right[g] == p:
                    top, ended[x] = up[g], ended[g]
                    a, b = left[x], right[x]
                    right[g], left[p] = a, b
                    if a:
                        up[a] = g
                    if b:
                        up[b] = p
                    left[x], right[x] = g, p
                    up[g] = up[p] = x
                else:
                    ended[x] = ended[p]
                    b = right[x]
                    left[p], right[x] = b, p
                    if b:
                        up[b] = p
                    up[p], up[x] = x, g
                    return
            elif right[p] == x:
                g = up[p]
                if g and right[g] == p:
                    top, ended[x] = up[g], ended[g]
                    a, b = left[p], left[x]
                    right[g], left[p] = a, g
                    if a:
                        up[a] = g
                    up[g] = p
                    right[p], left[x] = b, p
                    if b:
                        up[b] = p
                    up[p] = x
                elif g and left[g] == p:
                    top, ended[x] = up[g], ended[g]
                    a, b = left[x], right[x]
                    right[p], left[g] = a, b
                    if a:
                        up[a] = p
                    if b:
                        up[b] = g
                    left[x], right[x] = p, g
                    up[g] = up[p] = x
                else:
                    ended[x] = ended[p]
                    b = left[x]
                    right[p], left[x] = b, p
                    if b:
                        up[b] = p
                    up[p], up[x] = x, g
                    return
            else:
                return
            up[x] = top
            if top:
                if left[top] == g:
                    left[top] = x
                elif right[top] == g:
                    right[top] = x

    last = 0
    for i, word in enumerate(words):
        # the automaton takes the word
        state = len(size)
        follow.append({})
        size.append(size[last] + 1)
        link.append(0)
        up.append(0)
        left.append(0)
        right.append(0)
        ended.append(-1)
        at = last
        while at != -1 and word not in follow[at]:
            follow[at][word] = state
            at = link[at]
        if at != -1:
            to = follow[at][word]
            if size[to] != size[at] + 1:
                # the shorter suffixes of `to` become a state above it, on the same path
                copy = len(size)
                follow.append(follow[to].copy())
                size.append(size[at] + 1)
                link.append(link[to])
                to_root(to)
                above = left[to]
                up.append(to)
                left.append(above)
                right.append(0)
                ended.append(-1)
                if above:
                    up[above] = copy
                left[to] = copy
                link[to] = copy
                while at != -1 and follow[at].get(word) == to:
                    follow[at][word] = copy
                    at = link[at]
                to = copy
            link[state] = up[state] = to
        last = state
        # access: earlier paths on the way to the root, each with its own last end
        below, here = state, up[state]
        while here:
            to_root(here)
            j = ended[here]
            period = i - j
            length = size[here]
            if length >= factor * period and length + period >= least_length:
                ends[i - length - period + 1, period] = i
            deeper = right[here]
            if deeper:
                ended[deeper] = j
            right[here] = below
            below, here = here, up[here]
        ended[below] = i
        to_root(state)
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def window_size(least_length: int, least_exponent: int) -> int:
    """The most words a window may have so that all windows of every wanted run recur in it:
    a run of period q and length n has that property for windows of n - 2 * q + 1 words."""
    return 1 + min(max(least_length, least_exponent * q) - 2 * q for q in range(1, least_length + 1))


def stretches(numbers: np.ndarray, offsets: np.ndarray, size: int, least_length: int) -> list[list[tuple[int, int]]]:
    """Per text the stretches (first word, word after the last) of windows that occur again in
    the same text. `numbers` are all texts' words, `offsets` where each text's words begin.
    Equal words must have equal numbers; should others too, stretches only get longer."""
    found: list[list[tuple[int, int]]] = [[] for _ in offsets[1:]]
    count = len(numbers) - size + 1
    if count <= 0:
        return found
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = mixed(owner[:count].astype(np.uint64) + np.uint64(1))
    for k in range(size):
        key = key + numbers[k : k + count] * _PLACES[k]
    inside = owner[:count] == owner[size - 1 :]
    place = np.flatnonzero(inside)
    order = np.argsort(key[place])
    ranked = key[place][order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(count, dtype=bool)
    again[place[order]] = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    begin = np.flatnonzero(again & np.concatenate(([True], ~again[:-1] | (owner[1:count] != owner[: count - 1]))))
    end = 1 + np.flatnonzero(again & np.concatenate((~again[1:] | (owner[1:count] != owner[: count - 1]), [True])))
    end = end + size - 1
    wide = end - begin >= least_length
    for b, e, text in zip(begin[wide].tolist(), end[wide].tolist(), owner[begin[wide]].tolist(), strict=True):
        start = int(offsets[text])
        found[text].append((b - start, e - start))
    return found


def text_runs(texts: list[bytes], least_length: int, least_exponent: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Per text its runs, and the text of the words that stay, joined by one space."""
    size = window_size(least_length, least_exponent)
    for first, last in text_chunks(texts):
        numbers, offsets = word_numbers(texts[first:last])
        areas = stretches(numbers, offsets, size, least_length)
        for text, parts in zip(texts[first:last], areas, strict=True):
            words = text.split()
            found = [
                (b + start, length, period)
                for b, e in parts
                for start, length, period in runs(words[b:e], least_length, least_exponent)
            ]
            found.sort()
            if found:
                keep = bytearray(b"\x01") * len(words)
                for start, length, period in found:
                    keep[start + period : start + length] = bytes(length - period)
                words = compress(words, keep)
            yield found, b" ".join(words)


def collapse_runs(
    docs: DataFrame, text_col: str = "text", least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> DataFrame:
    """`docs` with `runs`, an array of (start, length, period) by start, then period, and
    `collapsed`: the words no run holds after its first period, joined by one space.

    Words are the longest stretches without 0x20 and 0x09-0x0D, numbered from 0; a run is a
    stretch of words with its smallest period, as long as it can be, of length
    `least_length` and `least_exponent` periods at least. Null and empty texts have no runs
    and an empty `collapsed`; rows are judged one by one, so repeated ones agree; columns
    `runs` and `collapsed` of `docs` are replaced. An automaton takes about a kilobyte of
    memory per word of the longest stretch of recurring windows.
    """
    docs = docs.drop("runs", "collapsed")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).cast(pa.binary()).fill_null(b"").to_pylist()
            found, kept = [], []
            for spans, text in text_runs(texts, least_length, least_exponent):
                found.append([{"start": s, "length": n, "period": q} for s, n, q in spans])
                kept.append(text)
            yield batch.append_column("runs", pa.array(found, kind)).append_column(
                "collapsed", pa.array(kept, pa.binary()).cast(pa.string())
            )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    made = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return docs.mapInArrow(run, f"{columns}, {made}")


def longest_run(runs_col: str = "runs") -> Column:
    """Of the runs by start, the one of greatest length / period, compared exactly; of equal
    ones the first, then that of least period; null if there are none."""
    return F.reduce(
        F.col(runs_col),
        F.get(F.col(runs_col), F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
