"""Words and word shingles of whole texts as 64-bit numbers, computed column-wise with numpy.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text, A-Z
lower-cased. Its number is a sum of one random number per byte times a power of an odd
number, taken modulo 2**64, mixed once more; equal words have equal numbers, and different
ones differ but for a chance of about 2**-50 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240917))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _byte_numbers() -> tuple[np.ndarray, np.ndarray]:
    numbers = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    numbers[65:91] = numbers[97:123]
    blank = np.zeros(256, dtype=bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    return numbers, blank


_BYTES, _BLANK = _byte_numbers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of `x`."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(texts: list[bytes], limit: int = 1 << 21, most: int = 1 << 31) -> Iterator[tuple[int, int]]:
    """Ranges of `texts` of about `limit` bytes and at most `most` texts each, one at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and (held + len(text) > limit or i - start >= most):
            yield start, i
            start, held = i, 0
        held += len(text)
    if texts:
        yield start, len(texts)


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' numbers of all texts in a row, and where each text's words begin
    (one more entry than texts)."""
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    blank = _BLANK[joined]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    begins = np.concatenate(([0], np.cumsum(lengths)))
    offsets = np.searchsorted(start, begins)
    powers = np.full(len(joined) + 1, _ODD, dtype=np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    part = _BYTES[joined] * powers[:-1]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)))
    # dividing by the power at the word's start makes the number independent of its place
    inverse = np.full(len(joined) + 1, np.uint64(pow(int(_ODD), -1, 2**64)), dtype=np.uint64)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    return mixed((sums[end] - sums[start]) * inverse[start]), offsets


# text that is numbered at a time: some forty times as many bytes of numbers are held meanwhile
CHUNK_BYTES = 1 << 19


def shingle_sets(texts: list[bytes], size: int = 5) -> Iterator[np.ndarray]:
    """Per text its distinct shingles of `size` words, sorted; the whole word sequence as
    the only one if there are fewer words, none without words."""
    for first, last in text_chunks(texts, CHUNK_BYTES):
        words, offsets = word_numbers(texts[first:last])
        total = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
        for k in range(size):
            total += words[k : len(words) - size + 1 + k] * _PLACES[k]
        total = mixed(total)
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if hi - lo >= size:
                yield np.unique(total[lo : hi - size + 1])
            elif hi > lo:
                short = (words[lo:hi] * _PLACES[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
                yield mixed(np.array([short], dtype=np.uint64))
            else:
                yield np.empty(0, dtype=np.uint64)
