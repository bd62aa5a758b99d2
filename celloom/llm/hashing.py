"""Vectorised word and shingle hashes of whole texts, for use inside tasks.

A hash of a byte range is a polynomial over a fixed random value per byte,
modulo 2**64, from one running sum over the text; ranges starting anywhere
compare because the sum is multiplied by the inverse power of its start.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
#: Texts are hashed in groups of about this many bytes.
GROUP_BYTES = 1 << 20

#: Bytes 0x20 and 0x09-0x0D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_CUT = re.compile(rb"[\x20\x09-\x0D]")

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, factor in enumerate((_BASE, _INVERSE)):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def lower_ascii() -> np.ndarray:
    """Byte values with A-Z as a-z."""
    table = np.arange(256)
    table[65:91] += 32
    return _BYTE[table]


LOWERED = lower_ascii()
PLAIN = _BYTE


def running(data: np.ndarray, values: np.ndarray = PLAIN) -> np.ndarray:
    """Running polynomial sums, one more than there are bytes."""
    power, _ = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * power[: len(data)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, equal where the bytes are."""
    _, inverse = _power_tables(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Words(NamedTuple):
    """Words of a group of texts: bytes, their running sums, and each word's place and hash."""

    data: np.ndarray
    sums: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray


def _words(data: bytes, separators: np.ndarray, values: np.ndarray) -> Words:
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~separators[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = running(raw, values)
    return Words(raw, sums, starts, ends, range_hashes(sums, starts, ends))


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut at white space; the pieces' words are the text's words."""
    at = 0
    while len(text) - at > GROUP_BYTES:
        cut = _CUT.search(text, at + GROUP_BYTES)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def grouped_words(
    texts: Iterable[bytes], separators: np.ndarray = SPACES, values: np.ndarray = PLAIN
) -> Iterator[tuple[int, Words, np.ndarray]]:
    """Words by groups of texts: the first text's index, the words, and where each text's begin and end.

    A long text comes alone and in pieces, each with the text's index.
    """
    group: list[bytes] = []
    size, first = 0, 0

    def flush() -> tuple[int, Words, np.ndarray]:
        words = _words(b"\n".join(group), separators, values)
        offsets = np.cumsum([0, *(len(t) + 1 for t in group)])
        return first, words, np.searchsorted(words.starts, offsets)

    for index, text in enumerate(texts):
        if len(text) > GROUP_BYTES:
            if group:
                yield flush()
            for piece in _pieces(text):
                words = _words(piece, separators, values)
                yield index, words, np.array([0, len(words.starts)])
            group, size, first = [], 0, index + 1
            continue
        group.append(text)
        size += len(text) + 1
        if size >= GROUP_BYTES:
            yield flush()
            group, size, first = [], 0, index + 1
    if group:
        yield flush()


def word_hashes(texts: Iterable[bytes], separators: np.ndarray = SPACES, values: np.ndarray = PLAIN) -> Iterator[np.ndarray]:
    """The word hashes of each text in turn."""
    held, index = [], 0
    for first, words, at in grouped_words(texts, separators, values):
        if held and first != index:
            yield np.concatenate(held)
            held = []
        index = first
        if len(at) == 2:
            held.append(words.hashes)
            continue
        for k in range(len(at) - 1):
            yield words.hashes[at[k] : at[k + 1]]
    if held:
        yield np.concatenate(held)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of `width` words, in order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, width):
        total *= _BASE
        total += hashes[k : n + k]
    return mix(total + U64(width))


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than the width are one shingle, none are none."""
    return np.unique(windows(hashes, min(width, len(hashes)) or 1))


def as_bytes(column) -> list[bytes]:
    """The values of an Arrow binary column, null as empty."""
    return [b"" if v is None else v for v in column.to_pylist()]
