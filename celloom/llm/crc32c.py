"""CRC-32C of many records at once, and its masked form, for use inside tasks.

Records are runs of 32-bit words. Each is cut into pieces of equal length, the
first one filled up with zeros in front, which leave a checksum that starts at
zero as it is. All pieces advance together, a word a step; then the pieces of a
record are joined, the checksum of what is before moved on by a piece's length.
"""

from __future__ import annotations

import numpy as np

U32 = np.uint32
_POLYNOMIAL = 0x82F63B78
#: Words in a piece.
_PIECE = 64
# Fixed value: what masked checksums add, after turning by 15 bits.
_MASK = U32(0xA282EAD8)


def _one_byte() -> np.ndarray:
    table = np.arange(256, dtype=U32)
    for _ in range(8):
        table = np.where(table & U32(1), (table >> U32(1)) ^ U32(_POLYNOMIAL), table >> U32(1))
    return table


def _after_word() -> np.ndarray:
    """For each of a word's four bytes, the checksum it leaves once the word has gone through."""
    tables = [_one_byte()]
    for _ in range(3):
        tables.append((tables[-1] >> U32(8)) ^ tables[0][tables[-1] & U32(255)])
    return np.stack(tables[::-1])


_WORD = _after_word()


def _through(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    return (
        tables[0][state & U32(255)]
        ^ tables[1][(state >> U32(8)) & U32(255)]
        ^ tables[2][(state >> U32(16)) & U32(255)]
        ^ tables[3][state >> U32(24)]
    )


def _after_piece() -> np.ndarray:
    """For each byte of a checksum, what is left of it after a piece of zeros."""
    state = (np.arange(256, dtype=U32)[None, :] << (U32(8) * np.arange(4, dtype=U32)[:, None])).ravel()
    for _ in range(_PIECE):
        state = _through(_WORD, state)
    return state.reshape(4, 256)


_SHIFT = _after_piece()


def crc32c(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32C of records of at least one word, as slices of an array of little-endian 32-bit words."""
    if not len(starts):
        return np.zeros(0, U32)
    pieces = -(-lengths // _PIECE)
    ends = np.cumsum(pieces)
    padded = np.zeros(int(ends[-1]) * _PIECE, U32)
    first = ends * _PIECE - lengths  # where each record starts once filled up in front
    at = np.repeat(first - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(int(lengths.sum()))
    padded[at] = words[np.repeat(starts, lengths) + at - np.repeat(first, lengths)]
    padded[first] ^= U32(0xFFFFFFFF)  # a checksum starts with all bits set
    columns = np.ascontiguousarray(padded.reshape(-1, _PIECE).T)
    state = np.zeros(columns.shape[1], U32)
    for column in columns:
        state = _through(_WORD, state ^ column)
    # records with the most pieces first: those that still have a piece are in front
    order = np.argsort(-pieces, kind="stable")
    begin, count = (ends - pieces)[order], pieces[order]
    joined = state[begin]
    for k in range(1, int(count[0])):
        still = np.searchsorted(-count, -k, side="left")
        joined[:still] = _through(_SHIFT, joined[:still]) ^ state[begin[:still] + k]
    out = np.empty(len(order), U32)
    out[order] = joined ^ U32(0xFFFFFFFF)
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    """Turned and moved, so that a checksum of data that holds checksums stays sound."""
    return ((crc >> U32(15)) | (crc << U32(17))) + _MASK
