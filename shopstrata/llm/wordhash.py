"""Vectorised words and shingles of one text, for Arrow batches inside tasks.

Words are hashed, not built as strings: a text costs a few numpy passes over its
UTF-8 bytes. The hash of a word is a polynomial in its bytes modulo 2**64, taken from
prefix sums, and then mixed together with the word's length.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _byte_table(separators: bytes) -> np.ndarray:
    """Lower-cases A-Z and turns separators into 0, which is no word byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(separators)] = 0
    return table


# Words between the six blanks; NUL is a word character there, so it gets a byte that UTF-8 never uses.
BLANK_WORDS = _byte_table(b" \t\n\x0b\f\r")
BLANK_WORDS[0] = 0xFF
# Words of ASCII letters, digits and all non-ASCII characters.
ALNUM_WORDS = _byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) >= n:
        return
    n = max(n, 2 * len(_powers), 1 << 16)
    with np.errstate(over="ignore"):
        _powers = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _BASE, dtype=np.uint64)]))
        back = np.full(n - 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        _inverse = np.cumprod(np.concatenate([[_U(1)], back]))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = data != 0
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    _grow(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(data * _powers[: len(data)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * _inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends


def words(text: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes and end bytes of the words of a text of any length.

    Long texts are cut at separators, so that the work arrays stay near one megabyte
    a piece; only a single word longer than that makes them grow.
    """
    data = table[np.frombuffer(text, dtype=np.uint8)]
    if len(data) <= PIECE:
        return _piece(data)
    found, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and data[end - 1] != 0:
            gap = np.flatnonzero(data[end : end + PIECE] == 0)
            end = end + int(gap[0]) + 1 if len(gap) else min(end + PIECE, len(data))
        hashes, starts, ends = _piece(data[at:end])
        found.append((hashes, starts + at, ends + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; empty if there are fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.full(n, size, dtype=np.uint64)
        for j in range(size):
            total = total * _U(_BASE) + hashes[j : j + n]
    return mix(total)
