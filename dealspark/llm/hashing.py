"""Hashed word features of whole texts in numpy, shared by the classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)  # odd multipliers
BLOCK = 1 << 20  # code points


def points_of(text: str) -> np.ndarray:
    """Code points between two spaces, ASCII white space being a space."""
    c = np.frombuffer(f" {text} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    c[(c >= 9) & (c <= 13)] = 32
    return c


def blocks_of(text: str | None) -> Iterator[str]:
    """The text in blocks of whole words, so that memory stays bounded; a run
    of ``BLOCK`` code points without a space is cut."""
    text, at = text or "", 0
    while len(text) - at > BLOCK:
        to = text.rfind(" ", at + 1, at + BLOCK)
        to = to if to > 0 else at + BLOCK
        yield text[at:to]
        at = to
    yield text[at:] if at else text


def bucket(h: np.ndarray, kind: int, bits: int) -> np.ndarray:
    h = (h ^ np.uint64(kind * 0x632BE59BD9B4E019 & (1 << 64) - 1)) * MIX
    h ^= h >> np.uint64(29)
    return ((h * BASE) >> np.uint64(64 - bits)).astype(np.int64)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_bounds(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one position of each word."""
    space = c == 32
    return np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1


def word_hashes(c: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    if not len(first):
        return np.zeros(0, np.uint64)
    at = np.arange(len(c)) - np.repeat(np.r_[0, first], np.diff(np.r_[0, first, len(c)]))
    terms = np.where(c == 32, np.uint64(0), c * powers(int((stop - first).max()) + 2)[np.minimum(at, int((stop - first).max()) + 1)])
    return np.add.reduceat(terms, first)
