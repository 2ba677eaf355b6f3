"""Splits texts before the merges of byte-level BPE, many texts at once.

The splitting pattern is the well-known one: contractions, runs of letters, of digits or
of other signs, each with one space before it, and white space. All of it is a matter of
where the class of a character changes, so numpy finds the cuts. Characters that
different versions of Unicode class differently are left to a slow, exact splitter that
the caller names.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable

import numpy as np

from .kernel import span_hashes

OTHER, LETTER, DIGIT, SPACE, UNSURE, SPECIAL = range(6)

# The characters of Unicode's property White_Space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# What may follow an apostrophe as a contraction.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def classes() -> np.ndarray:
    """The class of each code point.

    What Unicode 3.2 had has kept its class since. Later letters and digits, and what
    is not assigned yet, count as unsure: libraries differ in them.
    """
    old = unicodedata.ucd_3_2_0
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        now = unicodedata.category(chr(i))[0]
        if now in "LN":
            known = old.category(chr(i))[0] == now
            out[i] = (LETTER if now == "L" else DIGIT) if known else UNSURE
    assigned = np.array([unicodedata.category(chr(i)) != "Cn" for i in range(0x110000)])
    out[~assigned] = UNSURE
    out[WHITE] = SPACE
    return out


def _decode(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points, and the byte at which each starts (with the end)."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.zeros(len(points) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    return points, at


def _occurrences(data: np.ndarray, offsets: np.ndarray, special: bytes) -> list[int]:
    raw, found, at = data.tobytes(), [], 0
    while (at := raw.find(special, at)) >= 0:
        end = offsets[np.searchsorted(offsets, at, "right")]
        if at + len(special) <= end:
            found.append(at)
            at += len(special)
        else:
            at += 1
    return found


def split(
    data: np.ndarray,
    offsets: np.ndarray,
    exact: Callable[[str], list[str]],
    special: bytes | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all pre-tokens in bytes, and each text's first pre-token.

    `exact` splits a text with unsure characters. An occurrence of `special` is a
    pre-token of its own, and what is around it is split by itself.
    """
    points, at = _decode(data)
    n = len(points)
    kind = classes()[points]
    edge = np.zeros(n + 1, bool)
    text_at = np.searchsorted(at, offsets)
    edge[text_at] = True
    if special:
        for b in _occurrences(data, offsets, special):
            i, j = np.searchsorted(at, [b, b + len(special)])
            kind[i:j] = SPECIAL
            edge[[i, j]] = True
    unsure = np.unique(np.searchsorted(text_at, np.flatnonzero(kind == UNSURE), "right") - 1)

    run = edge[:-1].copy()
    run[1:] |= kind[1:] != kind[:-1]
    last = edge[1:].copy()
    last[:-1] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    cut = run.copy()
    cut |= white & last & ~edge[1:]
    joined = (points == 0x20) & ~edge[1:]
    cut[1:] &= ~(joined[:-1] & ~white[1:] & (kind[1:] != SPECIAL))

    mark = np.flatnonzero((points == 0x27) & run & last & cut & ~edge[1:])
    mark = mark[kind[np.minimum(mark + 1, n - 1)] == LETTER]
    if len(mark):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        within = ~np.concatenate([edge, np.ones(2, bool)])
        long = np.zeros(len(mark), np.int64)
        for ending in CONTRACTIONS:
            hit = padded[mark + 1] == ord(ending[0])
            if len(ending) == 2:
                hit &= within[mark + 2] & (padded[mark + 2] == ord(ending[1]))
            long[hit] = np.maximum(long[hit], len(ending))
        mark, long = mark[long > 0], long[long > 0]
        cut[mark + 1] = False
        after = mark + 1 + long
        inner = after[(after < n)]
        inner = inner[(kind[inner] == LETTER) & ~edge[inner]]
        cut[inner] = True

    starts = at[:-1][cut]
    if len(unsure):
        pieces = [starts]
        drop = np.zeros(len(starts), bool)
        for d in unsure:
            lo, hi = offsets[d], offsets[d + 1]
            drop[np.searchsorted(starts, lo) : np.searchsorted(starts, hi)] = True
            sizes = [len(p.encode()) for p in _exact(data[lo:hi].tobytes().decode(), exact, special)]
            pieces.append(lo + np.cumsum([0, *sizes[:-1]]))
        pieces[0] = starts[~drop]
        starts = np.sort(np.concatenate(pieces))
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


def _exact(text: str, exact: Callable[[str], list[str]], special: bytes | None) -> list[str]:
    if not special or (mark := special.decode()) not in text:
        return exact(text)
    out = []
    for i, part in enumerate(text.split(mark)):
        out += [mark] * (i > 0) + (exact(part) if part else [])
    return out


def distinct(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first place of each distinct span, and the number of it for every span."""
    hashes = span_hashes(data, starts, ends)
    found, place, number = np.unique(hashes, return_index=True, return_inverse=True)
    return found, place, number
