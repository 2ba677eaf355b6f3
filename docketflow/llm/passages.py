"""Removes passages that repeat across documents, by doubling the length that repeats.

A window is `window` consecutive words of one document. Windows of half that length come
first, and of these only one for each whole window, the one of least hash in it: equal
windows have equal ones. Where no other document holds that half, the window cannot
repeat. What repeats at half the length alone is extended to the whole: the hashes of
those windows travel, and the least id of a document that holds each comes back. If
nothing survives the first length, the second has nothing to do.

Documents stay in blocks (`blocks.py`); per block, a hash travels once however many of its
documents hold it, so copies by the thousand and passages in every document cost little
more than one. Hashes have 64 bits.

Defined results: a null or empty text has no words, and of fewer than `window` words
nothing is removed. Equal rows give equal rows; documents of the same id do not take words
from each other. A null id is after every other: such a document loses what any other
holds. A table without rows gives none. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import discard
from . import blocks, kernel

#: Buckets of hashes at least; a bucket's distinct ones must fit in a task.
BUCKETS = 64
_LAST = np.iinfo(np.int64).max


def least_of_runs(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each run of `size` values in a row."""
    n = len(values)
    if n < size:
        return np.zeros(0, values.dtype)
    rows = -(-n // size)
    padded = np.full(rows * size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(rows, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - size + 1], ahead[size - 1 : n])


def _ids(column: pa.Array) -> np.ndarray:
    return blocks.numbers(column.cast(pa.int64()).fill_null(_LAST))


class _Words:
    """The words of a block's documents and where their windows start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        starts, ends, self.first = kernel.words(data, offsets)
        self.hashes = kernel.span_hashes(data, starts, ends)
        counts = np.maximum(np.diff(self.first) - window + 1, 0)
        self.of = np.repeat(np.arange(len(counts)), counts)
        self.window_first = np.concatenate([[0], np.cumsum(counts)])
        self.at = np.arange(len(self.of)) + np.repeat(self.first[:-1] - self.window_first[:-1], counts)

    def halves(self, window: int) -> np.ndarray:
        """For each window, the least hash of its parts of half the length."""
        half = -(-window // 2)
        at, found = kernel.run_hashes(self.hashes, self.first, half)
        number = np.full(len(self.hashes) + 1, -1)
        number[at] = np.arange(len(at))
        return least_of_runs(found, window - half + 1)[number[self.at]] if len(self.at) else found[:0]


def _distinct(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of each hash, and each distinct one with its least and greatest id."""
    number, found = pd.factorize(hashes)
    low, high = np.full(len(found), _LAST), np.full(len(found), np.iinfo(np.int64).min)
    np.minimum.at(low, number, ids)
    np.maximum.at(high, number, ids)
    return number, found, low, high


def _by_bucket(found: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    return [(start, at[np.argsort(found[at])]) for start, at in blocks.in_buckets((found % np.uint64(buckets)).astype(np.int64))]


def _entries(found: np.ndarray, low: np.ndarray, high: np.ndarray | None, buckets: int) -> list[tuple[int, int, bytes]]:
    out = []
    for start, at in _by_bucket(found, buckets):
        more = {} if high is None else {"more": blocks.narrow((high[at] - low[at]).astype(np.uint64))}
        step = np.diff(found[at], prepend=np.uint64(0))
        payload = blocks.pack(step=step, low=blocks.narrow(low[at].astype(np.uint64)), **more)
        out.append((int(found[at[0]] % np.uint64(buckets)), start, payload))
    return out


def _read(part: dict[str, pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = blocks.numbers(part["low"]).astype(np.int64)
    more = blocks.numbers(part["more"]).astype(np.int64) if "more" in part else np.zeros(len(low), np.int64)
    return np.cumsum(blocks.numbers(part["step"]).astype(np.uint64)), low, low + more


def _add(parts: list[dict[str, pa.Array]]) -> bytes:
    """Least and greatest id of each hash over parts of a bucket."""
    hashes, low, high = (np.concatenate(x) for x in zip(*map(_read, parts)))
    order = np.argsort(hashes, kind="stable")
    hashes, low, high = hashes[order], low[order], high[order]
    begin = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    low, high = np.minimum.reduceat(low, begin), np.maximum.reduceat(high, begin)
    more = {"more": blocks.narrow((high - low).astype(np.uint64))} if "more" in parts[0] else {}
    return blocks.pack(step=np.diff(hashes[begin], prepend=np.uint64(0)), low=blocks.narrow(low.astype(np.uint64)), **more)


def _spread(total: dict[str, pa.Array]) -> bytes:
    """Of a total only the hashes that documents of several ids hold."""
    hashes, low, high = _read(total)
    return blocks.pack(step=np.diff(hashes[low < high], prepend=np.uint64(0)))


def _repeats(bucket: int, total: dict[str, pa.Array] | None):
    known = np.cumsum(blocks.numbers(total["step"]).astype(np.uint64))
    return lambda part: blocks.pack(repeats=np.packbits(np.isin(_read(part)[0], known)))


def _least(bucket: int, total: dict[str, pa.Array] | None):
    known, low, _ = _read(total)
    return lambda part: blocks.pack(low=blocks.narrow(low[np.searchsorted(known, _read(part)[0])].astype(np.uint64)))


def _digest(text: bytes, gone: np.ndarray | None = None) -> tuple[int, str]:
    """Words removed, and the hash of those kept, joined by one space."""
    words = text.split()
    if gone is not None:
        words = list(itertools.compress(words, ~gone))
    return (0 if gone is None else int(gone.sum())), hashlib.sha256(b" ".join(words)).hexdigest()


def remove_repeats(
    df: DataFrame, window: int = 50, doc_id: str = "doc_id", text: str = "text", kept: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256), with the words kept as text if wanted.

    A word goes if a window that covers it also starts in a document with a smaller id.
    `buckets` deals the hashes; without it there are `BUCKETS`, or more by the bytes of the texts.
    """
    if window < 2:
        raise ValueError("a window has at least two words")
    buckets = buckets or blocks.buckets_for(df, text, BUCKETS)

    def texts(own: dict[str, pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        offsets = np.concatenate([[0], np.cumsum(blocks.numbers(own["size"]).astype(np.int64))])
        return blocks.numbers(own["data"]), offsets, _ids(own["doc_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = blocks.numbered()
        for batch in batches:
            ids, column = batch.columns
            data, offsets = kernel.text_bytes(column)
            for a, b in kernel.chunks(offsets, blocks.BLOCK_BYTES):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                words = _Words(part, at, window)
                halves = words.halves(window)
                fresh = np.append(True, (halves[1:] != halves[:-1]) | (words.of[1:] != words.of[:-1]))[: len(halves)]
                own = ids.slice(a, b - a)
                _, found, low, high = _distinct(halves[fresh], _ids(own)[words.of[fresh]])
                home = blocks.pack(doc_id=own, size=blocks.narrow(np.diff(at)), data=part)
                yield blocks.rows(next(number), home, _entries(found, low, high, buckets))

    def extend(block: int, own: dict[str, pa.Array], found: list[tuple[int, dict[str, pa.Array]]]) -> pa.RecordBatch:
        """What repeats at half the length, at the whole; documents without it are done."""
        data, offsets, ids = texts(own)
        words = _Words(data, offsets, window)
        number, distinct, _, _ = _distinct(words.halves(window), ids[words.of])
        repeats = np.zeros(len(distinct), bool)
        places = dict(_by_bucket(distinct, buckets))
        for start, got in found:
            at = places[start]
            repeats[at] = np.unpackbits(blocks.numbers(got["repeats"]), count=len(at)).astype(bool)
        live = repeats[number]
        whole = window_hashes(words)[live]
        _, distinct, low, _ = _distinct(whole, ids[words.of[live]])
        goes_on = np.bincount(words.of[live], minlength=len(ids)) > 0
        n_words = np.diff(words.first)
        raw = data.tobytes()
        done = [None if goes_on[d] else _digest(raw[offsets[d] : offsets[d + 1]])[1] for d in range(len(ids))]
        rest = np.repeat(goes_on, np.diff(offsets)) if not kept else np.ones(len(data), bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], live.astype(np.int8), [0]])))
        home = blocks.pack(
            doc_id=own["doc_id"], size=blocks.narrow(np.diff(offsets)), goes_on=goes_on, n_words=blocks.narrow(n_words),
            done=pa.array(done, pa.string()), data=data[rest], edges=blocks.narrow(np.diff(edges, prepend=0)),
        )
        return blocks.rows(block, home, _entries(distinct, low, None, buckets))

    def window_hashes(words: _Words) -> np.ndarray:
        return kernel.run_hashes(words.hashes, words.first, window)[1]

    def finish(block: int, own: dict[str, pa.Array], found: list[tuple[int, dict[str, pa.Array]]]) -> pa.RecordBatch:
        goes_on = blocks.numbers(own["goes_on"])
        ids = _ids(own["doc_id"])
        size = blocks.numbers(own["size"]).astype(np.int64)
        if not kept:
            size = size * goes_on
        offsets = np.concatenate([[0], np.cumsum(size)])
        data = blocks.numbers(own["data"])
        words = _Words(data, offsets, window)
        edges = np.cumsum(blocks.numbers(own["edges"]).astype(np.int64))
        first_of_all = np.maximum(blocks.numbers(own["n_words"]).astype(np.int64) - window + 1, 0)
        live = np.zeros(int(first_of_all.sum()), bool)
        for a, b in zip(edges[::2], edges[1::2]):
            live[a:b] = True
        if not kept:
            live = live[np.repeat(goes_on, first_of_all)]
        place = np.flatnonzero(live)
        number, distinct, _, _ = _distinct(window_hashes(words)[place], ids[words.of[place]])
        low = np.full(len(distinct), _LAST)
        places = dict(_by_bucket(distinct, buckets))
        for start, got in found:
            low[places[start]] = blocks.numbers(got["low"]).astype(np.int64)
        goes = place[low[number] < ids[words.of[place]]]
        cover = np.zeros(len(words.hashes) + window + 1, np.int64)
        np.add.at(cover, words.at[goes], 1)
        np.add.at(cover, words.at[goes] + window, -1)
        gone = np.cumsum(cover)[: len(words.hashes)] > 0
        raw = data.tobytes()
        removed, digest, texts_kept = [], [], []
        for d, done in enumerate(own["done"].to_pylist()):
            mask = gone[words.first[d] : words.first[d + 1]]
            n, value = (0, done) if done is not None else _digest(raw[offsets[d] : offsets[d + 1]], mask)
            removed.append(n)
            digest.append(value)
            if kept:
                left = itertools.compress(raw[offsets[d] : offsets[d + 1]].split(), ~mask)
                texts_kept.append(b" ".join(left).decode())
        columns = [own["doc_id"], pa.array(blocks.numbers(own["n_words"]).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if kept:
            columns, names = [*columns, pa.array(texts_kept, pa.string())], [*names, "kept"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    kind = df.schema[doc_id].dataType.simpleString()
    staged = blocks.stage(df.select(doc_id, text).mapInArrow(cut, blocks.SCHEMA), "passages-half")
    n_blocks = blocks.homes(staged).count()
    answers = blocks.answered(staged, n_blocks, _add, _repeats, _spread)
    half, staged = staged, blocks.stage(blocks.bring_home(blocks.homes(staged), answers, extend, blocks.SCHEMA), "passages-whole")
    discard(half, answers)
    answers = blocks.answered(staged, n_blocks, _add, _least)
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * kept
    return blocks.bring_home(blocks.homes(staged), answers, finish, schema)
