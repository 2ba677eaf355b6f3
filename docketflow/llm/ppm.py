"""Scores texts by prediction by partial matching, learned from part of the corpus.

A text is its words in lower case, each followed by one space, then an end. A trie of
byte contexts up to `ORDER` long predicts each byte: the longest known context gives the
symbol a share (c - e) / n of its counts, or escapes with e d / n, d being its distinct
symbols, to the next shorter one, where the symbols of the longer context no longer count
(symbol exclusion). What no context knows is even over the symbols left.

The longest contexts count every occurrence, a shorter one each symbol once per longer
context that holds it. That is what counting only up to the context that knew the symbol
(update exclusion) comes to, and does not depend on the order in which texts come, so any
number of tasks can learn at once. Contexts with the same last two bytes lie in the same
bucket, with all of the trie above them; the two shortest orders have at most 256 x 257
counts and go to every task.

The base score beside it is a word model, (c + 1) / (N + V + 1) per token.

Learning and scoring both go by blocks (`blocks.py`): a block's distinct contexts and
words travel, not its text; counts are summed by a tree of tasks.

Defined results: a null or empty text is only its end. Equal rows give equal rows; equal
ids are not merged. A null id counts as not held out. A table without rows gives none.
Where nothing is learned from, every symbol has an even chance.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks, kernel

#: Bytes of the longest context.
ORDER = 5
#: e above: what each distinct symbol gives to the escape; 0.5 is method D. 0.2 to 0.5 score
#: within 1% of each other on held-out texts.
ESCAPE = 0.3
END = 256
SYMBOLS = 257
#: Buckets of contexts; as many more hold words. A bucket's counts must fit in a task:
#: take more where a corpus has more than some hundred million different contexts.
BUCKETS = 64


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << (9 + 8 * order)) - 1)


def canonical(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's words with one space after each, and where each text begins."""
    size = ends - starts
    after = np.cumsum(size + 1)
    at = after - size - 1
    out = np.full(int(after[-1]) if len(after) else 0, 32, np.uint8)
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + within] = data[np.repeat(starts, size) + within]
    return out, np.append(at, len(out))[first]


def events(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, symbol) of every symbol as one number, and each text's first; ends included.

    The context fills the upper bytes, its last byte lowest; before a text there are zeros.
    """
    n = len(offsets) - 1
    symbol = np.empty(len(text) + n, np.uint16)
    ends = offsets[1:] + np.arange(n)
    symbol[np.arange(len(text)) + np.repeat(np.arange(n), np.diff(offsets))] = text
    symbol[ends] = END
    first = np.append(offsets[:-1] + np.arange(n), len(symbol))
    key = symbol.astype(np.uint64)
    for k in range(1, ORDER + 1):
        before = symbol[:-k].astype(np.uint64)
        before <<= np.uint64(9 + 8 * (k - 1))
        # The first k symbols of a text have nothing of it that far before them.
        for j in range(k):
            at = first[:-1] + j - k
            before[at[(at >= 0) & (at + k < first[1:])]] = 0
        key[k:] |= before
    return key, first


def bucket_of(keys: np.ndarray) -> np.ndarray:
    suffix = (keys >> np.uint64(9)) & np.uint64(0xFFFF)
    return (kernel.mix(suffix) % np.uint64(BUCKETS)).astype(np.int64)


class Trie:
    """Counts and shares of all contexts of one bucket, and of the two shortest orders."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, short: np.ndarray):
        """`short`: for byte and symbol, how many two-byte contexts with it hold the symbol."""
        self.levels: list[dict[str, np.ndarray]] = []
        for order in range(ORDER, 1, -1):
            self._level(keys, counts)
            if order > 2:
                keys, counts = np.unique(keys & _mask(order - 1), return_counts=True)
        byte, symbol = np.nonzero(short)
        self._level((byte.astype(np.uint64) << np.uint64(9)) | symbol.astype(np.uint64), short[byte, symbol])
        held = (short > 0).sum(axis=0)
        self._level(np.flatnonzero(held).astype(np.uint64), held[held > 0])
        for order, longer, shorter in zip(range(ORDER - 1, -1, -1), self.levels, self.levels[1:]):
            if len(longer["keys"]):
                place = np.searchsorted(shorter["keys"], longer["keys"] & _mask(order))
                longer["shared"] = np.add.reduceat(shorter["counts"][place], longer["begin"])

    def _level(self, keys: np.ndarray, counts: np.ndarray) -> None:
        context = keys >> np.uint64(9)
        begin = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(keys) else np.zeros(0, np.int64)
        total = np.add.reduceat(counts, begin) if len(keys) else np.zeros(0, np.int64)
        distinct = np.diff(np.append(begin, len(keys)))
        self.levels.append({"keys": keys, "counts": counts, "begin": begin, "context": context[begin],
                            "total": total, "distinct": distinct, "shared": np.zeros(len(begin), np.int64)})

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """The log10 probability of each event."""
        out = np.zeros(len(keys))
        live = np.arange(len(keys))
        off_total, off_distinct = np.zeros(len(keys)), np.zeros(len(keys))
        for order, level in zip(range(ORDER, -1, -1), self.levels):
            if not len(level["keys"]) or not len(live):
                continue
            own = keys[live] & _mask(order)
            at = np.minimum(np.searchsorted(level["context"], own >> np.uint64(9)), len(level["context"]) - 1)
            has = level["context"][at] == own >> np.uint64(9)
            total = level["total"][at] - off_total
            distinct = level["distinct"][at] - off_distinct
            place = np.minimum(np.searchsorted(level["keys"], own), len(level["keys"]) - 1)
            hit = has & (level["keys"][place] == own)
            out[live[hit]] += np.log10((level["counts"][place[hit]] - ESCAPE) / total[hit])
            escape = has & ~hit & (distinct > 0)
            out[live[escape]] += np.log10(ESCAPE * distinct[escape] / total[escape])
            off_total = np.where(has, level["shared"][at], 0)[~hit]
            off_distinct = np.where(has, level["distinct"][at], 0)[~hit]
            live = live[~hit]
        out[live] -= math.log10(SYMBOLS - len(self.levels[-1]["keys"])) if len(live) else 0
        return out


class _Block:
    """A block's distinct events and words, each in order of bucket."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.starts, self.ends, self.first = kernel.words(data, offsets)
        self.data = data
        text, at = canonical(data, self.starts, self.ends, self.first)
        keys, self.event_first = events(text, at)
        self.event, self.keys = pd.factorize(keys)
        self.event = self.event.astype(np.int32)
        self.events = [(start, at[np.argsort(self.keys[at])]) for start, at in blocks.in_buckets(bucket_of(self.keys))]
        hashes = kernel.span_hashes(data, self.starts, self.ends)
        self.word, self.hashes = pd.factorize(hashes)
        self.words = list(blocks.in_buckets((self.hashes % np.uint64(BUCKETS)).astype(np.int64)))

    def entries(self, learned: np.ndarray) -> list[tuple[int, int, bytes]]:
        """What travels; `learned` tells which texts are learned from."""
        out = []
        counts = np.bincount(self.event[np.repeat(learned, np.diff(self.event_first))], minlength=len(self.keys))
        for start, at in self.events:
            keys = self.keys[at]
            step = np.diff(keys, prepend=np.uint64(0))
            payload = blocks.pack(step=blocks.narrow(step), n=blocks.narrow(counts[at]))
            out.append((int(bucket_of(keys[:1])[0]), start, payload))
        counts = np.bincount(self.word[np.repeat(learned, np.diff(self.first))], minlength=len(self.hashes))
        place = np.zeros(len(self.hashes), np.int64)
        place[self.word[::-1]] = np.arange(len(self.word))[::-1]
        raw = self.data.tobytes()
        for start, at in self.words:
            words = [raw[a:b] for a, b in zip(self.starts[place[at]], self.ends[place[at]])]
            payload = blocks.pack(word=pa.array(words, pa.binary()), n=blocks.narrow(counts[at]))
            out.append((BUCKETS + int(self.hashes[at[0]] % np.uint64(BUCKETS)), start, payload))
        return out


def _keys(part: dict[str, pa.Array]) -> np.ndarray:
    return np.cumsum(blocks.numbers(part["step"]).astype(np.uint64))


def _count(part: dict[str, pa.Array]) -> np.ndarray:
    return blocks.numbers(part["n"]).astype(np.int64)


def _add(parts: list[dict[str, pa.Array]]) -> bytes:
    """The sum of counts of the same bucket."""
    n = np.concatenate([_count(p) for p in parts])
    if "step" in parts[0]:
        code, keys = pd.factorize(np.concatenate([_keys(p) for p in parts])[n > 0])
        order = np.argsort(keys)
        total = np.bincount(code, n[n > 0], len(keys)).astype(np.int64)[order]
        step = np.diff(keys[order].astype(np.uint64), prepend=np.uint64(0))
        return blocks.pack(step=blocks.narrow(step), n=blocks.narrow(total))
    words = pa.concat_arrays([p["word"] for p in parts]).filter(pa.array(n > 0)).dictionary_encode()
    total = np.bincount(blocks.numbers(words.indices), n[n > 0], len(words.dictionary)).astype(np.int64)
    return blocks.pack(word=words.dictionary, n=blocks.narrow(total))


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a bucket: last byte and symbol, with the two-byte contexts that hold it; word totals."""
    for batch in batches:
        for row in batch.to_pylist():
            part = blocks.unpack(row["payload"])
            if row["bucket"] < BUCKETS:
                pairs, n = np.unique(np.unique(_keys(part) & _mask(2)) & _mask(1), return_counts=True)
                kind = np.zeros(len(n), np.int32)
            else:
                pairs, n = np.array([0, 1]), np.array([_count(part).sum(), len(part["n"])])
                kind = np.ones(2, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(pairs.astype(np.int64)), pa.array(n)], names=["kind", "pair", "n"])


def score(df: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the texts whose crc32 of the id as text is not `held` modulo `folds`.
    Scores are log10 probabilities.
    """

    def learned(ids: pa.Array) -> np.ndarray:
        return np.array([i is None or zlib.crc32(str(i).encode()) % folds != held for i in ids.to_pylist()], bool)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = blocks.numbered()
        for batch in batches:
            ids, column = batch.columns
            data, offsets = kernel.text_bytes(column)
            for a, b in kernel.chunks(offsets, blocks.BLOCK_BYTES):
                part, own = kernel.lower_ascii(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a]
                rows = ids.slice(a, b - a)
                home = blocks.pack(doc_id=rows, size=blocks.narrow(np.diff(own)), data=part)
                yield blocks.rows(next(number), home, _Block(part, own).entries(learned(rows)))

    kind = df.schema[doc_id].dataType.simpleString()
    staged = blocks.stage(df.select(doc_id, text).mapInArrow(cut, blocks.SCHEMA), "ppm-blocks")
    home, entries = blocks.homes(staged), blocks.entries(staged)
    n_blocks = home.count()
    model = blocks.stage(blocks.totals(entries, n_blocks, _add), "ppm-counts").drop("home")

    fold = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds != held, F.lit(True))
    n_learned = df.where(fold).count()
    short, train, distinct = np.zeros((256, SYMBOLS), np.int64), n_learned, int(n_learned > 0)
    small = model.select("bucket", "payload").mapInArrow(_short, "kind int, pair long, n long")
    for row in small.groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect():  # at most 256 * 257 + 2 rows
        if row.kind == 0:
            short[row.pair >> 9, row.pair & 511] = row.n
        elif row.pair == 0:
            train += row.n
        else:
            distinct += row.n

    def reply(bucket: int, total: dict[str, pa.Array] | None):
        if bucket < BUCKETS:
            nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            trie = Trie(*((_keys(total), _count(total)) if total else nothing), short)
            return lambda part: blocks.pack(log10=trie.log10(_keys(part)).astype(np.float32))
        known = dict(zip(total["word"].to_pylist(), _count(total).tolist())) if total else {}
        return lambda part: blocks.pack(n=blocks.narrow(np.array([known.get(w, 0) for w in part["word"].to_pylist()], np.int64)))

    replies = blocks.replies(entries, model, n_blocks, reply)

    def finish(block_number: int, own: dict[str, pa.Array], found: list[tuple[int, dict[str, pa.Array]]]) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum(blocks.numbers(own["size"]).astype(np.int64))])
        block = _Block(blocks.numbers(own["data"]), offsets)
        logs, counts = np.zeros(len(block.keys)), np.zeros(len(block.hashes), np.int64)
        by_key, by_word = dict(block.events), dict(block.words)
        for start, got in found:
            if "log10" in got:
                logs[by_key[start]] = blocks.numbers(got["log10"])
            else:
                counts[by_word[start]] = blocks.numbers(got["n"])
        whole = math.log10(train + distinct + 1)
        each = np.log10(counts + 1) - whole
        sums = lambda values, at: np.diff(np.concatenate([[0], np.cumsum(values)])[at])
        size = np.diff(block.first)
        columns = {
            "doc_id": own["doc_id"],
            "held_out": pa.array(~learned(own["doc_id"])),
            "n_tokens": size + 1,
            "n_known": sums(counts[block.word] > 0, block.first) + int(n_learned > 0),
            "train_tokens": np.full(len(size), train, np.int64),
            "base_score": sums(each[block.word], block.first) + math.log10(n_learned + 1) - whole,
            "score": sums(logs[block.event], block.event_first),
        }
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.bring_home(home, replies, finish, schema)
