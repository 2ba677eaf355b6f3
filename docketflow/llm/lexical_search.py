"""Ranked lexical search by hashed max-sketches, with exact scores.

The impact of a term in a document depends on how often it occurs there and on the
document's length. A document's sketch has `COORDINATES` places; at the place of a term's
hash lies the largest impact of all its terms of that place. So an item's terms, looked up
in the sketches of many documents at once and weighted, bound the documents' scores from
above. For each item, documents are then scored exactly, highest bound first, until the bound
falls below the score that the item's list asks for; a bound that equals it is still
scored, as the document may have the smaller id. What counts for a score is compared
letter by letter, so hashes only ever raise bounds.

Two passes go over the documents: the first counts documents, terms and how many documents
hold each term asked for; the second builds sketches of `SKETCHED` documents at a time,
searches them and keeps each task's best for every item. Spark ranks what the tasks found.
Items are asked in batches of about `BATCH_BYTES` of text, so that what is sent to the
tasks does not grow with the items.

Defined results: a null text has no terms; an item without terms, or with none that a
document holds, has no rows; items that stand there more than once, also with equal ids,
are answered each; equal rows of documents are ranked each, and a null id comes after the
others; without documents there are no rows. Only the columns named are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernel
from .components import stored

#: Places of a sketch, and documents whose sketches are held at once.
COORDINATES, SKETCHED = 4096, 512
#: Text of the items asked together.
BATCH_BYTES = 8 << 20
#: Text of documents worked on at once.
CHUNK_BYTES = 4 << 20
#: How many documents an item scores exactly at first, doubled from turn to turn.
FIRST_SCORED = 16

_TERM = np.zeros(256, bool)
_TERM[128:] = True
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the terms of texts, and each one's text."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, "right") - 1


def impacts(times: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Impact of a term that occurs so often, by the document's relative length."""
    return (1_000_000_000 * times) // (1000 * times + 8 * length)


def relative_length(n: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """A document's length in hundredths of the mean, a tenth of which is fixed."""
    return 100 - 90 + (90 * n * documents) // max(occurrences, 1)


@dataclass(frozen=True)
class _Asked:
    """The distinct terms of a batch of items, in order of hash, and each item's terms."""

    hashes: np.ndarray
    letters: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    of_items: list[np.ndarray]

    @staticmethod
    def of(texts: list[str | None]) -> _Asked:
        data, offsets = kernel.text_bytes(pa.array(texts, pa.string()))
        data = kernel.lower_ascii(data)
        starts, ends, item = terms(data, offsets)
        found = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        hash_of = kernel.span_hashes(data, starts, ends).tolist()
        number, hashed = {}, {}
        for term, h in zip(found, hash_of):
            number[term] = 0
            if hashed.setdefault(h, term) != term:
                raise ValueError(f"terms of equal hash: {term!r}, {hashed[h]!r}")
        ordered = [term for _, term in sorted(hashed.items())]
        number = {term: i for i, term in enumerate(ordered)}
        sets: list[set[int]] = [set() for _ in texts]
        for i, term in zip(item.tolist(), found):
            sets[i].add(number[term])
        sizes = np.array([len(t) for t in ordered], np.int64)
        letters = np.frombuffer(b"".join(ordered), np.uint8)
        return _Asked(
            np.array(sorted(hashed), np.uint64), letters, np.cumsum(sizes) - sizes, sizes, [np.array(sorted(s), np.int64) for s in sets]
        )

    def matches(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of terms that are asked for, letter by letter, and their numbers."""
        if not len(self.hashes) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        number = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        at = np.flatnonzero((self.hashes[number] == hashes) & (self.sizes[number] == ends - starts))
        number = number[at]
        size = self.sizes[number]
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        differs = data[np.repeat(starts[at], size) + step] != self.letters[np.repeat(self.starts[number], size) + step]
        wrong = np.unique(np.repeat(np.arange(len(at)), size)[differs])
        return np.delete(at, wrong), np.delete(number, wrong)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = kernel.text_bytes(batch.column(column))
        data = kernel.lower_ascii(data)
        for a, b in kernel.chunks(offsets, CHUNK_BYTES):
            for i in range(a, b, SKETCHED):
                j = min(i + SKETCHED, b)
                yield batch, i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def _counts(df: DataFrame, asked: _Asked) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and documents that hold each asked term."""
    n_asked = len(asked.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_asked + 2, np.int64)
        for _, i, j, data, offsets in _texts(batches, 0):
            starts, ends, of = terms(data, offsets)
            total[-2] += (np.bincount(of, minlength=j - i) > 0).sum()
            total[-1] += len(starts)
            at, number = asked.matches(data, starts, ends, kernel.span_hashes(data, starts, ends))
            held = np.unique(of[at] * n_asked + number) % max(n_asked, 1)
            total[:n_asked] += np.bincount(held, minlength=n_asked)[:n_asked]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "n"])

    rows = df.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = np.zeros(n_asked + 2, np.int64)
    for row in rows.collect():  # one row for each term of the batch
        total[row.term] = row.n
    return int(total[-2]), int(total[-1]), total[:n_asked]


class _Sketched:
    """Documents' sketches, and the exact impacts of asked terms."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, asked: _Asked, documents: int, occurrences: int, coordinates: int):
        n = len(offsets) - 1
        starts, ends, of = terms(data, offsets)
        hashes = kernel.span_hashes(data, starts, ends)
        length = relative_length(np.bincount(of, minlength=n).astype(np.int64), documents, occurrences)
        order = np.lexsort((hashes, of))
        doc, found = of[order], hashes[order]
        begin = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (found[1:] != found[:-1]))[: len(doc)])
        times = np.diff(np.append(begin, len(doc)))
        doc, found = doc[begin], found[begin]
        self.sketch = np.zeros((coordinates, n), np.int32)
        place = (found % np.uint64(coordinates)).astype(np.int64)
        np.maximum.at(self.sketch, (place, doc), impacts(times, length[doc]).astype(np.int32))
        at, number = asked.matches(data, starts, ends, hashes)
        self.n_asked = max(len(asked.hashes), 1)
        self.code, times = np.unique(of[at] * self.n_asked + number, return_counts=True)
        self.impact = impacts(times, length[self.code // self.n_asked])

    def bounds(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return weights @ self.sketch[places].astype(np.int64)

    def scores(self, docs: np.ndarray, numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
        if not len(self.code):
            return np.zeros(len(docs), np.int64)
        code = docs[:, None] * self.n_asked + numbers[None, :]
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.impact[at], 0) @ weights


class _Best:
    """The best documents that a task has met for one item."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.key, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def asks(self) -> int:
        """The least score that could still enter."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, key: np.ndarray, null: np.ndarray) -> None:
        held = score >= max(self.asks, 1)
        score, key, null = (np.concatenate([x, y[held]]) for x, y in ((self.score, score), (self.key, key), (self.null, null)))
        order = np.lexsort((key, null, -score))[: self.top]
        self.score, self.key, self.null = score[order], key[order], null[order]


def _search(sketched: _Sketched, best: _Best, numbers, places, weights, key, null) -> None:
    """Scores documents by descending bound until no other can enter."""
    bound = sketched.bounds(places, weights)
    able = np.flatnonzero(bound >= max(best.asks, 1))
    able = able[np.argsort(-bound[able], kind="stable")]
    at, step = 0, FIRST_SCORED
    while at < len(able) and bound[able[at]] >= best.asks:
        docs = able[at : at + step]
        best.add(sketched.scores(docs, numbers, weights), key[docs], null[docs])
        at, step = at + step, step * 2


def weight(documents: int, holding: int) -> int:
    """How much a term counts that so many of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _answers(df: DataFrame, items: list[int], asked: _Asked, top: int, coordinates: int) -> DataFrame:
    documents, occurrences, holding = _counts(df.select("text"), asked)
    weights = np.array([weight(documents, int(n)) if n else 0 for n in holding], np.int64)
    places = (asked.hashes % np.uint64(coordinates)).astype(np.int64)
    # Terms that no document holds add nothing.
    held = [numbers[holding[numbers] > 0] for numbers in asked.of_items]
    sent = df.sparkSession.sparkContext.broadcast((asked, weights, places, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights, places, held = sent.value
        best = [_Best(top) for _ in held]
        for batch, i, j, data, offsets in _texts(batches, 1):
            ids = batch.column(0).slice(i, j - i)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            key = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            sketched = _Sketched(data, offsets, asked, documents, occurrences, coordinates)
            for own, numbers in zip(best, held):
                if len(numbers):
                    _search(sketched, own, numbers, places[numbers], weights[numbers], key, null)
        found = [(np.full(len(b.score), item), pa.array(b.key, mask=b.null), b.score) for item, b in zip(items, best) if len(b.score)]
        for item, doc, score in found:
            yield pa.RecordBatch.from_arrays([pa.array(item), doc, pa.array(score)], names=["item", "doc_id", "score"])

    return df.mapInArrow(run, "item long, doc_id long, score long")


def search(
    documents: DataFrame, items: DataFrame, top: int = 10, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", coordinates: int = COORDINATES,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's `top` documents of a score above 0."""
    df = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    asked = stored(asked.withColumn("item", F.monotonically_increasing_id()), "search-items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_batches = max(1, math.ceil(size / BATCH_BYTES))
    found = None
    for number in range(n_batches):
        # By a hash of the row, so that batches hold about as much text each.
        some = asked.where(F.pmod(F.xxhash64("item"), F.lit(n_batches)) == number).select("item", "text").collect()
        answers = _answers(df, [r.item for r in some], _Asked.of([r.text for r in some]), top, coordinates)
        found = answers if found is None else found.unionByName(answers)
    # Each task gives at most `top` rows an item, and Spark again takes the best before it shuffles.
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
