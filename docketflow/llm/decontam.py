"""Finds benchmark passages in documents, also reworded ones, by latent semantic retrieval.

Words are runs of letters and digits in lower case. Of them only those of the benchmark
count, so a passage is a sparse vector over at most `PLACES` words, whatever the corpus.
One pass over all documents counts in how many passages each word is and multiplies the
passages' Gram matrix by random columns, summed by a tree of tasks; from that product
alone comes a randomised singular value decomposition of the TF-IDF matrix (Nystrom's
method), small enough for the driver. A second pass slides windows over each document,
takes them and the benchmark items to the latent space, scaled to unit variance, and keeps
pairs of high cosine. An item longer than a window is cut into passages of about the size
of one, and each is sought by itself. For each such document and item the longest common
subsequence of words is taken where the whole item would lie around the window: most of the
item in it is a leak, and so is a good part of it if its answer, the words it ends with, is
there as well.

Both passes read documents where they lie; no text is shuffled. A benchmark of more than
`PART_ITEMS` items or some `FEATURES` different words is searched in parts, each with a
decomposition of its own; every word of a part's items counts in it.

Defined results: a null or empty text, and an item that is null or has fewer than
`LEAST_WORDS` words, match nothing. Equal items match together, the one of smaller id is
reported; repeated documents get equal rows. Empty tables give clean documents or no rows.
Other columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks, kernel, pretokens

#: Places of hashed words, and of those how many a part of the benchmark has before it ends;
#: an item that alone has more is a part of its own.
PLACES, FEATURES = 1 << 20, 1 << 16
#: Columns of the decomposition.
RANK = 64
#: Words of a passage when counting.
PASSAGE = 48
#: Sizes of windows; an item is sought in the smallest that holds most of it, and one of
#: which none does in passages of at most the largest.
WINDOWS = (8, 20, 44)
#: Bytes of text worked on at once, and numbers of a product of windows and passages: both
#: bound what a worker holds beside its batch.
TEXT_BYTES, PRODUCT = 1 << 18, 1 << 22
#: Steps of a window to its size.
STEPS = 4
COSINE = 0.62
LEAST_WORDS = 6
#: Share of the item in common that is a leak, or one where the answer is there.
MOST, SOME, ANSWER = 0.7, 0.5, 0.8
ANSWER_WORDS = 8
PART_ITEMS = 4096
_SEED = 11
_SLICES = 64


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends in bytes of runs of letters and digits, and each text's first."""
    points, at = pretokens._decode(data)
    kind = pretokens.classes()[points]
    inside = (kind == pretokens.LETTER) | (kind == pretokens.DIGIT) | (kind == pretokens.UNSURE)
    edge = np.zeros(len(points) + 1, bool)
    edge[np.searchsorted(at, offsets)] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = at[:-1][start]
    return starts, at[1:][end], np.searchsorted(starts, offsets)


def texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts (from, to): the hashes of their words, and each text's first."""
    _, offsets = kernel.text_bytes(column)
    for a, b in kernel.chunks(offsets, TEXT_BYTES):
        part, own = kernel.text_bytes(pa.compute.utf8_lower(column.slice(a, b - a)))
        starts, ends, first = word_spans(part, own)
        yield a, b, kernel.span_hashes(part, starts, ends), first


@dataclass
class Items:
    """Benchmark items: ids, hashes of words, and the place of each word among all."""

    ids: list
    words: list[np.ndarray]
    table: np.ndarray
    size: int


def read_items(benchmark: DataFrame, item_id: str, text: str) -> list[Items]:
    """The benchmark in parts. Its size is checked."""
    rows = benchmark.where(F.col(text).isNotNull() & F.col(item_id).isNotNull()).select(item_id, text).distinct()
    letters = rows.agg(F.sum(F.length(text))).first()[0] or 0
    if letters > 1 << 28:
        raise ValueError("a benchmark of more than 2^28 characters does not fit beside a task")
    rows = rows.orderBy(item_id, text).collect()
    found: list[tuple] = []
    for a, b, hashes, first in texts(pa.array([r[1] for r in rows], pa.string())):
        found += [(rows[a + i][0], hashes[first[i] : first[i + 1]]) for i in range(b - a)]
    found = [(i, w) for i, w in found if len(w) >= LEAST_WORDS]
    parts: list[list[tuple]] = []
    held: set[int] = set()
    for item in found:
        places = set((item[1] % np.uint64(PLACES)).tolist())
        if not parts or len(parts[-1]) >= PART_ITEMS or len(held | places) > FEATURES:
            parts.append([])
            held = set()
        parts[-1].append(item)
        held |= places
    return [_part(part) for part in parts]


def _part(found: list[tuple]) -> Items:
    places = np.unique(np.concatenate([w for _, w in found]) % np.uint64(PLACES)).astype(np.int64)
    table = np.full(PLACES, -1, np.int32)
    table[places] = np.arange(len(places))
    return Items([i for i, _ in found], [w for _, w in found], table, len(places))


def _random_columns(size: int) -> np.ndarray:
    return np.random.default_rng(_SEED).standard_normal((size, RANK)).astype(np.float32)


def _counted(column: pa.Array, table: np.ndarray, columns: np.ndarray, product: np.ndarray, held: np.ndarray) -> int:
    """Adds a batch's passages to Gram product and counts; gives the number of passages."""
    total = 0
    for _, _, hashes, first in texts(column):
        size = np.diff(first)
        n = -(-size // PASSAGE)
        base = np.cumsum(n) - n
        of = np.repeat(base, size) + (np.arange(len(hashes)) - np.repeat(first[:-1], size)) // PASSAGE
        place = table[(hashes % np.uint64(PLACES)).astype(np.int64)]
        known = place >= 0
        # Each word once in a passage.
        pairs = np.unique(of[known] * np.int64(len(columns)) + place[known])
        of, place = pairs // len(columns), pairs % len(columns)
        total += int(n.sum())
        if not len(pairs):
            continue
        begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        sums = np.add.reduceat(columns[place], begin, axis=0)
        row = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(of))))
        order = np.argsort(place, kind="stable")
        place, row = place[order], row[order]
        begin = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        product[place[begin]] += np.add.reduceat(sums[row], begin, axis=0)
        held[place[begin]] += np.diff(np.append(begin, len(place)))
    return total


@dataclass
class Space:
    """Each word's latent vector, with its weight in it."""

    vectors: np.ndarray


def fit(df: DataFrame, items: Items, text: str) -> Space:
    """The latent space of the documents' passages, over the words of a part of the benchmark."""
    table, size = items.table, items.size
    columns = _random_columns(size)
    slices = [np.arange(s, size, _SLICES) for s in range(min(_SLICES, size))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product, held, n = np.zeros((size, RANK)), np.zeros(size, np.int64), 0
        for batch in batches:
            n += _counted(batch.column(0), table, columns, product, held)
            del batch
            kernel.give_back()
        block = TaskContext.get().partitionId()
        for s, at in enumerate(slices):
            yield blocks._row(block, s, 0, blocks.pack(product=product[at].ravel(), held=held[at], n=np.array([n])))

    def add(parts: list[dict[str, pa.Array]]) -> bytes:
        return blocks.pack(**{c: np.sum([blocks.numbers(p[c]) for p in parts], axis=0) for c in ("product", "held", "n")})

    found = blocks.totals(df.select(text).mapInArrow(count, blocks.SCHEMA), blocks.FAN_IN**2, add)
    product, held, n = np.zeros((size, RANK)), np.zeros(size), 1
    for row in found.collect():  # at most _SLICES rows, `size` * RANK numbers in all
        part = blocks.unpack(row.payload)
        product[slices[row.bucket]] = blocks.numbers(part["product"]).reshape(-1, RANK)
        held[slices[row.bucket]] = blocks.numbers(part["held"])
        n = max(n, int(blocks.numbers(part["n"])[0]))
    return Space(decompose(product, held, n, columns))


def decompose(product: np.ndarray, held: np.ndarray, n: int, columns: np.ndarray) -> np.ndarray:
    """Words' weighted vectors in the space of right singular vectors, each over its value.

    `product` is T'T times random columns R for the matrix T of passages and words. With
    the weights D of words, D T'T R is the product of the TF-IDF Gram matrix and the random
    columns R / D, which is all that Nystrom's method needs.
    """
    weight = np.log((n + 1) / (held + 1)) + 0.1
    sketch = weight[:, None] * product
    core = columns.T.astype(float) @ product
    core = (core + core.T) / 2
    value, vector = np.linalg.eigh(core + 1e-8 * max(np.trace(core), 1e-12) / RANK * np.eye(RANK))
    keep = value > max(value.max() * 1e-9, 1e-12)
    left, singular, _ = np.linalg.svd(sketch @ (vector[:, keep] / np.sqrt(value[keep])), full_matrices=False)
    keep = singular > max(singular.max() * 1e-6, 1e-12) if len(singular) else singular > 0
    return (weight[:, None] * left[:, keep] / singular[keep] * np.sqrt(max(n, 1))).astype(np.float32)


def masks(item: np.ndarray) -> dict[int, int]:
    """For each word of an item, a bit for each place where it stands."""
    out: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item.tolist()):
        out[w] |= 1 << i
    return dict(out)


def common(mask: dict[int, int], size: int, region: np.ndarray) -> int:
    """Length of the longest common subsequence, a word of the region at a time, in bits."""
    row = full = (1 << size) - 1
    for m in map(mask.get, region.tolist()):
        if m:
            both = row & m
            row = ((row + both) | (row - both)) & full
    return size - row.bit_count()


class Search:
    """Items of one part in the latent space, sought in windows of a size by theirs."""

    def __init__(self, items: Items, space: Space):
        self.items = items
        # The last row is that of a word that does not count.
        self.vectors = np.vstack([space.vectors, np.zeros((1, space.vectors.shape[1]), np.float32)])
        size = np.array([len(w) for w in items.words])
        limit = np.array(WINDOWS) * 1.5
        cuts = np.where(size > limit[-1], -(-size // WINDOWS[-1]), 1)
        # Of each passage: its item, and the word of the item it starts at.
        self.of_passage = np.repeat(np.arange(len(size)), cuts)
        k = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        self.offset = k * size[self.of_passage] // cuts[self.of_passage]
        ends = (k + 1) * size[self.of_passage] // cuts[self.of_passage]
        latent = np.zeros((len(k), space.vectors.shape[1]), np.float32)
        for i, (item, start, end) in enumerate(zip(self.of_passage, self.offset, ends)):
            place = items.table[(items.words[item][start:end] % np.uint64(PLACES)).astype(np.int64)]
            latent[i] = space.vectors[place[place >= 0]].sum(axis=0)
        self.unit = latent / np.maximum(np.linalg.norm(latent, axis=1), 1e-12)[:, None]
        self.masks = [(masks(w), len(w), masks(w[-ANSWER_WORDS:]), len(w[-ANSWER_WORDS:])) for w in items.words]
        at = np.minimum(np.searchsorted(limit, ends - self.offset), len(WINDOWS) - 1)
        self.of_window = [np.flatnonzero(at == k) for k in range(len(WINDOWS))]
        # From where an item would start to where it would end, a window at least.
        window = np.array(WINDOWS)[at]
        self.length = [0] * len(size)
        for i, w in zip(self.of_passage.tolist(), window.tolist()):
            self.length[i] = int(size[i]) if cuts[i] > 1 else w

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """(text, item) of close windows, with the word at which the item would start."""
        place = self.items.table[(hashes % np.uint64(PLACES)).astype(np.int64)]
        words = np.diff(first)
        of_word = np.repeat(np.arange(len(words)), words)
        inner = np.arange(len(hashes)) - first[of_word]
        out: dict[tuple[int, int], list[int]] = defaultdict(list)
        for size, passages in zip(WINDOWS, self.of_window):
            if not len(passages):
                continue
            step = max(1, size // STEPS)
            # Sums over steps; a window is the sum of its steps. Each text has STEPS - 1 empty
            # steps behind it, so that its last windows end with it.
            steps = -(-words // step)
            n = np.where(words > 0, np.maximum(steps - STEPS + 1, 1), 0)
            base = np.cumsum(steps + STEPS - 1) - (steps + STEPS - 1)
            held = np.full((int((steps + STEPS - 1).sum()), step), -1, np.int32)
            held.ravel()[base[of_word] * step + inner] = place
            sums = self.vectors[held[:, 0]]
            for k in range(1, step):
                sums += self.vectors[held[:, k]]
            k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            of, at = np.repeat(np.arange(len(words)), n), np.repeat(base, n) + k
            start = first[of] + k * step
            latent = sum(sums[at + k] for k in range(STEPS))
            scale = 1 / np.maximum(np.linalg.norm(latent, axis=1), 1e-6)
            unit = self.unit[passages].T
            rows = max(1, min(1 << 14, PRODUCT // len(passages)))
            for lo in range(0, len(start), rows):
                near = (latent[lo : lo + rows] @ unit) * scale[lo : lo + rows, None] >= COSINE
                for w, i in zip(*np.nonzero(near)):
                    passage = passages[i]
                    out[int(of[lo + w]), int(self.of_passage[passage])].append(int(start[lo + w] - self.offset[passage]))
        return out

    def leaks(self, hashes: np.ndarray, first: np.ndarray) -> dict[int, list[tuple[float, int]]]:
        """Per text: (share in common, item) of every item that it leaks."""
        out: dict[int, list[tuple[float, int]]] = defaultdict(list)
        for (text, i), starts in self.candidates(hashes, first).items():
            mask, size, answer, answer_size = self.masks[i]
            best, answered, reach = 0.0, False, -math.inf
            for at in sorted(starts):
                # An item cut off at the start of the text lies before it.
                if at - size // 2 <= reach:
                    continue
                reach = at - size // 2 + size // 4
                lo, hi = max(int(first[text]), at - size // 2), min(int(first[text + 1]), at + self.length[i] + size // 2)
                region = hashes[lo:hi]
                share = common(mask, size, region) / size
                if share > best:
                    best = share
                    answered = share >= SOME and common(answer, answer_size, region) >= ANSWER * answer_size
            if best >= MOST or (best >= SOME and answered):
                out[text].append((best, i))
        return out


def contamination(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Adds `contaminated`, `leaked_item` (of the largest share), `leaked_share`, `leaked_items`."""
    id_type = benchmark.schema[item_id].dataType
    added = {
        "contaminated": T.BooleanType(), "leaked_item": id_type, "leaked_share": T.DoubleType(),
        "leaked_items": T.ArrayType(id_type),
    }
    df = df.select(*[c for c in df.columns if c not in added])
    blank = {"contaminated": F.lit(False), "leaked_item": F.lit(None).cast(id_type), "leaked_share": F.lit(0.0),
             "leaked_items": F.array().cast(T.ArrayType(id_type))}
    out = df.withColumns(blank)
    parts = read_items(benchmark, item_id, item_text)
    if not parts:
        return out
    spark = df.sparkSession
    for items in parts:
        # PLACES * RANK numbers and PART_ITEMS items at most.
        sent = spark.sparkContext.broadcast((items, fit(df, items, text)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = Search(*sent.value)
            ids = search.items.ids
            for batch in batches:
                keep = [c for c in batch.schema.names if c not in added]
                for a, b, hashes, first in texts(batch.column(text)):
                    found, own = search.leaks(hashes, first), batch.slice(a, b - a)
                    rows = []
                    for i, (bad, item, share, items_so_far) in enumerate(zip(*(own.column(c).to_pylist() for c in added))):
                        leaks = sorted(((-s, ids[k]) for s, k in found.get(i, [])))
                        if leaks and -leaks[0][0] > share:
                            item, share = leaks[0][1], -leaks[0][0]
                        rows.append((bad or bool(leaks), item, share, sorted({*items_so_far, *(k for _, k in leaks)})))
                    columns = [pa.array(list(c), own.schema.field(n).type) for c, n in zip(zip(*rows), added)]
                    yield pa.RecordBatch.from_arrays([*own.select(keep).columns, *columns], names=[*keep, *added])
                    del own
                del batch
                kernel.give_back()

        out = out.mapInArrow(run, out.schema)
    return out
