"""Collocations: phrases that occur far more often than what they are made of, by stripes.

A stripe is a prefix with a counter of the words that follow it, the end of a piece among
them. Merged element by element, stripes of all texts give what is needed at once: their
entries are the totals of the prefix's extensions, their sums the totals of the prefixes, and
what occurs often enough tells its beginning and its end how much of them it takes over.

Every word of a text is the beginning of one stripe entry for each length of prefix, which is
1, 3 and so on for phrases of even length; words are counted as the stripe of the empty
prefix. A task packs some megabytes of texts into a block, merges the block's own stripes, and
deals them by a hash of the prefix. So a prefix that holds a third of all words is one
stripe a block. The stripes of one word, which very many others may follow, are dealt over
`SEGMENTS` parts by the next word, as their sums are counted apart. One shuffle brings the
stripes of a bucket together; the number of buckets follows the size of the texts. Words
travel as they are, so that no hash stands for one.

What occurs `least` times is all that leaves the buckets: phrases are then scored and dropped
by joins on phrases.

Defined results: a null or empty text has no words; a null group is `und`; repeated rows
count as often as they stand there; equal scores go by count, then by the phrase's bytes;
a table without words gives no rows. Only the columns named are read.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import blocks, kernel
from .components import stored

#: Text whose stripes one bucket merges, and the bounds of how many buckets there are.
BUCKET_BYTES, BUCKETS_LEAST, BUCKETS_MOST = 16 << 20, 128, 1 << 16
#: Parts of the stripe of one word, and of a group's phrases before they are ranked.
SEGMENTS, RANKED_APART = 16, 64
UNKNOWN = "und"

_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_OUTSIDE = _BREAKS.copy()
_OUTSIDE[[0x20, 0x09]] = True

_SCHEMA = "bucket int, prefix int, payload binary"
_FOUND = "lang string, phrase string, size int, n long"


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Each word's number, the distinct words, and for each word its text and its piece."""
    outside = _OUTSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start, end = ~outside, ~outside
    start[1:] &= outside[:-1] | edge[1:-1]
    end[:-1] &= outside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    of = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(_BREAKS[data], dtype=np.int32)[starts] + of
    letters = np.ascontiguousarray(data[~outside])
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return blocks.numbers(coded.indices).astype(np.int64), coded.dictionary, of, piece


def _keys(groups: list[str], words: pa.Array, pairs: np.ndarray) -> pa.Array:
    """Words with their groups before them, whose length tells where the word begins."""
    marks = pa.array([f"{len(g.encode())}:{g}".encode() for g in groups], pa.large_binary())
    empty = pa.scalar(b"", pa.large_binary())
    return pc.binary_join_element_wise(marks.take(pa.array(pairs // len(words))), words.take(pa.array(pairs % len(words))), empty)


def _plain(key: bytes) -> tuple[str, str]:
    size, _, rest = key.partition(b":")
    return rest[: int(size)].decode(), rest[int(size) :].decode()


def _hashes(keys: pa.Array) -> np.ndarray:
    data, offsets = kernel.text_bytes(keys.cast(pa.large_string()))
    return kernel.span_hashes(data, offsets[:-1], offsets[1:])


class _Block:
    """The distinct words of some texts in order of their keys, and where they stand.

    Number 0 is the end of a piece; a group's total stands as the word of one space,
    which no text holds.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, groups: list[str], group: np.ndarray):
        word, words, of, self.piece = words_of(kernel.lower_ascii(data), offsets)
        words = pa.concat_arrays([words, pa.array([b" "], pa.large_binary())])
        in_group = group[of]
        spoken, totals = np.unique(in_group, return_counts=True)
        pairs, at, times = np.unique(in_group * len(words) + word, return_inverse=True, return_counts=True)
        keys = _keys(groups, words, np.concatenate([pairs, spoken * len(words) + len(words) - 1]))
        order = blocks.numbers(pc.sort_indices(keys)).astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.keys = pa.concat_arrays([pa.array([b""], pa.large_binary()), keys.take(pa.array(order))])
        self.hashes = _hashes(self.keys)
        self.word = rank[at] + 1
        self.times = np.concatenate([[0], np.concatenate([times, totals])[order]])

    def counted(self, buckets: int) -> Iterator[tuple[int, int, bytes]]:
        """The stripe of the empty prefix."""
        numbers = np.arange(1, len(self.keys))
        yield from self._rows([numbers], self.times[1:], kernel.mix(self.hashes[1:]), buckets)

    def stripes(self, prefix: int, buckets: int) -> Iterator[tuple[int, int, bytes]]:
        n = len(self.word) - prefix + 1
        if n <= 0:
            return
        at = np.flatnonzero(self.piece[:n] == self.piece[prefix - 1 :])
        following = np.zeros(n, np.int64)
        inner = np.flatnonzero(self.piece[: n - 1] == self.piece[prefix:])
        following[inner] = self.word[inner + prefix]
        columns = [*(self.word[at + j] for j in range(prefix)), following[at]]
        # Two words to a key: a block has fewer than 2^32 distinct ones.
        joint = [x << 32 | y for x, y in itertools.zip_longest(columns[::2], columns[1::2], fillvalue=0)]
        order = np.lexsort(joint[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for key in joint:
            key = key[order]
            new[1:] |= key[1:] != key[:-1]
        begin = np.flatnonzero(new)
        columns = [c[order[begin]] for c in columns]
        times = np.diff(np.append(begin, len(order)))
        dealt = np.zeros(len(begin), np.uint64)
        for column in columns[:-1]:
            dealt = kernel.mix(dealt + self.hashes[column])
        if prefix == 1:
            dealt = kernel.mix(dealt + self.hashes[columns[-1]] % np.uint64(SEGMENTS))
        yield from self._rows(columns, times, dealt, buckets)

    def _rows(self, columns: list[np.ndarray], times: np.ndarray, dealt: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
        for start, at in blocks.in_buckets((dealt % np.uint64(buckets)).astype(np.int64)):
            bucket = int(dealt[at[0]] % np.uint64(buckets))
            used, number = np.unique(np.concatenate([c[at] for c in columns]), return_inverse=True)
            number = number.reshape(len(columns), -1)
            # The first word ascends; the bytes of the others lie apart, which compresses well.
            parts = [blocks.narrow(np.diff(number[0], prepend=0))]
            for own in number[1:]:
                parts += [(own & 255).astype(np.uint8), blocks.narrow(own >> 8)]
            yield bucket, len(columns) - 1, _packed(times[at], self.keys.take(pa.array(used)), parts)


def _packed(n: np.ndarray, keys: pa.Array, parts: list[np.ndarray]) -> bytes:
    """One stripe row's counts, words and entries, with less around them than a batch has."""
    letters, offsets = kernel.text_bytes(keys.cast(pa.large_string()))
    arrays = (blocks.narrow(n), blocks.narrow(np.diff(offsets)), np.ascontiguousarray(letters), *parts)
    return zstandard.compress(pickle.dumps([(a.dtype.char, a.tobytes()) for a in arrays], 5), 1)


def _unpacked(payload: bytes) -> tuple[np.ndarray, ...]:
    """(counts, lengths of words, their letters, columns of entries)."""
    n, sizes, letters, first, *rest = (np.frombuffer(b, t) for t, b in pickle.loads(zstandard.decompress(payload)))
    columns = [np.cumsum(first, dtype=np.int32)]
    columns += [low.astype(np.int32) | high.astype(np.int32) << 8 for low, high in zip(rest[::2], rest[1::2])]
    return n, sizes, letters, *columns


def _merged(payloads: list[bytes], prefix: int, least: int) -> Iterator[tuple[list[bytes], int, int]]:
    """(words, size, n) of what occurs often enough in the stripes of one bucket."""
    n, sizes, letters, *columns = (list(c) for c in zip(*map(_unpacked, payloads)))
    begin = np.cumsum([0, *map(len, sizes)])
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
    words = [None, pa.py_buffer(bounds), pa.py_buffer(np.concatenate(letters))]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, words).dictionary_encode()
    keys, number = coded.dictionary, blocks.numbers(coded.indices)
    del sizes, letters, words, bounds
    # Each column's own numbers end here: they are let go as soon as they are replaced.
    whole = [np.concatenate([number[b + own.pop(0)] for b in begin[:-1]]) for own in columns]
    n = np.concatenate(n)
    joint = [x.astype(np.int64) << 32 | y for x, y in itertools.zip_longest(whole[::2], whole[1::2], fillvalue=0)]
    order = np.lexsort(joint[::-1]).astype(np.int32)
    del joint
    whole, n = [c[order] for c in whole], n[order]
    new = np.zeros(len(n), bool)
    new[:1] = True
    for column in whole[:-1]:
        new[1:] |= column[1:] != column[:-1]
    if prefix > 1:
        begin = np.flatnonzero(new)
        sums = np.add.reduceat(n, begin, dtype=np.int64)
        for i, total in zip(begin[sums >= least].tolist(), sums[sums >= least].tolist()):
            yield [keys[int(c[i])].as_py() for c in whole[:-1]], prefix, total
    new[1:] |= whole[-1][1:] != whole[-1][:-1]
    begin = np.flatnonzero(new)
    sums = np.add.reduceat(n, begin, dtype=np.int64)
    kept = sums >= least
    if not prefix:
        kept |= blocks.numbers(pc.ends_with(keys, pattern=b" "))[whole[0][begin]]
    for i, total in zip(begin[kept].tolist(), sums[kept].tolist()):
        words = [keys[int(c[i])].as_py() for c in whole]
        if words[-1]:
            yield words, prefix + 1, total


def _found(df: DataFrame, least: int, longest: int, text: str, group: str) -> DataFrame:
    """Rows (lang, phrase, size, n) of what occurs `least` times; of size 0, a group's total."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = min(max(BUCKETS_LEAST, 1 << (size // BUCKET_BYTES).bit_length()), BUCKETS_MOST)
    prefixes, block_bytes = range(longest - 1, 0, -2), blocks.BLOCK_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).cast(pa.string()).fill_null(UNKNOWN).dictionary_encode()
            groups, own = langs.dictionary.to_pylist(), blocks.numbers(langs.indices).astype(np.int64)
            data, offsets = kernel.text_bytes(batch.column(0))
            for a, b in kernel.chunks(offsets, block_bytes):
                block = _Block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], groups, own[a:b])
                for rows in (block.counted(buckets), *(block.stripes(p, buckets) for p in prefixes)):
                    columns = list(zip(*rows)) or [[], [], []]
                    kinds = (pa.int32(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "prefix", "payload"])

    def merge(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        for (_, prefix), own in itertools.groupby(rows, key=lambda row: (row["bucket"], row["prefix"])):
            out: list[tuple] = []
            for words, n_words, n in _merged([row["payload"] for row in own], prefix, least):
                plain = [_plain(w) for w in words]
                phrase = " ".join(w for _, w in plain)
                out.append((plain[0][0], phrase, 0 if phrase == " " else n_words, n))
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "phrase", "size", "n"])

    rows = df.select(text, group).mapInArrow(cut, _SCHEMA)
    return stored(blocks.by_group(rows, ["bucket", "prefix"], [], merge, _FOUND), "phrases-found")


def collocations(
    df: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, share: int = 80, scale: int = 2_000_000,
    text: str = "text", group: str = "lang",
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each group's `top` phrases.

    A phrase of 2 to `longest` words occurs a >= `least` times; of its cuts into two, which
    occur l and r times, the lowest floor(scale * a / (l + r)) is its score. Phrases of
    which `share` hundredths of a lie inside one longer phrase are left out. n is the
    number of words in the group.
    """
    found = _found(df, least, longest, text, group)
    parts = found.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    phrases = found.where("size > 1").withColumnRenamed("n", "a")

    # A phrase inside one that is longer by several words is inside one longer by one as well.
    ends = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    longer = phrases.where("size > 2").select("lang", F.explode(ends).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = phrases.join(longer, ["lang", "phrase"], "left")
    kept = kept.where(F.col("most").isNull() | (F.col("most").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * share))

    cuts = kept.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("substring_index(phrase, ' ', k)"), "tail": F.expr("substring_index(phrase, ' ', k - size)")})
    cuts = stored(cuts, "phrases-cuts")
    cuts = cuts.join(parts.toDF("lang", "head", "l"), ["lang", "head"]).join(parts.toDF("lang", "tail", "r"), ["lang", "tail"])
    score = f"(cast({scale} as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr(score).alias("score"), "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # Ranked in parts first: what a group's one task ranks has a bound.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_APART)).alias("part")
    apart = scored.withColumn("rank", F.row_number().over(W.partitionBy("lang", part).orderBy(*order)))
    best = apart.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
    totals = found.where("size = 0").select("lang", "n")
    best = best.where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
