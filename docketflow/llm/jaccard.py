"""Exact similarity join on shingles: signatures of token combinations, then verification.

A document's set is its distinct shingles. Documents with equal sets are one set from then
on. Sets link when the intersection is at least `percent` hundredths of the union, so a
set x loses at most t(x) = |x| - ceil(percent |x| / 100) of its tokens to a linked one.

Tokens have one order: first those whose hash is in a fixed share of the range, rarest
class first, then the others; within a class by hash. A set's prefix is the shortest
beginning that t(x) lost tokens cannot wipe out. A rare token counts as one, and is a
signature alone. Frequent tokens, in so many sets that alone they would bring together
what is not alike, are dealt into groups by hash, and only pairs of tokens of the same
group are signatures; g tokens of a group count as g - 1, so the prefix is extended. Linked
sets share a signature. How many groups there are depends on the size of the set; a set
near a power of two signs for the sizes on both sides.

Counts of tokens over all documents come by blocks (`blocks.py`) and only for that share of
the hashes. A token found in one set only counts for the prefix and needs no signature.

Sets with a signature in common are candidates. So that a signature held by very many does
not make every pair of them, each is first verified against one set of its signature;
links so far give components, and then only pairs of different components are verified,
if the tokens that any other of these sets has could be enough for a link.
That gives the components of all links, as no pair within one could change them.

Hashes of shingles and sets have 64 bits, of shingles in verification 48.

Defined results: a text of fewer words than a shingle has its whole sequence as one
shingle; without words, or null, a text has an empty set and links with nothing. Equal rows
give equal rows, and repeated ids are rows of their own. A component's id is the smallest
id in it, nulls last. A table without rows gives none. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard
from . import blocks, kernel
from .components import components, stored

#: Tokens in so many sets are frequent and sign in pairs only.
FREQUENT = 12
BUCKETS = 256
#: Bits of the table that says which sets are candidates; it has this size for any input
#: and only saves moving other sets.
FILTER_BITS = 1 << 23
#: Signatures of a set that tell where a pair is made.
LEAST_FEW = 8
_LAST = np.iinfo(np.int64).max


def lost(size: int, percent: int) -> int:
    """Tokens that a set of this size may miss in a linked set."""
    return size - -(-percent * size // 100)


def share_of(percent: int) -> float:
    """The share of the hash range whose tokens are counted: prefixes need no more of most sets."""
    return min(1.0, 2.2 * (100 - percent) / 100)


def block_bytes(percent: int) -> int:
    """Text of one block: as much less as more of its tokens are counted."""
    return int(blocks.BLOCK_BYTES * min(1.0, 0.15 / max(share_of(percent), 0.01)))


def groups_of(scale: int) -> int:
    """Groups of frequent tokens for sets of 2^scale tokens and more."""
    return max(1, (1 << scale) >> 5)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles in order, and where each text's begin."""
    data = kernel.lower_ascii(data)
    starts, ends, first = kernel.words(data, offsets)
    hashes = kernel.span_hashes(data, starts, ends)
    at, found = kernel.run_hashes(hashes, first, words)
    n = len(offsets) - 1
    short = np.flatnonzero((np.diff(first) < words) & (np.diff(first) > 0))
    of = np.concatenate([np.searchsorted(first, at, "right") - 1, short])
    found = np.concatenate([found, kernel.text_hashes(hashes, first)[short]])
    order = np.lexsort((found, of))
    of, found = of[order], found[order]
    keep = np.append(True, (of[1:] != of[:-1]) | (found[1:] != found[:-1]))[: len(of)]
    return found[keep], np.searchsorted(of[keep], np.arange(n + 1))


def set_hashes(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(kernel.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return kernel.mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


def _joined(scale: int, a: int, b: int) -> int:
    """A signed 64-bit number for a token, or a pair of tokens, of one scale."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + (scale + 2) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 32
    x = x * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    return (x ^ x >> 29) - (1 << 63)


def signatures(tokens: np.ndarray, kinds: np.ndarray, size: int, percent: int) -> tuple[list[int], int]:
    """Signatures of a set, and how many of its tokens no other set has.

    `tokens` are those that a prefix can need, `kinds` their classes: 0 in one set only, 1
    rare, 2 frequent, 3 outside the share.
    """
    order = np.lexsort((tokens, kinds))
    tokens, kinds = tokens[order], kinds[order]
    alone = int((kinds == 0).sum())
    need = lost(size, percent) + 1
    if alone >= need:
        return [], alone
    out: set[int] = set()
    for scale in {size.bit_length() - 1, (100 * size // percent).bit_length() - 1}:
        groups = groups_of(scale)
        met = alone
        held: dict[int, list[int]] = {}
        for token, kind in zip(tokens[alone:].tolist(), kinds[alone:].tolist()):
            if met >= need:
                break
            if kind == 2:
                group = held.setdefault(token % groups, [])
                out.update(_joined(scale, other, token) for other in group)
                met += len(group) > 0
                group.append(token)
            else:
                out.add(_joined(-1, 0, token))
                met += 1
    return list(out), alone


def _pairs_of(ids: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    number, found = pd.factorize(sets)
    low = np.full(len(found), _LAST)
    np.minimum.at(low, number, ids)
    return number, found, low


class _Block:
    """A block's sets, with the tokens that prefixes can need."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, words: int, percent: int):
        tokens, first = shingle_sets(data, offsets, words)
        self.size = np.diff(first)
        self.sets = set_hashes(tokens, first)
        self.number, self.distinct, self.low = _pairs_of(ids, self.sets)
        share = np.uint64(share_of(percent) * (2.0**64 - 2048))
        of = np.repeat(np.arange(len(self.size)), self.size)
        once = np.zeros(len(self.size), bool)
        once[np.unique(self.number, return_index=True)[1]] = True
        inside = (tokens < share) & once[of]
        self.code, self.tokens = pd.factorize(tokens[inside])
        self.count = np.bincount(self.code, minlength=len(self.tokens))
        self.code_first = np.concatenate([[0], np.cumsum(inside)])[first]
        self.extra, self.extra_first = self._extra(tokens, first, once, share, percent)

    def _extra(self, tokens, first, once, share, percent):
        """Tokens outside the share, for sets whose prefix could need them."""
        out, at = [], [0]
        inner = np.diff(self.code_first)
        for d, size in enumerate(self.size.tolist()):
            lacking = 0
            if once[d] and size:
                most = groups_of((100 * size // percent).bit_length() - 1)
                lacking = max(0, lost(size, percent) + 1 - (int(inner[d]) - most))
            if lacking:
                begin = first[d] + int(inner[d])
                out.append(tokens[begin : min(begin + lacking, first[d + 1])])
            at.append(at[-1] + (len(out[-1]) if lacking else 0))
        return np.concatenate([*out, np.zeros(0, np.uint64)]).astype(np.uint64), np.array(at)

    def entries(self) -> list[tuple[int, int, bytes]]:
        out = []
        short = self.tokens >> np.uint64(16)
        for start, at in self.by_token():
            step = np.diff(short[at], prepend=np.uint64(0))
            payload = blocks.pack(step=blocks.narrow(step), n=blocks.narrow(self.count[at]))
            out.append((int(self.tokens[at[0]] % np.uint64(BUCKETS)), start, payload))
        for start, at in self.by_set():
            payload = blocks.pack(set=self.distinct[at], low=blocks.narrow(self.low[at].astype(np.uint64)))
            out.append((BUCKETS + int(self.distinct[at[0]] % np.uint64(BUCKETS)), start, payload))
        return out

    def by_token(self) -> list[tuple[int, np.ndarray]]:
        return [(s, at[np.argsort(self.tokens[at])]) for s, at in blocks.in_buckets((self.tokens % np.uint64(BUCKETS)).astype(np.int64))]

    def by_set(self) -> list[tuple[int, np.ndarray]]:
        return list(blocks.in_buckets((self.distinct % np.uint64(BUCKETS)).astype(np.int64)))


def _token_part(part: dict[str, pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(blocks.numbers(part["step"]).astype(np.uint64)), blocks.numbers(part["n"]).astype(np.int64)


def _set_part(part: dict[str, pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    return blocks.numbers(part["set"]), blocks.numbers(part["low"]).astype(np.int64)


def _merged(keys: np.ndarray, values: np.ndarray, how: np.ufunc) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[begin], how.reduceat(values, begin)


def _add(parts: list[dict[str, pa.Array]]) -> bytes:
    if "step" in parts[0]:
        keys, n = _merged(*(np.concatenate(x) for x in zip(*map(_token_part, parts))), np.add)
        return blocks.pack(step=blocks.narrow(np.diff(keys, prepend=np.uint64(0))), n=blocks.narrow(np.minimum(n, FREQUENT)))
    sets, low = _merged(*(np.concatenate(x) for x in zip(*map(_set_part, parts))), np.minimum)
    return blocks.pack(set=sets, low=blocks.narrow(low.astype(np.uint64)))


def _shared(total: dict[str, pa.Array]) -> bytes:
    """Of a total of tokens only those that several sets hold."""
    if "step" not in total:
        return blocks.pack(**total)
    keys, n = _token_part(total)
    return blocks.pack(step=blocks.narrow(np.diff(keys[n > 1], prepend=np.uint64(0))), n=blocks.narrow(n[n > 1]))


def _reply(bucket: int, total: dict[str, pa.Array] | None):
    if bucket < BUCKETS:
        keys, n = _token_part(total)
        # The last place is that of tokens beyond all keys; what is not among them is in one set.
        keys, kind = np.append(keys, np.uint64(_LAST)), np.append(np.where(n >= FREQUENT, 2, 1), 0).astype(np.uint8)

        def answer(part: dict[str, pa.Array]) -> bytes:
            asked = _token_part(part)[0]
            place = np.searchsorted(keys, asked)
            return blocks.pack(kind=np.where(keys[place] == asked, kind[place], 0).astype(np.uint8))

        return answer
    sets, low = _set_part(total)
    return lambda part: blocks.pack(low=blocks.narrow(low[np.searchsorted(sets, _set_part(part)[0])].astype(np.uint64)))


def _signed(df: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """Rows (doc_id, set, size, first, alone, signatures): `first` tells the set's document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = blocks.numbered(), block_bytes(percent)
        for batch in batches:
            ids, column = batch.columns
            data, offsets = kernel.text_bytes(column)
            for a, b in kernel.chunks(offsets, size):
                own = ids.slice(a, b - a)
                numbers = blocks.numbers(own.cast(pa.int64()).fill_null(_LAST))
                block = _Block(numbers, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words, percent)
                # References and tokens are kept in order of bucket, as the answers come.
                rank = np.empty(len(block.tokens), np.int64)
                for start, at in block.by_token():
                    rank[at] = start + np.arange(len(at))
                sorted_tokens = np.empty(len(rank), np.uint64)
                sorted_tokens[rank] = block.tokens
                home = blocks.pack(
                    doc_id=own, size=blocks.narrow(block.size), set=block.sets, code=blocks.narrow(rank[block.code]),
                    n_code=blocks.narrow(np.diff(block.code_first)), token=sorted_tokens,
                    extra=block.extra, n_extra=blocks.narrow(np.diff(block.extra_first)),
                )
                yield blocks.rows(next(number), home, block.entries())
            del data, offsets, column, batch
            kernel.give_back()

    def finish(block: int, own: dict[str, pa.Array], found: list[tuple[int, dict[str, pa.Array]]]) -> pa.RecordBatch:
        ids = blocks.numbers(own["doc_id"].cast(pa.int64()).fill_null(_LAST))
        sets, size = blocks.numbers(own["set"]), blocks.numbers(own["size"]).astype(np.int64)
        tokens, code, extra = (blocks.numbers(own[c]) for c in ("token", "code", "extra"))
        kinds = np.zeros(len(tokens), np.uint8)
        number, distinct, _ = _pairs_of(ids, sets)
        low = np.full(len(distinct), _LAST)
        places = dict(blocks.in_buckets((distinct % np.uint64(BUCKETS)).astype(np.int64)))
        for start, got in found:
            if "kind" in got:
                kinds[start : start + len(got["kind"])] = blocks.numbers(got["kind"])
            else:
                low[places[start]] = blocks.numbers(got["low"]).astype(np.int64)
        code_first = np.concatenate([[0], np.cumsum(blocks.numbers(own["n_code"]).astype(np.int64))])
        extra_first = np.concatenate([[0], np.cumsum(blocks.numbers(own["n_extra"]).astype(np.int64))])
        block_low = np.full(len(distinct), _LAST)
        np.minimum.at(block_low, number, ids)
        held: list[list[int] | None] = [None] * len(ids)
        alone = np.zeros(len(ids), np.int64)
        # The tokens of equal sets are kept with the first of them in the block; of all
        # blocks, the one with the set's smallest id signs for it.
        for s, d in enumerate(np.unique(number, return_index=True)[1].tolist()):
            if size[d] and low[s] == block_low[s]:
                inner = code[code_first[d] : code_first[d + 1]]
                outer = extra[extra_first[d] : extra_first[d + 1]]
                kind = np.concatenate([kinds[inner], np.full(len(outer), 3, np.uint8)])
                held[d], alone[d] = signatures(np.concatenate([tokens[inner], outer]), kind, int(size[d]), percent)
        columns = [own["doc_id"], pa.array(sets.view(np.int64)), pa.array(size), pa.array(alone), pa.array(held, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "set", "size", "alone", "signatures"])

    kind = df.schema[doc_id].dataType.simpleString()
    staged = blocks.stage(df.select(doc_id, text).mapInArrow(cut, blocks.SCHEMA), "jaccard-blocks")
    n_blocks = blocks.homes(staged).count()
    answers = blocks.answered(staged, n_blocks, _add, _reply, _shared)
    schema = f"doc_id {kind}, set long, size long, alone long, signatures array<long>"
    signed = stored(blocks.bring_home(blocks.homes(staged), answers, finish, schema), "jaccard-signed")
    discard(staged, answers)
    return signed


def _tokens(df: DataFrame, candidates: DataFrame, text: str, words: int, size: int) -> DataFrame:
    """Rows (set, low, high): the tokens of candidate sets, 48 bits of each, in order.

    Texts are read again in pieces of `size` bytes.
    """
    table = candidates.selectExpr(f"pmod(set, {FILTER_BITS}) as bit").selectExpr("shiftright(bit, 5) as at", "shiftleft(1L, cast(bit % 32 as int)) as one")
    table = table.groupBy("at").agg(F.bit_or("one").alias("bits"))
    passed = np.zeros(FILTER_BITS >> 5, np.uint32)
    for row in table.collect():  # at most FILTER_BITS / 32 rows
        passed[row.at] = row.bits
    bits = df.sparkSession.sparkContext.broadcast(passed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernel.text_bytes(batch.column(0))
            for a, b in kernel.chunks(offsets, size):
                tokens, first = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)
                sets = set_hashes(tokens, first).view(np.int64)
                place = sets % FILTER_BITS
                wanted = (bits.value[place >> 5] >> (place & 31).astype(np.uint32)) & 1
                once = np.zeros(len(sets), bool)
                once[np.unique(sets, return_index=True)[1]] = True
                at = np.flatnonzero((wanted == 1) & once & (np.diff(first) > 0))
                short = tokens >> np.uint64(16)
                low = [short[first[d] : first[d + 1]].astype("<u4").tobytes() for d in at]
                high = [(short[first[d] : first[d + 1]] >> np.uint64(32)).astype("<u2").tobytes() for d in at]
                found = pa.RecordBatch.from_arrays([pa.array(sets[at]), pa.array(low, pa.binary()), pa.array(high, pa.binary())], names=["set", "low", "high"])
                del tokens, short, low, high
                yield found
                del found
                kernel.give_back()
            del data, offsets, batch
            kernel.give_back()

    found = df.select(text).mapInArrow(run, "set long, low binary, high binary")
    return found.join(candidates, "set", "left_semi").dropDuplicates(["set"])


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                x, y = _read(row, "_a"), _read(row, "_b")
                place = np.searchsorted(x, y)
                shared = int((x[np.minimum(place, len(x) - 1)] == y).sum())
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    a.append(row["a"])
                    b.append(row["b"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _beside(pairs, tokens).mapInArrow(run, "a long, b long")


def _mixed(own: DataFrame) -> DataFrame:
    """Rows of signatures that several components hold, with the smallest size of each."""
    held = own.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("size").alias("smallest"))
    held = stored(held.where("low <> high").select("sig", "smallest"), "jaccard-mixed")
    return stored(own.join(held, "sig"), "jaccard-own")


def _read(row: dict, side: str = "") -> np.ndarray:
    """The 48 bits of a set's tokens, in order."""
    low = np.frombuffer(row[f"low{side}"], "<u4").astype(np.int64)
    return low | np.frombuffer(row[f"high{side}"], "<u2").astype(np.int64) << 32


def _against(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rows (a, set, lacks, more): the set's tokens held against those of the set a.

    `lacks` has a bit of 64 for each token of a that the set has not, by its hash; `more`
    is how many tokens of the set a has not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                x, y = _read(row, "_a"), _read(row, "_b")
                missing = np.setdiff1d(x, y, assume_unique=True)
                bits = np.bitwise_or.reduce(np.uint64(1) << (kernel.mix(missing) & np.uint64(63)), initial=np.uint64(0))
                rows.append((row["a"], row["b"], int(bits.view(np.int64)), len(y) - (len(x) - len(missing))))
            columns = zip(*rows) if rows else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["a", "set", "lacks", "more"])

    return _beside(pairs.withColumnRenamed("set", "b"), tokens).mapInArrow(run, "a long, set long, lacks long, more int")


def _beside(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    sides = [tokens.select(F.col("set").alias(s), F.col("low").alias(f"low_{s}"), F.col("high").alias(f"high_{s}")) for s in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "low_a", "high_a", "low_b", "high_b")


def _alone(tokens: DataFrame) -> DataFrame:
    """Rows (set, alone): how many tokens of a set none of the other sets has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                token = _read(row)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.full(len(token), row["set"]))], names=["token", "set"])

    each = tokens.select("set", "low", "high").mapInArrow(run, "token long, set long")
    once = each.groupBy("token").agg(F.min("set").alias("set"), F.count("*").alias("n")).where("n = 1")
    return once.groupBy("set").agg(F.count("*").alias("alone"))


def link(df: DataFrame, words: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each document."""
    signed = _signed(df, doc_id, text, words, percent)
    held = signed.where("signatures is not null").select("set", "size", "alone", F.explode("signatures").alias("sig")).distinct()
    held = stored(held, "jaccard-held")
    first = F.min(F.struct("alone", "set", "size"))
    pivots = held.groupBy("sig").agg(first.alias("p"), F.count("*").alias("n")).where("n > 1")
    pivots = stored(pivots.select("sig", F.col("p.set").alias("a"), F.col("p.size").alias("size_a")), "jaccard-pivots")

    def alike(x: str, y: str):
        return F.col(x) * 100 >= F.col(y) * percent

    both = alike("size_a", "size") & alike("size", "size_a")
    # A set found with several pivots of the same kind is verified against each once.
    pairs = held.join(pivots, "sig").where((F.col("a") != F.col("set")) & both).select("a", F.col("set").alias("b"))
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-pairs")
    several = held.join(pivots.select("sig"), "sig", "left_semi")
    tokens = stored(_tokens(df, several.select("set").distinct(), text, words, block_bytes(percent)), "jaccard-tokens")
    links = stored(_verified(pairs, tokens, percent), "jaccard-links")
    roots = components(links)

    own = several.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    own = stored(own, "jaccard-own")
    own = _mixed(own)
    alone = stored(_alone(tokens.join(own.select("set").distinct(), "set", "left_semi")), "jaccard-alone")
    own = own.drop("alone").join(alone, "set", "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    # No more than the tokens that another of these sets has can be shared, and a linked
    # set has a size to be met: what falls short of it even with the smallest has no link.
    share = (100 + percent) * (F.col("size") - F.col("alone"))
    least = F.greatest("smallest", F.ceil(F.col("size") * percent / 100))
    own = _mixed(stored(own.where(share >= percent * (F.col("size") + least)).drop("smallest"), "jaccard-able")).drop("smallest")

    # Once more against one set each, now the one with fewest tokens of its own: what is
    # nearest to the others joins most of them.
    pivots = own.groupBy("sig").agg(F.min(F.struct("alone", "set", "size", "root")).alias("p"))
    pivots = stored(pivots.select("sig", F.col("p.set").alias("a"), F.col("p.size").alias("size_a"), F.col("p.root").alias("root_a")), "jaccard-pivots")
    near = own.join(pivots, "sig").where((F.col("root") != F.col("root_a")) & both)
    near = near.select(F.least("a", "set").alias("a"), F.greatest("a", "set").alias("b")).distinct()
    near = stored(near.join(pairs, ["a", "b"], "left_anti"), "jaccard-pairs")
    pairs = pairs.unionByName(near)
    links = stored(links.unionByName(_verified(near, tokens, percent)), "jaccard-links")
    roots = components(links)
    own = own.drop("root").join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    own = _mixed(stored(own, "jaccard-able")).drop("smallest")

    # Sets of one signature are held against its pivot c, of size n. Two of them share at
    # most what neither lacks of c, and of the rest what is not one's own: that tells most
    # pairs apart that do not link, without looking at their tokens together.
    centres = pivots.select("sig", F.col("a").alias("c"), F.col("size_a").alias("n"))
    own = stored(own.join(centres, "sig"), "jaccard-centred")
    held = stored(_against(own.select(F.col("c").alias("a"), "set").distinct(), tokens).withColumnRenamed("a", "c"), "jaccard-against")
    own = stored(own.join(held, ["c", "set"]).withColumn("more", F.col("more") - F.when(F.col("c") == F.col("set"), 0).otherwise(F.col("alone"))), "jaccard-placed")
    most = own.groupBy("sig", "root").count().groupBy("sig").agg(F.max(F.struct("count", "root")).alias("m"))
    most = stored(most.select("sig", F.col("m.root").alias("major")), "jaccard-major")
    # A pair of sets shares many signatures. Where one of the least few of both is shared, only the
    # least of those makes the pair; where none is, every shared one does.
    least_few = F.slice(F.array_sort(F.collect_set("sig")), 1, LEAST_FEW).alias("few")
    few = stored(own.groupBy("set").agg(least_few), "jaccard-few")
    own = own.join(most, "sig").join(few, "set").withColumn("minor", F.col("root") != F.col("major")).drop("major")
    own = stored(own, "jaccard-ready")
    left = own.where("minor").select("sig", F.col("set").alias("a"), *[F.col(c).alias(f"{c}_a") for c in ("size", "root", "alone", "lacks", "more", "few")])
    share_a = (100 + percent) * (F.col("size_a") - F.col("alone_a"))
    shared = F.col("n") - F.bit_count(F.col("lacks").bitwiseOR(F.col("lacks_a"))) + F.least("more", "more_a")
    most_shared = F.least(share, share_a, (100 + percent) * shared)
    enough = most_shared >= percent * (F.col("size") + F.col("size_a"))
    once = ~F.col("minor") | (F.col("a") < F.col("set"))
    common = F.array_min(F.array_intersect("few", "few_a"))
    made_here = common.isNull() | (F.col("sig") <= common)
    rest = left.join(own, "sig").where((F.col("root_a") != F.col("root")) & once & both & enough & made_here).select("a", F.col("set").alias("b"))
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = rest.join(pairs, ["a", "b"], "left_anti")
    more = stored(_verified(rest, tokens, percent), "jaccard-links")
    roots = stored(components(links.unionByName(more)), "jaccard-roots")

    placed = signed.select("doc_id", "set", "size").join(roots.withColumnRenamed("node", "set"), "set", "left")
    placed = stored(placed.withColumn("root", F.coalesce("root", "set")), "jaccard-placed")
    least = stored(placed.where("size > 0").groupBy("root").agg(F.min("doc_id").alias("least")), "jaccard-least")
    component = F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return placed.join(least, "root", "left").select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))
