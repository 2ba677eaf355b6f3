"""Byte-level BPE, encoding and decoding, as DuckDB queries inside each Spark partition.

Each task cuts its texts into pre-tokens, keeps every distinct pre-token once, and hands
those that are no token themselves to a recursive query: rows of (word, position, token)
join the table of merges, and each round contracts every word's leftmost pair of least
rank until no pair of any word can be merged. What a task has merged it keeps, up to
`KNOWN_IDS`, and looks up by hash for the texts that follow. Decoding joins ids to their bytes
and puts them together by an ordered aggregation.

A word of more than `LONGEST` bytes goes to the query in windows that overlap by half. Tokens
are a word's encoding where each two neighbours are the encoding of their own bytes, since the
first contraction across a border would also be made in these bytes alone; so two windows that
share a token are joined there, exactly. Where neighbours share none, windows that grow are laid
from token to token until they meet the small ones again.

The vocabulary is a file of ranks, read once per Python worker. It has a fixed size; the
work of a task is bounded by `GROUP_BYTES` of text or by its longest text, whatever its words.

Defined results: a null text encodes as an empty one, with no ids; equal rows give equal
rows; a table without rows gives none; columns beside the named ones pass through or are
left out by name and never clash, as only named columns are read. Ids must be of the
vocabulary: an unknown id, or a null one, makes the decoded value null.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel, pretokens

#: Text whose distinct pre-tokens are merged by one query, and text that is split and put together at once.
GROUP_BYTES, TEXT_BYTES = 4 << 20, 1 << 18
#: Ids of pre-tokens that a task keeps; beyond that, it keeps those of the last group.
KNOWN_IDS = 1 << 21
#: From this many bytes, pre-tokens are told apart by a digest: sums of powers are equal for some of 1024.
DIGESTED = 256
#: From this many bytes, a word's equal pairs are contracted in the same round where that
#: gives the same as one by one; rounds then follow the merges, not the length.
LONG_WORD = 48
#: Words merged by one query.
QUERY_WORDS = 30_000
#: From more than this many bytes, words are merged in windows of this size, at most so many
#: by one query; where these do not meet, in windows that grow from the first to the last size.
LONGEST, WINDOW, QUERY_WINDOWS = 1024, 64, 15_000
FIRST_STRIDE, LAST_STRIDE = 256, 1 << 18
#: Ids decoded by one query.
QUERY_IDS = 100_000

_PAIRS = """
    select w, pos, tok, m.id, min(m.id) over (partition by w) as best
    from (select w, pos, tok, lead(tok) over (partition by w order by pos) as nxt from step where live)
    left join merges m on m.l = tok and m.r = nxt
"""

#: One contraction for each word and round: its leftmost pair of least rank. A word's
#: tokens travel as a list, unnested to rows of (word, position, token, next token).
LEFTMOST = """
with recursive step(w, toks, live) as (
  select w, toks, true from start
  union all
  select s.w,
    case when place is null then toks else list_concat(toks[:place - 1], [best], toks[place + 2:]) end,
    place is not null
  from step s left join (
    select w, cast(min((cast(m.id as bigint) << 8) | pos) >> 8 as int) as best,
      min((cast(m.id as bigint) << 8) | pos) & 255 as place
    from (
      select w, unnest(toks) as tok, unnest(toks[2:]) as nxt, generate_subscripts(toks, 1) as pos
      from step where live
    )
    join merges m on m.l = tok and m.r = nxt
    group by w
  ) using (w)
  where s.live
)
select w, toks from step where not live
"""

#: The same result in fewer rounds: every second pair of each chain of pairs of least
#: rank, from the left, unless a contraction makes a pair of lower rank, which must come
#: first; then only the leftmost.
TOGETHER = f"""
with recursive step(w, pos, tok, live) as (
  select w, pos, tok, true from start
  union all
  select w, pos, case when pick then best else tok end, best is not null
  from (
    select *, lag(pick, 1, false) over (partition by w order by pos) as gone
    from (
      select w, pos, tok, best, pick and (pos = place or not undercut) as pick
      from (
        select f.*, min(case when pick then f.pos end) over (partition by f.w) as place,
          coalesce(bool_or(pick and (coalesce(a.id < best, false) or coalesce(b.id < best, false)))
            over (partition by f.w), false) as undercut
        from (
          select *, case when lag(pick, 2, false) over s then best else lag(tok) over s end as prev,
            lead(tok, 2) over s as later
          from (
            select *, hit and (row_number() over (partition by w, hit, chain order by pos)) % 2 = 1 as pick
            from (
              select *, row_number() over (partition by w order by pos)
                - row_number() over (partition by w, hit order by pos) as chain
              from (select *, coalesce(id = best, false) as hit from ({_PAIRS}))
            )
          )
          window s as (partition by w order by pos)
        ) f
        left join merges a on a.l = f.prev and a.r = f.best
        left join merges b on b.l = f.best and b.r = f.later
      )
    )
  )
  where not gone
)
select w, pos, tok from step where not live order by w, pos
"""

DECODE = """
select t.doc, unhex(string_agg(v.hex, '' order by t.pos)) as bytes, count(*) as n, count(v.hex) as known
from ids t left join vocabulary v on v.id = t.id
group by t.doc order by t.doc
"""


#: Numbers of words, their ids end to end, and how many each has.
Merged = tuple[np.ndarray, np.ndarray, np.ndarray]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs of this size, end to end."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(size.sum()))


def _in_order(parts: list[Merged]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words by their numbers, end to end, and how many each has."""
    none = np.zeros(0, np.int32)
    number, ids, size = (np.concatenate(column) for column in zip((none, none, none), *parts))
    order = np.argsort(number)
    start = np.cumsum(size) - size
    return ids[_runs(start[order], size[order])], size[order]


class Vocabulary:
    """Tokens by rank, and a connection that holds the tables of merges and of bytes."""

    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        ids = self.ranks.values()
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.length = np.zeros(max(ids) + 1, np.int64)
        self.length[list(ids)] = [len(t) for t in self.ranks]
        left, right, made = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        self.base = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "250MB", "temp_directory": ""})
        self.base.execute("set enable_progress_bar = false")
        self._table("merges", l=np.array(left, np.int32), r=np.array(right, np.int32), id=np.array(made, np.int32))
        self._table("vocabulary", id=np.array(list(ids), np.int32), hex=[t.hex() for t in self.ranks])

    def _table(self, name: str, **columns) -> None:
        table = pa.table(columns)
        self.base.register("incoming", table)
        self.base.execute(f"create or replace table {name} as select * from incoming")
        self.base.unregister("incoming")

    def _query(self, sql: str, name: str, **columns) -> pa.Table:
        self._table(name, **columns)
        out = self.base.sql(sql).to_arrow_table()
        self.base.execute(f"drop table {name}")
        return out

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has, by the recursive query."""
        length = np.array([len(w) for w in words], np.int64)
        short = np.flatnonzero(length < LONG_WORD)
        parts = [self._merge_short(words, short[at : at + QUERY_WORDS]) for at in range(0, len(short), QUERY_WORDS)]
        for i in np.flatnonzero(length > LONGEST):
            ids = Windows(self, words[i]).ids()
            parts.append((np.array([i]), ids, np.array([len(ids)])))
        long = np.flatnonzero((length >= LONG_WORD) & (length <= LONGEST))
        at = 0
        while at < len(long):
            total = np.cumsum(length[long[at : at + QUERY_WORDS]])
            end = at + max(1, int(np.searchsorted(total, LONG_WORD * QUERY_WORDS, "right")))
            parts.append(self._merge_long(words, long[at:end]))
            at = end
        return _in_order(parts)

    def _bytes_of(self, words: list[bytes], of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = [words[i] for i in of.tolist()]
        return self.single[np.frombuffer(b"".join(own), np.uint8)], np.array([len(w) for w in own], np.int64)

    def _merge_short(self, words: list[bytes], of: np.ndarray) -> Merged:
        toks, size = self._bytes_of(words, of)
        bounds = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
        found = self._query(
            LEFTMOST, "start", w=pa.array(of, pa.int32()), toks=pa.ListArray.from_arrays(bounds, pa.array(toks))
        )
        lists = found.column("toks").combine_chunks()
        return found.column("w").to_numpy(), lists.flatten().to_numpy(), lists.value_lengths().to_numpy()

    def _merge_long(self, words: list[bytes], of: np.ndarray) -> Merged:
        toks, size = self._bytes_of(words, of)
        pos = np.arange(len(toks)) - np.repeat(np.cumsum(size) - size, size)
        found = self._query(TOGETHER, "start", w=np.repeat(of, size).astype(np.int32), pos=pos.astype(np.int32), tok=toks)
        number, size = np.unique(found.column("w").to_numpy(), return_counts=True)
        return number, found.column("tok").to_numpy(), size

    def merge_short(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of windows, of at most 255 bytes each."""
        every = np.arange(len(words))
        parts = [self._merge_short(words, every[at : at + QUERY_WINDOWS]) for at in range(0, len(words), QUERY_WINDOWS)]
        ids, size = _in_order(parts)
        return np.split(ids, np.cumsum(size)[:-1])

    def merge_whole(self, word: bytes) -> np.ndarray:
        """The ids of one word by one query over all of it."""
        return self._merge_long([word], np.array([0]))[1]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pre-tokens end to end, and how many each has. One that is a token is that token."""
        rank = np.array([self.ranks.get(w, -1) for w in words], np.int32)
        whole, rest = np.flatnonzero(rank >= 0), np.flatnonzero(rank < 0)
        merged = self.merge([words[i] for i in rest.tolist()])
        return _in_order([(whole, rank[whole], np.ones(len(whole), np.int64)), (rest, *merged)])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes | None]:
        """The bytes of each run of ids; None if it has an id that is unknown."""
        n = len(offsets) - 1
        size = np.diff(offsets)
        pos = np.arange(len(ids)) - np.repeat(offsets[:-1], size)
        doc = np.repeat(np.arange(n), size)
        found = self._query(
            DECODE, "ids", doc=doc.astype(np.int32), pos=pos.astype(np.int32), id=ids.astype(np.int64)
        )
        out: list[bytes | None] = [b""] * n
        for d, b, total, known in zip(*(found.column(i).to_pylist() for i in range(4))):
            out[d] = b if total == known else None
        return out


class Windows:
    """A long word in windows that overlap by half, and the tokens that neighbours share.

    `left` and `right` give for each two neighbours the place of a shared token among the
    tokens of all windows, as one window and as the next has it; -1 if they share none.
    """

    def __init__(self, vocab: Vocabulary, word: bytes):
        self.vocab, self.word = vocab, word
        step = WINDOW // 2
        starts = np.arange(0, len(word) - step, step)
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(word[s : s + WINDOW], len(number)) for s in starts.tolist()])
        found = vocab.merge_short(list(number))
        size = np.array([len(x) for x in found])[which]
        self.first = np.cumsum(size) - size
        window = np.repeat(np.arange(len(starts)), size)
        self.tokens = np.concatenate([found[k] for k in which.tolist()])
        ends = np.cumsum(vocab.length[self.tokens])
        at = ends - vocab.length[self.tokens]
        at += np.repeat(starts - at[self.first], size)
        # A token by its place and id; each is in two windows at most, and those are neighbours.
        self.key = at << 32 | self.tokens
        order = np.argsort(self.key, kind="stable")
        same = np.flatnonzero(self.key[order[1:]] == self.key[order[:-1]])
        border, k = np.unique(window[order[same]], return_index=True)
        self.left = np.full(len(starts) - 1, -1)
        self.right = self.left.copy()
        self.left[border], self.right[border] = order[same][k], order[same + 1][k]

    def ids(self) -> np.ndarray:
        out: list[np.ndarray] = []
        broken = np.flatnonzero(self.left < 0)
        k = begin = 0
        while True:
            to = broken[np.searchsorted(broken, k) :][:1]
            to = int(to[0]) if len(to) else len(self.left)
            # Windows from k to the next border without a shared token.
            lo = np.concatenate([[begin], self.right[k:to] + 1])
            hi = np.concatenate([self.left[k:to] + 1, [len(self.tokens)]])
            if to == len(self.left):
                out += [self.tokens[a:b] for a, b in zip(lo.tolist(), hi.tolist())]
                return np.concatenate(out)
            out += [self.tokens[a:b] for a, b in zip(lo[:-1].tolist(), hi[:-1].tolist())]
            # The last token taken is the first of what is laid from here.
            last = self.left[to - 1] if to > k else begin - 1 if begin else -1
            found = self._laid(int(self.key[last] >> 32), int(self.tokens[last]), to) if last >= 0 else None
            if last >= 0 and found is not None:
                out[-1] = out[-1][:-1]
            else:
                out, size = [], FIRST_STRIDE
                while (found := self._laid(0, None, to, size)) is None:
                    size *= 4
            ids, k = found
            out.append(ids)
            if k < 0:
                return np.concatenate(out)
            begin = int(self.right[k]) + 1
            k += 1

    def _laid(self, start: int, expected: int | None, border: int, size: int = FIRST_STRIDE) -> tuple[np.ndarray, int] | None:
        """Tokens from `start` to one that the neighbours of a border behind `border` share, and that border.

        The border is -1 at the word's end. None if a window does not begin with the token at
        which the one before ends, the first one with `expected`.
        """
        vocab, word = self.vocab, self.word
        shared = np.flatnonzero(self.left[border:] >= 0) + border
        keys = self.key[self.left[shared]]
        out: list[np.ndarray] = []
        while True:
            tokens = vocab.merge_whole(word[start : start + size])
            if expected is not None and tokens[0] != expected:
                return None
            ends = start + np.cumsum(vocab.length[tokens])
            at = ends - vocab.length[tokens]
            if start + size >= len(word):
                return np.concatenate([*out, tokens]), -1
            own = at << 32 | tokens
            place = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
            met = np.flatnonzero(keys[place] == own) if len(keys) else place[:0]
            if len(met):
                m = int(met[-1])
                return np.concatenate([*out, tokens[: m + 1]]), int(shared[place[m]])
            m = min(int(np.searchsorted(at, start + size * 3 // 4)), len(tokens) - 1)
            if not m:
                return None
            out.append(tokens[:m])
            start, expected = int(at[m]), int(tokens[m])
            size = max(size, min(2 * size, LAST_STRIDE))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.cache
def exact_splitter(pattern: str):
    import regex

    return regex.compile(pattern).findall


class Known:
    """The ids of pre-tokens that a task has met, by ascending hash; most come again in its next texts."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def lacks(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(hashes), bool)
        return self.hashes[np.minimum(self.places(hashes), len(self.hashes) - 1)] != hashes

    def places(self, hashes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.hashes, hashes)

    def add(self, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Takes in pre-tokens by ascending hash, none of which it has."""
        at, start = self.places(hashes), len(self.ids) + np.cumsum(size) - size
        self.hashes, self.start = np.insert(self.hashes, at, hashes), np.insert(self.start, at, start)
        self.size = np.insert(self.size, at, size)
        self.ids = np.concatenate([self.ids, ids])

    def keep(self, hashes: np.ndarray) -> None:
        """Drops all but these, or these too where they alone have more than `KNOWN_IDS`."""
        at = self.places(hashes)
        if self.size[at].sum() > KNOWN_IDS:
            at = at[:0]
        self.ids = self.ids[_runs(self.start[at], self.size[at])]
        self.hashes, self.size = self.hashes[at], self.size[at]
        self.start = np.cumsum(self.size, dtype=np.int64) - self.size


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first place of each distinct span, and the number of it for every span."""
    hashes = kernel.span_hashes(data, starts, ends)
    for i in np.flatnonzero(ends - starts >= DIGESTED).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return np.unique(hashes, return_index=True, return_inverse=True)


def encode_texts(column: pa.Array, vocab: Vocabulary, pattern: str, known: Known | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts end to end, and where each text's begin. What is in `known` is not merged again."""
    known = Known() if known is None else known
    data, offsets = kernel.text_bytes(column)
    parts, unmet = [], []
    for a, b in kernel.chunks(offsets, TEXT_BYTES):
        lo = offsets[a]
        part, own = data[lo : offsets[b]], offsets[a : b + 1] - lo
        starts, ends, begin = pretokens.split(part, own, exact_splitter(pattern))
        hashes, place, number = _distinct(part, starts, ends)
        new = known.lacks(hashes)
        unmet.append((hashes[new], lo + starts[place[new]], lo + ends[place[new]]))
        parts.append((hashes, number.astype(np.int32), begin[1:]))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(len(column) + 1, np.int64)
    hashes, starts, ends = map(np.concatenate, zip(*unmet))
    hashes, place = np.unique(hashes, return_index=True)
    raw = data.tobytes()
    known.add(hashes, *vocab.encode([raw[x:y] for x, y in zip(starts[place].tolist(), ends[place].tolist())]))
    out, bounds = [], [np.zeros(1, np.int64)]
    for hashes, number, begin in parts:
        at = known.places(hashes)[number]
        own = known.size[at]
        ends = np.concatenate([[0], np.cumsum(own, dtype=np.int64)])
        out.append(known.ids[_runs(known.start[at], own)])
        bounds.append(bounds[-1][-1] + ends[begin])
    if len(known.ids) > KNOWN_IDS:
        known.keep(np.unique(np.concatenate([hashes for hashes, _, _ in parts])))
    return np.concatenate(out), np.concatenate(bounds)


def release() -> None:
    """Let go of the vocabulary and its connection: a worker's next task may be of another kind."""
    vocabulary.cache_clear()
    kernel.give_back()


def _groups(column: pa.Array, group: int) -> Iterator[tuple[int, int]]:
    size = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    yield from kernel.chunks(size, group)


def _encoding(batches: Iterator[pa.RecordBatch], path: str, pattern: str, text: str, into: str, group: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    vocab, known = vocabulary(path), Known()
    for batch in batches:
        keep = [c for c in batch.schema.names if c != into]
        column = batch.column(text)
        for a, b in _groups(column, group):
            ids, bounds = encode_texts(column.slice(a, b - a), vocab, pattern, known)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            rest = batch.select(keep).slice(a, b - a)
            del ids, bounds
            kernel.give_back()
            yield pa.RecordBatch.from_arrays([*rest.columns, lists], names=[*keep, into])


def _decoding(batches: Iterator[pa.RecordBatch], path: str, ids: str, into: str) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(path)
    for batch in batches:
        keep = [c for c in batch.schema.names if c != into]
        lists = batch.column(ids)
        null = lists.is_null().to_numpy(zero_copy_only=False)
        size = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(size.astype(np.int64))])
        for a, b in kernel.chunks(bounds, QUERY_IDS):
            flat = pa.compute.fill_null(lists.slice(a, b - a).flatten(), -1).to_numpy(zero_copy_only=False)
            found = vocab.decode(flat, bounds[a : b + 1] - bounds[a])
            found = [None if n else x for n, x in zip(null[a:b], found)]
            rest = batch.select(keep).slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(found, pa.binary())], names=[*keep, into])
        del batch, lists
        kernel.give_back()


def _with(df: DataFrame, **added: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name not in added] + [T.StructField(n, t) for n, t in added.items()])


_IDS = T.ArrayType(T.IntegerType(), False)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Adds `into`, the ids of `text` as array<int>, by the ranks of the file `path`.

    A column that has this name already is replaced.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoding(rows, path, pattern, text, into)
        release()

    return df.mapInArrow(run, _with(df, **{into: _IDS}))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds `into`, the bytes that `ids` stand for; null ids or an unknown id give null."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoding(rows, path, ids, into)
        release()

    return df.mapInArrow(run, _with(df, **{into: T.BinaryType()}))


def encode_and_decode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", group: int = GROUP_BYTES
) -> DataFrame:
    """`encode`, then `decode` of its ids, in the same Python worker; a smaller `group` of bytes takes less memory and more time."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoding(_encoding(rows, path, pattern, text, ids, group), path, ids, decoded)
        release()

    return df.mapInArrow(run, _with(df, **{ids: _IDS, decoded: T.BinaryType()}))


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and hashes of the ids and of what they decode to."""
    return encode_and_decode(documents.select("doc_id", "text"), path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
