"""Joins many small things per document to a global table without a row for each.

A task packs its documents into blocks of bounded size. A block keeps, for every distinct
item (word, pre-token, context) of its documents, one entry, and where each document uses
it. Only the entries travel: dealt by a bucket of the item, answered there once per item,
and sent back to their block, where the answers meet the documents again. An item that
every document holds is one entry per block, so no task gets more than the others.

Rows of the exchange are (block, bucket, start, payload): `payload` holds the entries of
one block and bucket, `start` the place of the first among the block's entries.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, dropping_shuffles, work_path
from . import kernel
from .components import stored

#: Text of one block; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Blocks whose entries one task adds up, and to which one task gives answers.
FAN_IN, FAN_OUT = 64, 512
#: Text whose distinct items are one bucket's, and the most buckets: with more, a block's
#: entries for one are fewer than what packing them takes.
BUCKET_BYTES, BUCKETS_MOST = 16 << 20, 1 << 12

SCHEMA = "block long, bucket int, start int, payload binary"
_ARROW = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("start", pa.int32()), ("payload", pa.binary())])
#: The bucket of the row that holds the block's documents.
HOME = -1


def pack(**columns: pa.Array | np.ndarray) -> bytes:
    """Columns of any lengths as compressed bytes."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    lists = [pa.array(c) if not isinstance(c, pa.Array) else c for c in columns.values()]
    lists = [pa.LargeListArray.from_arrays(pa.array([0, len(c)], pa.int64()), c) for c in lists]
    batch = pa.RecordBatch.from_arrays(lists, names=list(columns))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> dict[str, pa.Array]:
    batch = next(iter(pa.ipc.open_stream(pa.py_buffer(payload))))
    return {n: batch.column(i).flatten() for i, n in enumerate(batch.schema.names)}


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest unsigned type, which compresses best."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)


def rows(block: int, home: bytes, entries: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """The rows of one block: its documents, and (bucket, start, payload) for its entries."""
    buckets = [HOME, *(b for b, _, _ in entries)]
    starts = [0, *(s for _, s, _ in entries)]
    payloads = [home, *(p for _, _, p in entries)]
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(buckets), pa.int64()), pa.array(buckets, pa.int32()),
         pa.array(starts, pa.int32()), pa.array(payloads, pa.binary())],
        schema=_ARROW,
    )


def in_buckets(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(start, places) of each bucket's entries, among all entries in order of bucket."""
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    begin = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    for a, b in zip(begin, np.append(begin[1:], len(order))):
        yield int(a), order[a:b]


def buckets_for(df: DataFrame, text: str, least: int) -> int:
    """How many buckets the distinct items of all texts are dealt to; it follows their bytes."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return min(max(least, 1 << (size // BUCKET_BYTES).bit_length()), BUCKETS_MOST)


def numbered() -> Iterator[int]:
    """Block numbers that no other task gives."""
    return itertools.count(TaskContext.get().partitionId() << 32)


def stage(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read again.

    Block numbers are then fixed, whatever task is run again. What belongs to documents
    and what travels lie in folders of their own, so each is read alone.
    """
    path = work_path(df.sparkSession, label)
    with dropping_shuffles(df.sparkSession):
        df.withColumn("home", F.col("bucket") == HOME).write.partitionBy("home").parquet(path)
    schema = df.schema.add("home", "boolean")
    return df.sparkSession.read.schema(schema).parquet(path)


def homes(staged: DataFrame) -> DataFrame:
    return staged.where("home").drop("home")


def entries(staged: DataFrame) -> DataFrame:
    return staged.where("not home").drop("home")


def by_group(
    df: DataFrame, keys: list[str], order: list[str], run: Callable[[Iterator[dict]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Deals rows by `keys` and runs `run` over each task's rows, in order of keys and `order`."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
        kernel.give_back()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(each, schema)


def answer(df: DataFrame, n_blocks: int, reply: Callable[[], Callable[[int, dict[str, pa.Array]], bytes]]) -> DataFrame:
    """Answers every entry row in its bucket; a task answers for `FAN_OUT` blocks.

    `reply()` makes one task's answering function.
    """

    def run(found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        answering = reply()
        for row in found:
            payload = answering(row["bucket"], unpack(row["payload"]))
            yield _row(row["block"], row["bucket"], row["start"], payload)

    groups = math.ceil(max(n_blocks, 1) / FAN_OUT)
    return by_group(_salted(df, groups), ["bucket", "salt"], ["block"], run, SCHEMA)


def _row(block: int, bucket: int, start: int, payload: bytes) -> pa.RecordBatch:
    columns = [[block], [bucket], [start], [payload]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _salted(df: DataFrame, groups: int) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(groups)))


def totals(
    found: DataFrame, n_blocks: int, add: Callable[[list[dict[str, pa.Array]]], bytes],
    trim: Callable[[dict[str, pa.Array]], bytes] | None = None,
) -> DataFrame:
    """What each bucket's entries of all blocks come to, in one row each, by a tree of tasks.

    `add` puts parts of the same bucket together; a task adds those of `FAN_IN` blocks. At last `trim`
    leaves out of the sum what answers can do without.
    """

    def run(rows: Iterator[dict], last: bool) -> Iterator[pa.RecordBatch]:
        for (bucket, block), group in itertools.groupby(rows, key=lambda row: (row["bucket"], row["salt"])):
            parts: list[dict[str, pa.Array]] = []
            size = 0
            for row in group:
                parts.append(unpack(row["payload"]))
                size += len(next(iter(parts[-1].values())))
                if len(parts) > 8 and size > 4 * len(next(iter(parts[0].values()))):
                    parts = [unpack(add(parts))]
                    size = len(next(iter(parts[0].values())))
            total = add(parts)
            yield _row(block, bucket, 0, trim(unpack(total)) if last and trim else total)

    groups = max(n_blocks, 1)
    while True:
        groups = math.ceil(groups / FAN_IN)
        each = functools.partial(run, last=groups == 1)
        found = by_group(_salted(found, groups), ["bucket", "salt"], ["block"], each, SCHEMA)
        if groups == 1:
            return found


def replies(
    found: DataFrame,
    total: DataFrame,
    n_blocks: int,
    reply: Callable[[int, dict[str, pa.Array] | None], Callable[[dict[str, pa.Array]], bytes]],
) -> DataFrame:
    """Answers every entry from its bucket's total.

    `reply(bucket, total)` makes the answering function; a task answers for `FAN_OUT` blocks.
    """

    def run(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        for bucket, group in itertools.groupby(rows, key=lambda row: row["bucket"]):
            answering = None
            for row in group:
                part = unpack(row["payload"])
                if row["block"] < 0:
                    answering = reply(bucket, part)
                    continue
                answering = answering or reply(bucket, None)
                yield _row(row["block"], bucket, row["start"], answering(part))

    groups = math.ceil(max(n_blocks, 1) / FAN_OUT)
    copies = total.withColumns({"block": F.lit(-1).cast("long"), "salt": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    asked = _salted(found, groups).unionByName(copies.withColumn("salt", F.col("salt").cast("long")))
    return by_group(asked, ["bucket", "salt"], ["block"], run, SCHEMA)


def answered(
    staged: DataFrame, n_blocks: int, add: Callable[[list[dict[str, pa.Array]]], bytes],
    reply: Callable[[int, dict[str, pa.Array] | None], Callable[[dict[str, pa.Array]], bytes]],
    trim: Callable[[dict[str, pa.Array]], bytes] | None = None,
) -> DataFrame:
    """The answers to all staged entries from their totals; the entries are removed.

    Totals and answers are written each by a job of its own, so that the shuffles of one are gone
    before the next one's.
    """
    total = stored(totals(entries(staged), n_blocks, add, trim), "totals")
    answers = stored(replies(entries(staged), total, n_blocks, reply), "answers")
    discard(total)
    discard(staged, part="home=false")
    return answers


def bring_home(
    home: DataFrame, answers: DataFrame, finish: Callable[[int, dict[str, pa.Array], list[tuple[int, dict[str, pa.Array]]]], pa.RecordBatch], schema: str
) -> DataFrame:
    """Each block's documents with the answers to its entries, as `finish` makes rows of them."""

    def run(found: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        for block, group in itertools.groupby(found, key=lambda row: row["block"]):
            own = unpack(next(group)["payload"])
            yield finish(block, own, [(row["start"], unpack(row["payload"])) for row in group])

    return by_group(home.unionByName(answers), ["block"], ["bucket"], run, schema)
