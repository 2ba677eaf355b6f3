"""Exact top-k search by inner product over buckets of vectors of like length.

Vectors become whole numbers, floor(scale * x), and are grouped by their length; a bucket
of very many is dealt over blocks of about `BLOCK_ROWS`. A first pass over one block of
long vectors gives every query a score that its k-th best reaches at least. From it a
query has, for each bucket, a least cosine with which a vector of that length can still
enter its list: over 1, the bucket is not visited at all. In a visited block the threshold
chooses the pruning. A high one bounds coordinates: a vector within that angle of the
query has each coordinate within a known range, and the query's largest ones are tested. A
low one leaves only the length to test. What is left is verified by exact products, and
the threshold rises with what is found.

The vectors are dealt once; only queries are sent to more than one block.

Defined results: a vector that is null, empty, or holds a null or a non-finite component
takes no part, neither as a query nor as a candidate; what scaling takes beyond the largest double is held there.
Vectors of different dimension are not compared. Rows are told apart as rows: repeated
rows and ids are candidates each, only the query's own row is not. Products beyond 64 bits are held at the limits. Ties go to the smaller
id, null ids last. A table without rows, or with one, gives no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_path
from . import blocks

#: Vectors of one block.
BLOCK_ROWS = 4096
#: Buckets of length to each doubling.
PER_OCTAVE = 4
#: Least cosine from which coordinates are tested, and how many of them.
BY_COORDINATE, COORDINATES = 0.6, 4
#: Allowance for rounding in bounds; products themselves are exact.
SLACK = 1e-9
_MOST = np.finfo(np.float64).max


def _whole(batch: pa.RecordBatch, scale: float, number: Iterator[int]) -> pa.RecordBatch:
    ids, column = batch.columns
    lists = column.to_pylist()
    rows = []
    for vec_id, xs in zip(ids.to_pylist(), lists):
        row = next(number)
        if not xs or any(x is None for x in xs):
            continue
        value = np.array(xs, np.float64)
        if not np.isfinite(value).all():
            continue
        with np.errstate(over="ignore"):
            value = np.clip(np.floor(scale * value), -_MOST, _MOST)
            longest = float(np.abs(value).max())
            # Divided by the longest component first, as squares could pass the largest number.
            norm = min(longest * math.sqrt(float(np.square(value / longest).sum())), _MOST) if longest else 0.0
        bucket = math.floor(math.log2(norm) * PER_OCTAVE) if norm else -1
        rows.append((row, vec_id, len(value), bucket, norm, value.astype("<f8").tobytes()))
    names = ["row", "vec_id", "dims", "bucket", "norm", "value"]
    kinds = [pa.int64(), ids.type, pa.int32(), pa.int32(), pa.float64(), pa.binary()]
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)


class _Block:
    """The vectors of one block, longest first."""

    def __init__(self, rows: list[dict]):
        rows.sort(key=lambda r: -r["norm"])
        self.row = np.array([r["row"] for r in rows], np.int64)
        self.vec_id = [r["vec_id"] for r in rows]
        null = np.array([i is None for i in self.vec_id])
        self.order = np.argsort(np.lexsort((np.array([i or 0 for i in self.vec_id], np.int64), null)))
        self.value = np.array([np.frombuffer(r["value"], "<f8") for r in rows])
        self.norm = np.array([r["norm"] for r in rows])
        self.unit = self.value / np.maximum(self.norm, 1e-300)[:, None]

    def products(self, at: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
        """Exact inner products; whole numbers below 2^53 are exact in floating point.

        Products beyond 64 bits count as the largest or smallest number of 64 bits.
        """
        small = self.norm[at] * norm < 2**52
        out = np.zeros(len(at), np.int64)
        out[small] = (self.value[at[small]] @ query).astype(np.int64)
        if not small.all():
            asked = [int(x) for x in query]
            for i in np.flatnonzero(~small).tolist():
                whole = sum(int(x) * y for x, y in zip(self.value[at[i]], asked))
                out[i] = max(min(whole, 2**63 - 1), -(2**63))
        return out

    def candidates(self, query: np.ndarray, norm: float, least: float | None) -> np.ndarray:
        """Places of vectors whose product can reach `least`."""
        if least is None or least <= 0 or not norm:
            return np.arange(len(self.norm))
        least *= 1 - SLACK
        n = int(np.searchsorted(-self.norm, -least / norm, "right"))
        if not n:
            return np.zeros(0, np.int64)
        cosine = least / (norm * self.norm[0])
        if cosine < BY_COORDINATE:
            return np.arange(n)
        angle = math.acos(min(1.0, cosine))
        keep = np.ones(n, bool)
        unit = query / norm
        for f in np.argsort(-np.abs(unit))[:COORDINATES]:
            own = math.acos(max(-1.0, min(1.0, unit[f])))
            low, high = math.cos(min(math.pi, own + angle)), math.cos(max(0.0, own - angle))
            keep &= (self.unit[:n, f] >= low - SLACK) & (self.unit[:n, f] <= high + SLACK)
        return np.flatnonzero(keep)

    def best(self, row: int, query: np.ndarray, norm: float, k: int, least: float | None) -> list[tuple[int, int]]:
        """(place, score) of the k best that reach `least`, of the block's rows but `row`."""
        found: list[tuple[int, int]] = []
        step = 512
        for at in range(0, len(self.norm), step):
            if len(found) == k:
                least = max(found[-1][1], -math.inf if least is None else least)
            if at and least is not None and least > 0 and self.norm[at] * norm < least * (1 - SLACK):
                break
            if not at:
                places = self.candidates(query, norm, least)
            own = places[(places >= at) & (places < at + step)]
            own = own[self.row[own] != row]
            if not len(own):
                continue
            scores = self.products(own, query, norm)
            if least is not None:
                own, scores = own[scores >= least], scores[scores >= least]
            best = np.lexsort((self.order[own], -scores))[:k]
            found += zip(own[best].tolist(), scores[best].tolist())
            found.sort(key=lambda x: (-x[1], self.order[x[0]]))
            del found[k:]
        return found


def _search(k: int, kind: pa.DataType):
    names = ["query", "query_id", "vec_id", "score"]

    def run(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        for _, group in itertools.groupby(rows, key=lambda r: (r["dims"], r["bucket"], r["part"])):
            vectors: list[dict] = []
            block = None
            out: list[tuple] = []
            for row in group:
                if not row["asks"]:
                    vectors.append(row)
                    continue
                if not vectors and block is None:
                    break
                if block is None:
                    block, vectors = _Block(vectors), []
                query = np.frombuffer(row["value"], "<f8")
                for place, score in block.best(row["row"], query, row["norm"], k, row["least"]):
                    out.append((row["row"], row["vec_id"], block.vec_id[place], score))
                if len(out) > 20_000:
                    yield _rows(out, names, kind)
                    out = []
            if out:
                yield _rows(out, names, kind)

    return run


def _rows(out: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), kind, kind, pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*out)), kinds)], names=names)


def _visit(vectors: DataFrame, queries: DataFrame, k: int, kind: str) -> DataFrame:
    """The k best of each block for every query sent to it."""
    columns = ["dims", "bucket", "part", "asks", "row", "vec_id", "norm", "value", "least"]
    vectors = vectors.withColumns({"asks": F.lit(False), "least": F.lit(None).cast("double")})
    both = vectors.select(columns).unionByName(queries.withColumn("asks", F.lit(True)).select(columns))
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16()}[kind]
    schema = f"query long, query_id {kind}, vec_id {kind}, score long"
    return blocks.by_group(both, ["dims", "bucket", "part"], ["asks"], _search(k, arrow), schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(
    df: DataFrame, k: int, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query row's k best other rows.

    `is_query` is a condition on the column `vec_id`.
    """
    kind = df.schema[vec_id].dataType.simpleString()

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = blocks.numbered()
        for batch in batches:
            yield _whole(batch, scale, number)

    path = work_path(df.sparkSession, "top-k")
    schema = f"row long, vec_id {kind}, dims int, bucket int, norm double, value binary"
    df.select(F.col(vec_id).alias("vec_id"), vector).mapInArrow(prepare, schema).write.parquet(path)
    stored = df.sparkSession.read.schema(schema).parquet(path)

    # One row for each length and dimension: some hundred, however many vectors.
    buckets = stored.groupBy("dims", "bucket").agg(F.count("*").alias("n"), F.max("norm").alias("longest"))
    buckets = buckets.withColumn("parts", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    buckets = df.sparkSession.createDataFrame(buckets.collect(), buckets.schema)
    parts = F.broadcast(buckets.select("dims", "bucket", "parts"))
    dealt = stored.join(parts, ["dims", "bucket"]).withColumn("part", F.pmod(F.xxhash64("row"), "parts").cast("int"))

    queries = stored.where(is_query)
    first = buckets.where(F.col("n") > k).groupBy("dims").agg(F.max("bucket").alias("bucket"))
    first = F.broadcast(first)
    asked = queries.drop("bucket").join(first, "dims").withColumns({"part": F.lit(0), "least": F.lit(None).cast("double")})
    seeds = _visit(dealt.join(first, ["dims", "bucket"], "left_semi").where("part = 0"), asked, k, kind)
    least = _ranked(seeds, k).where(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").cast("double").alias("least"))

    reach = F.col("least").isNull() | (F.col("least") <= F.col("norm") * F.col("longest") * (1 + SLACK)) | (F.col("least") <= 0)
    visits = queries.join(least, "row", "left").drop("bucket").join(F.broadcast(buckets), "dims").where(reach)
    visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = _ranked(_visit(dealt, visits, k, kind), k)
    return found.select("query_id", "rank", "vec_id", "score")
