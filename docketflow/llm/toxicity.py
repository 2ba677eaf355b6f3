"""Severity of toxic language by ordinal regression on sparse features of a text.

Features are the words of a text, in lower case, and their beginnings of 3 to 6 letters,
each present or absent and hashed to `FEATURES` places. A cumulative-link model gives the
chance that a text's grade is at least j as logistic(w.x - b_j): one weight for a feature,
shared by all thresholds b_1 < b_2 < ... The sum of these chances is the expected severity.

The model is fitted on at most about `sample` labelled texts, in one task: features that
tell grades apart are kept, and their weights found by accelerated proximal gradient
steps with an L1 penalty, so that most are zero. It has at most `FEATURES` weights. Every
text of the table is then scored where it lies, whole.

Defined results: a null or empty text has no features and gets the thresholds' own
chances; a text labelled more than once takes its highest grade; labels that are null or
without a text teach nothing. Without labels, or with labels of one grade, no text is
toxic: chances and severity are 0. Equal rows give equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel, pretokens

#: Places of hashed features, and the lengths of the beginnings of words among them.
FEATURES = 1 << 20
BEGINNINGS = (3, 4, 5, 6)
#: Labelled texts that the fit reads, about.
SAMPLE = 8000
#: A feature needs so many texts, and its share among graded and other texts must differ
#: by so many standard errors.
LEAST_TEXTS, LEAST_ERRORS = 4, 4.0
PENALTY, STEPS = 3e-4, 400
#: Bytes of text worked on at once: they bound what a worker holds beside its batch.
TEXT_BYTES = 1 << 18
#: Chance of a grade of at least 1 from which a text counts as toxic.
TOXIC = 0.5


@dataclass(frozen=True)
class Model:
    """Places and weights of features that count, and the thresholds."""

    places: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, sums: np.ndarray) -> np.ndarray:
        """Per text and threshold, the chance of a grade that high."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - sums[:, None], -500, 500)))


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts (from, to): each occurring feature's text and place, repeated."""
    _, offsets = kernel.text_bytes(column)
    letters = np.isin(np.arange(6), [pretokens.LETTER, pretokens.UNSURE])
    for a, b in kernel.chunks(offsets, TEXT_BYTES):
        part, own = kernel.text_bytes(pa.compute.utf8_lower(column.slice(a, b - a).cast(pa.large_string())))
        points, at = pretokens._decode(part)
        inside = letters[pretokens.classes()[points]]
        edge = np.zeros(len(points) + 1, bool)
        text_at = np.searchsorted(at, own)
        edge[text_at] = True
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        end[:-1] &= ~inside[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        text = np.searchsorted(text_at, starts, "right") - 1
        found = [(text, kernel.span_hashes(part, at[starts], at[ends]))]
        for n in BEGINNINGS:
            long = ends - starts >= n
            first = starts[long]
            found.append((text[long], kernel.mix(kernel.span_hashes(part, at[first], at[first + n]) + np.uint64(n))))
        places = np.concatenate([h for _, h in found]) % np.uint64(FEATURES)
        yield a, b, np.concatenate([t for t, _ in found]), places.astype(np.int64)


def _pairs(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text and place of the features of ranges of texts, each once."""
    for a, _, text, place in features(texts):
        pairs = np.unique((a + text) * FEATURES + place)
        yield pairs // FEATURES, pairs % FEATURES


def fit(texts: pa.Array, grades: np.ndarray) -> Model:
    """The model of labelled texts; grades are whole numbers from 0."""
    none = Model(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    top = int(grades.max()) if len(grades) else 0
    if not top or int(grades.min()) == top:
        return none
    high = grades > 0
    n1, n0 = int(high.sum()), int((~high).sum())
    in1, in0 = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
    for text, place in _pairs(texts):
        graded = high[text]
        in1 += np.bincount(place[graded], minlength=FEATURES)
        in0 += np.bincount(place[~graded], minlength=FEATURES)
    share = (in1 + in0) / (n1 + n0)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    useful = (in1 + in0 >= LEAST_TEXTS) & (np.abs(in1 / n1 - in0 / n0) >= LEAST_ERRORS * error)
    places = np.flatnonzero(useful)
    number = np.full(FEATURES, -1)
    number[places] = np.arange(len(places))
    # Made again, as all features of all texts are many times those that are useful.
    kept = [(text[useful[place]], number[place[useful[place]]]) for text, place in _pairs(texts)]
    text, column = (np.concatenate(x) for x in zip(*kept))
    del in1, in0, share, error, useful, number, kept

    n = len(grades)
    above = grades[:, None] >= np.arange(1, top + 1)[None, :]
    share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    bias, weights = np.log((1 - share) / share), np.zeros(len(places))
    most = np.bincount(text, minlength=n).max() if len(text) else 0
    rate = 4.0 / ((most + 1) * top)
    looked, ahead, pace = weights.copy(), bias.copy(), 1.0
    for _ in range(STEPS):
        sums = np.bincount(text, looked[column], n)
        # P(grade = g) = s(g) - s(g+1): the gradient of its log in w.x is 1 - s(g) - s(g+1).
        s = 1 / (1 + np.exp(np.clip(ahead[None, :] - sums[:, None], -500, 500)))
        full = np.concatenate([np.ones((n, 1)), s, np.zeros((n, 1))], axis=1)
        own, above_own = full[np.arange(n), grades], full[np.arange(n), grades + 1]
        slope = 1 - own - above_own
        step = np.bincount(column, slope[text], len(places)) / n
        new = looked + rate * 8 * step
        new = np.sign(new) * np.maximum(np.abs(new) - rate * 8 * PENALTY, 0)
        chance = np.maximum(own - above_own, 1e-12)
        move = np.zeros(top)
        for j in range(1, top + 1):
            d = s[:, j - 1] * (1 - s[:, j - 1]) / chance
            move[j - 1] = (np.where(grades == j, -d, 0) + np.where(grades == j - 1, d, 0)).mean()
        fresh = np.maximum.accumulate(ahead + np.clip(move, -1, 1) * 0.5)
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        if np.dot(looked - new, new - weights) > 0:
            following = pace = 1.0
        looked = new + (pace - 1) / following * (new - weights)
        weights, ahead, pace = new, fresh, following
    counts = weights != 0
    return Model(places[counts], weights[counts], ahead)


def train(documents: DataFrame, labels: DataFrame, grade: Column, sample: int = SAMPLE) -> Model:
    """Fits the model on labelled documents; `grade` is a column expression over `labels`."""
    graded = labels.groupBy("doc_id").agg(F.max(grade.cast("int")).alias("grade")).where("grade is not null and doc_id is not null")
    total = graded.count()
    share = min(1.0, sample / max(total, 1))
    some = graded.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = documents.select("doc_id", "text").join(some, "doc_id").where("text is not null").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("grade").alias("grade"))

    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=pa.schema([("text", pa.string()), ("grade", pa.int32())]))
        texts, grades = table.column("text").combine_chunks(), table.column("grade").to_numpy().astype(np.int64)
        del table
        model = fit(texts, grades)
        del texts
        kernel.give_back()
        values = [pa.array([v.tolist()]) for v in (model.places.astype(np.int64), model.weights, model.thresholds)]
        kinds = [pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([v.cast(k) for v, k in zip(values, kinds)], names=["places", "weights", "thresholds"])

    schema = "places array<long>, weights array<double>, thresholds array<double>"
    found = rows.select("text", "grade").repartition(1).mapInArrow(fitting, schema).first()
    if found is None:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    return Model(np.array(found.places, np.int64), np.array(found.weights, float), np.array(found.thresholds, float))


def severity(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds `toxic_chance`, `severity` (expected grade), `grade` (likeliest) and `toxic`.

    Columns of these names are replaced.
    """
    added = {"toxic_chance": T.DoubleType(), "severity": T.DoubleType(), "grade": T.IntegerType(), "toxic": T.BooleanType()}
    schema = T.StructType([f for f in df.schema if f.name not in added] + [T.StructField(n, t, False) for n, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(FEATURES)
        weight[model.places] = model.weights
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros(n)
            column = batch.column(text)
            for a, b, of, place in features(column):
                counts = weight[place] != 0
                pairs = np.unique(of[counts] * FEATURES + place[counts])
                sums[a:b] = np.bincount(pairs // FEATURES, weight[pairs % FEATURES], b - a)
            chances = model.chances(sums) if len(model.thresholds) else np.zeros((n, 1))
            grades = np.diff(np.concatenate([np.ones((n, 1)), chances, np.zeros((n, 1))], axis=1) * -1, axis=1).argmax(axis=1)
            values = [chances[:, 0], chances.sum(axis=1), grades.astype(np.int32), chances[:, 0] >= TOXIC]
            keep = [c for c in batch.schema.names if c not in added]
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, *map(pa.array, values)], names=[*keep, *added])
            kernel.give_back()

    return df.mapInArrow(run, schema)


def toxic_grade() -> Column:
    """A grade from the labels given: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    return F.col("toxic") * F.when(F.col("quality") == 0, 2).otherwise(1)
