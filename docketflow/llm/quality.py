"""Quality of documents by a regularised quadratic discriminant on statistics of the text.

Every text becomes some twenty statistics of its letters, words and lines, each brought
near a bell shape by a logarithm (`FEATURES`). Either class of labels has a mean and a
covariance of its own, summed over all labelled texts. The covariance is drawn towards that
of both classes together and towards its own diagonal, so that it can be inverted however few
texts there are. The score is the chance of class 1: the logistic function of the difference
of the log densities, which are Mahalanobis lengths and log determinants from Cholesky
factors that the model holds inverted.

Texts are read once: their statistics are written to the cluster's shared folder, and
both the sums and the scores come from there.

Defined results: a null or empty text has statistics like any other, those of no letters;
a text labelled more than once takes its lowest label; labels that are null, other than 0
and 1, or without a text teach nothing. With labels of one class alone every score is that
class, without labels 1: nothing tells against a text. Equal rows give equal rows; no rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel
from .components import stored

#: How far a class's covariance is drawn to that of both, and how far to its diagonal.
TO_COMMON, TO_DIAGONAL = 0.5, 0.01
#: Added to shares before the logarithm.
FLOOR = 0.01
#: Added to variances: statistics that never vary tell nothing.
LEAST_VARIANCE = 1e-4
#: Chance of class 1 from which a text counts as good.
GOOD = 0.3

FEATURES = (
    "bytes", "words", "word_length", "word_spread", "upper", "digits", "stops", "shouts", "symbols", "beyond_ascii",
    "word_words", "shouted_words", "marked_words", "bare_words", "distinct_words", "distinct_pairs", "same_as_before",
    "top_word", "line_length", "distinct_lines", "short_words",
)

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digits": b"0123456789",
    "stops": b".,;:'\"()-", "shouts": b"!?", "symbols": b"#$%&*+/<=>@[\\]^_`{|}~",
}


def _flags(name: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(_KINDS[name])] = True
    return out


_FLAGS = {name: _flags(name) for name in _KINDS}


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log(part / np.maximum(whole, 1) + FLOOR)


def _distinct(of: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each of n texts, and how often the commonest occurs."""
    order = np.lexsort((values, of))
    of, values = of[order], values[order]
    begin = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (values[1:] != values[:-1]))[: len(of)])
    most = np.zeros(n, np.int64)
    np.maximum.at(most, of[begin], np.diff(np.append(begin, len(of))))
    return np.bincount(of[begin], minlength=n), most


def _statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    size = np.diff(offsets)
    kinds = {name: _sums(flag[data]) for name, flag in _FLAGS.items()}
    beyond = _sums(data >= 128)
    count = {name: np.diff(sums[offsets]) for name, sums in (kinds | {"beyond": beyond}).items()}
    starts, ends, first = kernel.words(data, offsets)
    words = np.diff(first)
    of = np.repeat(np.arange(n), words)
    hashes = kernel.span_hashes(data, starts, ends)

    def each(name: str) -> np.ndarray:
        return kinds[name][ends] - kinds[name][starts]

    # Bytes of letters beyond ASCII count as letters.
    letters = each("upper") + each("lower") + beyond[ends] - beyond[starts]
    length = ends - starts
    shouted = (each("upper") >= 2) & (each("lower") == 0)
    marked = (each("symbols") + each("shouts") > 0) & (letters > 0)
    long_sum = np.bincount(of, letters, n)
    mean = long_sum / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(np.bincount(of, letters.astype(float) ** 2, n) / np.maximum(words, 1) - mean**2, 0))
    distinct, most = _distinct(of, hashes, n)
    at, pairs = kernel.run_hashes(hashes, first, 2)
    distinct_pairs, _ = _distinct(of[at], pairs, n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])

    breaks = np.flatnonzero(data == 10)
    edges = np.unique(np.concatenate([offsets[:-1][size > 0], breaks + 1, offsets[-1:]]))
    edges = edges[edges <= offsets[-1]]
    line_starts = edges[:-1]
    line_of = np.searchsorted(offsets, line_starts, "right") - 1
    lines = np.bincount(line_of, minlength=n)[:n]
    distinct_lines, _ = _distinct(line_of, kernel.span_hashes(data, line_starts, edges[1:]), n)

    all_letters = count["upper"] + count["lower"] + count["beyond"]
    per_word = {name: np.bincount(of, flag, n) for name, flag in {
        "word": letters == length, "shouted": shouted, "marked": marked, "bare": letters == 0, "same": same, "short": (letters > 0) & (letters <= 3),
    }.items()}
    columns = [
        np.log1p(size), np.log1p(words), np.log1p(mean), np.log1p(spread), _share(count["upper"], all_letters),
        _share(count["digits"], size), _share(count["stops"], size), _share(count["shouts"], size),
        _share(count["symbols"], size), _share(count["beyond"], size), _share(per_word["word"], words),
        _share(per_word["shouted"], words), _share(per_word["marked"], words), _share(per_word["bare"], words),
        # Longer texts repeat more of their words, as by a power of the length.
        np.log((distinct + 1) / (words + 1) ** 0.85), _share(distinct_pairs, words - 1), _share(per_word["same"], words),
        _share(most, words), np.log1p(words / np.maximum(lines, 1)), _share(distinct_lines, lines), _share(per_word["short"], words),
    ]
    return np.stack(columns, axis=1)


def statistics(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, x): the transformed statistics of every text, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernel.text_bytes(batch.column(1))
            found = [_statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in kernel.chunks(offsets)]
            x = np.concatenate([*found, np.zeros((0, len(FEATURES)))])
            bounds = pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(bounds, pa.array(x.ravel()))], names=["doc_id", "x"])

    kind = df.schema[doc_id].dataType.simpleString()
    return stored(df.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, x array<double>"), "quality-statistics")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


@dataclass(frozen=True)
class Model:
    """Log share, mean, inverted Cholesky factor and log determinant of each class seen."""

    classes: dict[int, tuple[float, np.ndarray, np.ndarray, float]]

    def chance(self, x: np.ndarray) -> np.ndarray:
        """The chance of class 1."""
        if len(self.classes) < 2:
            return np.full(len(x), float(next(iter(self.classes), 1)))
        density = {}
        for label, (prior, mean, factor, log_det) in self.classes.items():
            z = (x - mean) @ factor.T
            density[label] = prior - 0.5 * (np.einsum("ij,ij->i", z, z) + log_det)
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], to_common: float = TO_COMMON, to_diagonal: float = TO_DIAGONAL) -> Model:
    """The model from (texts, sum of x, sum of x x') of each class."""
    sums = {label: s for label, s in sums.items() if s[0] > 0}
    total = sum(s[0] for s in sums.values())
    means = {label: first / n for label, (n, first, _) in sums.items()}
    scatter = {label: second - n * np.outer(means[label], means[label]) for label, (n, _, second) in sums.items()}
    common = sum(scatter.values()) / max(total, 1) if sums else None
    classes = {}
    for label, (n, _, _) in sums.items():
        cov = (1 - to_common) * scatter[label] / n + to_common * common
        cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(cov)) + LEAST_VARIANCE * np.eye(len(cov))
        root = np.linalg.cholesky((cov + cov.T) / 2)
        classes[label] = (float(np.log(n / total)), means[label], np.linalg.inv(root), 2 * float(np.log(np.diag(root)).sum()))
    return Model(classes)


def train(stats: DataFrame, labels: DataFrame, quality: str = "quality", where: Column | None = None) -> Model:
    """The model of labelled texts, of whose `doc_id` the condition `where` holds.

    Sums are added up by task and then by Spark, cell by cell: all labelled texts count.
    """
    size = len(FEATURES)
    label = labels.groupBy("doc_id").agg(F.min(F.col(quality).cast("int")).alias("label")).where("label in (0, 1)")
    rows = stats.join(label.where(where) if where is not None else label, "doc_id").select("label", "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {label: np.zeros((size + 1, size + 1)) for label in (0, 1)}
        for batch in batches:
            own, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            # With a one before the statistics, one product gives counts, sums and products.
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            for label, total in sums.items():
                total += x[own == label].T @ x[own == label]
        cells = np.arange((size + 1) ** 2, dtype=np.int32)
        for label, total in sums.items():
            columns = [pa.array(np.full(len(cells), label, np.int32)), pa.array(cells), pa.array(total.ravel())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "cell", "value"])

    found = rows.mapInArrow(run, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value"))
    whole = {label: np.zeros((size + 1) ** 2) for label in (0, 1)}
    for row in found.collect():  # one row for each cell of two matrices
        whole[row.label][row.cell] = row.value
    whole = {label: m.reshape(size + 1, size + 1) for label, m in whole.items()}
    return fit({label: (m[0, 0], m[0, 1:], m[1:, 1:]) for label, m in whole.items()})


def scored(stats: DataFrame, model: Model, good: float = GOOD) -> DataFrame:
    """Rows (doc_id, score, predicted) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chance = model.chance(_matrix(batch.column(1)))
            columns = [batch.column(0), pa.array(chance), pa.array((chance >= good).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a text's id falls in the fold that teaches nothing."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))
