"""Quality score of documents from statistics of their text.

Random Fourier features of the standardised statistics approximate a Gaussian kernel; ridge regression on them is fitted
from normal equations that are summed per partition; isotonic regression on rows kept aside turns its output into a
probability.

Defined results: a null or empty text has all statistics 0 and gets the score of that point; labels may be missing,
repeated or conflicting (rows with a null id or label are left out, repeats count); without labels of both kinds every
score is the share of label 1, or 0.5 without any. Other columns pass through untouched.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import values

STATISTICS = (
    "log_chars", "log_words", "mean_word", "spread_word", "symbols", "digits", "upper", "punctuation", "wide", "blanks",
    "short_words", "distinct_words", "most_frequent_word", "log_lines", "mean_line", "repeated_lines", "line_ends",
    "compressed",
)
FEATURES, WIDTH, RIDGE, SEED = 256, 3.0, 1e-4, 1
#: Share of the labelled rows that calibrate and do not fit; bins of the regression's output for calibration.
CALIBRATE_ONE_IN, BINS = 4, 2000
#: Labelled rows the model is fitted on, at most.
MAX_TRAIN = 200_000
_LOW, _HIGH = -1.0, 2.0

_CLASS = np.zeros(256, np.int64)
for _kind, _chars in enumerate((b"#*$%&|<>", b"0123456789", bytes(range(65, 91)), b".,;:!?\"'()-", bytes(range(128, 256)), b" \t\n\r\x0b\f"), 1):
    _CLASS[list(_chars)] = _kind


def statistics(text: bytes | None) -> list[float]:
    """The figures named in ``STATISTICS``."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(_CLASS, np.bincount(np.frombuffer(text, np.uint8), minlength=256), 7) / len(text)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return [
        np.log1p(len(text)), np.log1p(len(words)), lengths.mean(), lengths.std(), *kinds[1:7],
        (lengths <= 3).mean(), len(counts) / len(words), max(counts.values()) / len(words), np.log1p(len(lines)),
        np.log1p(len(text) / len(lines)), 1 - len(set(lines)) / len(lines),
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines), len(zlib.compress(text, 1)) / len(text),
    ]


def text_statistics(text: Column | str) -> Column:
    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t) for t in values(texts, pa.binary())], pa.list_(pa.float64()))

    return run(text)


class Model:
    """Scale of the statistics, random features, weights and the calibration curve."""

    def __init__(self, mean, scale, coef, curve, seed: int = SEED, width: float = WIDTH):
        self.mean, self.scale, self.coef, self.curve, self.seed, self.width = mean, scale, coef, curve, seed, width
        random = np.random.default_rng(seed)
        n = 0 if coef is None else len(coef) - 1
        self.direction = random.normal(0, 1 / width, (len(STATISTICS), n))
        self.phase = random.uniform(0, 2 * np.pi, n)

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.direction + self.phase) * np.sqrt(2 / len(self.phase))
        return np.column_stack((z, np.ones(len(z))))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.coef, _LOW, _HIGH)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.coef is None:
            return np.full(len(stats), float(self.curve[1][0]))
        raw = self.raw(stats)
        # A thousandth of the uncalibrated order keeps documents on one step of the curve apart.
        return 0.999 * np.interp(raw, *self.curve) + 0.001 * (raw - _LOW) / (_HIGH - _LOW)


def pool_adjacent(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Isotonic regression: the closest non-decreasing values."""
    blocks: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist()):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(n, v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    stats = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(STATISTICS))
    return stats, batch.column(1).to_numpy(zero_copy_only=False).astype(float)


def fit(rows: DataFrame, stats: str = "stats", label: str = "quality", key: str = "doc_id", features: int = FEATURES) -> Model:
    """Train on all rows of ``(key, stats, label)``. What comes to the driver has a size fixed by the number of features
    and bins."""
    rows = rows.filter(F.col(label).isNotNull() & F.col(stats).isNotNull()).select(
        stats, F.col(label).cast("double").alias("y"), (F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(CALIBRATE_ONE_IN)) == 0).alias("aside")
    )
    column = [F.col(stats)[i] for i in range(len(STATISTICS))]
    # Means and deviations from all rows, the shares of the labels with them.
    found = rows.agg(
        F.count("*"), F.avg("y"), F.array(*map(F.avg, column)), F.array(*map(F.stddev_pop, column))
    ).first()
    if not found[0] or found[1] in (0.0, 1.0):
        return Model(None, None, None, ([0.0], [0.5 if not found[0] else found[1]]))
    mean, scale = np.array(found[2]), np.array(found[3])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(features + 1), ([0.0], [0.0]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                x, y = _rows(part)
                z = model.features(x)
                total += z.T @ np.column_stack((z, y))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(features + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"]
        )

    def add(group: pa.Table) -> pa.Table:
        total = group["sums"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1).sum(axis=0)
        return pa.table({"i": group["i"][:1], "sums": pa.array([total], pa.list_(pa.float64()))})

    kind = "i int, sums array<double>"
    equations = rows.filter("not aside").select(stats, "y").mapInArrow(sums, kind).groupBy("i").applyInArrow(add, kind)
    solved = np.array([r.sums for r in sorted(equations.collect(), key=lambda r: r.i)])
    gram, right = solved[:, :-1], solved[:, -1]
    penalty = RIDGE * max(1.0, gram[-1, -1]) * np.eye(features + 1)
    penalty[-1, -1] = 0
    model = Model(model.mean, model.scale, np.linalg.solve(gram + penalty + 1e-9 * np.eye(features + 1), right), ([0.0], [0.0]))

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _rows(batch)
            at = ((model.raw(x) - _LOW) / (_HIGH - _LOW) * (BINS - 1)).round().astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(y)], names=["bin", "y"])

    curve = (
        rows.filter("aside").select(stats, "y").mapInArrow(bins, "bin int, y double").groupBy("bin")
        .agg(F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    )
    if curve:
        place = np.array([r.bin for r in curve]) / (BINS - 1) * (_HIGH - _LOW) + _LOW
        level = pool_adjacent(np.array([r.y for r in curve]), np.array([r.n for r in curve], float))
        model.curve = (place, level)
    else:
        model.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def quality(stats: Column | str, model: Model) -> Column:
    """The score of a statistics column, 0 to 1."""

    @F.arrow_udf("double")
    def run(stats: pa.Array) -> pa.Array:
        x = np.array(stats.to_pylist(), float).reshape(len(stats), len(STATISTICS))
        return pa.array(model.score(x), pa.float64())

    return run(stats)
