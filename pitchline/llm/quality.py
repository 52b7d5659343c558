"""Quality scores by random Fourier features, ridge regression and isotonic calibration.

Every text becomes a vector of document statistics (sizes, shares of character
and word classes, repetition of words and lines, entropy). After scaling, the
features sqrt(2 / D) cos(W x + b) approximate a Gaussian kernel. Each partition
sums its normal equations, Z'Z and Z'y; Spark adds the blocks, and the driver
solves one D x D system, whose size does not depend on the data. The raw scores
of training rows kept apart from the fit are pooled in bins by Spark and
calibrated by isotonic regression (pool adjacent violators), so a score reads as
the probability of label 1.

All labelled rows outside ``held_out`` are used: three quarters of them (by a
hash of the id) for the fit, the others for the calibration. The features are
computed once for every text, whole, and written; labels meet them by id.

Defined cases: a null or empty text has zero statistics and is scored like any
other; labels other than 0 and 1 are left out; an id with several labels counts
with each; a row without an id is scored, meets no label and is not held out;
without training rows every score is 1/2; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import materialize, small_batches, uniform

#: ASCII classes: lower, upper, digit, white space, sentence marks, other marks.
_CLASS = np.full(256, 6)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_CLASS[[c for c in range(128) if _CLASS[c] == 6]] = 5
_WIDTH = 23
BLOCK = 32
BINS = 2048


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, each of order one."""
    if not text:
        return [0.0] * _WIDTH
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    share = np.bincount(_CLASS, counts, minlength=7) / size
    p = counts[counts > 0] / size
    words = text.split()
    n = len(words)
    if not n:
        return [np.log1p(size) / 10, *share, float(-(p * np.log2(p)).sum()) / 8, *[0.0] * (_WIDTH - 9)]
    lengths = np.fromiter(map(len, words), np.int64, n)
    of = Counter(words)
    most = of.most_common(3)
    follow = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    marked = sum(not w[-1:].isalpha() and w[-1] < 128 and w[-1:] not in b".,;:!?" for w in words)
    return [
        np.log1p(size) / 10,
        *share,
        float(-(p * np.log2(p)).sum()) / 8,
        np.log1p(n) / 8,
        float(lengths.mean()) / 10,
        float(lengths.std()) / 10,
        float(np.log1p(lengths.max())) / 5,
        len(of) / n,
        len(of) / n**0.7 / 2,
        most[0][1] / n,
        sum(c for _, c in most) / n,
        follow / n,
        pairs / n,
        marked / n,
        len(set(lines)) / max(1, len(lines)),
        np.log1p(size / max(1, len(lines))) / 10,
        sum(w.isupper() for w in words) / n,
    ]


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([statistics(t or b"") for t in batch.column(1).to_pylist()], np.float32).reshape(-1, _WIDTH)
        x = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), _WIDTH).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), x], names=["doc_id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, _WIDTH)


class QualityModel:
    """Scaling, random features, ridge weights and calibration."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, gamma: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.directions = rng.normal(0, np.sqrt(2 * gamma), (len(mean), features))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.knots = np.array([0.0])
        self.levels = np.array([0.5])

    def expand(self, x: np.ndarray) -> np.ndarray:
        scaled = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.phase)) * np.cos(scaled @ self.directions + self.phase)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def isotonic(x: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted pool-adjacent-violators: knots and non-decreasing levels."""
    blocks: list[list[float]] = []  # sum of x, rows, positives
    for a, b, c in zip(x, n, positive, strict=True):
        blocks.append([a * b, b, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([s / w for s, w, _ in blocks]), np.array([c / w for _, w, c in blocks])


def _normal_equations(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = None
        for batch in batches:
            z = model.expand(_matrix(batch.column(0)))
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            part = np.hstack([z.T @ z, (z.T @ y)[:, None]])
            total = part if total is None else total + part
        if total is not None:
            yield _blocks({k: total[k * BLOCK : (k + 1) * BLOCK] for k in range(-(-len(total) // BLOCK))})

    return run


def _blocks(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([p.tobytes() for p in parts.values()], pa.binary())], names=["block", "sums"])


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = np.frombuffer(part)
            sums[block] = sums[block] + values if block in sums else values
    if sums:
        yield _blocks(sums)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics x of every row, written once."""
    given = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary"))
    return materialize(given.mapInArrow(_features, "doc_id long, x array<float>"), "quality-features")


def train(rows: DataFrame, random_features: int = 256, gamma: float = 0.01, ridge: float = 1e-5, seed: int = 7) -> QualityModel:
    """A model from ``rows`` (doc_id, x, y), y 0 or 1."""
    spark = rows.sparkSession
    rows = materialize(rows.withColumn("_fit", uniform("doc_id", 31) < 0.75), "quality-training")
    fit, apart = rows.where("_fit"), rows.where("NOT _fit")
    moments = fit.select(
        *(F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(_WIDTH)), *(F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(_WIDTH)), F.count("y")
    ).first()
    n = moments[-1]
    if not n:
        return QualityModel(np.zeros(_WIDTH), np.ones(_WIDTH), random_features, gamma, seed)
    scale = np.array(moments[_WIDTH : 2 * _WIDTH], float)
    model = QualityModel(np.array(moments[:_WIDTH], float), np.where(scale > 1e-6, scale, 1.0), random_features, gamma, seed)
    shared = spark.sparkContext.broadcast(model)
    schema = "block int, sums binary"
    parts = fit.select("x", "y").mapInArrow(_normal_equations(shared), schema).repartition("block").mapInArrow(_add, schema)
    width = random_features + 2
    sums = np.vstack([np.frombuffer(bytes(r[1])).reshape(-1, width) for r in sorted(parts.collect(), key=lambda r: r[0])])
    gram, target = sums[:, :-1], sums[:, -1]
    model.weights = np.linalg.solve(gram + ridge * n * np.diag([1.0] * random_features + [0.0]) + 1e-9 * np.eye(width - 1), target)
    fitted = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def raw(x):
        import pandas as pd

        return pd.Series(fitted.value.raw(np.array(x.tolist(), float).reshape(-1, _WIDTH)))

    bins = apart.select(F.floor(raw("x") * (BINS / 2)).alias("bin"), "y").groupBy("bin").agg(F.count("y").alias("n"), F.sum("y").alias("good"))
    told = bins.where("n > 0").orderBy("bin").toPandas()  # raw scores lie near [0, 1], so a few thousand bins
    if len(told):
        center = (told["bin"].to_numpy(float) + 0.5) / (BINS / 2)
        # one imagined row of each label keeps the ends off 0 and 1
        levels = isotonic(center, told["n"].to_numpy(float), told["good"].to_numpy(float))
        total = told["n"].sum()
        model.knots, model.levels = levels[0], (levels[1] * total + 0.5) / (total + 1)
    return model


def scores(found: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of every row of ``features``."""
    shared = found.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(x):
        import pandas as pd

        return pd.Series(shared.value.score(np.array(x.tolist(), float).reshape(-1, _WIDTH)))

    return found.select("doc_id", score("x").alias("score"))
