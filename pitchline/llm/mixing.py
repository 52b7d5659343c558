"""Mixing sources to target weights along a time-varying curriculum.

Sources in code-point order (null last) take the weights in turn and share all
words; a target stops at ``most`` times its source's size and the excess goes to
the others by weight (water filling, solved in closed form over the sources
ordered by the level at which they are full).

Within a source the documents follow a hash of their id. Their running size is
a two-level prefix sum: totals of hash buckets, a running sum over the buckets of
a source, and a running sum inside each (source, bucket), so a source with a
third of all rows is scanned by as many tasks as it has buckets. A source that
is used q times takes every document floor(q) times and then documents in hash
order until its target is met; only the last of them is taken in part.

A source's weight at time t in [0, 1] is weight * (1 + slope * (2 t - 1)). Its
integral is the demand for its words until t. The demand at which a copy's middle
stands is inverted to a time, its training position, and the documents are
range-sorted by the position of their first copy.

Everything is DataFrame code. Defined cases: a null text has size 0; documents
without words and sources without words take nothing and have no position (they
sort last); rows that agree in id and size are interchangeable; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.llm.common import WORD, materialize

ROWS_PER_BUCKET = 2048
MOST_BUCKETS = 65_536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: tuple[int, ...], slopes: tuple[float, ...], most: int) -> DataFrame:
    """``totals`` (source, source_size) with weight, slope and target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    full_at = Window.orderBy("_full_at", F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    cap = most * F.col("source_size")
    return (
        totals.withColumn("_turn", turn + 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("_turn")))
        .withColumn("slope", F.element_at(F.array(*map(F.lit, slopes)), F.col("_turn")))
        .withColumn("_full_at", cap / F.col("weight"))
        .withColumn("_all", F.sum("source_size").over(Window.partitionBy(F.lit(0))))
        .withColumn("_before", F.coalesce(F.sum(cap).over(full_at.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(full_at.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_level", (F.col("_all") - F.col("_before")) / F.col("_weights"))
        .withColumn("_level", F.max("_level").over(Window.partitionBy(F.lit(0))))
        .withColumn(
            "target",
            F.when(F.col("_full_at") <= F.col("_level"), cap.cast("double")).otherwise(F.col("_level") * F.col("weight")),
        )
        .select("source", "source_size", "weight", "slope", "target")
    )


def when_demanded(share: Column, slope: Column) -> Column:
    """The time at which a source has met ``share`` of its demand.

    Solves (1 - a) t + a t^2 = share, the integral of its schedule.
    """
    start = 1 - slope
    return 2 * share / (start + F.sqrt(start * start + 4 * slope * share))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    slopes: tuple[float, ...] = (-0.5, 0.0, 0.5),
    most: int = 3,
    key_col: str | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, positions and position of every row, and its ``key`` if a column holds one."""
    key = [F.col(key_col).alias("key")] if key_col else []
    sizes = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *key),
        "mix-sizes",
    )
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, slopes, most)
    rows = sizes.count()
    buckets = min(MOST_BUCKETS, max(1, rows // ROWS_PER_BUCKET))
    draw = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    head = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    drawn = sizes.withColumn("draw", draw).withColumn("bucket", F.floor(head * buckets / F.lit(float(1 << 32))).cast("int"))
    offsets = (
        drawn.groupBy("source", "bucket")
        .agg(F.sum("size").alias("inside"))
        .withColumn(
            "offset",
            F.sum("inside").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("inside"),
        )
        .select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "offset")
    )
    plan = offsets.join(targets, F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    order = Window.partitionBy("source", "bucket").orderBy("draw", F.col("doc_id").asc_nulls_first(), "size", *(["key"] if key else []))
    at = (
        drawn.withColumn("_inside", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
        .withColumn("at", F.col("offset") + F.col("_inside"))
    )
    times = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double"))), F.lit(0)).cast("long")
    cut = F.floor(F.col("target") - F.col("_times") * F.col("source_size") + 0.5).cast("long")
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), cut - F.col("at")))
    copies = F.when(F.col("size") > 0, F.col("_times") + (F.col("_part") > 0).cast("long")).otherwise(0)

    def position(j: Column) -> Column:
        length = F.when(j < F.col("_times"), F.col("size")).otherwise(F.col("_part"))
        share = F.try_divide(j * F.col("source_size") + F.col("at") + length / 2, F.col("target"))
        return when_demanded(F.least(F.lit(1.0), share), F.col("slope"))

    return (
        at.withColumn("_times", times)
        .withColumn("_part", part)
        .withColumn("_copies", copies)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("_times") * F.col("size") + F.col("_part")).alias("taken"),
            F.when(F.col("_copies") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1), position))
            .otherwise(F.array().cast("array<double>"))
            .alias("positions"),
            *(["key"] if key else []),
        )
        .withColumn("position", F.try_element_at("positions", F.lit(1)))
    )


def in_training_order(mixed: DataFrame, position: str = "position") -> DataFrame:
    """Rows range-sorted by the position of their first copy."""
    return mixed.orderBy(F.col(position).asc_nulls_last(), "doc_id")
