"""Ordered recurrences over one key's timeline.

A rating history and a chemistry edge are both affine recurrences
``x' = a * x + b`` in match order. Affine maps compose associatively, so a
timeline is cut into calendar chunks: each (key, chunk) is scanned on its own,
only one composite per chunk travels to the key's task, and the entry value of
every chunk is joined back. A key holding a large part of all rows is spread
over as many tasks as it has chunks. Chunks must follow the order of the rows,
that is the order starts with the day the chunk is made of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def chunk_of(day: str, days: int) -> str:
    return f"unix_date({day}) div {int(days)}"


def _over(part: list[str], order: list[str], rows: str = "") -> str:
    return f"OVER (PARTITION BY {', '.join(part)} ORDER BY {', '.join(order)} {rows})"


_UP_TO_HERE = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BEFORE_HERE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def prefix_count(
    df: DataFrame, keys: list[str], order: list[str], out: str, chunk: str
) -> DataFrame:
    """Number of earlier rows of the same key."""
    part = [*keys, chunk]
    totals = df.groupBy(*part).agg(F.expr("count(1) AS _rows")).selectExpr(
        *part, f"coalesce(sum(_rows) {_over(keys, [chunk], _BEFORE_HERE)}, 0) AS _offset"
    )
    rows = df.selectExpr("*", f"row_number() {_over(part, order)} AS _nth")
    return rows.join(totals, part).selectExpr("* EXCEPT (_nth, _offset)", f"_offset + _nth - 1 AS {out}")


def _running_maps(df: DataFrame, part: list[str], order: list[str], a: str, b: str) -> DataFrame:
    """Add (_a, _b): the composite of all maps up to and including the row.

    With running product P of the factors, the composite offset is
    ``P * sum(b / P)``. A zero factor forgets everything before it, so it opens
    a new segment whose composite factor stays 0.
    """
    in_segment = [*part, "_seg"]
    upto = Window.partitionBy(*in_segment).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    segments = df.selectExpr("*", f"sum(if({a} = 0, 1, 0)) {_over(part, order, _UP_TO_HERE)} AS _seg")
    products = segments.withColumn("_p", F.product(F.expr(f"if({a} = 0, 1D, {a})")).over(upto))
    return products.selectExpr(
        "* EXCEPT (_p, _seg)",
        "if(_seg = 0, _p, 0D) AS _a",
        f"_p * sum({b} / _p) {_over(in_segment, order, _UP_TO_HERE)} AS _b",
    )


def affine_history(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    init: str,
    before: str,
    after: str,
    chunk: str,
) -> DataFrame:
    """Value before and after every row of ``x' = a * x + b``, starting at ``init``.

    ``a`` and ``b`` are columns of ``df``; ``init`` is constant per key.
    """
    part = [*keys, chunk]
    rows = _running_maps(df, part, order, "a", "b").selectExpr(
        "*", f"lag(_a) {_over(part, order)} AS _pa", f"lag(_b) {_over(part, order)} AS _pb"
    )
    composite = affine_fold(df, part, order, f"max({init}) AS _init").withColumnsRenamed({"a": "_ca", "b": "_cb"})
    chained = _running_maps(composite, keys, [chunk], "_ca", "_cb")
    earlier = _over(keys, [chunk])
    entry = chained.selectExpr(
        *part, f"coalesce(lag(_a) {earlier} * _init + lag(_b) {earlier}, _init) AS _entry"
    )
    return rows.join(entry, part).selectExpr(
        "* EXCEPT (_a, _b, _pa, _pb, _entry)",
        f"coalesce(_pa * _entry + _pb, _entry) AS {before}",
        f"_a * _entry + _b AS {after}",
    )


def affine_fold(df: DataFrame, keys: list[str], order: list[str], *extra: str) -> DataFrame:
    """Composite map (a, b) per key of the maps (a, b) taken in ``order``.

    The composite factor is the product of all factors, the composite offset
    the sum of the offsets, each times the factors after it. The window that
    yields these sorts within the shuffle of the aggregate and can spill; no
    group is gathered into an array. ``extra`` are further aggregates, named
    with AS.
    """
    after = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    later = F.product("a").over(after.rowsBetween(Window.unboundedPreceding, -1))
    weighted = df.withColumn("_later", later)
    return weighted.groupBy(*keys).agg(
        F.product("a").alias("a"), F.expr("sum(b * coalesce(_later, 1D)) AS b"), *[F.expr(e) for e in extra]
    )
