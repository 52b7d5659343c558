"""Composed affine maps of calendar intervals: any stretch of a timeline in a few rows.

For every key there is a node for each interval of ``FAN ** level`` days that holds
something: the composite of the maps ``x' = a x + b`` in it, in order, and their
number ``n``. A stretch of days is a fold of at most ``FAN`` nodes a level, and a
changed day changes the ``LEVELS`` nodes above it and no others, so both cost the
logarithm of the timeline. ``ROOT`` intervals are some ninety years; what a key has
done altogether is one node, or one for each root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.operators.scan import affine_fold

FAN = 8
ROOT = 5
LEVELS = ROOT + 1

VALUES = ["a", "b", "n"]


def _floor(value: str, by: str) -> str:
    return f"CAST(floor({value} / {by}) AS BIGINT)"


def interval_of(day: str, level: str) -> str:
    """The interval of a level that holds a day number."""
    return _floor(day, f"pow({FAN}, {level})")


def _start(part: str = "part", level: str = "level") -> str:
    return f"{part} * CAST(pow({FAN}, {level}) AS BIGINT)"


def fold(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Composite of the nodes of each key; intervals that do not overlap, in order."""
    return affine_fold(nodes.selectExpr(*keys, *VALUES, f"{_start()} AS _start"), keys, ["_start"], "sum(n) AS n")


def before(nodes: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Composite of everything before ``day`` of each asked key; keys without any have no row.

    ``asked`` holds one row (keys, day) a key.
    """
    left_of = (
        f"part < {interval_of('_day', 'level')} AND "
        f"(level = {ROOT} OR {_floor('part', str(FAN))} = {interval_of('_day', 'level + 1')})"
    )
    wanted = asked.selectExpr(*keys, "unix_date(day) AS _day")
    return fold(nodes.join(wanted, keys).where(left_of), keys)


def siblings(nodes: DataFrame, days: DataFrame, keys: list[str]) -> DataFrame:
    """Stored nodes beside the ones that hold the given days (keys, day), below the same parents."""
    touched = days.selectExpr(*keys, "unix_date(day) AS _day", f"explode(sequence(0, {ROOT})) AS level")
    touched = touched.selectExpr(*keys, "level", f"{interval_of('_day', 'level')} AS part").distinct()
    below = touched.where("level > 0").selectExpr(*keys, "CAST(level - 1 AS INT) AS level", "part AS _parent")
    family = nodes.where(f"level < {ROOT}").withColumn("_parent", F.expr(_floor("part", str(FAN))))
    return family.join(below, [*keys, "level", "_parent"], "left_semi").join(touched, [*keys, "level", "part"], "left_anti").drop("_parent")


def refresh(leaves: DataFrame, beside: DataFrame, keys: list[str]) -> DataFrame:
    """The nodes of all levels above (and of) the changed days.

    ``leaves`` hold the new composite (keys, day, a, b, n) of each changed day, identity
    where nothing is left; ``beside`` their ``siblings``. Every node is folded from leaves
    and siblings alone.
    """
    own = leaves.selectExpr(*keys, "0 AS level", "CAST(unix_date(day) AS BIGINT) AS part", *VALUES, "0 AS _from")
    other = beside.selectExpr(*keys, "level", "part", *VALUES, "level + 1 AS _from")
    frontier = own.unionByName(other).selectExpr("*", f"explode(sequence(_from, {ROOT})) AS _level")
    target = frontier.selectExpr(
        *keys, *VALUES, f"{_start()} AS _start", "_level AS level", f"{_floor('part', f'pow({FAN}, _level - level)')} AS part"
    )
    return affine_fold(target, [*keys, "level", "part"], ["_start"], "sum(n) AS n")
