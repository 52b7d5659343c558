"""Per-player match statistics and career profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions import formulas
from pitchline.operators.facts import COUNTERS

NO_PLAYER = 0


def assigned(df: DataFrame) -> DataFrame:
    """Drop the "no player" sentinel; stated before the shuffle, it is a hot key."""
    return df.where(f"player_id <> {NO_PLAYER}")


def _count(rows: DataFrame, order: str, *extra: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return rows.groupBy(*keys, "match_id", "player_id").agg(
        F.expr(f"max_by(team_id, {order}) AS team_id"),
        F.expr(f"max({order}) AS last_event_id"),
        *[F.expr(f"sum({c}) AS {c}") for c in COUNTERS],
        *[F.expr(e) for e in extra],
    )


def count_by_player(facts: DataFrame, *extra: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sum the counters per (match, player), within further ``keys`` if any.

    The sums and the team of the latest event all have fixed-width buffers, so
    this is a hash aggregate with a map-side partial: however hot a player or a
    match is, each task sends one row per key.
    """
    return _count(facts, "event_id", *extra, keys=keys)


def merge_counts(partials: DataFrame, *extra: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Merge partial counts of the same (match, player), in any order and grouping."""
    return _count(partials, "last_event_id", *extra, keys=keys)


def with_ratios(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "match_id",
        "player_id",
        "team_id",
        *COUNTERS,
        *[f"{expr} AS {name}" for name, expr in formulas.RATIOS.items()],
        f"{formulas.PASS_NUM} AS pass_num",
        f"{formulas.PASS_TOT} AS pass_tot",
    )


def player_match_stats(facts: DataFrame) -> DataFrame:
    """Counters and ratios per (match, player), sentinel player dropped first."""
    return with_ratios(count_by_player(assigned(facts)))


def player_profiles(stats: DataFrame) -> DataFrame:
    """Career sums per player over all matches.

    ``shots_target_sum`` adds up the match ratios; ``shots_target_avg`` is their
    mean and is what the profile answer shows.
    """
    total = stats.groupBy("player_id").agg(
        F.expr("sum(fouls) AS fouls"),
        F.expr("sum(goal) AS goals"),
        F.expr("sum(own_goal) AS own_goals"),
        F.expr("sum(pass_num) AS pass_num"),
        F.expr("sum(pass_tot) AS pass_tot"),
        F.expr("sum(shots_on_target) AS shots_target_sum"),
        F.expr("avg(shots_on_target) AS shots_target_avg"),
    )
    return total.selectExpr("*", f"{formulas.ratio('pass_num', 'pass_tot')} AS pass_accuracy")
