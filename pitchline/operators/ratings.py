"""Match ratings and the running player rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions import formulas
from pitchline.operators.lineup import prior_matches
from pitchline.operators.scan import affine_history, chunk_of
from pitchline.operators.stats import assigned
from pitchline.settings import CHUNK_DAYS, TIMELINE

_START = formulas.double(formulas.START_RATING)


def participations(stats: DataFrame, apps: DataFrame) -> DataFrame:
    """One row per match and player on the field, with the figures a rating needs.

    Figures are NULL for a player without events; such a match is not rated but
    counts as played.
    """
    played = assigned(apps.where("participated")).select(
        "match_id", "match_day", "kickoff", "player_id", "minutes"
    )
    measured = stats.select("match_id", "player_id", "team_id", *formulas.RATIOS, "fouls", "own_goal")
    return played.join(measured, ["match_id", "player_id"], "left")


def match_ratings(
    played: DataFrame, seeds: DataFrame | None = None, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Rating of every participation that has events.

    Prior matches are counted over all participations, before those without
    events are dropped.
    """
    counted = prior_matches(played, seeds, chunk_days).where("pass_accuracy IS NOT NULL")
    return counted.selectExpr(
        "match_id", "match_day", "kickoff", "player_id", "team_id", "minutes", "prior_matches",
        f"{formulas.match_rating('minutes')} AS match_rating",
    )


def player_ratings(
    rated: DataFrame, seeds: DataFrame | None = None, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Rating history: (match_rating + old * n) / (1 + n) in match order.

    ``seeds`` (player_id, seed_rating) carries ratings from before these rows.
    A player without a team (id 0) is rated but shows no change. ``rated`` is read
    several times, so it should be stored.
    """
    start = _START
    if seeds is not None:
        rated = rated.join(seeds.select("player_id", "seed_rating"), "player_id", "left")
        start = f"coalesce(seed_rating, {_START})"
    n = "double(prior_matches)"
    steps = rated.selectExpr(
        "*", f"{n} / (1 + {n}) AS a", f"match_rating / (1 + {n}) AS b", f"{start} AS _start"
    ).drop("seed_rating")
    steps = steps.selectExpr("*", f"{chunk_of('match_day', chunk_days)} AS chunk")
    history = affine_history(steps, ["player_id"], list(TIMELINE), "_start", "_old", "rating", "chunk")
    return history.drop("a", "b", "_start", "chunk").selectExpr(
        "* EXCEPT (_old)", "if(team_id = 0, 0D, rating - _old) AS rating_change"
    )


def latest_ratings(history: DataFrame) -> DataFrame:
    """Last row of each player's history, found by a partial aggregate."""
    value = "struct(match_id, team_id, match_rating, rating, rating_change)"
    latest = history.groupBy("player_id").agg(F.expr(f"max_by({value}, struct({', '.join(TIMELINE)})) AS v"))
    return latest.select("player_id", "v.*")


def running_mean_ratings(rated: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """The special case where every participation is rated.

    With n = number of earlier rated matches the recurrence is the running mean
    of the match ratings.
    """
    counted = prior_matches(rated, chunk_days=chunk_days).selectExpr("*", "1L AS team_id")
    return player_ratings(counted, chunk_days=chunk_days).drop("team_id", "prior_matches")
