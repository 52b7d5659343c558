"""Match summaries: scorers and cards per match as typed arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counter(text: Column) -> Column:
    """A counter kept as text; "null" and junk count as 0."""
    return F.coalesce(text.try_cast("int"), F.lit(0))


def _members(team: Column) -> Column:
    empty = F.array().cast("array<struct<playerId:bigint,goals:string,ownGoals:string,yellowCards:string,redCards:string>>")
    return F.concat(F.coalesce(team["bench"], empty), F.coalesce(team["lineup"], empty))


def _scorers(field: str) -> Column:
    def of_team(team):
        scored = F.filter(_members(team), lambda m: _counter(m[field]) > 0)
        return F.transform(
            scored,
            lambda m: F.struct(
                m["playerId"].alias("player_id"),
                team["team_id"].alias("team_id"),
                _counter(m[field]).alias("goals"),
            ),
        )

    return F.flatten(F.transform("teams", of_team))


def _carded(field: str) -> Column:
    def shown(member):
        return F.coalesce(F.nullif(member[field], F.lit("null")), F.lit("0")) != "0"

    return F.flatten(
        F.transform("teams", lambda t: F.transform(F.filter(_members(t), shown), lambda m: m["playerId"]))
    )


def summarise(matches: DataFrame) -> DataFrame:
    """Summary of every match record; computed within the row, no shuffle."""
    return matches.select(
        "date", "label", "match_id", "duration", "winner", "venue", "gameweek",
        _scorers("goals").alias("goals"),
        _scorers("ownGoals").alias("own_goals"),
        _carded("yellowCards").alias("yellow_cards"),
        _carded("redCards").alias("red_cards"),
    )


def match_summaries(matches: DataFrame) -> DataFrame:
    """One summary per (date, label)."""
    return preferred(summarise(matches))


def preferred(rows: DataFrame) -> DataFrame:
    """Of the summaries of a (date, label) the one of the smallest match id, then of the smallest content hash.

    ``rows`` may be a stream; the rule does not depend on arrival.
    """
    values = F.struct(*[c for c in rows.columns if c not in ("date", "label")])
    order = F.struct(F.col("match_id").isNull(), "match_id", F.xxhash64(F.to_json(values)))
    return rows.groupBy("date", "label").agg(F.min_by(values, order).alias("s")).select("date", "label", "s.*")


def scorers(summaries: DataFrame, field: str) -> DataFrame:
    """Exploded goals or own goals in listing order."""
    return summaries.select("date", "label", F.posexplode(field).alias("pos", "g")).select(
        "date", "label", "pos", "g.*"
    )


def cards(summaries: DataFrame) -> DataFrame:
    """Exploded yellow and red cards in listing order."""
    def tagged(colour, field):
        return F.transform(
            field, lambda p, i: F.struct(F.lit(colour).alias("card"), i.alias("pos"), p.alias("player_id"))
        )

    return summaries.select(
        "date", "label",
        F.inline(F.concat(tagged("yellow", F.col("yellow_cards")), tagged("red", F.col("red_cards")))),
    )
