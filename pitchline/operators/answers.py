"""Answers to requests from a set of results, computed or stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.operators import prediction
from pitchline.sources import requests as request_source
from pitchline.sources.dimensions import players_by_name

_LISTS = ("goals", "own_goals", "yellow_cards", "red_cards")


def _error(found: str, what: str):
    return F.when(F.col("Id").isNull(), "unknown player").when(F.col(found).isNull(), what)


def profile_answers(requests: DataFrame, players: DataFrame, profiles: DataFrame) -> DataFrame:
    """The player's dimension row with the career figures."""
    figures = profiles.select(
        F.col("player_id").alias("Id"), "fouls", "goals", "own_goals",
        F.col("pass_accuracy").alias("percent_pass_accuracy"),
        F.col("shots_target_avg").alias("percent_shots_on_target"),
    )
    asked = requests.select("req_id", "name").join(players_by_name(players), "name", "left")
    return asked.join(figures, "Id", "left").withColumn("error", _error("fouls", "no profile"))


def rating_answers(requests: DataFrame, players: DataFrame, latest: DataFrame) -> DataFrame:
    """Performance in the player's last match, on a scale of about ten."""
    known = players_by_name(players).select("name", "Id")
    rates = latest.select(F.col("player_id").alias("Id"), (10 * F.col("match_rating")).alias("performance"))
    asked = requests.select("req_id", "name").join(known, "name", "left").join(rates, "Id", "left")
    return asked.select("req_id", "name", "performance", _error("performance", "no match rating").alias("error"))


def named_details(summaries: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Summaries with ids replaced by names; empty lists stay empty arrays."""
    def tagged(kind):
        scorer = kind in ("goals", "own_goals")
        return F.transform(
            kind,
            lambda x, i: F.struct(
                F.lit(kind).alias("kind"),
                i.alias("pos"),
                (x["player_id"] if scorer else x).alias("player_id"),
                (x["team_id"] if scorer else F.lit(None).cast("bigint")).alias("team_id"),
                (x["goals"] if scorer else F.lit(None).cast("int")).alias("number_of_goals"),
            ),
        )

    keys = ["date", "label"]
    names = players.select(F.col("Id").alias("player_id"), "name")
    team_names = teams.select(F.col("Id").alias("team_id"), F.col("name").alias("team"))
    items = (
        summaries.select(*keys, F.inline(F.concat(*[tagged(kind) for kind in _LISTS])))
        .join(names, "player_id", "left")
        .join(team_names, "team_id", "left")
    )
    scorer = F.struct("name", "team", "number_of_goals")

    def gathered(kind):
        value = scorer if kind in ("goals", "own_goals") else F.col("name")
        ordered = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("pos", value.alias("v")))))
        return F.transform(ordered, lambda x: x["v"]).alias(kind)

    lists = items.groupBy(*keys).agg(*[gathered(kind) for kind in _LISTS])
    # Winner 0 is a draw, whatever the team table holds under that id.
    winners = team_names.where("team_id <> 0").select(
        F.col("team_id").alias("winner"), F.col("team").alias("winner_name")
    )
    header = summaries.select(*keys, "duration", "venue", "gameweek", "winner").join(winners, "winner", "left")
    filled = {
        "goals": "array<struct<name:string,team:string,number_of_goals:int>>",
        "own_goals": "array<struct<name:string,team:string,number_of_goals:int>>",
        "yellow_cards": "array<string>",
        "red_cards": "array<string>",
    }
    return header.join(lists, keys, "left").select(
        *keys, "duration", F.col("winner_name").alias("winner"), "gameweek", "venue",
        *[F.coalesce(kind, F.array().cast(kind_type)).alias(kind) for kind, kind_type in filled.items()],
    )


def match_answers(
    requests: DataFrame, summaries: DataFrame, players: DataFrame, teams: DataFrame
) -> DataFrame:
    """Details of the requested matches.

    Names are resolved once per distinct match, so many requests for one match
    cost one row each.
    """
    keys = ["date", "label"]
    wanted = requests.select(*keys).distinct()
    details = named_details(summaries.join(wanted, keys, "left_semi"), players, teams)
    answered = requests.select("req_id", *keys).join(details.withColumn("found", F.lit(True)), keys, "left")
    return answered.withColumn("error", F.when(F.col("found").isNull(), "unknown match")).drop("found")


def answer_all(
    asked: DataFrame,
    players: DataFrame,
    teams: DataFrame,
    *,
    ratings: DataFrame,
    chemistry: DataFrame,
    profiles: DataFrame,
    summaries: DataFrame,
) -> dict[str, DataFrame]:
    """The answers to a mixed set of requests, one table per kind, and the documents that are no requests."""
    of = lambda kind: request_source.routed(asked, kind)
    return {
        "predict": prediction.predict(of("predict"), players, ratings, chemistry),
        "profile": profile_answers(of("profile"), players, profiles),
        "match_rate": rating_answers(of("match_rate"), players, ratings),
        "details": match_answers(of("details"), summaries, players, teams),
        "rejected": request_source.rejected(asked),
    }
