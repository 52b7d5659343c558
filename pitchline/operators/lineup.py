"""Squads, playing time and match counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions.formulas import FULL_MATCH_MINUTES as FULL
from pitchline.operators.scan import chunk_of, prefix_count
from pitchline.operators.stats import assigned
from pitchline.settings import CHUNK_DAYS, TIMELINE

ON_FIELD = "on_field"
FULL_90 = "full_90"

_NOBODY = "CAST(array() AS ARRAY<STRUCT<slot: STRING, slot_pos: INT, idx: INT, player_id: BIGINT, sub_minute: INT>>)"


def _listed(slot: str, slot_pos: int, side: str) -> str:
    """Members of one list with the minute of the first substitution naming them."""
    minute = f"get(filter(t.substitutions, s -> s.{side} = m.playerId), 0).minute"
    member = (
        f"named_struct('slot', '{slot}', 'slot_pos', {slot_pos}, 'idx', i,"
        f" 'player_id', m.playerId, 'sub_minute', {minute})"
    )
    return f"coalesce(transform(t.{slot}, (m, i) -> {member}), {_NOBODY})"


def squad_members(matches: DataFrame) -> DataFrame:
    """One row per listed player, bench before line-up within a team."""
    # The outer generators keep Catalyst from adding "array is not empty" filters,
    # which would evaluate the nested expressions a second time.
    team = matches.selectExpr("match_id", "match_day", "kickoff", "status", "explode_outer(teams) AS t")
    listed = f"concat({_listed('bench', 0, 'playerIn')}, {_listed('lineup', 1, 'playerOut')})"
    members = team.selectExpr(
        "match_id", "match_day", "kickoff", "status",
        "t.team_pos AS team_pos", "t.team_id AS team_id", f"inline_outer({listed})",
    )
    return members.where("player_id IS NOT NULL")


def appearances(matches: DataFrame, minutes_mode: str = ON_FIELD) -> DataFrame:
    """Time on the field per listed player.

    ``on_field`` gives the real minutes; ``full_90`` credits everybody with 90
    in matches whose status is ``Played``.
    """
    bench = "slot = 'bench'"
    unused = f"({bench} AND sub_minute IS NULL)"
    entered = f"CASE WHEN {unused} THEN -1 WHEN {bench} THEN sub_minute ELSE 0 END"
    left = f"CASE WHEN {unused} THEN -1 WHEN {bench} THEN {FULL} ELSE coalesce(sub_minute, {FULL}) END"
    minutes = f"if({unused}, 0, {left} - {entered})"
    if minutes_mode == FULL_90:
        minutes = f"if(status = 'Played', {FULL}, {minutes})"
    elif minutes_mode != ON_FIELD:
        raise ValueError(f"unknown minutes_mode {minutes_mode!r}")
    return squad_members(matches).selectExpr(
        "match_id", "match_day", "kickoff", "player_id", "team_id", "team_pos", "slot",
        f"{entered} AS minute_in",
        f"{left} AS minute_out",
        f"{minutes} AS minutes",
        f"NOT {unused} AS participated",
    )


def match_counts(apps: DataFrame) -> DataFrame:
    """Matches played per player; no row for the sentinel; being listed without coming on does not count."""
    return assigned(apps).where("participated").groupBy("player_id").agg(F.expr("count(1) AS matches_played"))


def prior_matches(
    played: DataFrame, seeds: DataFrame | None = None, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Add ``prior_matches``: how many matches the player took part in before.

    ``played`` holds participations only, one row per match and player;
    ``seeds`` (player_id, seed_matches) carries counts from before these rows.
    """
    rows = played.selectExpr("*", f"{chunk_of('match_day', chunk_days)} AS chunk")
    counted = prefix_count(rows, ["player_id"], list(TIMELINE), "prior_matches", "chunk").drop("chunk")
    if seeds is None:
        return counted
    earlier = seeds.select("player_id", "seed_matches")
    return counted.join(earlier, "player_id", "left").selectExpr(
        "* EXCEPT (prior_matches, seed_matches)", "prior_matches + coalesce(seed_matches, 0) AS prior_matches"
    )
