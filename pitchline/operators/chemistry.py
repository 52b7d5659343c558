"""Pairwise chemistry: an undirected weighted graph kept as a sparse edge table.

Edges are keyed (player_lo, player_hi) with player_lo < player_hi. An absent
edge has the start value; that replaces a table of all pairs of all players.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pitchline.functions.formulas import START_CHEMISTRY, changed, double
from pitchline.operators.scan import affine_fold, chunk_of
from pitchline.operators.stats import assigned
from pitchline.settings import CHUNK_DAYS, TIMELINE

PAIR = ["player_lo", "player_hi"]

_START = double(START_CHEMISTRY)


def _same_match_pairs(rows: DataFrame, carry: list[str]) -> DataFrame:
    """Unordered pairs of rows of one match.

    An equi-join on the match with the order as residual condition; a match has
    as many rows as its two squads.
    """
    left, right = (
        rows.selectExpr("match_id", f"player_id AS player_{s}", *[f"{c} AS {c}_{s}" for c in carry])
        for s in ("lo", "hi")
    )
    return left.join(right, "match_id").where("player_lo < player_hi")


def chemistry_init(members: DataFrame) -> DataFrame:
    """Start edges of all pairs listed in a match together, the only ones that can change."""
    listed = assigned(members.select("match_id", "player_id"))
    pairs = _same_match_pairs(listed, []).select(*PAIR).distinct()
    return pairs.selectExpr(*PAIR, f"{_START} AS chemistry")


def pair_updates(history: DataFrame, keep_unchanged: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One update per match and pair of players whose rating changed.

    ``keep_unchanged`` also emits pairs without an update, with delta 0. Columns named
    in ``carry`` come along for both players.
    """
    rows = history.select("match_id", "match_day", "kickoff", "player_id", "team_id", "rating_change", *carry)
    if not keep_unchanged:
        rows = rows.where(changed("rating_change"))
    pairs = _same_match_pairs(rows, ["match_day", "kickoff", "team_id", "rating_change", *carry])
    one, two = "rating_change_lo", "rating_change_hi"
    same_sign = f"({one} < 0 AND {two} < 0 OR {one} > 0 AND {two} > 0)"
    delta = f"abs({one} + {two}) / 2"
    both = f"({changed(one)} AND {changed(two)})"
    if keep_unchanged:
        delta = f"if({both}, {delta}, 0D)"
    return pairs.selectExpr(
        "match_id", "match_day_lo AS match_day", "kickoff_lo AS kickoff", *PAIR,
        f"{delta} AS delta", f"(team_id_lo = team_id_hi) = {same_sign} AS up",
        *([f"{both} AS updated"] if keep_unchanged else []), *[f"{c}_{s}" for c in carry for s in ("lo", "hi")],
    )


def pair_maps(updates: DataFrame) -> DataFrame:
    """Each update as a map on the edge: c + d(1 - c) going up, c - dc going down."""
    return updates.selectExpr("*", "1 - delta AS a", "if(up, delta, 0D) AS b")


def fold_days(updates: DataFrame) -> DataFrame:
    """Composite map per pair and match day, with the number of real updates ``n``."""
    return affine_fold(
        pair_maps(updates), [*PAIR, "match_day"], ["kickoff", "match_id"], "sum(int(updated)) AS n"
    )


def apply_maps(maps: DataFrame) -> DataFrame:
    """Chemistry from one composite map per pair."""
    return maps.selectExpr(*PAIR, f"a * {_START} + b AS chemistry")


def fold_maps(maps: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Edges from maps (match_day, a, b), folded per pair in match order.

    A pair's maps are folded per calendar chunk first.
    """
    order = [c for c in TIMELINE if c in maps.columns]
    chunked = maps.selectExpr("*", f"{chunk_of('match_day', chunk_days)} AS chunk")
    return apply_maps(affine_fold(affine_fold(chunked, [*PAIR, "chunk"], order), PAIR, ["chunk"]))


def chemistry(updates: DataFrame, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """Edges after all updates."""
    return fold_maps(pair_maps(updates), chunk_days)
