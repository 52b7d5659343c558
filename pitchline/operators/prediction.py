"""Win prediction for many requests at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions.formulas import LINEUP_SIZE, START_CHEMISTRY, double, win_chance
from pitchline.operators.chemistry import PAIR
from pitchline.sources.dimensions import players_by_name

UNRATED_FACTOR = 1.0

# A line-up is valid with exactly one keeper and at least this
# many players of the other roles.
KEEPERS = 1
MIN_ROLE = {"DF": 3, "MD": 2, "FW": 1}


def lineups(requests: DataFrame, players: DataFrame) -> DataFrame:
    """One row per request, team and slot, with the player's id and role."""
    sides = "array(struct(1 AS team, team1.*), struct(2 AS team, team2.*))"
    slots = (
        requests.selectExpr("req_id", f"inline({sides})")
        .selectExpr("req_id", "team", "name AS team_name", "posexplode(players) AS (pos, name)")
    )
    known = players_by_name(players).selectExpr("name", "Id AS player_id", "role")
    return slots.join(known, "name", "left")


def _role_counts() -> list[str]:
    return [f"count_if(role = '{role}') AS {role.lower()}" for role in ("GK", *MIN_ROLE)]


VALID = " AND ".join([f"gk = {KEEPERS}", *[f"{role.lower()} >= {least}" for role, least in MIN_ROLE.items()]])


def formation_check(members: DataFrame) -> DataFrame:
    """Role counts per line-up and whether they make a valid formation."""
    counted = members.groupBy("req_id", "team").agg(*[F.expr(e) for e in _role_counts()])
    return counted.selectExpr("*", f"{VALID} AS valid")


# Pairs (lower id, higher id) of an array ``m`` of members, later ones with each
# earlier one. A line-up has eleven slots by its schema, hence at most 55 pairs.
_PAIRS = f"""flatten(transform(m, (x, i) -> transform(slice(m, i + 2, {LINEUP_SIZE}),
    y -> struct(least(x.player_id, y.player_id) AS player_lo, greatest(x.player_id, y.player_id) AS player_hi,
                x.factor + y.factor AS factors))))"""

_MEMBERS = "array_sort(collect_list(struct(pos, player_id, factor)) FILTER (WHERE player_id IS NOT NULL)) AS m"


def _with_chemistry(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    return pairs.join(edges.select(*PAIR, "chemistry"), PAIR, "left").selectExpr(
        "* EXCEPT (chemistry)", f"coalesce(chemistry, {double(START_CHEMISTRY)}) AS chemistry"
    )


def mean_chemistry(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Mean chemistry of each player with the other ten of the line-up."""
    gathered = members.selectExpr("*", "1D AS factor").groupBy("req_id", "team").agg(F.expr(_MEMBERS))
    pairs = _with_chemistry(gathered.selectExpr("req_id", "team", f"inline({_PAIRS})"), edges)
    ends = pairs.selectExpr("req_id", "team", "chemistry", "explode(array(player_lo, player_hi)) AS player_id")
    return ends.groupBy("req_id", "team", "player_id").agg(
        F.expr(f"sum(chemistry) / {LINEUP_SIZE - 1} AS mean_chemistry")
    )


def _sides(members: DataFrame, edges: DataFrame, ratings: DataFrame, unrated_factor: float) -> DataFrame:
    """One row per request and team: name, roles, unknown players and strength.

    The strength, the sum over players of rating times mean chemistry with the
    others, is the sum over pairs of chemistry times both ratings; so one pass
    over the pairs is enough.
    """
    rated = members.join(ratings.select("player_id", "rating"), "player_id", "left").selectExpr(
        "*", f"coalesce(rating, {double(unrated_factor)}) AS factor"
    )
    sides = rated.groupBy("req_id", "team").agg(
        F.expr("max(team_name) AS name"),
        F.expr("count_if(player_id IS NULL) AS unknown"),
        *[F.expr(e) for e in _role_counts()],
        F.expr(_MEMBERS),
    )
    header = ["req_id", "team", "name", "unknown", "valid"]
    pairs = sides.selectExpr("*", f"{VALID} AS valid").selectExpr(*header, f"inline_outer({_PAIRS})")
    return _with_chemistry(pairs, edges).groupBy(*header).agg(
        F.expr(f"sum(chemistry * factors) / {LINEUP_SIZE - 1} AS strength")
    )


def team_strength(
    members: DataFrame, edges: DataFrame, ratings: DataFrame, unrated_factor: float = UNRATED_FACTOR
) -> DataFrame:
    """Sum of mean chemistry times rating; an unrated player has a fixed factor."""
    return _sides(members, edges, ratings, unrated_factor).select("req_id", "team", "strength")


def predict(
    requests: DataFrame,
    players: DataFrame,
    ratings: DataFrame,
    edges: DataFrame,
    unrated_factor: float = UNRATED_FACTOR,
) -> DataFrame:
    """Winning chance of both teams of every request.

    A request without two teams, or naming an unknown player, is answered with an
    error instead of a chance; an invalid formation is reported but does not block
    the answer.
    """
    sides = _sides(lineups(requests, players), edges, ratings, unrated_factor)
    known = sides.groupBy("req_id").agg(
        F.expr("sum(unknown) > 0 AS unknown"),
        *[
            F.expr(f"max(struct(name, valid, strength)) FILTER (WHERE team = {i}) AS t{i}")
            for i in (1, 2)
        ],
    )

    asked = requests.selectExpr("req_id", "team1 IS NULL OR team2 IS NULL AS missing")
    error = "CASE WHEN missing THEN 'missing team' WHEN unknown THEN 'unknown player' END"
    both = asked.join(known, "req_id", "left").selectExpr("*", f"{error} AS error")

    def answer(i: int, other: int) -> str:
        return (
            f"struct({i} AS team, t{i}.name AS name,"
            f" if(error IS NULL, {win_chance(f't{i}.strength', f't{other}.strength')}, NULL) AS winning_chance,"
            f" t{i}.valid AS valid, error)"
        )

    return both.selectExpr("req_id", f"inline(array({answer(1, 2)}, {answer(2, 1)}))")
