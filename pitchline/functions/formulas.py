"""Scoring formulas as SQL expressions over the counter columns.

Each function returns expression text for ``selectExpr``/``expr``; Catalyst
compiles it into the surrounding stage. A zero denominator yields 0.0 unless
the function says otherwise.
"""

from __future__ import annotations

# Fixed values of the scoring model.
START_RATING = 0.5
START_CHEMISTRY = 0.5
FULL_MATCH_MINUTES = 90
FULL_MATCH_BONUS = 1.05
PASS_WEIGHT = 0.4
DUEL_WEIGHT = 0.3
SHOT_WEIGHT = 0.1
FREE_KICK_WEIGHT = 0.2
FOUL_PENALTY = 0.005
OWN_GOAL_PENALTY = 0.05
LINEUP_SIZE = 11

# A rating change at or below this is float noise, not a change.
CHANGE_TOLERANCE = 1e-9

PASS_NUM = "acc_pass + key_acc_pass"
PASS_TOT = "acc_pass + inacc_pass + key_acc_pass + key_inacc_pass"


def double(value: float) -> str:
    """A DOUBLE literal (a bare decimal would be of DECIMAL type)."""
    return f"{value!r}D"


def ratio(numerator: str, denominator: str) -> str:
    return f"coalesce(try_divide(double({numerator}), double({denominator})), 0D)"


# The four ratios of one player's match. Free kicks may exceed 1: a penalty
# adds to the numerator only.
RATIOS = {
    "pass_accuracy": ratio(PASS_NUM, PASS_TOT),
    "duel_effectiveness": ratio("duel_won + 0.5D * duel_neutral", "duel_won + duel_lost + duel_neutral"),
    "fk_effectiveness": ratio("fk_acc + penalty", "fk_acc + fk_inacc"),
    "shots_on_target": ratio("goal + 0.5D * (on_target - goal)", "on_target + off_target + goal"),
}


def match_rating(minutes: str) -> str:
    """Rating of one match from the four ratios, playing time, fouls and own goals."""
    base = (
        f"({double(PASS_WEIGHT)} * pass_accuracy + {double(DUEL_WEIGHT)} * duel_effectiveness"
        f" + {double(SHOT_WEIGHT)} * shots_on_target + {double(FREE_KICK_WEIGHT)} * fk_effectiveness)"
    )
    share = (
        f"if({minutes} = {FULL_MATCH_MINUTES}, {double(FULL_MATCH_BONUS)},"
        f" {minutes} / {double(float(FULL_MATCH_MINUTES))})"
    )
    discount = f"(1 - {double(FOUL_PENALTY)} * fouls - {double(OWN_GOAL_PENALTY)} * own_goal)"
    return f"0.5D + 0.5D * {base} * {share} * {discount}"


def changed(delta: str) -> str:
    return f"abs({delta}) > {double(CHANGE_TOLERANCE)}"


def win_chance(mine: str, other: str) -> str:
    """Percent, not clamped (-50 to 150); NULL when both strengths are 0."""
    return f"(0.5D + try_divide({mine} - {other}, {mine} + {other})) * 100"
