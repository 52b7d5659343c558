"""Event facts: one row per event with fifteen 0/1 counters."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Rule(NamedTuple):
    counter: str
    code: int | None = None
    tags: tuple[int, ...] = ()
    absent: tuple[int, ...] = ()
    sub_event: int | None = None


# Which event code, tags and sub-event raise which counter.
RULES = (
    Rule("acc_pass", 8, (1801,)),
    Rule("inacc_pass", 8, (1802,)),
    Rule("key_acc_pass", 8, (302, 1801), (1802,)),
    Rule("key_inacc_pass", 8, (302, 1802)),
    Rule("duel_lost", 1, (701,)),
    Rule("duel_neutral", 1, (702,)),
    Rule("duel_won", 1, (703,)),
    Rule("penalty", 3, (101,), sub_event=35),
    Rule("fk_acc", 3, (1801,)),
    Rule("fk_inacc", 3, (1802,)),
    Rule("goal", 10, (101,)),
    Rule("on_target", 10, (1801,)),
    Rule("off_target", 10, (1802,)),
    Rule("fouls", 2),
    Rule("own_goal", None, (102,)),
)

COUNTERS = tuple(rule.counter for rule in RULES)


def _has(tag: int) -> str:
    return f"coalesce(array_contains(tag_ids, {tag}), false)"


def _counter(rule: Rule) -> str:
    parts = []
    if rule.code is not None:
        parts.append(f"event_code = {rule.code}")
    if rule.sub_event is not None:
        parts.append(f"sub_event = {rule.sub_event}")
    parts += [_has(tag) for tag in rule.tags]
    parts += [f"NOT {_has(tag)}" for tag in rule.absent]
    return f"if({' AND '.join(parts)}, 1, 0) AS {rule.counter}"


def event_facts(events: DataFrame, *carry: str) -> DataFrame:
    """Keep every event, also those that raise no counter, and the columns in ``carry``."""
    return events.selectExpr(
        "event_id", "match_id", "team_id", "player_id", "event_code", *carry, *[_counter(r) for r in RULES]
    )
