"""Counters with evicted state against counters of all events."""

import random

import pytest

from pitchline.operators import stats
from pitchline.operators.facts import COUNTERS, event_facts
from pitchline.streaming import finalise

SCHEMA = "event_id BIGINT, match_id BIGINT, team_id BIGINT, player_id BIGINT, event_code INT, sub_event INT, tag_ids ARRAY<INT>, event_ts TIMESTAMP"


def _events(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA.replace("event_ts TIMESTAMP", "ts STRING"))
    return df.selectExpr("* EXCEPT (ts)", "CAST(ts AS TIMESTAMP) AS event_ts")


def _rows(days, per_day=6):
    out = []
    for day in days:
        for k in range(per_day):
            number = 100 * day + k
            out.append((number, day, k % 2, 1 + k % 3, (8, 1, 10)[number % 3], 0, [1801, 101], f"2024-01-{day + 1:02d} {8 + k:02d}:00:00"))
    return out


def _table(df):
    return {(r.match_id, r.player_id): [r[c] for c in ("team_id", *COUNTERS)] for r in df.collect()}


@pytest.mark.parametrize("order", ["in order", "shuffled", "backwards"])
def test_no_row_is_lost_and_state_is_bounded(spark, tmp_path, order):
    rows = _rows(range(20))
    rows += [(9000, 3, 1, 0, 8, 0, [1801], "2024-01-05 10:00:00"), (9001, 3, 1, 2, 8, 0, [1801], None)]
    if order == "shuffled":
        random.Random(4).shuffle(rows)
    parts = [rows[k : k + 31] for k in range(0, len(rows), 31)]
    if order == "backwards":
        parts.reverse()
    store = finalise.open_store(spark, str(tmp_path), fan=2)
    for number, part in enumerate(parts):
        finalise.process_batch(store, _events(spark, part), number)
        # Three days within the delay, three players a day: the state does not grow with the stream.
        assert store.snapshot().rows("open").count() <= 4 * 3
        finalise.process_batch(store, _events(spark, part), number)
    expected = _table(stats.count_by_player(event_facts(stats.assigned(_events(spark, rows)))))
    assert _table(finalise.counters(store)) == expected
    late = store.snapshot().rows("correction").count()
    assert (late > 10) == (order != "in order") and late >= 1
    assert store.snapshot().rows("final").count() > 0


def test_a_closed_day_is_corrected(spark, tmp_path):
    """A record of a closed day reaches the counters through the corrections."""
    store = finalise.open_store(spark, str(tmp_path))
    for number, days in enumerate([[0, 1], [10], [0]]):
        finalise.process_batch(store, _events(spark, _rows(days)), number)
    now = store.snapshot()
    assert {str(r.day) for r in now.rows("correction").collect()} == {"2024-01-01"}
    assert {str(r.day) for r in now.rows("open").collect()} == {"2024-01-11"}
    assert _table(finalise.counters(store))[(0, 1)][0] is not None
