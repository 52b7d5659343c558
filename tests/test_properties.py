"""Properties that hold for all inputs."""

import datetime
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from records import event, formation, lines, match, member, season

from pitchline.operators import stats
from pitchline.operators.facts import event_facts
from pitchline.operators.scan import affine_fold, affine_history, prefix_count
from pitchline.plans.gold import Gold
from pitchline.sources import lines as line_source

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_counts_do_not_depend_on_grouping_or_order(spark):
    records = [r for r in season() if "eventId" in r]
    facts = event_facts(line_source.read_events(lines(spark, records)))
    whole = stats.count_by_player(facts)
    random.Random(3).shuffle(records)
    parts = [stats.count_by_player(event_facts(line_source.read_events(lines(spark, records[i::3])))) for i in range(3)]
    merged = stats.merge_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert _rows(merged) == _rows(whole)


factor = st.one_of(st.just(0.0), st.floats(0.01, 1.0))
timeline = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 90), factor, st.floats(0, 1)), min_size=1, max_size=40)


def _timeline(spark, steps):
    start = datetime.date(2020, 1, 1)
    rows = [(k, (start + datetime.timedelta(days=d)).toordinal() // 10, d, i, a, b, 0.5) for i, (k, d, a, b) in enumerate(steps)]
    return spark.createDataFrame(rows, "k INT, chunk BIGINT, day INT, i INT, a DOUBLE, b DOUBLE, x0 DOUBLE")


def _by_hand(steps):
    state, seen, out = {}, {}, {}
    for i, (k, d, a, b) in sorted(enumerate(steps), key=lambda s: (s[1][1], s[0])):
        old = state.get(k, 0.5)
        state[k] = a * old + b
        out[i] = (old, state[k], seen.get(k, 0))
        seen[k] = seen.get(k, 0) + 1
    return out, state


@few
@given(timeline)
def test_scans_equal_the_recurrence(spark, steps):
    df = _timeline(spark, steps)
    expected, final = _by_hand(steps)
    got = affine_history(df, ["k"], ["day", "i"], "x0", "old", "new", "chunk")
    counted = prefix_count(got, ["k"], ["day", "i"], "n", "chunk")
    rows = {r.i: (r.old, r.new, r.n) for r in counted.collect()}
    assert rows.keys() == expected.keys()
    for i, (old, new, n) in rows.items():
        assert (old, new) == pytest.approx(expected[i][:2], abs=1e-9)
        assert n == expected[i][2]
    folded = affine_fold(affine_fold(df, ["k", "chunk"], ["day", "i"]), ["k"], ["chunk"])
    assert {r.k: r.a * 0.5 + r.b for r in folded.collect()} == pytest.approx(final, abs=1e-9)


def test_chunk_size_does_not_change_results(spark):
    """Records without a readable time sort first within their day, in chunks of any size."""
    records = season(days=6)
    for r in records:
        if r.get("wyId", 0) // 100 in (2, 5):
            r["dateutc"] = r["dateutc"][:10] + " 25:61:00"
    source = lines(spark, records)
    one, two = (Gold.from_lines(source, chunk_days=days) for days in (2, 400))
    for name, keys, value in (("rating_history", ("match_id", "player_id"), "rating"), ("chemistry", ("player_lo", "player_hi"), "chemistry")):
        a, b = ({tuple(r[k] for k in keys): r[value] for r in getattr(gold, name).collect()} for gold in (one, two))
        assert a == pytest.approx(b, abs=1e-12)
        assert len(a) > 20


def test_unreadable_time_keeps_its_day(spark):
    teams = {"1": formation([member(1)]), "2": formation([member(2)])}
    dates = ["2018-02-01 15:00:00", "2018-04-02 25:61:00", "2018-05-01 15:00:00"]
    source = lines(spark, [match(k + 1, teams, d) for k, d in enumerate(dates)] + [event(8, [1801], 1, k + 1, 1, number=k) for k in range(3)])
    history = Gold.from_lines(source, chunk_days=7).rating_history
    assert {r.match_id: r.prior_matches for r in history.where("player_id = 1").collect()} == {1: 0, 2: 1, 3: 2}


def test_running_mean_is_the_recurrence_when_every_match_is_rated(spark):
    gold = Gold.from_lines(lines(spark, season(days=6)))
    sums = {}
    rated = gold.match_ratings.orderBy("match_day", "kickoff", "match_id").collect()
    every = {r.player_id for r in rated}
    gaps = {r.player_id for r in gold.participations.where("pass_accuracy IS NULL").collect()}
    history = {(r.player_id, r.match_id): r.rating for r in gold.rating_history.collect()}
    assert every - gaps
    for r in rated:
        if r.player_id in gaps:
            continue
        sums.setdefault(r.player_id, []).append(r.match_rating)
        values = sums[r.player_id]
        assert history[(r.player_id, r.match_id)] == pytest.approx(sum(values) / len(values))


def test_chemistry_stays_between_0_and_1(spark):
    values = [r.chemistry for r in Gold.from_lines(lines(spark, season(days=8))).chemistry.collect()]
    assert values and all(0 <= v <= 1 for v in values)
