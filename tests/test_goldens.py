"""Hand-computed values of every formula and branch."""

import datetime

import pytest
from pyspark.sql import functions as F
from records import event, formation, lines, match, member

from pitchline.functions import formulas
from pitchline.operators import chemistry, lineup, prediction, ratings, stats, summary
from pitchline.operators.facts import COUNTERS, event_facts
from pitchline.sources import lines as line_source
from pitchline.sources import requests


@pytest.mark.parametrize(
    "code, sub, tags, expected",
    [
        (8, 30, [1801, 302], {"acc_pass", "key_acc_pass"}),
        (8, 30, [1801, 1802, 302], {"acc_pass", "inacc_pass", "key_inacc_pass"}),
        (8, 30, [302], set()),
        (1, 30, [701, 702, 703], {"duel_lost", "duel_neutral", "duel_won"}),
        (3, 35, [101, 1801], {"penalty", "fk_acc"}),
        (3, 30, [101], set()),
        (3, "", [101, 1802], {"fk_inacc"}),
        (10, 30, [101, 1801], {"goal", "on_target"}),
        (10, 30, [1802], {"off_target"}),
        (2, 30, [], {"fouls"}),
        (9, 30, [102], {"own_goal"}),
        (7, 30, [], set()),
        (10, 30, [1801, 1801], {"on_target"}),
    ],
)
def test_event_counters(spark, code, sub, tags, expected):
    facts = event_facts(line_source.read_events(lines(spark, [event(code, tags, sub=sub)]))).collect()
    assert len(facts) == 1
    assert {c: facts[0][c] for c in COUNTERS} == {c: int(c in expected) for c in COUNTERS}


GOLDEN_COUNTS = dict(
    acc_pass=3, inacc_pass=1, key_acc_pass=1, key_inacc_pass=1, duel_won=2, duel_neutral=1, duel_lost=1,
    fk_acc=1, fk_inacc=1, penalty=1, goal=1, on_target=2, off_target=1, fouls=2, own_goal=0,
)


def _counts(spark, values):
    columns = ["match_id", "player_id", "team_id", *COUNTERS]
    return spark.createDataFrame(
        [(1, 7, 3, *[values[c] for c in COUNTERS])], ", ".join(f"{c} BIGINT" for c in columns)
    )


def test_ratios_and_match_rating(spark):
    row = stats.with_ratios(_counts(spark, GOLDEN_COUNTS)).selectExpr(
        "*", f"{formulas.match_rating('90')} AS full", f"{formulas.match_rating('60')} AS part"
    ).first()
    assert (row.pass_num, row.pass_tot) == (4, 6)
    assert row.pass_accuracy == pytest.approx(4 / 6)
    assert row.duel_effectiveness == pytest.approx(0.625)
    assert row.fk_effectiveness == pytest.approx(1.0)
    assert row.shots_on_target == pytest.approx(0.375)
    assert row.full == pytest.approx(0.859494, abs=1e-6)
    assert row.part == pytest.approx(0.728250, abs=1e-6)


def test_no_events_give_zero_ratios(spark):
    row = stats.with_ratios(_counts(spark, dict.fromkeys(COUNTERS, 0))).selectExpr(
        "*", f"{formulas.match_rating('90')} AS full"
    ).first()
    assert [row[c] for c in formulas.RATIOS] == [0.0] * 4
    assert row.full == 0.5


def _rated(spark, steps):
    day = datetime.date(2018, 1, 1)
    rows = [
        (i + 1, day + datetime.timedelta(days=20 * i), datetime.datetime(2018, 1, 1) + datetime.timedelta(days=20 * i), 7, team, n, m)
        for i, (m, n, team) in enumerate(steps)
    ]
    return spark.createDataFrame(
        rows, "match_id BIGINT, match_day DATE, kickoff TIMESTAMP, player_id BIGINT, team_id BIGINT, "
        "prior_matches BIGINT, match_rating DOUBLE"
    )


@pytest.mark.parametrize("chunk_days", [1, 28])
def test_rating_recurrence(spark, chunk_days):
    rows = ratings.player_ratings(_rated(spark, [(0.859494, 0, 3), (0.728250, 1, 3)]), chunk_days=chunk_days)
    first, second = rows.orderBy("match_id").collect()
    assert (first.rating, first.rating_change) == pytest.approx((0.859494, 0.359494))
    assert (second.rating, second.rating_change) == pytest.approx((0.793872, -0.065622))


@pytest.mark.parametrize("chunk_days", [1, 30])
def test_general_fold_with_gaps_and_reset(spark, chunk_days):
    rows = ratings.player_ratings(_rated(spark, [(0.6, 0, 3), (0.7, 1, 3), (0.2, 5, 3), (0.9, 0, 3), (0.5, 3, 3)]), chunk_days=chunk_days)
    values = [r.rating for r in rows.orderBy("match_id").collect()]
    assert values == pytest.approx([0.6, 0.65, 0.575, 0.9, 0.8])


def test_player_without_team_shows_no_change(spark):
    row = ratings.player_ratings(_rated(spark, [(0.9, 0, 0)])).first()
    assert (row.rating, row.rating_change) == (0.9, 0.0)


def test_seeded_rating(spark):
    seeds = spark.createDataFrame([(7, 4, 0.9)], "player_id BIGINT, seed_matches BIGINT, seed_rating DOUBLE")
    row = ratings.player_ratings(_rated(spark, [(0.4, 4, 3)]), seeds).first()
    assert (row.rating, row.rating_change) == pytest.approx((0.8, -0.1))


@pytest.mark.parametrize(
    "one, two, same, expected",
    [(0.2, 0.1, True, 0.575), (0.2, 0.1, False, 0.425), (0.2, -0.1, True, 0.475),
     (0.2, -0.1, False, 0.525), (-0.2, -0.1, True, 0.575), (-0.2, -0.1, False, 0.425)],
)
def test_chemistry_update(spark, one, two, same, expected):
    when = datetime.datetime(2018, 1, 1)
    rows = [(1, when.date(), when, 9, 3, one), (1, when.date(), when, 4, 3 if same else 5, two)]
    history = spark.createDataFrame(
        rows, "match_id BIGINT, match_day DATE, kickoff TIMESTAMP, player_id BIGINT, team_id BIGINT, rating_change DOUBLE"
    )
    edge = chemistry.chemistry(chemistry.pair_updates(history)).collect()
    assert [(e.player_lo, e.player_hi) for e in edge] == [(4, 9)]
    assert edge[0].chemistry == pytest.approx(expected)


def test_unchanged_players_have_no_update(spark):
    when = datetime.datetime(2018, 1, 1)
    rows = [(1, when.date(), when, p, 3, c) for p, c in ((4, 0.1), (5, 0.0), (6, 1e-12), (7, 0.1))]
    history = spark.createDataFrame(
        rows, "match_id BIGINT, match_day DATE, kickoff TIMESTAMP, player_id BIGINT, team_id BIGINT, rating_change DOUBLE"
    )
    pairs = chemistry.pair_updates(history).collect()
    assert [(p.player_lo, p.player_hi) for p in pairs] == [(4, 7)]
    kept = chemistry.fold_days(chemistry.pair_updates(history, keep_unchanged=True)).collect()
    assert len(kept) == 6 and sum(r.n for r in kept) == 1


def _appearances(spark, status, mode=lineup.ON_FIELD):
    subs = [
        {"playerIn": 8, "playerOut": 2, "minute": 60},
        {"playerIn": 2, "playerOut": 8, "minute": 70},
        {"playerIn": 7, "playerOut": 2, "minute": 80},
    ]
    teams = {"20": formation([member(1), member(2)], [member(8), member(9)], subs), "3": formation([member(30)])}
    parsed = line_source.parse_matches(lines(spark, [match(5, teams, status=status)]))
    rows = lineup.appearances(parsed, mode).collect()
    return {r.player_id: (r.minute_in, r.minute_out, r.minutes, r.participated, r.team_id, r.team_pos) for r in rows}


def test_appearances(spark):
    assert _appearances(spark, "Played") == {
        1: (0, 90, 90, True, 20, 0),
        2: (0, 60, 60, True, 20, 0),
        8: (60, 90, 30, True, 20, 0),
        9: (-1, -1, 0, False, 20, 0),
        30: (0, 90, 90, True, 3, 1),
    }


def test_appearances_full_90(spark):
    assert {p: v[2] for p, v in _appearances(spark, "Played", lineup.FULL_90).items()} == dict.fromkeys((1, 2, 8, 9, 30), 90)
    assert _appearances(spark, "Suspended", lineup.FULL_90)[2][2] == 60
    with pytest.raises(ValueError):
        _appearances(spark, "Played", "other")


def test_matches_played_counts_participations_only(spark):
    teams = {"1": formation([member(1)], [member(2)]), "2": formation([member(3)])}
    parsed = line_source.parse_matches(lines(spark, [match(5, teams), match(6, teams, "2018-03-02 12:00:00")]))
    counted = {r.player_id: r.matches_played for r in lineup.match_counts(lineup.appearances(parsed)).collect()}
    assert counted == {1: 2, 3: 2}


@pytest.mark.parametrize("mine, other, expected", [(3.0, 2.0, 70.0), (9.0, 1.0, 130.0), (1.0, 9.0, -30.0), (0.0, 0.0, None)])
def test_win_chance(spark, mine, other, expected):
    value = spark.createDataFrame([(mine, other)], "a DOUBLE, b DOUBLE").selectExpr(
        f"{formulas.win_chance('a', 'b')} AS c"
    ).first().c
    assert value == (None if expected is None else pytest.approx(expected))


@pytest.mark.parametrize(
    "gk, df, md, fw, valid",
    [(1, 4, 4, 2, True), (1, 3, 2, 5, True), (2, 4, 4, 1, False), (0, 4, 4, 3, False),
     (1, 2, 5, 3, False), (1, 8, 1, 1, False), (1, 5, 5, 0, False)],
)
def test_formation(spark, gk, df, md, fw, valid):
    roles = ["GK"] * gk + ["DF"] * df + ["MD"] * md + ["FW"] * fw
    members = spark.createDataFrame([(1, 1, r) for r in roles], "req_id INT, team INT, role STRING")
    assert prediction.formation_check(members).first().valid is valid


def test_match_summary_lists(spark):
    teams = {
        "20": formation([member(1, goals="2"), member(2, yellow="null")], [member(3, goals="null", own="1", red="70")]),
        "3": formation([member(4), member(5, yellow="33")], [member(6, goals="1", yellow="12")]),
    }
    parsed = line_source.parse_matches(lines(spark, [match(5, teams, date="  2018-03-01 15:00:00", winner=20)]))
    row = summary.match_summaries(parsed).first()
    assert (row.date, row.winner, row.duration, row.venue, row.gameweek) == ("2018-03-01", 20, "Regular", "Ground", 1)
    assert [tuple(g) for g in row.goals] == [(1, 20, 2), (6, 3, 1)]
    assert [tuple(g) for g in row.own_goals] == [(3, 20, 1)]
    assert row.yellow_cards == [6, 5]
    assert row.red_cards == [3]


def test_summary_keeps_one_match_per_date_and_label(spark):
    teams = {"1": formation([member(1)]), "2": formation([member(2)])}
    records = [match(7, teams, label="a"), match(5, teams, label="a"), match(6, teams, label="b")]
    rows = summary.match_summaries(line_source.parse_matches(lines(spark, records))).collect()
    assert sorted((r.label, r.match_id) for r in rows) == [("a", 5), ("b", 6)]


def test_request_routes(spark):
    kinds = [(0,), (1,), (2,), (3,), (4,), (5,), (None,)]
    rows = spark.createDataFrame(kinds, "k INT").select(requests.route(F.col("k")).alias("r"))
    assert [r.r for r in rows.collect()] == ["details", "predict", "profile", "details", "match_rate", None, "details"]
