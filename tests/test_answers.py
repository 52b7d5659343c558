"""Answers to requests, with unknown names and empty lists."""

import json

import pytest
from records import lines, season

from pitchline.operators import answers, prediction
from pitchline.plans.gold import Gold
from pitchline.sources import requests

PLAYERS = "Id BIGINT, name STRING, role STRING, height INT"


def _players(spark):
    return spark.createDataFrame([(i, f"p{i}", "GK" if i in (1, 12) else "DF", 180) for i in range(1, 30)], PLAYERS)


def _requests(spark, swap=False, unknown=False):
    one = ("Reds", [f"p{i}" for i in range(1, 12)])
    two = ("Blues", [f"p{i}" for i in range(12, 22)] + ["nobody" if unknown else "p22"])
    schema = "req_id STRING, team1 STRUCT<name: STRING, players: ARRAY<STRING>>, team2 STRUCT<name: STRING, players: ARRAY<STRING>>"
    return spark.createDataFrame([("r", two, one) if swap else ("r", one, two)], schema)


def _edges(spark):
    return spark.createDataFrame([(1, 2, 0.9), (12, 13, 0.1)], "player_lo BIGINT, player_hi BIGINT, chemistry DOUBLE")


def _ratings(spark):
    return spark.createDataFrame([(i, 0.5 + i / 100) for i in range(2, 23)], "player_id BIGINT, rating DOUBLE")


def _strength(ids, chem, rating):
    total = 0.0
    for p in ids:
        mean = sum(chem.get((min(p, q), max(p, q)), 0.5) for q in ids if q != p) / 10
        total += mean * rating.get(p, 1.0)
    return total


def test_prediction_matches_definition_and_swaps(spark):
    chem = {(1, 2): 0.9, (12, 13): 0.1}
    rating = {i: 0.5 + i / 100 for i in range(2, 23)}
    s1, s2 = _strength(range(1, 12), chem, rating), _strength(range(12, 23), chem, rating)
    expected = (0.5 + (s1 - s2) / (s1 + s2)) * 100
    args = (_players(spark), _ratings(spark), _edges(spark))
    rows = {r.name: r for r in prediction.predict(_requests(spark), *args).collect()}
    assert rows["Reds"].winning_chance == pytest.approx(expected)
    assert rows["Reds"].winning_chance + rows["Blues"].winning_chance == pytest.approx(100)
    assert rows["Reds"].team == 1 and rows["Reds"].valid is False and rows["Reds"].error is None
    swapped = {r.name: r for r in prediction.predict(_requests(spark, swap=True), *args).collect()}
    assert swapped["Reds"].team == 2
    assert swapped["Reds"].winning_chance == pytest.approx(expected)


def test_prediction_with_unknown_player(spark):
    rows = prediction.predict(_requests(spark, unknown=True), _players(spark), _ratings(spark), _edges(spark)).collect()
    assert {(r.team, r.winning_chance, r.error) for r in rows} == {(1, None, "unknown player"), (2, None, "unknown player")}


def test_unrated_factor(spark):
    members = prediction.lineups(_requests(spark), _players(spark))
    none = spark.createDataFrame([], "player_id BIGINT, rating DOUBLE")
    edges = spark.createDataFrame([], "player_lo BIGINT, player_hi BIGINT, chemistry DOUBLE")
    rows = prediction.team_strength(members, edges, none, unrated_factor=0.4).collect()
    assert [r.strength for r in rows] == pytest.approx([11 * 0.5 * 0.4] * 2)


def test_profile_answers(spark):
    profiles = spark.createDataFrame(
        [(1, 2, 3, 1, 0.75, 0.5)],
        "player_id BIGINT, fouls BIGINT, goals BIGINT, own_goals BIGINT, pass_accuracy DOUBLE, shots_target_avg DOUBLE",
    )
    asked = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "nobody")], "req_id INT, name STRING")
    rows = {r.req_id: r for r in answers.profile_answers(asked, _players(spark), profiles).collect()}
    assert (rows[1].Id, rows[1].height, rows[1].percent_pass_accuracy, rows[1].percent_shots_on_target, rows[1].error) == (1, 180, 0.75, 0.5, None)
    assert rows[2].error == "no profile" and rows[3].error == "unknown player"


def test_rating_answers(spark):
    latest = spark.createDataFrame([(1, 0.62)], "player_id BIGINT, match_rating DOUBLE")
    asked = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "nobody")], "req_id INT, name STRING")
    rows = {r.req_id: (r.performance, r.error) for r in answers.rating_answers(asked, _players(spark), latest).collect()}
    assert rows == {1: (pytest.approx(6.2), None), 2: (None, "no match rating"), 3: (None, "unknown player")}


def test_match_answers(spark):
    scorer = "ARRAY<STRUCT<player_id: BIGINT, team_id: BIGINT, goals: INT>>"
    summaries = spark.createDataFrame(
        [
            ("2018-03-01", "a", 5, "Regular", 7, "Ground", 1, [(2, 7, 1), (1, 7, 2)], [], [3], [2, 1]),
            ("2018-03-02", "b", 6, "Regular", 0, "Ground", 1, [], [], [], []),
        ],
        "date STRING, label STRING, match_id BIGINT, duration STRING, winner BIGINT, venue STRING, gameweek INT, "
        f"goals {scorer}, own_goals {scorer}, yellow_cards ARRAY<BIGINT>, red_cards ARRAY<BIGINT>",
    )
    teams = spark.createDataFrame([(7, "Reds"), (0, "nobody")], "Id BIGINT, name STRING")
    asked = spark.createDataFrame(
        [(1, "2018-03-01", "a"), (2, "2018-03-02", "b"), (3, "2018-03-02", "a"), (4, "2018-03-01", "a")],
        "req_id INT, date STRING, label STRING",
    )
    rows = {r.req_id: r for r in answers.match_answers(asked, summaries, _players(spark), teams).collect()}
    assert [tuple(g) for g in rows[1].goals] == [("p2", "Reds", 1), ("p1", "Reds", 2)]
    assert (rows[1].winner, rows[1].yellow_cards, rows[1].red_cards, rows[1].duration) == ("Reds", ["p3"], ["p2", "p1"], "Regular")
    assert rows[4].goals == rows[1].goals
    assert (rows[2].winner, rows[2].goals, rows[2].own_goals, rows[2].yellow_cards, rows[2].error) == (None, [], [], [], None)
    assert rows[3].error == "unknown match"


def test_mixed_requests_over_a_season(spark):
    gold = Gold.from_lines(lines(spark, season(days=3)))
    ids = [t * 10 + i for t in (1, 2, 3, 4) for i in range(1, 7)]
    players = spark.createDataFrame([(i, f"p{i}", "DF") for i in ids], "Id BIGINT, name STRING, role STRING")
    teams = spark.createDataFrame([(t, f"t{t}") for t in (1, 2, 3, 4)], "Id BIGINT, name STRING")
    side = lambda name, part: {"name": name, **{f"player{i + 1}": f"p{p}" for i, p in enumerate(part)}}
    documents = [
        {"req_type": 1, "team1": side("t1", ids[:11]), "team2": side("t2", ids[11:22])},
        {"req_type": 2, "name": "p12"},
        {"req_type": 4, "name": "p12"},
        {"req_type": 3, "date": "2018-03-01", "label": "match 100"},
        {"req_type": 9, "name": "p12"},
    ]
    asked = requests.parse_requests(
        spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "req_id INT, value STRING")
    )
    got = {kind: df.collect() for kind, df in gold.answer(asked, players, teams).items()}
    assert sum(r.winning_chance for r in got["predict"]) == pytest.approx(100)
    assert [(r.req_id, r.Id, r.error) for r in got["profile"]] == [(1, 12, None)]
    last = gold.latest_ratings.where("player_id = 12").first()
    assert [(r.req_id, r.performance) for r in got["match_rate"]] == [(2, pytest.approx(10 * last.match_rating))]
    assert [(r.req_id, r.venue, r.error) for r in got["details"]] == [(3, "Ground", None)]


def test_rating_and_pairing_the_requested_players_alone(spark):
    """What is computed for some players equals their part of everything."""
    whole = Gold.from_lines(lines(spark, season(days=4)))
    some = [11, 12, 13, 21, 22, 31]
    part = whole.among(spark.createDataFrame([(p,) for p in [*some, 999, None]], "player_id BIGINT"))
    wanted = ", ".join(map(str, some))

    def rows(df):
        return sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)

    assert rows(part.latest_ratings) == rows(whole.latest_ratings.where(f"player_id IN ({wanted})")) != []
    assert rows(part.chemistry) == rows(whole.chemistry.where(f"player_lo IN ({wanted}) AND player_hi IN ({wanted})")) != []
    assert {r.player_id for r in part.participations.select("player_id").distinct().collect()} == set(some)
