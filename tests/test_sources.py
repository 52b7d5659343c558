"""Routing, parsing, dimensions, requests and stored results."""

import json
import random

from records import event, formation, lines, match, member

from pitchline.operators.stats import count_by_player
from pitchline.operators.facts import event_facts
from pitchline.sources import catalog, dimensions, requests
from pitchline.sources import lines as line_source

BOTH = '{"wyId":1,"eventId":8,"playerId":3,"matchId":1,"tags":[]}'


# Text after a valid object, which JSON functions accept.
AFTER = ['{"eventId":8,"id":1} trailing', '{"eventId":8}{"eventId":9}', '{"wyId":8},{"wyId":9}', '{"eventId":8},']


def _values(df):
    return sorted(r.value for r in df.collect())


def test_routing(spark):
    texts = [
        '{"wyId":1}', '{"eventId":8}', '{"wyId":null}', BOTH, "[1,2]", '[{"eventId":8}]', "junk{",
        '{"eventId":8,', '{"a":{"wyId":1,"eventId":2}}', '{"wy\\u0049d":3}', '{"eventId":null}', "5", "", *AFTER,
    ]
    routed = line_source.route_records(lines(spark, texts))
    assert _values(routed.matches) == sorted(['{"wyId":1}', '{"wyId":null}', BOTH, '{"wy\\u0049d":3}'])
    assert _values(routed.events) == sorted(['{"eventId":8}', BOTH, '{"eventId":null}'])
    assert _values(routed.dead_letters) == sorted(["[1,2]", '[{"eventId":8}]', "junk{", '{"eventId":8,', "5", "", *AFTER])
    split = line_source.split_by_kind(lines(spark, texts))
    assert [_values(a) for a in split] == [_values(a) for a in routed]


def _kinds(text):
    """Kinds of a line by the standard parser, where both agree on what is JSON."""
    try:
        value = json.loads(text, parse_constant=lambda name: {}[name])
    except (ValueError, KeyError):
        return {"dead"}
    if not isinstance(value, dict):
        return {"dead"}
    return {kind for kind, key in (("match", "wyId"), ("event", "eventId")) if key in value}


def test_routing_of_broken_lines(spark):
    """Each line goes where the standard parser would send it, broken ones included."""
    r = random.Random(5)
    good = [
        BOTH, '{"eventId":null}', '{"wyId":{"a":1,"a":2}}', '{"eventId":1,"wyId":{"b":[1],"b":2}}', '{"eventId":1,"eventId":2}',
        '{"b":1,"b":2,"wyId":1}', '{"x":{"eventId":1}}', '{"x":"wyId"}', '{"eventId":1,"x":"\\u00e9 wyId"}', '{"eventId":1e999}',
        '{"eventId":NaN}', '{"wyId":1,"x":NaN}', ' {"eventId" : [1, {"wyId": 2}] } ', '{"eventId":' + "9" * 400 + "}", '{"\\u0077yId":1,"eventId":2}',
    ]
    texts = list(good)
    for _ in range(400):
        t = r.choice(good)
        k = r.randrange(len(t))
        texts.append(r.choice([t[:k] + t[k + 1 :], t[:k] + r.choice('{}[],:"1 ') + t[k:], t[:k]]))
    # A bracket that closes the array early is not seen by either rule.
    texts = sorted({t for t in texts if "]" not in t[t.rfind("}") + 1 :]})
    split = line_source.split_by_kind(lines(spark, texts))
    found = {t: set() for t in texts}
    for kind, part in zip(("match", "event", "dead"), split, strict=True):
        for value in _values(part):
            found[value].add(kind)
    assert {t: k for t, k in found.items() if k != _kinds(t)} == {}
    routed = line_source.route_records(lines(spark, texts))
    assert [_values(a) for a in split] == [_values(a) for a in routed]


def test_one_pass_reading_equals_route_then_parse(spark):
    texts = [
        BOTH, '{"eventId":8}', '{"wyId":1}', '{"eventId":null,"playerId":4}', '[{"eventId":8}]', "junk{",
        *AFTER, '{"eventId":"x","playerId":5}', '{"event\\u0049d":8,"id":9}', json.dumps(event(10, [101, 1801])),
    ]
    source = lines(spark, texts)
    one = line_source.read_events(source).collect()
    two = line_source.parse_events(line_source.route_records(source).events).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
    assert len(one) == 6


def test_unread_fields_are_kept_on_request(spark):
    row = line_source.read_events(lines(spark, [event(8, [1801])]), keep_unread=True).first()
    assert (row.event_name, row.sub_event_name, row.positions[0].x, row.period) == ("x", "y", 2, "1H")


def test_sub_event_that_is_no_number(spark):
    assert line_source.read_events(lines(spark, [event(3, sub="")])).first().sub_event is None


def test_match_parsing_keeps_team_order_and_null_substitutions(spark):
    subs = [{"playerIn": 8, "playerOut": 1, "minute": 60}]
    teams = {"20": formation([member(1)], [member(8)], subs), "3": formation([member(2)])}
    parsed = line_source.parse_matches(lines(spark, [match(5, teams, date="bad date")]))
    assert [(r.team_pos, r.team_id) for r in line_source.match_team_ids(parsed).collect()] == [(0, 20), (1, 3)]
    row = parsed.first()
    assert [tuple(s) for s in row.teams[0].substitutions] == [(8, 1, 60)]
    assert row.teams[1].substitutions is None
    assert row.kickoff is None and str(row.match_day) == line_source.UNDATED


def test_first_record_of_a_match(spark):
    teams = {"1": formation([member(1)]), "2": formation([member(2)])}
    once = lines(spark, [match(5, teams), match(6, teams)])
    parsed = line_source.parse_matches(once.unionByName(once))
    assert sorted(r.match_id for r in line_source.first_match_records(parsed).collect()) == [5, 6]


def test_event_time(spark):
    teams = {"1": formation([member(1)]), "2": formation([member(2)])}
    source = lines(spark, [match(5, teams), event(8, matchPeriod="2H", eventSec=1.5), event(8, match=99)])
    timed = line_source.with_event_time(
        line_source.read_events(source), line_source.parse_matches(line_source.route_records(source).matches)
    ).collect()
    assert [str(r.event_ts) for r in timed] == ["2018-03-01 16:00:01.500000"]


def test_seconds_beyond_all_time(spark):
    teams = {"1": formation([member(1)]), "2": formation([member(2)])}
    source = lines(spark, [match(5, teams), event(8, eventSec=1e300), event(8, eventSec=1e17), event(8, eventSec=2.0)])
    events, matches = line_source.read_events(source), line_source.parse_matches(line_source.route_records(source).matches)
    assert sorted(str(r.event_ts) for r in line_source.with_event_time(events, matches).collect()) == ["2018-03-01 15:00:02", "None", "None"]
    assert line_source.match_spans(events, matches).first().events == 3


def test_records_without_an_id_are_kept_apart(spark):
    teams = {"1": formation([member(1)]), "2": formation([member(2)])}
    parsed = line_source.parse_matches(lines(spark, [match(None, teams, label="a"), match(None, teams, label="b"), match(5, teams), match(5, teams)]))
    assert line_source.first_match_records(parsed).count() == 3


def test_dimensions(spark, tmp_path):
    (tmp_path / "players.csv").write_text("Id,name,role\n2,Ann,GK\n1,Ann,DF\n3,Bo,FW\n")
    (tmp_path / "teams.csv").write_text("name,Id\nReds,7\n")
    players = dimensions.read_players(spark, str(tmp_path / "players.csv"))
    assert {(r.name, r.Id, r.role) for r in dimensions.players_by_name(players).collect()} == {("Ann", 1, "DF"), ("Bo", 3, "FW")}
    assert dimensions.distinct_player_ids(players).count() == 3
    assert [tuple(r) for r in dimensions.read_teams(spark, str(tmp_path / "teams.csv")).collect()] == [("Reds", 7)]


def test_request_files(spark, tmp_path):
    side = {"name": "Reds", **{f"player{i}": f"p{i}" for i in range(1, 12)}}
    documents = {
        "a.json": {"req_type": 1, "team1": side, "team2": side},
        "b.json": {"req_type": 2, "name": "Ann"},
        "c.json": {"date": "2018-03-01", "label": "x"},
    }
    for name, body in documents.items():
        (tmp_path / name).write_text(json.dumps(body, indent=2))
    rows = requests.read_requests(spark, str(tmp_path))
    base = f"file:{tmp_path}/"
    assert {r.req_id for r in requests.routed(rows, "predict").collect()} == {base + "a.json"}
    assert requests.routed(rows, "predict").first().team1.players == [f"p{i}" for i in range(1, 12)]
    assert {r.req_id for r in requests.routed(rows, "profile").collect()} == {base + "b.json"}
    assert {r.req_id for r in requests.routed(rows, "details").collect()} == {base + "c.json"}


def test_documents_that_are_no_requests(spark, tmp_path):
    """Such a document is told apart from a request for an unknown match; other requests are answered."""
    texts = {1: "junk", 2: '{"req_type": 2, "name": "Ann"', 3: "", 4: None, 5: '"text"', 6: '{"req_type": 2, "name": "Ann"}', 7: "{}"}
    rows = requests.parse_requests(spark.createDataFrame(list(texts.items()), "req_id INT, value STRING"))
    assert {r.req_id: r.document for r in requests.rejected(rows).collect()} == {k: texts[k] or "" for k in range(1, 6)}
    assert [r.req_id for r in requests.routed(rows, "profile").collect()] == [6]
    assert [r.req_id for r in requests.routed(rows, "details").collect()] == [7]
    (tmp_path / "a.json").write_text('{"req_type": 2,\n')
    (tmp_path / "b.json").write_text('{"req_type": 2,\n "name": "Ann"}')
    read = requests.read_requests(spark, str(tmp_path))
    assert [r.req_id.rsplit("/", 1)[1] for r in requests.rejected(read).collect()] == ["a.json"]
    assert [r.name for r in requests.routed(read, "profile").collect()] == ["Ann"]


def test_dimension_rows_without_a_number(spark, tmp_path):
    (tmp_path / "players.csv").write_text("Id,name,role\nx2,Ann,GK\n1,Ann,DF\n,Bo,FW\n")
    path = str(tmp_path / "players.csv")
    assert [(r.Id, r.name) for r in dimensions.read_players(spark, path).collect()] == [(1, "Ann")]
    assert [(r.Id, r.name, r.role) for r in dimensions.rejected_rows(spark, path).collect()] == [("x2", "Ann", "GK"), (None, "Bo", "FW")]


def test_snapshots_and_responses(spark, tmp_path):
    store = catalog.Catalog(spark, str(tmp_path))
    store.publish({"rating": spark.range(3), "other": spark.range(1)}, 1)
    store.publish({"rating": spark.range(5)}, 2)
    assert store.read_snapshot("rating", "id BIGINT").count() == 5
    assert store.read_snapshot("other").count() == 1
    store.publish({"rating": spark.range(6)}, 3, "json")
    assert store.read_snapshot("rating", "id BIGINT").count() == 6
    assert len(list((tmp_path / "snapshot" / "data").iterdir())) == 2
    catalog.write_response(spark.range(2), str(tmp_path / "answer"))
    assert spark.read.schema("id BIGINT").json(str(tmp_path / "answer")).count() == 2


def test_player_without_counted_events_has_a_row(spark):
    source = lines(spark, [event(7, player=4), event(8, [1801], player=5), event(8, [1801], player=5, team=9, number=2)])
    counted = {r.player_id: r for r in count_by_player(event_facts(line_source.read_events(source))).collect()}
    assert counted[4].acc_pass == 0
    assert (counted[5].acc_pass, counted[5].team_id) == (2, 9)


def test_published_results_are_looked_up_by_key(spark, tmp_path):
    store = catalog.Catalog(spark, str(tmp_path / "store"))
    played = spark.range(2000).selectExpr("concat('2024-', id % 50) AS date", "concat('match ', id) AS label", "id AS gameweek")
    store.publish({"match_summary": played, "player_profile": spark.range(100).selectExpr("id AS player_id", "id AS goals")}, 1)
    assert store.read_snapshot("match_summary").columns == played.columns
    assert store.read_snapshot("match_summary").count() == 2000
    documents = spark.createDataFrame(
        [("a", '{"req_type":3,"date":"2024-7","label":"match 57"}'), ("b", '{"req_type":3,"date":"2024-8","label":"none"}'), ("c", "junk")],
        "req_id string, value string",
    )
    documents.write.parquet(str(tmp_path / "asked"))
    asked = requests.routed(requests.parse_requests(spark.read.parquet(str(tmp_path / "asked"))), "details").select("date", "label")
    rows = store.look_up("match_summary", asked)
    met = rows.collect()
    assert len(met) < 2000 / 4 and len({r.label for r in met}) == len(met)
    assert rows.join(asked, ["date", "label"]).collect()[0].gameweek == 57
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
    # Keys of another type than the published ones find their bucket too.
    ids = spark.createDataFrame([(7,)], "Id int")
    assert 7 in {r.player_id for r in store.look_up("player_profile", ids).collect()}
    assert store.look_up("match_summary", asked.where("false")).count() == 0
