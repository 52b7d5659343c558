"""The streaming pipeline gives what the batch composition gives."""

import json
import random

import pytest
from records import lines, season

from pitchline.operators import intervals
from pitchline.plans.gold import Gold
from pitchline.sources import lines as line_source
from pitchline.sources.catalog import TABLES, Catalog
from pitchline.sources.lines import stream_lines
from pitchline.sources.store import Files, Transaction
from pitchline.streaming import driver, stateful

KEYS = {
    "rating_history": ["match_id", "player_id"],
    "latest_ratings": ["player_id"],
    "match_counts": ["player_id"],
    "player_profiles": ["player_id"],
    "edges": ["player_lo", "player_hi"],
    "match_summaries": ["date", "label"],
}


def _table(df, keys):
    names = [c for c in sorted(df.columns) if c not in keys]
    return {tuple(r[k] for k in keys): [r[c] for c in names] for r in df.select(*keys, *names).collect()}


def _same(one, two):
    assert one.keys() == two.keys()
    for key, values in one.items():
        for a, b in zip(values, two[key]):
            assert a == (pytest.approx(b, abs=1e-9) if isinstance(b, float) else b), key


def _expected(spark, records):
    gold = Gold.from_lines(lines(spark, records))
    history = gold.rating_history
    return {
        "rating_history": _table(history.drop("chunk"), KEYS["rating_history"]),
        "latest_ratings": _table(gold.latest_ratings, KEYS["latest_ratings"]),
        "match_counts": _table(gold.match_counts, KEYS["match_counts"]),
        "player_profiles": _table(gold.player_profiles, KEYS["player_profiles"]),
        "edges": _table(gold.chemistry, KEYS["edges"]),
        "match_summaries": _table(gold.match_summaries, KEYS["match_summaries"]),
    }


def _check(catalog, expected):
    for name, keys in KEYS.items():
        _same(_table(getattr(driver, name)(catalog), keys), expected[name])


def _write(folder, number, records):
    folder.mkdir(exist_ok=True)
    (folder / f"part-{number:03d}.txt").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def _run(spark, folder, catalog):
    query = driver.run_stream(stream_lines(spark, str(folder), 1), catalog, available_now=True)
    query.awaitTermination()
    assert query.exception() is None
    return query


@pytest.mark.parametrize("batches, shuffled", [(2, True), (3, False)])
def test_stream_equals_batch(spark, tmp_path, batches, shuffled):
    records = season(days=4)
    if shuffled:
        random.Random(5).shuffle(records)
    cuts = sorted(random.Random(batches).sample(range(1, len(records)), batches - 1))
    for i, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(records)])):
        _write(tmp_path / "in", i, records[lo:hi] + (["junk{"] if i == 0 else []))
    catalog = Catalog(spark, str(tmp_path / "store"))
    _run(spark, tmp_path / "in", catalog)
    _check(catalog, _expected(spark, records))
    assert [r.value for r in catalog.read("dead_letter").collect()] == ["junk{"]


def test_restart_repeat_and_late_match(spark, tmp_path):
    records = season(days=4)
    late = [r for r in records if r.get("matchId", r.get("wyId")) == 200]
    rest = [r for r in records if r not in late]
    catalog = Catalog(spark, str(tmp_path / "store"))
    _write(tmp_path / "in", 0, rest)
    _run(spark, tmp_path / "in", catalog)
    _check(catalog, _expected(spark, rest))
    # The same checkpoint goes on with a match of an earlier day.
    _write(tmp_path / "in", 1, late)
    _run(spark, tmp_path / "in", catalog)
    expected = _expected(spark, records)
    _check(catalog, expected)
    # A micro-batch repeated after a failure changes nothing.
    driver.process_batch(catalog, lines(spark, late), 1)
    _check(catalog, expected)


def test_differing_versions_of_a_record_in_both_orders(spark, tmp_path):
    """Batch and stream prefer the same version, and a moved match leaves its old day."""
    records = season(days=3)
    changed = json.loads(json.dumps(next(r for r in records if r.get("wyId") == 201)))
    changed["dateutc"] = "2018-03-09 12:00:00"
    changed["label"] = "moved"
    expected = _expected(spark, [*records, changed])
    for name, parts in (("first", ([*records], [changed])), ("last", ([changed], [*records]))):
        catalog = driver.open_catalog(spark, str(tmp_path / name))
        for number, part in enumerate(parts):
            driver.process_batch(catalog, lines(spark, part), number)
        _check(catalog, expected)


def test_a_record_that_moves_its_match_keeps_all_counters(spark, tmp_path):
    """Events before and after a version of another day, then another match between the two days."""
    records = season(days=3)
    of_match = [r for r in records if r.get("matchId") == 201]
    first = json.loads(json.dumps(next(r for r in records if r.get("wyId") == 201)))
    between = json.loads(json.dumps(next(r for r in records if r.get("wyId") == 301)))
    rest = [r for r in records if r.get("matchId", r.get("wyId")) not in (201, 301)]
    first["dateutc"], between["dateutc"] = "2018-03-09 12:00:00", "2018-03-05 12:00:00"
    moved = {**first, "dateutc": "2018-03-02 12:00:00"}
    for number in range(20):  # a label under which the first version stays preferred
        moved["label"] = f"moved {number}"
        both = line_source.preferred_records(line_source.parse_matches(lines(spark, [first, moved])))
        if str(both.first().match_day) == "2018-03-09":
            break
    parts = [rest + [first] + of_match[::2], [moved], of_match[1::2], [between] + [r for r in records if r.get("matchId") == 301]]
    catalog = driver.open_catalog(spark, str(tmp_path))
    for number, part in enumerate(parts):
        driver.process_batch(catalog, lines(spark, part), number)
    _check(catalog, _expected(spark, [r for part in parts for r in part]))


def test_counters_wait_for_their_record(spark, tmp_path):
    records = season(days=3)
    record = next(r for r in records if r.get("wyId") == 101)
    catalog = driver.open_catalog(spark, str(tmp_path))
    driver.process_batch(catalog, lines(spark, [r for r in records if r is not record]), 0)
    before = {name: catalog.store.snapshot().runs(name) for name in ("player_count", "played", "pair_node")}
    driver.process_batch(catalog, lines(spark, [record]), 1)
    driver.process_batch(catalog, lines(spark, ["junk"]), 2)
    for name, runs in before.items():
        assert catalog.store.snapshot().runs(name)[: len(runs)] == runs
    _check(catalog, _expected(spark, records))


def _written(catalog, name, batch):
    return catalog.store.snapshot().rows(name).where(f"batch_id = {batch}")


def test_a_late_match_touches_its_own_players_alone(spark, tmp_path):
    records = season(days=6)
    late = [r for r in records if r.get("matchId", r.get("wyId")) == 200]
    catalog = driver.open_catalog(spark, str(tmp_path))
    driver.process_batch(catalog, lines(spark, [r for r in records if r not in late]), 0)
    driver.process_batch(catalog, lines(spark, late), 1)
    _check(catalog, _expected(spark, records))
    mine = {r.player_id for r in _written(catalog, "played", 1).where("match_id = 200").collect()}
    rewritten = _written(catalog, "played", 1).collect()
    assert {r.player_id for r in rewritten} == mine and min(str(r.match_day) for r in rewritten) == "2018-03-02"
    assert {r.player_id for r in _written(catalog, "standing", 1).collect()} == mine
    pairs = _written(catalog, "pair_node", 1)
    assert pairs.where(f"player_lo NOT IN ({', '.join(map(str, mine))}) AND player_hi NOT IN ({', '.join(map(str, mine))})").isEmpty()


def test_a_new_day_writes_a_handful_of_nodes(spark, tmp_path):
    """In order, what is written does not depend on how much is stored."""
    catalog = driver.open_catalog(spark, str(tmp_path))
    records = season(days=7)
    written = []
    for number, days in enumerate([range(1, 6), [6], [7]]):
        part = [r for r in records if r.get("matchId", r.get("wyId")) // 100 in days]
        driver.process_batch(catalog, lines(spark, part), number)
        written.append({name: _written(catalog, name, number).count() for name in ("played", "standing", "pair_node")})
        players = _written(catalog, "played", number).select("player_id").distinct().count()
        assert written[-1]["standing"] <= players * (intervals.LEVELS + (len(days) - 1) * 2)
    assert written[1]["played"] < 30 and written[2]["played"] < 30
    for name in ("standing", "pair_node"):
        level_rows = _written(catalog, name, 2).groupBy("level").count().collect()
        assert sorted(r.level for r in level_rows) == list(range(intervals.LEVELS)) and len({r["count"] for r in level_rows}) == 1
    _check(catalog, _expected(spark, records))


class _Stop(Exception):
    pass


def test_a_failure_between_any_two_writes_leaves_the_tables_as_they_were(spark, tmp_path, monkeypatch):
    records = season(days=2)
    last = [r for r in records if r.get("matchId", r.get("wyId")) == 201]
    catalog = driver.open_catalog(spark, str(tmp_path))
    driver.process_batch(catalog, lines(spark, [r for r in records if r not in last]), 0)
    before, counted = catalog.store.snapshot().manifest, catalog.read("player_count").count()
    write, publish = Transaction.write, Files.publish
    done = 0

    def failing(limit):
        def run(self, *args, **kwargs):
            nonlocal done
            if done == limit:
                raise _Stop
            done += 1
            return write(self, *args, **kwargs)

        return run

    for limit in range(20):
        done = 0
        monkeypatch.setattr(Transaction, "write", failing(limit))
        try:
            with monkeypatch.context() as m:
                m.setattr(Files, "publish", lambda *a: (_ for _ in ()).throw(_Stop()))
                driver.process_batch(catalog, lines(spark, last), 1)
        except _Stop:
            pass
        assert catalog.store.snapshot().manifest == before and catalog.read("player_count").count() == counted
        if done < limit:
            break  # all writes were made and the commit failed
    assert limit > 6
    monkeypatch.setattr(Transaction, "write", write)
    assert Files.publish is publish
    driver.process_batch(catalog, lines(spark, last), 1)
    _check(catalog, _expected(spark, records))
    # What the failed attempts wrote is gone with the commit.
    for name in TABLES:
        named = {f"run={r['name']}" for m in (catalog.store.snapshot().manifest, before) for r in m["tables"].get(name, [])}
        folder = tmp_path / "tables" / "data" / name
        assert not folder.exists() or {f.name for f in folder.iterdir() if f.is_dir()} <= named


def test_runs_are_merged_level_by_level(spark, tmp_path):
    records = season(days=5, matches=1)
    random.Random(3).shuffle(records)
    catalog = Catalog(spark, str(tmp_path), fan=2)
    for number in range(6):
        driver.process_batch(catalog, lines(spark, records[number::6]), number)
    runs = catalog.store.snapshot().manifest["tables"]
    assert all(len(r) <= 3 for r in runs.values()) and max(r["level"] for r in runs["player_count"]) == 2
    _check(catalog, _expected(spark, records))


def test_records_without_an_id_and_players_listed_twice(spark, tmp_path):
    records = season(days=2)
    nameless = json.loads(json.dumps(next(r for r in records if r.get("wyId") == 101)))
    nameless["wyId"] = None
    twice = next(r for r in records if r.get("wyId") == 200)
    team = next(iter(twice["teamsData"].values()))["formation"]
    team["lineup"].append(team["lineup"][1])
    records += [nameless, json.loads(json.dumps(nameless))]
    catalog = driver.open_catalog(spark, str(tmp_path))
    for number, part in enumerate((records[:40], records[40:])):
        driver.process_batch(catalog, lines(spark, part), number)
    expected = {r.player_id: r.matches_played for r in Gold.from_lines(lines(spark, records)).match_counts.collect()}
    assert {r.player_id: r.matches_played for r in driver.match_counts(catalog).collect()} == expected


def test_counters_in_the_state_store(spark, tmp_path):
    """A match over midnight is one, late events count, and the log shrinks to the current rows."""
    rows = [
        [(1, "2024-01-10 23:50:00"), (2, "2024-01-10 10:00:00")],
        [(1, "2024-01-11 00:05:00"), (3, "2024-01-11 09:00:00")],
        [(1, "2024-01-10 23:55:00"), (4, "2024-01-01 09:00:00")],
    ]
    schema = "event_id BIGINT, event_ts TIMESTAMP, match_id BIGINT, team_id BIGINT, player_id BIGINT, event_code INT, sub_event INT, tag_ids ARRAY<INT>"
    for number, part in enumerate(rows):
        values = ", ".join(f"({10 * number + k}L, TIMESTAMP'{ts}', {m}L, 2L, 11L, 2, 30, CAST(array() AS ARRAY<INT>))" for k, (m, ts) in enumerate(part))
        spark.sql(f"SELECT * FROM VALUES {values} AS t(event_id, event_ts, match_id, team_id, player_id, event_code, sub_event, tag_ids)").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counters = stateful.running_counters(stream)
    stateful.start_updates(counters, str(tmp_path / "out")).awaitTermination()
    for _ in range(2):
        found = stateful.current_rows(spark, str(tmp_path / "out"), counters.schema, ["match_id", "player_id"])
        assert {r.match_id: r.fouls for r in found.collect()} == {1: 3, 2: 1, 3: 1, 4: 1}
        stateful.compact(spark, str(tmp_path / "out"), counters.schema, ["match_id", "player_id"])
    assert len(list((tmp_path / "out" / "rows").glob("batch_id=*"))) == 1


def test_published_snapshots(spark, tmp_path):
    records = season(days=2)
    catalog = driver.open_catalog(spark, str(tmp_path))
    driver.process_batch(catalog, lines(spark, records), 0)
    driver.publish(catalog, 0)
    for name, result in driver.RESULTS.items():
        live = result(catalog)
        assert catalog.read_snapshot(name).count() == live.count() > 0
