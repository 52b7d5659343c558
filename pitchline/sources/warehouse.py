"""Domain tables derived from warehouse tables.

Users play the players (user 0 the "no player" sentinel), 22 users of adjacent
ids form the squads of a match per day, customers supply names and roles,
nations the team names. Every value is a deterministic expression of the input
rows, so the same tables can be derived by any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.operators.facts import event_facts
from pitchline.operators.stats import count_by_player

FIRST_DAY = "2024-01-01"
SQUADS = 22
TEAM = 11
TEAMS = 20
# Match id = day * DAY_BASE + bucket; leaves room for 22 billion users.
DAY_BASE = 1_000_000_000

# Matches of these days have a date but no readable time.
UNTIMED = f"match_id div {DAY_BASE} % 6 = 4"

EVENT_CODES = {"click": 8, "view": 1, "purchase": 10, "error": 2, "signup": 3}


_SCHEMAS: dict[str, T.StructType] = {}


def schema(spark: SparkSession, sf_dir: str, name: str) -> T.StructType:
    """Schema of a table, read from its files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return _SCHEMAS[path]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schema(spark, sf_dir, name)).parquet(f"{sf_dir}/{name}.parquet")


def _team_of(half_bucket: str) -> str:
    return f"1 + ({half_bucket}) % {TEAMS}"


_TAG_RULES = {
    1801: "k < 60",
    1802: "k >= 60 AND k < 97",
    302: "k % 7 = 0",
    701: "k % 3 = 0",
    702: "k % 3 = 1",
    703: "k % 3 = 2",
    101: "k % 11 = 0",
    102: "k % 53 = 0",
}


def events(raw: DataFrame) -> DataFrame:
    """Typed event rows; ``raw`` may be a stream."""
    base = raw.selectExpr(
        "event_id",
        "make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), extract(SECOND FROM ts), 'UTC') AS event_ts",
        "user_id",
        "event_type",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        f"CAST(datediff(CAST(ts AS DATE), DATE '{FIRST_DAY}') AS BIGINT) AS day",
    )
    codes = " ".join(f"WHEN '{name}' THEN {code}" for name, code in EVENT_CODES.items())
    tags = ", ".join(f"if({rule}, {tag}, 0)" for tag, rule in _TAG_RULES.items())
    return base.selectExpr(
        "event_id",
        f"day * {DAY_BASE} + user_id div {SQUADS} AS match_id",
        f"{_team_of(f'user_id div {TEAM}')} AS team_id",
        "user_id AS player_id",
        f"CASE event_type {codes} END AS event_code",
        "if(k % 5 = 0, 35, 30) AS sub_event",
        f"array_remove(array({tags}), 0) AS tag_ids",
        "event_ts",
        "day",
    )


def event_line(df: DataFrame) -> DataFrame:
    """The event rows as JSON lines."""
    return df.selectExpr(
        """to_json(named_struct(
            'eventId', event_code,
            'subEventId', string(sub_event),
            'tags', transform(tag_ids, t -> named_struct('id', t)),
            'playerId', player_id, 'matchId', match_id, 'teamId', team_id, 'id', event_id,
            'eventSec', (unix_micros(event_ts) % 2700000000) / 1e6D,
            'matchPeriod', if(unix_micros(event_ts) div 3600000000 % 24 < 12, '1H', '2H'))) AS value"""
    )


def day_of(match_id: str) -> str:
    """Day of a match of these tables, as an SQL expression."""
    return f"date_add(DATE '{FIRST_DAY}', int({match_id} div {DAY_BASE}))"


def counts(raw: DataFrame) -> DataFrame:
    """Counters per (match, player), sentinel included; the squads need it."""
    return count_by_player(event_facts(events(raw)))


def _member(x: str) -> str:
    """Squad entry of ``x`` = (player, counters of the match or NULL)."""
    slot = f"{x}.player % {TEAM}"
    fouls = f"coalesce({x}.counted.fouls, 0)"

    def text(counter: str) -> str:
        value = f"coalesce({x}.counted.{counter}, 0)"
        return f"if({slot} = 9 AND {value} = 0, 'null', string({value}))"

    return (
        f"named_struct('playerId', {x}.player, 'goals', {text('goal')}, 'ownGoals', {text('own_goal')},"
        f" 'yellowCards', CASE WHEN {slot} = 10 THEN 'null' WHEN {fouls} >= 2 THEN string(30 + {fouls}) ELSE '0' END,"
        f" 'redCards', if({fouls} >= 4, '80', '0'))"
    )


def _team(pos: int) -> str:
    first = f"(bucket * {SQUADS} + {pos * TEAM})"
    team_id = _team_of(f"2 * bucket + {pos}")
    minute = f"46 + (day + {team_id}) % 39"

    def members(slots: str) -> str:
        listed = f"filter(squad, p -> (p div {TEAM}) % 2 = {pos} AND p % {TEAM} {slots})"
        return f"transform(transform({listed}, p -> struct(p AS player, c[p] AS counted)), x -> {_member('x')})"

    def substitution(bench: int, lineup: int, later: int) -> str:
        there = f"array_contains(squad, {first} + {bench}) AND array_contains(squad, {first} + {lineup})"
        return (
            f"if({there}, named_struct('playerIn', {first} + {bench}, 'playerOut', {first} + {lineup},"
            f" 'minute', int({minute} + {later})), NULL)"
        )

    substitutions = f"filter(array({substitution(8, 0, 0)}, {substitution(9, 1, 5)}), s -> s IS NOT NULL)"
    return (
        f"named_struct('team_pos', {pos}, 'team_id', {team_id},"
        f" 'substitutions', if(day % 7 = 3, NULL, {substitutions}),"
        f" 'lineup', {members('<= 7')}, 'bench', {members('>= 8')})"
    )


def matches(counted: DataFrame) -> DataFrame:
    """Typed match rows from the per-player counters.

    Every user of a bucket is listed in every match of that bucket. Both
    aggregates gather at most 22 players by the definition of a bucket.
    """
    squads = counted.groupBy(F.expr(f"player_id div {SQUADS} AS bucket")).agg(
        F.expr("array_sort(collect_set(player_id)) AS squad")
    )

    def goals(pos: int) -> str:
        return f"coalesce(sum(goal) FILTER (WHERE (player_id div {TEAM}) % 2 = {pos}), 0) AS goals_{pos}"

    played = counted.groupBy("match_id").agg(
        F.expr(
            "map_from_entries(collect_list(struct(player_id, struct(goal, own_goal, fouls)))) AS c"
        ),
        F.expr(goals(0)),
        F.expr(goals(1)),
    )
    games = played.selectExpr(
        "*", f"match_id % {DAY_BASE} AS bucket", f"match_id div {DAY_BASE} AS day",
        f"{day_of('match_id')} AS match_day",
    )
    home, away = _team_of("2 * bucket"), _team_of("2 * bucket + 1")
    return games.join(squads, "bucket").selectExpr(
        "match_id",
        "if(day % 5 <> 0, 'Played', 'Suspended') AS status",
        f"if({UNTIMED}, NULL, timestamp_seconds(bigint(unix_date(match_day)) * 86400 + 15 * 3600)) AS kickoff",
        "match_day",
        "string(match_day) AS date",
        "concat('B', bucket, ' day ', day) AS label",
        "'Regular' AS duration",
        f"CASE WHEN goals_0 > goals_1 THEN {home} WHEN goals_1 > goals_0 THEN {away} ELSE 0 END AS winner",
        f"concat('Ground ', {home}) AS venue",
        "int(day div 7 + 1) AS gameweek",
        f"array({_team(0)}, {_team(1)}) AS teams",
    )


def match_line(typed: DataFrame) -> DataFrame:
    """The match rows as JSON lines; missing substitutions become the string "null"."""

    def record(substitutions: str) -> str:
        formation = f"named_struct('substitutions', {substitutions}, 'lineup', t.lineup, 'bench', t.bench)"
        entry = f"struct(string(t.team_id), named_struct('formation', {formation}))"
        return (
            f"to_json(named_struct('wyId', match_id, 'status', status, 'dateutc', concat(date, if({UNTIMED}, ' 25:61:00', ' 15:00:00')),"
            " 'label', label, 'duration', duration, 'winner', winner, 'venue', venue, 'gameweek', gameweek,"
            f" 'teamsData', map_from_entries(transform(teams, t -> {entry}))))"
        )

    missing = "exists(teams, t -> t.substitutions IS NULL)"
    return typed.selectExpr(f"if({missing}, {record(chr(39) + 'null' + chr(39))}, {record('t.substitutions')}) AS value")


def mixed_lines(raw: DataFrame) -> DataFrame:
    """One line per event: event and match records, records that are both or
    neither, null keys, and lines that are no object or more than one."""
    return raw.selectExpr(
        """CASE WHEN event_id % 97 = 0 THEN concat('junk{', event_id)
                WHEN event_id % 89 = 0 THEN concat('[', event_id, ']')
                WHEN event_id % 83 = 0 THEN concat('{"eventId":8,"id":', event_id)
                WHEN event_id % 79 = 0 THEN concat('{"wyId":null,"label":"', event_id, '"}')
                WHEN event_id % 73 = 0 THEN concat('{"wyId":', event_id, ',"eventId":null,"id":', event_id, '}')
                WHEN event_id % 71 = 0 THEN concat('{"other":{"eventId":1,"wyId":2},"id":', event_id, '}')
                WHEN event_id % 67 = 0 THEN concat('{"eventId":8,"id":', event_id, '} trailing')
                WHEN event_id % 61 = 0 THEN concat('{"eventId":8,"id":', event_id, '}{"eventId":9}')
                WHEN event_id % 59 = 0 THEN concat('{"wyId":', event_id, '},{"wyId":1}')
                WHEN event_id % 11 = 0 THEN concat('{"wyId":', event_id, '}')
                ELSE concat('{"eventId":8,"id":', event_id, '}') END AS value"""
    )


def players(customer: DataFrame) -> DataFrame:
    slot = f"c_custkey % {TEAM}"
    role = f"CASE WHEN {slot} = 0 THEN 'GK' WHEN {slot} <= 4 THEN 'DF' WHEN {slot} <= 8 THEN 'MD' ELSE 'FW' END"
    return customer.selectExpr("c_custkey AS Id", "c_name AS name", f"{role} AS role")


def teams(nation: DataFrame) -> DataFrame:
    return nation.selectExpr("bigint(n_nationkey) AS Id", "n_name AS name")


def prediction_requests(users: DataFrame, player_names: DataFrame, team_names: DataFrame) -> DataFrame:
    """One request per bucket with a full squad of 22 named players."""
    named = users.join(player_names.selectExpr("Id AS player_id", "name"), "player_id")
    squads = named.groupBy(F.expr(f"player_id div {SQUADS} AS req_id")).agg(
        F.expr("array_sort(collect_list(struct(player_id, name))) AS squad")
    )
    full = squads.where(f"size(squad) = {SQUADS}").selectExpr(
        "*", f"{_team_of('2 * req_id')} AS t1", f"{_team_of('2 * req_id + 1')} AS t2"
    )
    for i in (1, 2):
        full = full.join(team_names.selectExpr(f"Id AS t{i}", f"name AS name{i}"), f"t{i}")
    sides = [
        f"named_struct('name', name{i}, 'players', slice(squad.name, {1 + (i - 1) * TEAM}, {TEAM})) AS team{i}"
        for i in (1, 2)
    ]
    return full.selectExpr("req_id", *sides)


def request_documents(users: DataFrame) -> DataFrame:
    """One JSON request per user, cycling through all request types and none."""
    kind = "player_id % 7"
    typed = f"to_json(named_struct('req_type', int({kind}), 'name', concat('n', player_id)))"
    return users.selectExpr(
        "player_id AS req_id", f"if({kind} = 6, to_json(named_struct('label', 'x')), {typed}) AS value"
    )
