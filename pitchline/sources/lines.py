"""Line sources and the routing and parsing of their JSON records.

A line is a match record when its top-level object has the key ``wyId`` (a null
value counts), an event record when it has ``eventId``; it may be both. A line
that is not one JSON object, text after an object included, goes to the dead letters.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline import schemas
from pitchline.settings import scratch_path

# Seconds from kickoff at which each period starts: two halves of 45 minutes
# with a 15-minute break, two extra halves of 15, then the shoot-out.
PERIOD_START = {"1H": 0, "2H": 3600, "E1": 6600, "E2": 7800, "P": 9000}

# Day of a match whose date cannot be read; like its NULL kickoff it sorts first.
UNDATED = "1970-01-01"


class Routed(NamedTuple):
    matches: DataFrame
    events: DataFrame
    dead_letters: DataFrame


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


# The JSON functions stop at the end of a first value and accept what follows;
# as the elements of an array the text must be one value.
_ONE_VALUE = "coalesce(json_array_length(concat('[', value, ']')) = 1, false)"


def _keys(text: Column) -> Column:
    """Keys of a line that is one JSON object, else NULL."""
    one = F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))
    return F.when(one, F.json_object_keys(text))


def _has_key(text: Column, key: str) -> Column:
    # The substring test spares the second parse of nearly all lines; a key
    # written with \u escapes has to be looked at too.
    maybe = text.contains(key) | text.contains("\\u")
    return maybe & F.coalesce(F.array_contains(_keys(text), key), F.lit(False))


def is_match_line(text: Column) -> Column:
    return _has_key(text, "wyId")


def is_event_line(text: Column) -> Column:
    return _has_key(text, "eventId")


def is_dead_line(text: Column) -> Column:
    return _keys(text).isNull()


def route_records(lines: DataFrame) -> Routed:
    text = F.col("value")
    return Routed(
        matches=lines.where(is_match_line(text)),
        events=lines.where(is_event_line(text)),
        dead_letters=lines.where(is_dead_line(text)),
    )


def split_by_kind(lines: DataFrame) -> Routed:
    """The lines by kind, written once as one partition per kind.

    A record that is both a match and an event is in both parts. Every reader then
    scans its own part instead of all text.
    """
    text = F.col("value")
    kinds = F.array(F.when(is_match_line(text), "match"), F.when(is_event_line(text), "event"), F.when(is_dead_line(text), "dead"))
    path = scratch_path(lines.sparkSession, "lines")
    parts = lines.select(F.explode(F.array_compact(kinds)).alias("kind"), "value")
    parts.write.partitionBy("kind").parquet(path)
    stored = lines.sparkSession.read.schema("value STRING, kind STRING").parquet(path)
    return Routed(*(stored.where(F.col("kind") == kind).select("value") for kind in ("match", "event", "dead")))


def _event_columns(keep_unread: bool) -> list[str]:
    columns = [
        "coalesce(r.id, 0L) AS event_id",
        "r.matchId AS match_id",
        "r.teamId AS team_id",
        "r.playerId AS player_id",
        "r.eventId AS event_code",
        "try_cast(r.subEventId AS INT) AS sub_event",
        "r.tags.id AS tag_ids",
        "r.matchPeriod AS period",
        "r.eventSec AS event_sec",
    ]
    if keep_unread:
        columns += ["r.eventName AS event_name", "r.subEventName AS sub_event_name", "r.positions AS positions"]
    return columns


def _event_fields(keep_unread: bool) -> str:
    return schemas.EVENT_FIELDS + (", " + schemas.EVENT_UNREAD_FIELDS if keep_unread else "")


def parse_events(lines: DataFrame, keep_unread: bool = False) -> DataFrame:
    """Typed event rows of lines already routed; ``keep_unread`` adds the fields no operator uses."""
    record = lines.select(F.from_json("value", _event_fields(keep_unread)).alias("r"))
    return record.selectExpr(*_event_columns(keep_unread))


def read_events(lines: DataFrame, keep_unread: bool = False) -> DataFrame:
    """Route and parse event lines in one pass over mixed lines.

    A line that parses cleanly into an object with an event id needs no second
    look; the keys are read only where that leaves a doubt. The generator keeps
    Catalyst from pushing the test below the parse, which would run it twice.
    """
    fields = f"{_event_fields(keep_unread)}, {schemas.CORRUPT} STRING"
    record = lines.select("value", F.from_json("value", fields).alias("r"))
    clean = f"r.{schemas.CORRUPT} IS NULL AND r.eventId IS NOT NULL AND startswith(ltrim(value), '{{')"
    keyed = "coalesce(array_contains(json_object_keys(value), 'eventId'), false)"
    routed = f"({clean} OR {keyed}) AND {_ONE_VALUE}"
    kept = record.selectExpr(f"inline_outer(if({routed}, array(struct(true AS routed, r)), NULL))")
    return kept.where("routed").selectExpr(*_event_columns(keep_unread))


def _first_token(text: Column) -> Column:
    return F.split(F.trim(text), r"\s+")[0]


def parse_matches(lines: DataFrame) -> DataFrame:
    """Typed match rows; ``teams`` keeps the order of the JSON object."""
    record = lines.select(F.from_json("value", schemas.MATCH_FIELDS).alias("r")).select("r.*")

    def team(entry, position):
        formation = entry["value"]["formation"]
        return F.struct(
            position.alias("team_pos"),
            entry["key"].try_cast("bigint").alias("team_id"),
            F.from_json(formation["substitutions"], schemas.SUBSTITUTIONS).alias("substitutions"),
            formation["lineup"].alias("lineup"),
            formation["bench"].alias("bench"),
        )

    # The date is in UTC whatever the time zone of the session.
    kickoff = F.expr("coalesce(try_cast(concat(trim(dateutc), 'Z') AS TIMESTAMP), try_cast(dateutc AS TIMESTAMP))")
    date = _first_token(F.col("dateutc"))
    return record.select(
        F.col("wyId").alias("match_id"),
        "status",
        kickoff.alias("kickoff"),
        F.coalesce(date.try_cast("date"), F.lit(UNDATED).cast("date")).alias("match_day"),
        date.alias("date"),
        "label",
        "duration",
        "winner",
        "venue",
        "gameweek",
        F.transform(F.map_entries("teamsData"), team).alias("teams"),
    )


def content_hash(records: DataFrame) -> Column:
    """A hash of all columns that does not depend on their order, as stored tables have another."""
    return F.xxhash64(F.to_json(F.struct(*sorted(records.columns))))


def preferred_records(matches: DataFrame) -> DataFrame:
    """One record per match id, whatever the order of arrival; ``matches`` may be a stream.

    Of records that differ the one with the smallest hash of its content is kept.
    Records without an id are left out.
    """
    columns = matches.columns
    order = content_hash(matches)
    known = matches.where("match_id IS NOT NULL")
    return known.groupBy("match_id").agg(F.min_by(F.struct(*columns), order).alias("m")).select("m.*")


def first_match_records(matches: DataFrame) -> DataFrame:
    """The preferred record of each match id, and all records without an id, which are no versions of each other."""
    return preferred_records(matches).unionByName(matches.where("match_id IS NULL"))


def match_team_ids(matches: DataFrame) -> DataFrame:
    return matches.select("match_id", F.posexplode("teams").alias("team_pos", "t")).select(
        "match_id", "team_pos", F.col("t.team_id").alias("team_id")
    )


_STARTS = ", ".join(f"'{period}', {second}" for period, second in PERIOD_START.items())
# NULL for seconds beyond all time; such an event has no time and bounds no span.
_OFFSET = f"try_cast(round((coalesce(map({_STARTS})[period], 0) + coalesce(event_sec, 0D)) * 1e6D) AS BIGINT)"
_INSTANT = "if(abs({offset}) < 4000000000000000, timestamp_micros(unix_micros(kickoff) + {offset}), NULL)"


def with_event_time(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Add ``event_ts`` = kickoff + period start + seconds into the period."""
    kickoffs = matches.select("match_id", "kickoff", "match_day")
    return events.join(kickoffs, "match_id").selectExpr(
        "*", f"{_INSTANT.format(offset=_OFFSET)} AS event_ts"
    )


def match_spans(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Number of events and their first and last time per match record.

    The events are reduced to one row per match before they meet the records.
    """
    offsets = events.selectExpr("match_id", f"{_OFFSET} AS offset").groupBy("match_id").agg(
        F.expr("count(1) AS events"), F.expr("min(offset) AS first"), F.expr("max(offset) AS last")
    )
    return offsets.join(matches.select("match_id", "kickoff"), "match_id").selectExpr(
        "match_id", "events",
        f"{_INSTANT.format(offset='first')} AS first_ts", f"{_INSTANT.format(offset='last')} AS last_ts",
    )
