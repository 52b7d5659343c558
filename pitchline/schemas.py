"""Explicit schemas of the records, dimensions and requests.

Nothing in the engine infers a schema: inference costs an extra scan and fails
on the union-typed fields of the match record (``substitutions`` is either an
array or the string ``"null"``).
"""

CORRUPT = "_corrupt_record"

# Fields of an event record that operators read.
EVENT_FIELDS = (
    "eventId INT, subEventId STRING, tags ARRAY<STRUCT<id: INT>>, "
    "playerId BIGINT, matchId BIGINT, teamId BIGINT, "
    "id BIGINT, eventSec DOUBLE, matchPeriod STRING"
)

# Fields that are part of the record but that no operator reads.
EVENT_UNREAD_FIELDS = (
    "eventName STRING, subEventName STRING, positions ARRAY<STRUCT<y: INT, x: INT>>"
)

MEMBER = (
    "STRUCT<playerId: BIGINT, goals: STRING, ownGoals: STRING, "
    "yellowCards: STRING, redCards: STRING>"
)

# substitutions stays text in the first pass because of its union type.
MATCH_FIELDS = (
    "wyId BIGINT, status STRING, dateutc STRING, label STRING, duration STRING, "
    "winner BIGINT, venue STRING, gameweek INT, "
    "teamsData MAP<STRING, STRUCT<formation: STRUCT<"
    f"substitutions: STRING, lineup: ARRAY<{MEMBER}>, bench: ARRAY<{MEMBER}>>>>"
)

SUBSTITUTIONS = "ARRAY<STRUCT<playerIn: BIGINT, playerOut: BIGINT, minute: INT>>"

PLAYERS = "Id BIGINT, name STRING, role STRING"
TEAMS = "name STRING, Id BIGINT"

_SIDE = "STRUCT<name: STRING, " + ", ".join(f"player{i}: STRING" for i in range(1, 12)) + ">"

REQUESTS = f"req_type INT, name STRING, date STRING, label STRING, team1 {_SIDE}, team2 {_SIDE}"
