"""Where the stored tables of the streaming pipeline and published results live.

The pipeline's tables are described here and kept by ``sources.store``: every
micro-batch adds runs and commits them with one manifest. Published results are
folders of their own, named by a manifest as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.functions import formulas
from pitchline.operators import answers, stats
from pitchline.operators.facts import COUNTERS
from pitchline.sources import requests as request_source
from pitchline.sources.dimensions import players_by_name
from pitchline.sources.store import Manifests, Store, Table

#: Buckets of the tables keyed by match.
MATCH_BUCKETS = 16

_MEMBER = "STRUCT<playerId: BIGINT, goals: STRING, ownGoals: STRING, yellowCards: STRING, redCards: STRING>"
_TEAM = (
    "STRUCT<team_pos: INT, team_id: BIGINT, "
    "substitutions: ARRAY<STRUCT<playerIn: BIGINT, playerOut: BIGINT, minute: INT>>, "
    f"lineup: ARRAY<{_MEMBER}>, bench: ARRAY<{_MEMBER}>>"
)
_RECORD = (
    "match_id BIGINT, status STRING, kickoff TIMESTAMP, date STRING, label STRING, duration STRING, "
    f"winner BIGINT, venue STRING, gameweek INT, teams ARRAY<{_TEAM}>, match_day DATE"
)
_COUNTED = "match_id BIGINT, player_id BIGINT, team_id BIGINT, last_event_id BIGINT, " + ", ".join(
    f"{c} BIGINT" for c in COUNTERS
)
_FIGURES = ", ".join(f"{c} DOUBLE" for c in formulas.RATIOS)
_NODE = "level INT, part BIGINT, a DOUBLE, b DOUBLE, n BIGINT, batch_id BIGINT"


def _sum_counts(rows: DataFrame) -> DataFrame:
    return stats.merge_counts(rows, "max(batch_id) AS batch_id", "max(bucket) AS bucket")


TABLES: dict[str, Table] = {
    # Counters by match and player alone; a match's day and record are no matter.
    "player_count": Table(f"{_COUNTED}, batch_id BIGINT, bucket INT", ("bucket",), merge=_sum_counts),
    # The preferred record of every match: an index by match, not a log of versions.
    "match_current": Table(f"{_RECORD}, content BIGINT, batch_id BIGINT, bucket INT", ("bucket",), ("match_id",)),
    # Records without an id, which are no versions of each other.
    "match_unnamed": Table(f"{_RECORD}, record_no BIGINT, batch_id BIGINT"),
    "dead_letter": Table("value STRING, batch_id BIGINT"),
    # Participations with their rating; rating columns are NULL without events.
    "played": Table(
        "match_key STRING, match_id BIGINT, player_id BIGINT, nth INT, match_day DATE, kickoff TIMESTAMP, team_id BIGINT, "
        f"minutes INT, {_FIGURES}, fouls BIGINT, own_goal BIGINT, prior_matches BIGINT, match_rating DOUBLE, rating DOUBLE, "
        "rating_change DOUBLE, gone BOOLEAN, batch_id BIGINT, chunk INT",
        ("chunk",), ("player_id", "match_key", "match_day", "nth"),
    ),
    # Matches and rating of a player over intervals: n matches, and x' = a x + b for the rating.
    "standing": Table(f"player_id BIGINT, {_NODE}", ("level",), ("player_id", "level", "part")),
    # Chemistry of a pair over intervals.
    "pair_node": Table(f"player_lo BIGINT, player_hi BIGINT, {_NODE}", ("level",), ("player_lo", "player_hi", "level", "part")),
    # The last rated match of every player.
    "latest": Table(
        "player_id BIGINT, match_id BIGINT, team_id BIGINT, match_rating DOUBLE, rating DOUBLE, rating_change DOUBLE, "
        "gone BOOLEAN, batch_id BIGINT",
        (), ("player_id",),
    ),
}


#: Published results that are asked for by key: dealt into a folder a bucket, sorted within.
LOOKUP_KEYS = {"match_summary": ("date", "label"), "player_profile": ("player_id",)}
LOOKUP_BUCKETS = 32
_SLOT = "_slot"


def _slot(buckets: int, *keys) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class Catalog:
    def __init__(self, spark: SparkSession, root: str, fan: int = 8):
        self.spark = spark
        self.root = root.rstrip("/")
        self.store = Store(spark, self.path("tables"), TABLES, fan)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def checkpoint(self) -> str:
        return self.path("_checkpoint")

    def read(self, name: str) -> DataFrame:
        """The current rows of a table, as the newest commit names them."""
        return self.store.snapshot().current(name)

    def publish(self, results: dict[str, DataFrame], version: int, fmt: str = "parquet", keep: int = 2) -> None:
        """Store results as one new version; readers see all of it or none.

        Each publication goes to folders of its own, and a small file, renamed into
        place last, names them. A publication that fails is not seen. Data of all but
        the last ``keep`` publications go. Results of LOOKUP_KEYS are dealt by their key,
        so that a question reads the folders of the keys it asks for.
        """
        stamp = uuid.uuid4().hex
        dealt = {}
        for name, df in results.items():
            path = f"{self.path('snapshot')}/data/{stamp}/{name}"
            keys = LOOKUP_KEYS.get(name, ())
            if keys and set(keys) <= set(df.columns):
                dealt[name] = LOOKUP_BUCKETS
                rows = df.withColumn(_SLOT, _slot(LOOKUP_BUCKETS, *keys)).repartition(LOOKUP_BUCKETS, _SLOT)
                rows.sortWithinPartitions(_SLOT, *keys).write.format(fmt).partitionBy(_SLOT).save(path)
            else:
                df.write.format(fmt).save(path)
        published = self._published(keep)
        kept = published.commit({"version": version, "stamp": stamp, "format": fmt, "names": sorted(results), "dealt": dealt})
        folder = f"{self.path('snapshot')}/data"
        for old in set(published.files.names(folder)) - {m["stamp"] for m in kept}:
            published.files.remove(f"{folder}/{old}")

    def _published(self, keep: int = 2) -> Manifests:
        return Manifests(self.spark, f"{self.path('snapshot')}/published", keep)

    def _newest(self, name: str, schema: str | None = None) -> tuple[DataFrame, int | None]:
        """A result of the newest version that holds it, and the number of its buckets."""
        published = self._published()
        pointers = sorted((published.read(n) for n in published.numbers()), key=lambda m: -m["version"])
        newest = next(m for m in pointers if name in m["names"])
        reader = self.spark.read.format(newest["format"])
        if schema:
            reader = reader.schema(schema)
        return reader.load(f"{self.path('snapshot')}/data/{newest['stamp']}/{name}"), newest.get("dealt", {}).get(name)

    def read_snapshot(self, name: str, schema: str | None = None) -> DataFrame:
        """A result of the newest version that holds it."""
        rows, buckets = self._newest(name, schema)
        return rows.drop(_SLOT) if buckets else rows

    def look_up(self, name: str, wanted: DataFrame) -> DataFrame:
        """The rows of a published result in the buckets of the ``wanted`` keys, columns in the order of LOOKUP_KEYS.

        The buckets are folders and ``wanted`` is no larger than the questions, so Spark
        prunes the scan by them at run time where it broadcasts them.
        """
        rows, buckets = self._newest(name)
        if not buckets:
            return rows
        keys = LOOKUP_KEYS[name]
        cast = [F.col(w).cast(rows.schema[key].dataType) for w, key in zip(wanted.columns, keys, strict=True)]
        # The planner prunes by a side that a comparison cuts; the routing of requests is none.
        slots = wanted.select(_slot(buckets, *cast).alias(_SLOT)).where(F.col(_SLOT) >= 0).distinct()
        return rows.join(slots, _SLOT, "left_semi").drop(_SLOT)

    def answer(self, asked: DataFrame, players: DataFrame, teams: DataFrame) -> dict[str, DataFrame]:
        """The answers to a mixed set of requests from the published results."""
        named = request_source.routed(asked, "profile").select("name").join(players_by_name(players), "name")
        return answers.answer_all(
            asked, players, teams,
            ratings=self.read_snapshot("player_rating"), chemistry=self.read_snapshot("chemistry"),
            profiles=self.look_up("player_profile", named.select("Id")),
            summaries=self.look_up("match_summary", request_source.routed(asked, "details").select("date", "label")),
        )


def write_response(df: DataFrame, path: str) -> None:
    """Answers as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_responses(answered: dict[str, DataFrame], path: str) -> None:
    """One folder of JSON lines for each kind of answer."""
    for kind, df in answered.items():
        write_response(df, f"{path}/{kind}")
