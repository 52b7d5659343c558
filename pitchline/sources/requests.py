"""Request documents and their routing to the four answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline import schemas
from pitchline.functions.formulas import LINEUP_SIZE


def _side(name: str) -> Column:
    players = F.array(*[F.col(f"{name}.player{i}") for i in range(1, LINEUP_SIZE + 1)])
    return F.when(
        F.col(name).isNotNull(), F.struct(F.col(f"{name}.name").alias("name"), players.alias("players"))
    )


_FIELDS = f"{schemas.REQUESTS}, {schemas.CORRUPT} STRING"

#: What is said about a document that is no request at all.
NO_REQUEST = "not a JSON object"


def normalise(raw: DataFrame, req_id: Column, junk: Column) -> DataFrame:
    """Requests with line-ups as arrays, one row per request; ``junk`` is the text of a document that is none."""
    return raw.select(
        req_id.alias("req_id"), "req_type", "name", "date", "label",
        _side("team1").alias("team1"), _side("team2").alias("team2"), junk.alias("junk"),
    )


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Multi-line JSON documents, one request per file; the full path of the file is the id."""
    files = spark.read.text(path, wholetext=True)
    return parse_requests(files.select(F.col("_metadata.file_path").alias("req_id"), "value"))


def parse_requests(documents: DataFrame) -> DataFrame:
    """Requests from a table of (req_id, value) with one JSON document each."""
    raw = documents.select("req_id", "value", F.from_json("value", _FIELDS).alias("r")).select("req_id", "value", "r.*")
    # A text without a value, an empty one say, is no corrupt record and no object either.
    object_like = F.coalesce(F.ltrim("value").startswith("{"), F.lit(False))
    junk = F.when(F.col(schemas.CORRUPT).isNotNull() | ~object_like, F.coalesce("value", F.lit("")))
    return normalise(raw, F.col("req_id"), junk)


def rejected(requests: DataFrame) -> DataFrame:
    """Documents that are no requests: req_id, the text and an error."""
    return requests.where("junk IS NOT NULL").select("req_id", F.col("junk").alias("document"), F.lit(NO_REQUEST).alias("error"))


def route(req_type: Column) -> Column:
    """Name of the answer; NULL for a type nobody answers."""
    kind = F.coalesce(req_type, F.lit(0))
    return (
        F.when(kind == 1, "predict")
        .when(kind == 2, "profile")
        .when(kind == 4, "match_rate")
        .when(kind.isin(0, 3), "details")
    )


def routed(requests: DataFrame, answer: str) -> DataFrame:
    return requests.where(F.col("junk").isNull() & (route(F.col("req_type")) == answer))
