"""Player and team dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline import schemas


def _read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_players(spark: SparkSession, path: str, extra: str = "") -> DataFrame:
    """Players with explicit types; ``extra`` declares further columns to keep.

    A row whose id is no number names nobody; ``rejected_rows`` lists it.
    """
    return _read_csv(spark, path, schemas.PLAYERS + (f", {extra}" if extra else "")).where("Id IS NOT NULL")


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.TEAMS).where("Id IS NOT NULL")


def rejected_rows(spark: SparkSession, path: str, schema: str = schemas.PLAYERS) -> DataFrame:
    """The rows of a dimension file that its reader leaves out, as text, with the file they are in."""
    columns = [part.split()[0] for part in schema.split(", ")]
    raw = _read_csv(spark, path, ", ".join(f"{c} STRING" for c in columns))
    return raw.where(F.col("Id").try_cast("bigint").isNull()).select(*columns, F.col("_metadata.file_path").alias("file"))


def players_by_name(players: DataFrame) -> DataFrame:
    """One player per name: the smallest id decides between namesakes."""
    row = F.struct(*players.columns)
    return players.groupBy("name").agg(F.min_by(row, F.col("Id")).alias("p")).select("p.*")


def distinct_player_ids(players: DataFrame) -> DataFrame:
    return players.select("Id").distinct()
