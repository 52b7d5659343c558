"""Results kept in Spark's state store: running aggregates and deduplication.

They are emitted in update mode: each micro-batch writes the changed keys under
its batch id, and the newest row per key is the current value. ``compact`` folds
the written rows into the current ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitchline.operators import lineup, stats, summary
from pitchline.operators.facts import event_facts
from pitchline.settings import materialize


def running_counters(events: DataFrame) -> DataFrame:
    """Counters per (match, player).

    The match alone is the key, so a match over midnight is one, and there is no
    watermark, so a late event counts. The state holds one row for each match and
    player; on a cluster choose the RocksDB provider.
    """
    return stats.count_by_player(event_facts(stats.assigned(events))).drop("last_event_id")


def match_counts(records: DataFrame) -> DataFrame:
    """Participations per player from the current preferred records (``lines.preferred_records``).

    The state holds the records, so one sent again or in another version counts once.
    """
    return lineup.match_counts(lineup.appearances(records))


def first_summaries(summaries: DataFrame) -> DataFrame:
    """The preferred summary per (date, label), as in batch."""
    return summary.preferred(summaries)


def start_updates(
    df: DataFrame, path: str, mode: str = "update", available_now: bool = True
) -> StreamingQuery:
    """Write the rows of each micro-batch as its own partition, replacing it when repeated."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    writer = df.writeStream.outputMode(mode).foreachBatch(on_batch).option("checkpointLocation", f"{path}/_checkpoint")
    trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
    return writer.trigger(**trigger).start()


def current_rows(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    """The newest row of every key."""
    rows = _logged(spark, path, schema)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.expr(f"max_by(struct({', '.join(values)}), batch_id) AS v"))
    return newest.select(*keys, "v.*")


def _logged(spark: SparkSession, path: str, schema) -> DataFrame:
    wide = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(wide).parquet(f"{path}/rows")


def compact(spark: SparkSession, path: str, schema, keys: list[str]) -> None:
    """Replace the log of finished micro-batches by the current rows.

    They are written beside the log as the partition of the newest batch they hold;
    that partition replaces its like, and the older ones go last, so a reader finds
    every key's newest row at any moment. No query may be writing meanwhile.
    """
    log = _logged(spark, path, schema)
    newest = log.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return
    kept = materialize(current_rows(spark, path, schema, keys), "compacted")
    kept.write.mode("overwrite").parquet(f"{path}/rows/batch_id={newest}")
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in system.listStatus(root):
        number = entry.getPath().getName().removeprefix("batch_id=")
        if number.isdigit() and int(number) < newest:
            system.delete(entry.getPath(), True)
