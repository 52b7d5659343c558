"""Session helpers: where shared files live and how a local session is set up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Timelines are scanned in calendar chunks of this many days, whatever their length.
CHUNK_DAYS = 28

# The one order of a timeline. A day is always known (see UNDATED in sources.lines),
# a kickoff may be NULL, and the match id decides the rest.
TIMELINE = ("match_day", "kickoff", "match_id")

# Named folder for stored intermediates of a local session whose settings name none.
LOCAL_SCRATCH = "/tmp/checkpoints"


def local_session(app: str = "pitchline", cores: int | str = "*", **conf) -> SparkSession:
    """A single-machine session for tests and the benchmark.

    The size thresholds let a few megabytes use all cores; a cluster keeps the
    defaults, which suit partitions of its size.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", LOCAL_SCRATCH)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.startswith("local"):
        root = LOCAL_SCRATCH
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the session ends."""
    path = f"{shared_root(spark)}/pitchline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where several branches of a plan need the same aggregate: the raw
    input is then scanned once, later stages prune columns on a compact table
    with known size, and a lost executor costs no recomputation of the scan.
    """
    return materialize_counted(df, name)[0]


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As ``materialize``, with the number of rows, counted while writing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]
