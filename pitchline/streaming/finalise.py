"""Running counters whose state is evicted behind a watermark, without losing a row.

Events are counted per day, match and player. A day is open until the watermark, the
latest event time of earlier micro-batches less ``delay_days``, has passed its end; only
counters of open days are state. A micro-batch rewrites them, appends the days that its
events close to the final counters, and puts events of days already closed, which a
plain watermark would drop, into a table of corrections. Readers merge the three.

The state is therefore bounded by the players of the days within ``delay_days``, however
long the stream; what readers merge are appended runs, compacted level by level. All
tables and the watermark change with one commit, so a repeated micro-batch changes
nothing. Events without a time belong to no open day and go to the corrections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchline.operators import stats
from pitchline.operators.facts import COUNTERS, event_facts
from pitchline.settings import materialize
from pitchline.sources.store import Store, Table

DAY_MICROS = 86_400_000_000
DELAY_DAYS = 2

_READ = ["event_id", "match_id", "team_id", "player_id", "event_code", "sub_event", "tag_ids"]
_COUNTED = "match_id BIGINT, player_id BIGINT, team_id BIGINT, last_event_id BIGINT, " + ", ".join(f"{c} BIGINT" for c in COUNTERS)


def _merge_days(rows: DataFrame) -> DataFrame:
    return stats.merge_counts(rows, keys=("day",))


TABLES = {
    "open": Table(f"day DATE, {_COUNTED}"),
    "final": Table(f"day DATE, {_COUNTED}", merge=_merge_days),
    "correction": Table(f"day DATE, {_COUNTED}", merge=_merge_days),
}


def open_store(spark: SparkSession, root: str, fan: int = 8) -> Store:
    return Store(spark, root, TABLES, fan)


def process_batch(store: Store, events: DataFrame, batch_id: int, delay_days: int = DELAY_DAYS) -> None:
    """Take the typed events (with ``event_ts``) of one micro-batch into the tables."""
    now = store.snapshot()
    if now.batch >= batch_id:
        return
    tx = store.begin(batch_id)
    day = f"date_from_unix_date(CAST(floor(unix_micros(event_ts) / {DAY_MICROS}) AS INT)) AS day"
    facts = event_facts(stats.assigned(events).selectExpr(*_READ, day, "unix_micros(event_ts) AS micros"), "day", "micros")
    partial = materialize(stats.count_by_player(facts, "max(micros) AS micros", keys=("day",)), "day-counts")
    seen, closed_until = now.manifest.get("latest"), now.manifest.get("closed_until")
    newest = partial.agg(F.max("micros")).first()[0]
    seen = max((x for x in (seen, newest) if x is not None), default=None)
    until = None if seen is None else seen - delay_days * DAY_MICROS

    def closed(micros):
        ends = f"(unix_date(day) + 1) * {DAY_MICROS}L"
        return "day IS NULL" if micros is None else f"(day IS NULL OR {ends} <= {micros}L)"

    rows = partial.drop("micros")
    tx.write("correction", rows.where(closed(closed_until)))
    current = now.rows("open").unionByName(rows.where(f"NOT {closed(closed_until)}"))
    state = materialize(stats.merge_counts(current, keys=("day",)), "open-days")
    tx.write("final", state.where(closed(until)))
    tx.replace("open", state.where(f"NOT {closed(until)}"))
    tx.commit(latest=seen, closed_until=until)


def run_stream(events: DataFrame, store: Store, delay_days: int = DELAY_DAYS, available_now: bool = False) -> StreamingQuery:
    """Start on a streaming DataFrame of typed events with ``event_ts``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        process_batch(store, batch, batch_id, delay_days)

    writer = events.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{store.root}/_checkpoint")
    trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
    return writer.trigger(**trigger).start()


def counters(store: Store) -> DataFrame:
    """Counters per (match, player) of everything read so far."""
    now = store.snapshot()
    rows = now.rows("open").unionByName(now.rows("final")).unionByName(now.rows("correction"))
    return stats.merge_counts(rows.drop("day"))
