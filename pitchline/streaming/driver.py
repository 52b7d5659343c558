"""The streaming pipeline: micro-batches of record lines into stored tables.

State lives in tables, not in memory. All tables of a micro-batch appear with one
commit (``sources.store``): a reader, or the next micro-batch, meets all of them or
none, and a micro-batch repeated after a failure changes nothing.

A micro-batch costs its input and what follows from it, not the history:

* records go to an index by match that holds the preferred version; the stored
  records of touched matches alone are read, by bucket and range of ids;
* counters are added by match and player, whatever the day of the match, so a record
  that moves its match, or arrives last, changes no counter;
* the players of touched matches whose participations differ from the stored ones
  are rated again from their first differing day on. Where they stood before comes
  from a few nodes of ``operators.intervals``. Other players' rows stay;
* pairs are folded again for days on which a row of one of the two differs, and the
  nodes above these days, a handful a pair.

In a feed that arrives in order the differing rows are the new ones. A late match is
followed by the later matches of its own players: the running rating is a mean over
all matches, so a match put in between changes every later rating of a player, and
with it every later change that chemistry is made of. No other player is touched.

The result equals the batch composition over all lines read so far, wherever the
batches are cut and in whatever order records arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchline.functions import formulas
from pitchline.operators import chemistry, intervals, lineup, ratings, stats, summary
from pitchline.operators.facts import event_facts
from pitchline.operators.scan import affine_fold, chunk_of
from pitchline.settings import CHUNK_DAYS, TIMELINE, materialize
from pitchline.sources import lines as line_source
from pitchline.sources.catalog import MATCH_BUCKETS, TABLES, Catalog
from pitchline.sources.store import Snapshot, Transaction

TRIGGER = "5 seconds"

_START = formulas.double(formulas.START_RATING)
_BUCKET = f"CAST(pmod(xxhash64(match_id), {MATCH_BUCKETS}) AS INT)"
_CHUNK = f"CAST({chunk_of('match_day', CHUNK_DAYS)} AS INT)"

_KEY = list(TABLES["played"].keys)
_FACTS = ["kickoff", "team_id", "minutes", *formulas.RATIOS, "fouls", "own_goal"]
_RATED = ["prior_matches", "match_rating", "rating", "rating_change"]
_ROW = ["match_key", "match_id", "player_id", "nth", "match_day", *_FACTS]


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(map(str, values))})" if values else "false"


def _stamped(df: DataFrame, tx: Transaction, *extra: str) -> DataFrame:
    return df.selectExpr("*", *extra, f"{tx.batch}L AS batch_id")


def _differing(new: DataFrame, old: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ``new`` that ``old`` lacks or holds with other values, and rows of ``old`` whose key is not in ``new``."""
    known = old.select(*[F.col(c).alias(f"_{c}") for c in (*_KEY, *values)])
    same = [F.col(c) == F.col(f"_{c}") for c in _KEY] + [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in values]
    return new.join(known, same, "left_anti"), old.join(new.select(*_KEY), _KEY, "left_anti")


# --- records and counters ---------------------------------------------------


class _Touched:
    """The matches that a micro-batch brings events or records of, with their records before and now.

    ``records`` holds their current records with ``fresh``, whether this micro-batch changed
    them, and ``day_before``, the day of the record they had.
    """

    def __init__(self, now: Snapshot, parsed: DataFrame, partial: DataFrame):
        ids = parsed.selectExpr("match_id", "true AS record").unionByName(partial.selectExpr("match_id", "false AS record"))
        bounds = ids.agg(
            F.expr(f"array_sort(collect_set({_BUCKET}) FILTER (WHERE match_id IS NOT NULL)) AS buckets"), F.min("match_id").alias("lo"),
            F.max("match_id").alias("hi"), F.expr("count_if(record AND match_id IS NULL) AS nameless"),
        ).first()
        self.nameless = bounds["nameless"]
        self.where = f"{_in('bucket', bounds['buckets'])} AND match_id BETWEEN {bounds['lo'] or 0} AND {bounds['hi'] or 0}"
        stored = now.rows("match_current").where(self.where).join(ids, "match_id", "left_semi")
        held = now.current("match_current", stored).selectExpr(
            "match_id", "struct(* EXCEPT (match_id, content, batch_id, bucket)) AS old", "content AS old_content"
        )
        preferred = line_source.preferred_records(parsed)
        offered = preferred.select(
            "match_id", line_source.content_hash(preferred).alias("new_content"), F.struct(*[c for c in preferred.columns if c != "match_id"]).alias("new")
        )
        fresh = "new_content IS NOT NULL AND (old_content IS NULL OR new_content < old_content)"
        both = held.join(offered, "match_id", "full").selectExpr("match_id", "old", "old_content", "new", "new_content", f"{fresh} AS fresh")
        self._fields = [c for c in parsed.columns if c != "match_id"]
        chosen = [F.when(F.col("fresh"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in self._fields]
        content = F.when(F.col("fresh"), F.col("new_content")).otherwise(F.col("old_content")).alias("content")
        self.records = materialize(both.select("match_id", *chosen, content, "fresh", F.col("old.match_day").alias("day_before")), "records")
        told = self.records.agg(
            F.expr("count(1) AS records"), F.expr("count_if(fresh) AS fresh"),
            F.expr(f"array_sort(collect_set({_CHUNK.replace('match_day', 'day_before')}) FILTER (WHERE day_before IS NOT NULL)) AS chunks"),
        ).first()
        self.count, self.fresh, self.chunks = told
        self.now = self.records.select("match_id", *self._fields)

    def changed_records(self) -> DataFrame:
        return self.records.where("fresh").selectExpr("match_id", *self._fields, "content", f"{_BUCKET} AS bucket")

    def merged_counts(self, now: Snapshot, partial: DataFrame) -> DataFrame:
        """Counters of the touched matches that have a record."""
        stored = now.rows("player_count").where(self.where).drop("batch_id", "bucket")
        mine = stored.unionByName(partial).join(self.records, "match_id", "left_semi")
        return stats.merge_counts(stats.assigned(mine))


def _unnamed(tx: Transaction, parsed: DataFrame) -> DataFrame:
    """Records without an id, numbered so that equal ones stay apart."""
    rows = parsed.withColumn("_content", line_source.content_hash(parsed)).where("match_id IS NULL")
    numbered = rows.selectExpr(
        "* EXCEPT (_content)",
        f"xxhash64(_content, {tx.batch}L, row_number() OVER (PARTITION BY _content ORDER BY match_day)) AS record_no",
    )
    return materialize(numbered, "unnamed")


def _participations(touched: _Touched, unnamed: DataFrame | None, counts: DataFrame, minutes_mode: str) -> DataFrame:
    """Participations of the touched matches as their records and counters have them now."""
    named = ratings.participations(stats.with_ratios(counts), lineup.appearances(touched.now, minutes_mode))
    rows = named.selectExpr("*", "CAST(match_id AS STRING) AS match_key")
    if unnamed is not None:
        # Their number stands in for the id; no event names it.
        apps = lineup.appearances(unnamed.selectExpr("* EXCEPT (match_id, record_no)", "record_no AS match_id"), minutes_mode)
        nameless = ratings.participations(stats.with_ratios(counts.where("false")), apps)
        rows = rows.unionByName(
            nameless.selectExpr("* EXCEPT (match_id)", "CAST(NULL AS BIGINT) AS match_id", "concat('r', match_id) AS match_key")
        )
    nth = "CAST(row_number() OVER (PARTITION BY player_id, match_key, match_day ORDER BY minutes) AS INT) AS nth"
    return rows.selectExpr("*", nth).select(*_ROW)


# --- ratings ------------------------------------------------------------------


def _near(now: Snapshot, name: str, days: tuple[int, int]) -> DataFrame:
    """Stored nodes that a question about these days can need; lower levels are cut to the days' neighbourhood."""
    lo, hi = days
    rows = now.rows(name)
    parts = [
        rows.where(f"level = {k} AND part BETWEEN {lo // intervals.FAN ** (k + 1) * intervals.FAN} AND {(hi // intervals.FAN ** (k + 1) + 1) * intervals.FAN}")
        for k in (0, 1)
    ]
    return parts[0].unionByName(parts[1]).unionByName(rows.where("level > 1"))


def _nodes(now: Snapshot, name: str, keys: list[str], asked: DataFrame, days: tuple[int, int]) -> DataFrame:
    """Current nodes of the asked keys."""
    rows = _near(now, name, days).join(asked.select(*keys).distinct(), keys, "left_semi")
    return now.current(name, rows).drop("batch_id")


def _store_nodes(now: Snapshot, tx: Transaction, name: str, keys: list[str], leaves: DataFrame, days: tuple[int, int]) -> None:
    if now.runs(name):
        beside = intervals.siblings(_nodes(now, name, keys, leaves, days), leaves, keys)
    else:
        beside = leaves.selectExpr(*keys, "0 AS level", "0L AS part", "a", "b", "n").where("false")
    tx.write(name, _stamped(intervals.refresh(leaves, beside, keys), tx))


def _seeds(now: Snapshot, affected: DataFrame, days: tuple[int, int]) -> DataFrame:
    """Matches and rating of each affected player before the first differing day."""
    nodes = _nodes(now, "standing", ["player_id"], affected, days)
    stood = intervals.before(nodes, affected, ["player_id"])
    return stood.selectExpr("player_id", "n AS seed_matches", f"a * {_START} + b AS seed_rating")


def _rated(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """All rows with the count before them, those with events with their rating."""
    counted = materialize(lineup.prior_matches(rows, seeds), "counted")
    steps = counted.where("pass_accuracy IS NOT NULL").selectExpr("*", f"{formulas.match_rating('minutes')} AS match_rating")
    history = ratings.player_ratings(steps, seeds)
    unrated = counted.where("pass_accuracy IS NULL").selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS {c}" for c in _RATED[1:]])
    return history.select(*_ROW, *_RATED).unionByName(unrated.select(*_ROW, *_RATED))


def _standing_leaves(state: DataFrame, days: DataFrame) -> DataFrame:
    """Composite of each differing day of a player; a day without a match left is the identity."""
    last = f"max_by(rating, struct({', '.join(TIMELINE)})) FILTER (WHERE rating IS NOT NULL)"
    held = state.join(days, ["player_id", "match_day"], "left_semi").groupBy("player_id", "match_day").agg(
        F.expr("count(1) AS n"), F.expr(f"{last} AS last")
    )
    return days.join(held, ["player_id", "match_day"], "left").selectExpr(
        "player_id", "match_day AS day", "if(last IS NULL, 1D, 0D) AS a", "coalesce(last, 0D) AS b", "coalesce(n, 0L) AS n"
    )


def _latest(now: Snapshot, tx: Transaction, state: DataFrame, affected: DataFrame) -> DataFrame:
    """The last rated row of each affected player."""
    found = ratings.latest_ratings(state.where("rating IS NOT NULL"))
    rows = found.selectExpr("*", "false AS gone")
    lost = affected.join(found.select("player_id"), "player_id", "left_anti")
    if now.runs("latest") and not (lost := materialize(lost, "lost")).isEmpty():
        # Nothing rated is left from the differing day on: look before it.
        earlier = now.rows("played").join(lost, "player_id").where("match_day < day").drop("day")
        back = ratings.latest_ratings(now.current("played", earlier).where("rating IS NOT NULL")).selectExpr("*", "false AS gone")
        none = lost.join(back.select("player_id"), "player_id", "left_anti").select("player_id")
        rows = rows.unionByName(back).unionByName(none.selectExpr("player_id", "true AS gone"), allowMissingColumns=True)
    return _stamped(rows, tx)


# --- chemistry ----------------------------------------------------------------


def _pairs_of_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Updates of the pairs one of whom has a row on a differing day of theirs."""
    marked = rows.where("rating IS NOT NULL").join(days.withColumn("touched", F.lit(True)), ["player_id", "match_day"], "left")
    return chemistry.pair_updates(marked, carry=("touched",)).where("touched_lo OR touched_hi").drop("touched_lo", "touched_hi")


def _pair_leaves(before: DataFrame, after: DataFrame, days: DataFrame) -> DataFrame:
    """Composite per pair and differing day; pairs that had one and have none any more get the identity."""
    columns = [*chemistry.PAIR, "match_day", "kickoff", "match_id", "a", "b", "n"]
    fresh = chemistry.pair_maps(_pairs_of_days(after, days)).selectExpr("*", "1L AS n").select(*columns)
    ended = _pairs_of_days(before, days).selectExpr("*", "1D AS a", "0D AS b", "0L AS n").select(*columns)
    folded = affine_fold(fresh.unionByName(ended), [*chemistry.PAIR, "match_day"], ["kickoff", "match_id"], "sum(n) AS n")
    return folded.withColumnRenamed("match_day", "day")


# --- one micro-batch ----------------------------------------------------------


def _refresh(now: Snapshot, tx: Transaction, touched: _Touched, fresh: DataFrame) -> None:
    """Ratings, standings and chemistry of everyone whose participations differ from the stored ones."""
    touched_keys = touched.records.selectExpr("CAST(match_id AS STRING) AS match_key")
    stored = now.current("played", now.rows("played").where(_in("chunk", touched.chunks)).join(touched_keys, "match_key", "left_semi"))
    new, ended = _differing(fresh, stored, _FACTS)
    differing = new.select("player_id", "match_day").unionByName(ended.select("player_id", "match_day"))
    affected = materialize(differing.groupBy("player_id").agg(F.min("match_day").alias("day")), "affected")
    first = affected.agg(F.expr("min(unix_date(day)) AS lo"), F.expr("max(unix_date(day)) AS hi")).first()
    if first["lo"] is None:
        return

    # Everything these players played from their first differing day on, before and now.
    from_chunk = first["lo"] // CHUNK_DAYS
    later = now.rows("played").where(f"chunk >= {from_chunk}").join(affected, "player_id").where("match_day >= day").drop("day")
    before = materialize(now.current("played", later), "before")
    kept = before.join(touched_keys, "match_key", "left_anti").select(*_ROW)
    rows = kept.unionByName(fresh.join(affected, "player_id").where("match_day >= day").select(*_ROW))
    seeds = materialize(_seeds(now, affected, (first["lo"], first["hi"])), "seeds")
    state = materialize(_rated(rows, seeds), "state")

    changed, gone = _differing(state, before, [*_FACTS, *_RATED])
    delta = changed.selectExpr("*", "false AS gone").unionByName(gone.select(*_ROW, *_RATED).selectExpr("*", "true AS gone"))
    delta = materialize(delta, "delta")
    days = delta.select("player_id", "match_day").distinct()
    span = delta.agg(F.expr("min(unix_date(match_day))"), F.expr("max(unix_date(match_day))"), F.expr(f"array_sort(collect_set({_CHUNK}))")).first()
    if span[0] is None:
        return
    tx.write("played", _stamped(delta, tx, f"{_CHUNK} AS chunk"))
    tx.write("latest", _latest(now, tx, state, affected))
    _store_nodes(now, tx, "standing", ["player_id"], materialize(_standing_leaves(state, days), "standing-leaves"), span[:2])

    # All members of the matches that these players have on these days.
    theirs = state.unionByName(before.select(*_ROW, *_RATED)).join(days, ["player_id", "match_day"], "left_semi")
    here = now.rows("played").where(_in("chunk", span[2])).join(theirs, "match_key", "left_semi")
    members = materialize(now.current("played", here).select(*_ROW, *_RATED), "members")
    after = members.join(delta.select(*_KEY), _KEY, "left_anti").unionByName(delta.where("NOT gone").drop("gone"))
    leaves = materialize(_pair_leaves(members, after, days), "pair-leaves")
    _store_nodes(now, tx, "pair_node", chemistry.PAIR, leaves, span[:2])


def process_batch(
    catalog: Catalog, lines: DataFrame, batch_id: int, minutes_mode: str = lineup.ON_FIELD
) -> None:
    """Take one micro-batch of lines into the tables; one that is committed already is left alone."""
    now = catalog.store.snapshot()
    if now.batch >= batch_id:
        return
    tx = catalog.store.begin(batch_id)
    kinds = line_source.split_by_kind(lines)
    partial = materialize(stats.count_by_player(event_facts(line_source.parse_events(kinds.events))), "partial_counts")
    parsed = materialize(line_source.parse_matches(kinds.matches), "parsed")
    tx.write("dead_letter", _stamped(kinds.dead_letters, tx))
    tx.write("player_count", _stamped(partial, tx, f"{_BUCKET} AS bucket"))
    touched = _Touched(now, parsed, partial)
    if touched.fresh:
        tx.write("match_current", _stamped(touched.changed_records(), tx))
    unnamed = _unnamed(tx, parsed) if touched.nameless else None
    if unnamed is not None:
        tx.write("match_unnamed", _stamped(unnamed, tx))
    if touched.count or unnamed is not None:
        rows = _participations(touched, unnamed, touched.merged_counts(now, partial), minutes_mode)
        _refresh(now, tx, touched, materialize(rows, "participations"))
    tx.commit()


def run_stream(
    lines: DataFrame,
    catalog: Catalog,
    minutes_mode: str = lineup.ON_FIELD,
    available_now: bool = False,
    publish_each_batch: bool = False,
) -> StreamingQuery:
    """Start the pipeline on a streaming DataFrame with a ``value`` column."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        process_batch(catalog, batch, batch_id, minutes_mode)
        if publish_each_batch:
            publish(catalog, batch_id)

    writer = lines.writeStream.foreachBatch(on_batch).option("checkpointLocation", catalog.checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": TRIGGER}
    return writer.trigger(**trigger).start()


# --- results as views over the tables -------------------------------------


def rating_history(catalog: Catalog) -> DataFrame:
    rows = catalog.read("played").where("rating IS NOT NULL")
    return rows.select("match_id", "match_day", "kickoff", "player_id", "team_id", "minutes", *_RATED)


def latest_ratings(catalog: Catalog) -> DataFrame:
    """One stored row a player."""
    return catalog.read("latest").drop("gone", "batch_id")


def _root(catalog: Catalog, name: str) -> DataFrame:
    """The top nodes of all keys, one row a key for some ninety years."""
    now = catalog.store.snapshot()
    return now.current(name, now.rows(name).where(f"level = {intervals.ROOT}"))


def match_counts(catalog: Catalog) -> DataFrame:
    """From the top nodes; participations are counted as they are stored."""
    return _root(catalog, "standing").groupBy("player_id").agg(F.sum("n").alias("matches_played")).where("matches_played > 0")


def player_match_stats(catalog: Catalog) -> DataFrame:
    """Of all events so far, those of matches without a record included."""
    return stats.with_ratios(stats.assigned(catalog.read("player_count")))


def player_profiles(catalog: Catalog) -> DataFrame:
    return stats.player_profiles(player_match_stats(catalog))


def edges(catalog: Catalog) -> DataFrame:
    """Chemistry edges; pairs whose rating never changed together have none."""
    return chemistry.apply_maps(intervals.fold(_root(catalog, "pair_node").where("n > 0"), chemistry.PAIR))


def match_records(catalog: Catalog) -> DataFrame:
    """The preferred record of every match, and all records without an id."""
    now = catalog.store.snapshot()
    named = now.current("match_current").drop("content", "batch_id", "bucket")
    return named.unionByName(now.current("match_unnamed").drop("record_no", "batch_id"))


def match_summaries(catalog: Catalog) -> DataFrame:
    return summary.match_summaries(match_records(catalog))


RESULTS = {
    "player_profile": player_profiles,
    "player_rating": latest_ratings,
    "match_rating": rating_history,
    "match_summary": match_summaries,
    "match_count": match_counts,
    "chemistry": edges,
}


def publish(catalog: Catalog, version: int, fmt: str = "parquet") -> None:
    """Write every result as a new snapshot version."""
    catalog.publish({name: result(catalog) for name, result in RESULTS.items()}, version, fmt)


def open_catalog(spark: SparkSession, root: str) -> Catalog:
    return Catalog(spark, root)
