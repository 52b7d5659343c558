"""Personal data by seed patterns and bootstrapped contextual extraction.

Seeds are emails, IP addresses, card numbers (Luhn) and phone numbers. Their spans
come from two passes of one regular expression: the pieces between its matches and
the matches, whose lengths add up to positions by a window over a document's hits.
The expressions match exactly what the plain ones do, but start only where a match
can start and give back nothing, so they take linear time on any text.

The words that one seed touches are one instance; so is a run of up to
``MOST_PARTS`` words of digits, and any other word with a digit or an @. Instances
have several patterns, scored apart: the word before (or a mark for the start of
the text) with the instance's shape (runs of letters and digits reduced to one
mark), and, whatever the shape, the word before, the word after, and both. These
need a context word with a letter and an instance with an @ or with ``LEAST_MARKS``
letters and digits. Patterns and distinct instances form a graph that Spark scores
in rounds: a pattern's score is the share of one kind in all its instances, each
counted with its own score, if at least ``least_support`` of that kind carry one; an
instance that is no seed gets the best score of its patterns at or above
``least_score``. High-confidence patterns thereby find identifiers that no seed
expression matches, of shapes that no seed has; these get the pattern's kind.
Words without a digit or an @ are no instances.

Only DataFrame functions are used. The graph is aggregated to distinct pairs
before any round, so a word or a pattern that a third of all rows share is one
node and its counts are summed on the map side.

Defined cases: a null or empty text has no spans; rows that repeat an id or a text
each give a row of their own; adjacent matches are separate; a match that fails
its test is dropped and not tried again; an empty table gives no rows; columns
other than those named are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
_BREAK = r"\x20\x09-\x0D"
_BLANKS = " \t\n\x0b\x0c\r"
#: What a seed expression matches, and characters without which it can't match.
PATTERNS = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "word": (rf"(?<![^{_BREAK}])[^0-9@{_BREAK}]*+[0-9@][^{_BREAK}]*+", None),
}
_CONTEXT = 64
#: Marks that stand for the word before a text and the word after it.
_START, _END = "^", "$"
#: Parts of one identifier at most, and letters and digits that one has at least.
MOST_PARTS, LEAST_MARKS = 6, 5
_EDGE = r"[,.;:!?\"'()\[\]{}<>]*"


def _hits(text: Column, kind: str) -> Column:
    """Array of (kind, at, gap, length, value, before, after): each match and what lies around it."""
    pattern, needed = PATTERNS[kind]
    pieces = F.split(text, pattern, -1)
    gaps = F.transform(pieces, lambda g: F.struct(F.length(g).alias("gap"), F.right(F.rtrim(g, F.lit(_BLANKS)), F.lit(_CONTEXT)).alias("before")))
    pairs = F.arrays_zip(gaps.alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.slice(pieces, 2, F.size(pieces)).alias("next"))
    hits = F.transform(
        pairs,
        lambda p, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("at"),
            p["g"]["gap"].alias("gap"),
            F.length(p["m"]).alias("length"),
            p["m"].alias("value"),
            (p["g"]["before"] if kind == "word" else F.lit(None).cast("string")).alias("before"),
            (F.left(F.ltrim(p["next"], F.lit(_BLANKS)), F.lit(_CONTEXT)) if kind == "word" else F.lit(None).cast("string")).alias("after"),
        ),
    )
    possible = {"email": F.lit(True), "word": text.rlike("[0-9@]")}.get(kind, text.rlike("[0-9]"))
    if needed:
        possible = F.contains(text, F.lit(needed)) & possible
    return F.when(possible, F.filter(hits, lambda h: h["value"].isNotNull()))


def _luhn(digits: Column) -> Column:
    back = F.reverse(F.split(digits, ""))
    doubled = F.transform(back, lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _passes(kind: Column, value: Column) -> Column:
    """The tests that go with the seed expressions."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    part = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(part, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", _luhn(digits))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(F.lit(True))
    )


def find_hits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All rows (row, doc_id), and hits (row, kind, start, end, value, left, right, adjacent) of all kinds.

    left and right are what lies next to a hit, or the hit of its kind next to it;
    they are null at the ends of the text. adjacent: blanks alone part a hit from the one before.
    """
    text = F.col(text_col)
    arrays = [F.coalesce(_hits(text, kind), F.array().cast("array<struct<kind: string, at: int, gap: int, length: int, value: string, before: string, after: string>>")) for kind in PATTERNS]
    found = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*arrays).alias("hits")),
        "pii-hits",
    )
    order = Window.partitionBy("row", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    left = F.when(F.col("before") != "", F.col("before")).otherwise(F.lag("value").over(order))
    right = F.when(F.col("after") != "", F.col("after")).otherwise(F.lead("value").over(order))
    hits = found.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h")).select("row", "h.*").withColumns({"end": end, "left": left, "right": right, "adjacent": (F.col("before") == "") & (F.col("at") > 0)})
    hits = hits.select("row", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value", "left", "right", "adjacent")
    return found.select("row", "doc_id"), hits


def shape(word: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(word, r"\p{L}+", "a"), "[0-9]+", "9")


def _bare(word: Column) -> Column:
    """A word of a context in lower case without marks at its ends, digits as in a shape."""
    bare = F.regexp_replace(F.regexp_replace(word, f"^{_EDGE}", ""), f"{_EDGE}$", "")
    bare = F.lower(F.when(bare == "", word).otherwise(bare))
    return F.when(bare.rlike("[0-9]"), shape(bare)).otherwise(bare)


def _instances(words: DataFrame, seeds: DataFrame) -> DataFrame:
    """Instances (row, start, end, value, patterns, seed): the words that one seed touches, or a run that none does."""
    mark = rf"^(?!\([0-9]+\)[-0-9]){_EDGE}"  # what opens an area code stays
    lead = F.length(F.regexp_extract("value", mark, 0))
    inner = F.regexp_replace(F.regexp_replace("value", mark, ""), f"{_EDGE}$", "")
    area = F.col("value").rlike(r"^\([0-9]+\)$")
    own = (
        words.withColumn("opens", F.when(area, F.col("start")))
        .withColumn("start", F.col("start") + lead)
        .withColumn("value", inner)
        .where(F.col("value").rlike(r"[\p{L}0-9]"))
        .select(
            "row",
            "opens",
            "adjacent",
            "start",
            (F.col("start") + F.length("value")).alias("end"),
            F.lower("value").alias("value"),
            F.coalesce(_bare(F.regexp_extract("left", rf"([^{_BREAK}]+)[{_BREAK}]*$", 1)), F.lit(_START)).alias("left"),
            F.coalesce(_bare(F.regexp_extract("right", rf"^([^{_BREAK}]+)", 1)), F.lit(_END)).alias("right"),
        )
    )
    # a seed touches a word if one that starts before the word's end ends after its start
    none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("value", "left", "right", "opens", "adjacent")]
    events = own.select("*", F.lit(None).cast("string").alias("kind"), F.col("end").alias("key"), F.lit(0).alias("turn")).unionByName(
        seeds.select("row", "start", "end", "kind", *none, F.col("start").alias("key"), F.lit(1).alias("turn"))
    )
    earlier = Window.partitionBy("row").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("turn") == 1, F.struct("end", "kind", "start"))).over(earlier)
    told = events.withColumn("_last", last).where("turn = 0").withColumn("_last", F.when(F.col("_last.end") > F.col("start"), F.col("_last")))
    # words of digits that no seed touches and that stand side by side are one run, unless there are too many for an identifier
    in_text = Window.partitionBy("row").orderBy("start", "end")
    told = told.withColumn("digits", F.col("_last").isNull() & ~F.col("value").rlike(r"[\p{L}@]"))
    told = told.withColumn("goes_on", F.coalesce(F.col("digits") & F.col("adjacent") & F.lag("digits").over(in_text), F.lit(False)))
    told = told.withColumn("run", F.count_if(~F.col("goes_on")).over(in_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    told = told.withColumn("several", F.count(F.lit(1)).over(Window.partitionBy("row", "run")).between(2, MOST_PARTS))
    at = F.when(F.col("_last").isNotNull(), F.col("_last.start")).when(F.col("several"), F.col("run")).otherwise(F.col("start"))
    kind = F.when(F.col("_last").isNotNull(), 2).when(F.col("several"), 1).otherwise(0)
    merged = told.groupBy("row", F.struct(kind.alias("is"), at.alias("at")).alias("unit")).agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "value"))), lambda w: w["value"]), " ").alias("value"),
        F.min_by("left", "start").alias("left"),
        F.max_by("right", "start").alias("right"),
        F.min_by("opens", "start").alias("opens"),
        F.max("_last.kind").alias("seed"),
    )
    start = F.when(F.col("unit.is") == 1, F.least("opens", "start")).otherwise(F.col("start"))
    return merged.select("row", start.alias("start"), "end", "value", _patterns().alias("patterns"), "seed")


def _patterns() -> Column:
    """The patterns of an instance: its left word with its shape, and for an identifier's length the words around it alone."""
    by_shape = F.concat_ws(" ", F.lit("shape"), "left", shape(F.col("value")))
    long = F.contains("value", F.lit("@")) | (F.length(F.regexp_replace("value", r"[^\p{L}0-9]", "")) >= LEAST_MARKS)
    cue = [F.when(long & F.col(c).rlike(r"\p{L}"), F.concat_ws(" ", F.lit(c), c)) for c in ("left", "right")]
    both = F.when(cue[0].isNotNull() & cue[1].isNotNull(), F.concat_ws(" ", F.lit("both"), "left", "right"))
    return F.array_compact(F.array(by_shape, *cue, both))


def bootstrap(instances: DataFrame, rounds: int = 3, least_support: int = 5, least_score: float = 0.9) -> DataFrame:
    """pattern, score and kind of the patterns that end with high confidence."""
    pairs = instances.select(F.explode("patterns").alias("pattern"), "value", "seed")
    edges = materialize(pairs.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "pii-graph")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    seeds = materialize(edges.where("seed IS NOT NULL").groupBy("value").agg(F.lit(1.0).alias("score"), F.max("seed").alias("kind")), "pii-seeds")
    scores, patterns = seeds, None
    for _ in range(rounds):
        # values without a score add nothing to a sum, but all count in ``n``
        known = edges.select("pattern", "value").join(scores, "value")
        kinds = known.groupBy("pattern", "kind").agg(F.sum("score").alias("weight"))
        kinds = kinds.groupBy("pattern").agg(F.max_by("kind", F.struct("weight", "kind")).alias("kind"), F.max("weight").alias("support"))
        means = kinds.where(F.col("support") >= least_support).join(sizes, "pattern").withColumn("score", F.col("support") / F.col("n"))
        patterns = materialize(means.where(F.col("score") >= least_score).select("pattern", "score", "kind"), "pii-patterns")
        reached = edges.where("seed IS NULL").join(patterns, "pattern").groupBy("value").agg(F.max(F.struct("score", "kind")).alias("best"))
        others = reached.join(seeds, "value", "left_anti").select("value", "best.score", "best.kind")
        scores = materialize(seeds.unionByName(others), "pii-scores")
    return patterns


def _joined(spans: Column) -> Column:
    """kind:start:end of sorted (order, start, end), joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["order"] + 1), s["start"], s["end"])), ",")


def _count(spans: Column, order: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["order"] == order))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and spans of every row."""
    rows, hits = find_hits(docs, id_col, text_col)
    hits = materialize(hits.where((F.col("kind") == "word") | _passes(F.col("kind"), F.col("value"))), "pii-spans")
    seeds = hits.where("kind <> 'word'").select("row", "kind", "start", "end")
    instances = materialize(_instances(hits.where("kind = 'word'"), seeds), "pii-instances")
    patterns = bootstrap(instances, **options)
    unseen = instances.where("seed IS NULL").select("row", "start", "end", F.explode("patterns").alias("pattern")).join(patterns, "pattern")
    found = unseen.groupBy("row", "start", "end").agg(F.max(F.struct("score", "kind")).alias("best"))
    found = found.select("row", "best.kind", "start", "end", F.lit(False).alias("base"))
    order = reduce(lambda a, k: F.when(F.col("kind") == KINDS[k], k).otherwise(a), range(len(KINDS)), F.lit(None).cast("int"))
    spans = (
        seeds.withColumn("base", F.lit(True))
        .unionByName(found)
        .select("row", "base", F.struct(order.alias("order"), "start", "end").alias("s"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.when(F.col("base"), F.col("s")))).alias("seeds"), F.sort_array(F.collect_list("s")).alias("spans"))
    )
    none = F.array().cast("array<struct<order: int, start: long, end: long>>")
    told = rows.join(spans, "row", "left").withColumns({"seeds": F.coalesce("seeds", none), "spans": F.coalesce("spans", none)})
    counts = [_count(F.col("seeds"), k).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return told.select("doc_id", *counts, F.sha2(_joined(F.col("seeds")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
