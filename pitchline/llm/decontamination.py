"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are the stated query set. A first pass over all documents counts in how
many of them each n-gram of an item occurs; of any ``window`` n-grams in a row the
rarest becomes a seed, so every run of n + window - 1 words that a document takes
over unchanged holds a seed, however frequent the item is. A second pass looks
the seeds up in every document and aligns the passage around each hit with the
item (match +2, mismatch and gap -1, on words). A document is contaminated by an
item if the best local alignment has ``least`` of the score of a verbatim copy, so
copies with replaced, inserted or left-out words count too.

Both passes are on the map side: documents are never shuffled, and a passage that
a third of all documents share makes no group. Items are broadcast in blocks of
about ``block_bytes``, so a large set takes several passes, not more memory.

Words are compared in lower case (A-Z) without punctuation at their ends. Defined
cases: null and empty texts and items match nothing; an item shorter than n words
is one seed; equal items each match; of equal alignments the first counts; an
empty table on either side gives no match; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import hashed_words, in_parts, mix, small_batches
from pitchline.llm.language_id import Lookup

MATCH, OTHER = 2, -1
_MATCHES = "array<struct<item_id: long, score: double, start: int, end: int>>"


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words in order; none if there are fewer."""
    last = max(0, len(words) - n + 1)
    out = np.full(last, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + last])
    return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word arrays: score, start and end in the passage."""
    width = len(passage)
    steps = np.arange(width + 1)
    above = np.zeros(width + 1, np.int64)
    start_above = steps.copy()
    best = (0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, MATCH, OTHER)
        here, start = above + OTHER, start_above.copy()
        better = diagonal > here[1:]
        here[1:] = np.where(better, diagonal, here[1:])
        start[1:] = np.where(better, np.where(above[:-1] > 0, start_above[:-1], steps[:-1]), start[1:])
        here[0] = 0
        empty = here <= 0
        here[empty] = 0
        lifted = here - OTHER * steps
        top = np.maximum.accumulate(lifted)
        origin = np.maximum.accumulate(np.where(lifted == top, steps, 0))
        here = top + OTHER * steps
        start = np.where(here > 0, np.where(empty[origin], steps, start[origin]), steps)
        at = int(here.argmax())
        if here[at] > best[0]:
            best = (int(here[at]), int(start[at]), at)
        above, start_above = here, start
    return best


class Seeds:
    """The seeds of a block of items, and where each stands."""

    def __init__(self, items: list[tuple[int, np.ndarray]], n: int, window: int, df: dict[int, int] | None = None):
        self.items, self.n = items, n
        self.lengths = sorted({min(n, len(w)) for _, w in items if len(w)})
        where: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for number, (_, words) in enumerate(items):
            if not len(words):
                continue
            size = min(n, len(words))
            keys = runs(words, size).tolist()
            span = min(window, len(keys))
            chosen = range(len(keys))
            if df is not None:
                chosen = {min(range(a, a + span), key=lambda k: (df.get(keys[k], 0), k)) for a in range(len(keys) - span + 1)}
            for k in chosen:
                where.setdefault((size, keys[k]), []).append((number, k))
        self.by_size = {}
        for size in self.lengths:
            keys = sorted(k for s, k in where if s == size)
            self.by_size[size] = (Lookup(np.array(keys, np.uint64)), [where[size, k] for k in keys], np.array(keys, np.uint64))

    def hits(self, texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, list[tuple[int, int, int]]]]:
        """(number, words, [(size, row, position)]) of every text that holds seeds."""
        for a, b in in_parts(texts):
            words, ends = hashed_words(texts[a:b], trim=True)
            by_text: dict[int, list[tuple[int, int, int]]] = {}
            starts = np.concatenate([[0], ends[:-1]])
            for size, (lookup, _, _) in self.by_size.items():
                rows = lookup.rows(runs(words, size))
                at = np.flatnonzero(rows >= 0)
                text = np.searchsorted(ends, at, side="right")
                inside = at + size <= ends[text]
                for k, t in zip(at[inside].tolist(), text[inside].tolist(), strict=True):
                    by_text.setdefault(t, []).append((size, int(rows[k]), k - int(starts[t])))
            for t, found in by_text.items():
                yield a + t, words[starts[t] : ends[t]], found

    def matches(self, words: np.ndarray, hits: list[tuple[int, int, int]], least: float) -> list[tuple[int, float, int, int]]:
        """(item_id, score, start, end) of items that a document with these seeds holds."""
        diagonals: dict[int, list[int]] = {}
        for size, row, at in hits:
            for number, k in self.by_size[size][1][row]:
                diagonals.setdefault(number, []).append(at - k)
        found = []
        for number, starts in sorted(diagonals.items()):
            item_id, item = self.items[number]
            slack = len(item) // 2 + 1
            best = (0, 0, 0)
            for low, high in _spans(starts, slack, len(item), len(words)):
                passage = words[low:high]
                there = np.sort(passage)
                at = np.minimum(np.searchsorted(there, item), len(there) - 1)
                if (there[at] == item).sum() < least * len(item):  # no alignment can reach it
                    continue
                score, a, b = align(item, passage)
                if score > best[0]:
                    best = (score, low + a, low + b)
            if best[0] >= least * MATCH * len(item):
                found.append((item_id, best[0] / (MATCH * len(item)), best[1], best[2]))
        return found


def _spans(starts: list[int], slack: int, length: int, most: int) -> Iterator[tuple[int, int]]:
    """Passages around the diagonals, overlapping ones joined."""
    low = high = None
    for start in sorted(set(starts)):
        a, b = max(0, start - slack), min(most, start + length + slack)
        if low is not None and a <= high:
            high = max(high, b)
            continue
        if low is not None:
            yield low, high
        low, high = a, b
    if low is not None:
        yield low, high


def _df_counter(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        counts: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, _, found in seeds.hits(batch.column(0).to_pylist()):
                for hit in {(size, row) for size, row, _ in found}:
                    counts[hit] = counts.get(hit, 0) + 1
        if counts:
            keys = [int(seeds.by_size[size][2][row].astype(np.int64)) for size, row in counts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["key", "docs"])

    return run


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 3,
    window: int = 2,
    least: float = 0.5,
    block_bytes: int = 8 << 20,
    name: str = "matches",
) -> DataFrame:
    """``docs`` with a column ``name``: the items each document holds."""
    spark = small_batches(docs).sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("binary").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    block = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, blocks)))
    columns = []
    for k in range(blocks):
        rows = items.where(block == k).orderBy("id", "text").collect()  # about block_bytes
        prepared = [(r["id"], hashed_words([bytes(r["text"])], trim=True)[0]) for r in rows]
        every = spark.sparkContext.broadcast(Seeds(prepared, n, window))
        counted = docs.select(F.col(text_col).cast("binary")).mapInArrow(_df_counter(every), "key long, docs long").groupBy("key").agg(F.sum("docs"))
        df = {key & (2**64 - 1): found for key, found in counted.collect()}  # at most one row for each n-gram of the block
        rare = spark.sparkContext.broadcast(Seeds(prepared, n, window, df))
        columns.append(_matcher(rare, least)(F.col(text_col)))
    matches = F.concat(*columns) if columns else F.array().cast(_MATCHES)
    return docs.withColumn(name, matches)


def _matcher(shared, least: float):
    @F.pandas_udf(_MATCHES)
    def matches(texts):
        import pandas as pd

        seeds, out = shared.value, [[] for _ in range(len(texts))]
        for k, words, hits in seeds.hits([t.encode() if t else None for t in texts]):
            out[k] = [dict(zip(("item_id", "score", "start", "end"), m, strict=True)) for m in seeds.matches(words, hits, least)]
        return pd.Series(out)

    return matches.asNondeterministic()  # else a filter on the result runs it twice


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns."""
    found = find_matches(docs, benchmark, text_col, name="_matches", **options)
    return found.where(F.size("_matches") == 0).select(*docs.columns)
