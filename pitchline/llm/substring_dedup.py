"""Substring deduplication with prefix-partitioned sparse suffix trees.

A window is ``WINDOW`` consecutive words of one text; a window whose words also
start anywhere else, in the same text or another, is repeated, and every word that
a repeated window covers goes.

Which suffixes to look at. Of any ``SPAN`` consecutive positions the one whose next
``GRAM`` words hash lowest is an anchor, so equal windows have equal anchors at
equal places. The prefixes at anchors are counted over all texts; a window that holds
an anchor whose prefix occurs once cannot be repeated. A filter of prefixes that occur
more often, of at most 64 MB whatever the corpus, goes to all
tasks; false hits cost work, nothing else. Neighbouring windows left over that have
the same first anchor travel as one slice of words, so a word travels about three
times, not ``WINDOW`` times.

Which group. The prefix of variable length that ends with the first anchor's words
names the group of a slice. A prefix with more than ``group_rows`` occurrences would
make a group too large; its windows travel one by one and the prefix that names their
group is the whole window. Equal slices of one part of the input meet in the task
that reads them: their windows are known to be repeated, and one row stands for all.

In a group the suffixes that start at the windows are sorted, which is the suffix
tree of the group down to ``WINDOW`` words: suffixes below one internal node of that
depth are neighbours. The words themselves are compared, so hashes decide nothing.
A group keeps distinct slices only; further copies pass through.

Rows are told apart by file and place in the file (``row_keys``), so null and equal
ids are no matter. Defined cases: a null text has no words; a text shorter than a
window keeps all its words; repeated rows lose everything that windows cover; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import SPACE, Bits, bits_of, in_parts, materialize, mix, row_keys, small_batches, span_hashes

WINDOW, SPAN, GRAM = 35, 16, 7
#: Spans within a window.
INNER = WINDOW - SPAN - GRAM + 2
PART_BYTES = 2 << 20

_SLICE = "key long, part long, at long, first int, windows int, words binary, copies int"
_HIT = "part long, at long, first int, windows int"
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)
_BLANK = np.zeros(256, bool)
_BLANK[list(SPACE)] = True


class Words(NamedTuple):
    """All words of some texts: their hashes, the texts with one blank after each word, word starts there, first word of each text."""

    hashes: np.ndarray
    text: bytes
    start: np.ndarray
    bounds: np.ndarray


def words_of(texts: list[bytes | None]) -> Words:
    data = np.frombuffer(b"".join((t or b"") + b"\n" for t in texts), np.uint8)
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view(np.int8)))
    first, end = edge[::2], edge[1::2]
    hashes = span_hashes(data, first, end)
    keep = ~blank
    keep[end[end < len(data)]] = True
    text = np.where(blank, np.uint8(32), data)[keep].tobytes()
    start = np.concatenate([[0], np.cumsum(end - first + 1)])
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(first, ends)])
    return Words(hashes, text, start, bounds)


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every position the first anchor of the span that starts there, whether that span is within one text, and the prefix hash of every position."""
    n = len(words.hashes)
    text = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    left = words.bounds[1:][text] - np.arange(n)
    long_enough = np.diff(words.bounds)[text] >= WINDOW
    padded = np.concatenate([words.hashes, np.zeros(GRAM, np.uint64)])
    prefix = np.full(n, GRAM, np.uint64)
    for k in range(GRAM):
        prefix = mix(prefix * np.uint64(0x9E3779B97F4A7C15) + padded[k : k + n])
    least = np.where((left >= GRAM) & long_enough, prefix, _FAR)
    place = np.arange(n)
    step = 1
    while step < SPAN:
        other = np.concatenate([least[step:], np.full(min(step, n), _FAR)])
        other_place = np.concatenate([place[step:], place[n - min(step, n) :]])
        earlier = least <= other
        place = np.where(earlier, place, other_place)
        least = np.where(earlier, least, other)
        step *= 2
    return place, (left >= SPAN + GRAM - 1) & long_enough, mix(prefix)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes | None], int]]:
    texts = batch.column(batch.schema.get_field_index("content")).to_pylist()
    for a, b in in_parts(texts, PART_BYTES):
        yield texts[a:b], a


def _count_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts, _ in _texts(batch):
            place, inside, prefix = anchors(words_of(texts))
            found, count = np.unique(prefix[np.unique(place[inside])], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count.astype(np.int64))], names=["prefix", "n"])


class Filter(NamedTuple):
    """Prefixes that occur more than once, as bits, and those too frequent for one group, sorted."""

    often: Bits
    hot: np.ndarray

    def is_hot(self, prefix: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(prefix), bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, prefix), len(self.hot) - 1)] == prefix


def _filter(given: DataFrame, group_rows: int) -> Filter:
    counted = given.select("content").mapInArrow(_count_anchors, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
    often = materialize(counted.where("n > 1"), "substring-prefixes")
    size, total = often.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most 2^20 prefixes pass a bound that is at least a 2^20th of all occurrences.
    hot = [r[0] for r in often.where(F.col("n") > max(group_rows, total >> 20)).select("prefix").collect()]
    return Filter(bits_of(often, "prefix", size), np.sort(np.array(hot, np.int64).view(np.uint64)))


def candidate_slices(words: Words, seen: Filter) -> list[tuple[int, int, int, int]]:
    """Runs of windows that may be repeated and share their first anchor: group key, text, first word, windows."""
    place, inside, prefix = anchors(words)
    n = len(place)
    if n < WINDOW:
        return []
    dead = np.concatenate([[0], np.cumsum(~(inside & seen.often.may_hold(prefix[place])))])
    live = np.zeros(n, bool)
    last = n - INNER + 1
    live[:last] = dead[INNER:] == dead[:last]
    first = np.flatnonzero(live)
    if not len(first):
        return []
    hot = seen.is_hot(prefix[place[first]])
    new = np.ones(len(first), bool)
    new[1:] = (np.diff(first) > 1) | (np.diff(place[first]) > 0) | hot[1:]
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(first)))
    at = first[starts]
    text = np.searchsorted(words.bounds, at, side="right") - 1
    key = prefix[place[at]].view(np.int64)
    out = []
    for k, t, a, m, h in zip(key.tolist(), text.tolist(), at.tolist(), count.tolist(), hot[starts].tolist(), strict=True):
        if h:
            k = xxhash.xxh3_64_intdigest(_between(words, a, a + WINDOW)) - (1 << 63)
        out.append((k, t, a, m))
    return out


def _between(words: Words, first: int, end: int) -> bytes:
    return words.text[words.start[first] : words.start[end] - 1]


def _slicer(shared):
    names = [c.split()[0] for c in _SLICE.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch in batches:
            parts, places = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for texts, offset in _texts(batch):
                words = words_of(texts)
                same: dict[bytes, list[tuple]] = {}
                for key, text, first, windows in candidate_slices(words, seen):
                    row = (parts[offset + text], places[offset + text], first - int(words.bounds[text]), windows)
                    same.setdefault(_between(words, first, first + windows + WINDOW - 1), []).append((key, *row))
                rows = []
                for content, members in same.items():
                    if len(members) == 1:
                        rows.append((*members[0], content, 1))
                    else:
                        rows.append((members[0][0], None, None, None, members[0][4], content, len(members)))
                        # Known to be repeated: on their way to the texts, spread by place.
                        rows += [(m[1] ^ m[2], *m[1:], None, len(members)) for m in members]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def repeated_windows(slices: list[bytes]) -> list[list[int]]:
    """For every slice the windows that also start elsewhere in the slices.

    The suffixes at all windows are sorted; neighbours that agree in ``WINDOW`` words
    hang below one internal node of that depth or deeper.
    """
    leaves = []
    for number, content in enumerate(slices):
        cuts = np.flatnonzero(np.frombuffer(content, np.uint8) == 32).tolist()
        starts, ends = [0, *[c + 1 for c in cuts]], [*cuts, len(content)]
        leaves += [(content[starts[k] : ends[k + WINDOW - 1]], number, k) for k in range(len(starts) - WINDOW + 1)]
    leaves.sort()
    found: list[list[int]] = [[] for _ in slices]
    start = 0
    for end in range(1, len(leaves) + 1):
        if end == len(leaves) or leaves[end][0] != leaves[start][0]:
            if end - start > 1:
                for _, number, k in leaves[start:end]:
                    found[number].append(k)
            start = end
    return found


def _subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeated windows of every group; a group's rows come together."""
    held: list[tuple] = []

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def flush() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in _HIT.split(", ")])
        held.clear()
        return out

    for _, group in groupby(rows(), key=lambda r: r[0]):
        slices: dict[bytes, list] = {}
        for _, part, at, first, windows, content, copies in group:
            if content is None:
                held.append((part, at, first, windows))
            elif (known := slices.get(content)) is None:
                slices[content] = [part, at, first, windows, copies]
            else:
                if known[4] == 1:
                    held.append(tuple(known[:4]))
                known[4] += copies
                if part is not None:
                    held.append((part, at, first, windows))
            if len(held) >= 20_000:
                yield flush()
        if len(slices) == 1 and next(iter(slices.values()))[3] == 1:
            continue
        for (part, at, first, _, copies), repeated in zip(slices.values(), repeated_windows(list(slices)), strict=True):
            if copies == 1:
                repeated.sort()
                for _, run in groupby(enumerate(repeated), key=lambda p: p[1] - p[0]):
                    ks = [k for _, k in run]
                    held.append((part, at, first + ks[0], len(ks)))
    if held:
        yield flush()


def _keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, hits = (batch.column(k) for k in range(3))
        total, removed, shas = [], [], []
        for text, runs in zip(texts.to_pylist(), hits.to_pylist(), strict=True):
            words = (text or b"").split()
            total.append(len(words))
            if runs:
                change = np.zeros(len(words) + 1, np.int64)
                for run in runs:
                    change[run["first"]] += 1
                    change[run["first"] + run["windows"] + WINDOW - 1] -= 1
                covered = (np.cumsum(change[:-1]) > 0).tolist()
                words = [w for w, c in zip(words, covered, strict=True) if not c]
            removed.append(total[-1] - len(words))
            shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def repeated_runs(given: DataFrame, group_rows: int = 20_000) -> DataFrame:
    """Runs of repeated windows of rows (part, at, content): part, at, first, windows."""
    seen = _filter(given, group_rows)
    shared = given.sparkSession.sparkContext.broadcast(seen)
    slices = given.select("part", "at", "content").mapInArrow(_slicer(shared), _SLICE)
    return slices.repartition("key").sortWithinPartitions("key").mapInArrow(_subtrees, _HIT)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = 20_000) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by a blank)."""
    given = small_batches(row_keys(docs, {"doc_id": F.col(id_col).cast("long"), "content": F.col(text_col).cast("binary")}))
    runs = repeated_runs(given, group_rows).groupBy("part", "at").agg(F.collect_list(F.struct("first", "windows")).alias("hits"))
    # The texts always meet their runs by a shuffle, at every size alike.
    marked = given.join(runs.hint("shuffle_merge"), ["part", "at"], "left").select("doc_id", "content", "hits")
    return marked.mapInArrow(_keep, "doc_id long, n_words long, n_removed long, kept_sha256 string")
