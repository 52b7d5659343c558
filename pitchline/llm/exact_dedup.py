"""Exact deduplication by Grace hashing over complete contents.

Texts are equal when they are identical without ASCII white space. Every Arrow
batch first merges its own copies, so a content that a third of all rows share
costs one row per batch afterwards, whatever the number of its copies. These
rows are dealt out by content hash. A task reads its bucket into an
open-addressing table that compares complete contents; a bucket whose contents
pass ``memory_bytes`` goes to private spill files by further bits of the hash,
each treated in the same way. The files belong to one task attempt, are removed
when it ends, and are never read by another task.

The result returns to the documents by (batch, slot), so no join key is shared
by more rows than one batch holds.

Defined cases: a null text counts as empty; empty texts are equal to each other;
of rows that agree in text, length and ``doc_id`` exactly one stays; an empty
table gives no rows; columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import SPACE, materialize, small_batches

FAN_OUT = 16
_MEMBER = "batch long, slot int, row int, doc_id long, length int, copies long, hash long, content binary, key long"
_GROUP = "batch long, slot int, keep_id long, keep_batch long, keep_row int, group_size long, text_sha256 string"


class ContentTable:
    """An open-addressing table from complete contents to entry numbers."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = np.full(slots, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, key: int, content: bytes) -> int:
        """The entry of ``content``, a new one if it was not there."""
        mask = len(self.slots) - 1
        at = key & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.hashes[entry] == key and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        self.slots[at] = entry = len(self.contents)
        self.hashes.append(key)
        self.contents.append(content)
        self.bytes += len(content) + 100
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = np.full(mask + 1, -1, np.int64)
        for entry, key in enumerate(self.hashes):
            at = key & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(batches):
        ids, lengths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        found, best, copies, slots = ContentTable(), [], [], []
        for row, text in enumerate(batch.column(2).to_pylist()):
            content = (text or b"").translate(None, SPACE)
            slot = found.find(xxhash.xxh3_64_intdigest(content), content)
            slots.append(slot)
            rank = (-lengths[row], ids[row] is None, ids[row] or 0, row)
            if slot == len(best):
                best.append(rank)
                copies.append(1)
            else:
                best[slot] = min(best[slot], rank)
                copies[slot] += 1
        n = len(slots)
        stay = {rank[3]: slot for slot, rank in enumerate(best)}
        told = [stay.get(row, -1) for row in range(n)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([first + number] * n, pa.int64()),
                pa.array(slots, pa.int32()),
                pa.array(range(n), pa.int32()),
                pa.array(ids, pa.int64()),
                pa.array(lengths, pa.int32()),
                pa.array([copies[s] if s >= 0 else 0 for s in told], pa.int64()),
                pa.array([found.hashes[s] - (1 << 63) if s >= 0 else None for s in told], pa.int64()),
                pa.array([found.contents[s] if s >= 0 else None for s in told], pa.binary()),
                batch.column(3),
            ],
            names=[c.split()[0] for c in _MEMBER.split(", ")],
        )


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def grace_groups(rows: Iterator[tuple], memory_bytes: int, folder: str, depth: int = 0) -> Iterator[tuple]:
    """Group rows (batch, slot, row, doc_id, length, copies, hash, content) by content.

    Yields (batch, slot, keep_id, keep_batch, keep_row, group_size, sha256) for
    every row read. Past ``memory_bytes`` all rows, those in the table included,
    go on to ``FAN_OUT`` files by the next bits of the hash. A single content
    larger than the bound stays in the table alone.
    """
    found, groups = ContentTable(), []
    spill: list | None = None

    def out(row: tuple) -> None:
        part = ((row[6] + (1 << 63)) >> (60 - 4 * depth)) & (FAN_OUT - 1)
        if spill[part] is None:
            spill[part] = open(os.path.join(folder, f"{depth}-{part}-{id(spill)}"), "wb")
        pickle.dump(row, spill[part], pickle.HIGHEST_PROTOCOL)

    try:
        for row in rows:
            if spill is not None:
                out(row)
                continue
            entry = found.find(row[6] + (1 << 63), row[7])
            if entry == len(groups):
                groups.append([])
            groups[entry].append(row[:6])
            if found.bytes > memory_bytes and len(found.contents) > 1 and depth < 15:
                spill = [None] * FAN_OUT
                for key, content, members in zip(found.hashes, found.contents, groups, strict=True):
                    for member in members:
                        out((*member, key - (1 << 63), content))
                found, groups = ContentTable(), []
        if spill is not None:
            for f in spill:
                if f is not None:
                    f.close()
                    yield from grace_groups(_spilled(f.name), memory_bytes, folder, depth + 1)
                    os.remove(f.name)
            return
        for content, members in zip(found.contents, groups, strict=True):
            best = min(members, key=lambda m: (-m[4], m[3] is None, m[3] or 0, m[0], m[2]))
            total, sha = sum(m[5] for m in members), hashlib.sha256(content).hexdigest()
            for m in members:
                yield (m[0], m[1], best[3], best[0], best[2], total, sha)
    finally:
        for f in spill or ():
            if f is not None:
                f.close()


def _grouper(memory_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _GROUP.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            held: list[tuple] = []

            def batch() -> pa.RecordBatch:
                columns = zip(*held, strict=True)
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

            for row in grace_groups(_rows(batches), memory_bytes, folder):
                held.append(row)
                if len(held) == 10_000:
                    yield batch()
                    held = []
            if held:
                yield batch()

    return run


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    memory_bytes: int = 128 << 20,
    key_col: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and its ``key`` if a column holds one."""
    text = F.col(text_col)
    given = small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.length(text), F.lit(0)).alias("length"),
        text.cast("binary").alias("content"),
        (F.col(key_col) if key_col else F.lit(None)).cast("long").alias("key"),
    )
    members = materialize(given.mapInArrow(_members, _MEMBER), "dedup-members")
    firsts = members.where(F.col("content").isNotNull()).drop("key").repartition("hash")
    groups = firsts.mapInArrow(_grouper(memory_bytes), _GROUP)
    return (
        members.select("batch", "slot", "row", "doc_id", "key")
        .join(groups, ["batch", "slot"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            ((F.col("batch") == F.col("keep_batch")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
            "text_sha256",
            *(["key"] if key_col else []),
        )
    )
