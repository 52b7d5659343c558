"""A Merkle manifest of a dataset, with a witness for every row.

A row is a leaf; the leaves of one tree (here: of one language) stand in order, and
every ``ARITY`` consecutive nodes of a level become one node above until one is
left, the subroot. The subroots, ordered by tree, are the leaves of a last tree
whose top is the root. The witness of a leaf is, level by level, the digests left
and right of its way up; with them anyone recomputes the root from the leaf alone.

Witnesses grow by aligned append (``OpenSubtrees``): a node that joins the open run
of its level gives all leaves below it one entry that holds the siblings before it,
and each sibling completed later is added to the entries of the run. Spark deals
the leaves out in aligned blocks of ``BLOCK`` leaves, each appended by one task; the
block roots are appended to the level above in the same way, block by block again,
so no task sees more than ``BLOCK`` nodes of a tree at once and the number of rounds
is the logarithm of the largest tree.

``append`` adds rows behind the stored ones: full blocks stay as they are, open
blocks are gone on with, and the block roots rise anew.

Defined cases: a null field is hashed as ``-``; rows without an id come first, rows
that agree in the order are ordered by digest; a tree of one leaf has that leaf as
its subroot; an empty table gives no rows; other columns of the table, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.llm.common import materialize

ARITY = 8
#: Levels that one task builds; a block holds ARITY ** LEVELS nodes.
LEVELS = 4
BLOCK = ARITY**LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_WITNESS = "array<struct<left:string,right:string>>"
_NODE = ("tree", "pos", "n", "digest")


def digest_of(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class OpenSubtrees:
    """The open right edge of a tree of known height to which nodes are appended.

    ``witness[k]`` lists for the k-th appended node one entry [left, rights] a level;
    the entry of a node is shared by everything below it.
    """

    def __init__(self, levels: int):
        self.levels = levels
        self.runs: list[list[tuple]] = [[] for _ in range(levels + 1)]
        self.witness: list[list] = []

    def append(self, digest: str) -> None:
        self.witness.append([])
        self._join(0, digest, len(self.witness) - 1)

    def _join(self, level: int, digest: str, first: int) -> None:
        run = self.runs[level]
        if level == self.levels:
            run.append((digest, first, None))
            return
        entry = ["".join(d for d, _, _ in run), []]
        for _, _, other in run:
            other[1].append(digest)
        for below in self.witness[first:]:
            below.append(entry)
        run.append((digest, first, entry))
        if len(run) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        self._join(level + 1, digest_of(d for d, _, _ in run), run[0][1])

    def close(self) -> str:
        """Complete the open runs, shorter ones too, and return the top digest."""
        for level in range(self.levels):
            if self.runs[level]:
                self._complete(level)
        return self.runs[self.levels][0][0]


def _witness_array(subtrees: list[OpenSubtrees]) -> pa.Array:
    offsets, left, right = [0], [], []
    for subtree in subtrees:
        joined = {}
        for entries in subtree.witness:
            for entry in entries:
                text = joined.get(id(entry))
                if text is None:
                    text = joined[id(entry)] = "".join(entry[1])
                left.append(entry[0])
                right.append(text)
            offsets.append(len(left))
    pair = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pair)


def _appender(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Append the nodes of each block, which come together and in order; add block root and witness."""
    parts: list[pa.RecordBatch] = []
    subtrees: list[OpenSubtrees] = []
    roots: list[str] = []
    current = None

    def finish() -> None:
        if len(roots) < len(subtrees):
            roots.append(subtrees[-1].close())

    def flush() -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        tops = pa.array([root for root, s in zip(roots, subtrees, strict=True) for _ in s.witness], pa.string())
        out = pa.RecordBatch.from_arrays([*rows.columns, tops, _witness_array(subtrees)], names=[*rows.schema.names, "root", "witness"])
        for held in (parts, subtrees, roots):
            held.clear()
        return out

    for batch in batches:
        start = 0
        trees, places, sizes, digests = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in _NODE)
        for row, (tree, pos, n, digest) in enumerate(zip(trees, places, sizes, digests, strict=True)):
            block = (tree, pos // BLOCK)
            if block != current:
                finish()
                if row > start:
                    parts.append(batch.slice(start, row - start))
                    start = row
                if sum(len(s.witness) for s in subtrees) >= BLOCK:
                    yield flush()
                current = block
                subtrees.append(OpenSubtrees(min(LEVELS, height(n))))
            subtrees[-1].append(digest)
        if batch.num_rows > start:
            parts.append(batch.slice(start))
    finish()
    if parts:
        yield flush()


def _rise(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``root`` and ``witness`` within their block of ``BLOCK`` nodes."""
    block = F.expr(f"pos div {BLOCK}")
    dealt = nodes.repartition("tree", block).sortWithinPartitions("tree", "pos")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return materialize(dealt.mapInArrow(_appender, f"{schema}, root string, witness {_WITNESS}"), "merkle")


def _next_level(done: DataFrame) -> DataFrame:
    """The block roots as nodes of the next round, one for each block."""
    first = done.where(f"pos % {BLOCK} = 0")
    return first.selectExpr("tree", f"pos div {BLOCK} AS pos", f"(n + {BLOCK - 1}) div {BLOCK} AS n", "root AS digest")


def _in_order(rows: DataFrame, order: Sequence[str], taken: DataFrame | None = None) -> DataFrame:
    """Add ``pos``, the place within the tree, and ``n``, the size of the tree.

    The rows are sorted by ranges, so a tree that holds most rows spreads over many
    tasks; the counts of the ranges give the places. ``taken`` (tree, n) are places
    that earlier rows hold.
    """
    spread = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    spread = materialize(spread.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    spread = spread.withColumn("_part", F.expr("shiftright(_at, 33)"))
    runs = spread.groupBy("tree", "_part").agg(F.expr("count(1) AS _rows"), F.expr("min(_at) AS _first"))
    by_part = Window.partitionBy("tree").orderBy("_part")
    runs = runs.select(
        F.col("tree").alias("_tree"), F.col("_part").alias("_run"), "_first",
        F.coalesce(F.sum("_rows").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy("tree")).alias("n"),
    )
    if taken is not None:
        held = taken.selectExpr("tree AS _held", "n AS _taken")
        runs = runs.join(held, F.col("_tree").eqNullSafe(F.col("_held")), "left").selectExpr(
            "* EXCEPT (_held, _taken, n, _before)", "_before + coalesce(_taken, 0) AS _before", "n + coalesce(_taken, 0) AS n"
        )
    placed = spread.join(runs, (F.col("_part") == F.col("_run")) & F.col("tree").eqNullSafe(F.col("_tree")))
    return placed.selectExpr(*rows.columns, "_before + _at - _first AS pos", "n")


def _to_the_top(done: DataFrame) -> DataFrame:
    """Per block of ``done``: ``above``, the witness from its root on, and the top digest of its tree."""
    rounds = []
    nodes = _next_level(done)
    size = nodes.agg(F.max("n")).first()[0] or 0
    while size > 1:
        rounds.append(_rise(nodes))
        nodes = _next_level(rounds[-1])
        size = -(-size // BLOCK)
    above = nodes.selectExpr("tree", "pos", "digest AS top", f"CAST(array() AS {_WITNESS}) AS above")
    for level in reversed(rounds):
        above = _with_above(level, above).selectExpr("tree", "pos", "top", "concat(witness, above) AS above")
    return above


def _with_above(done: DataFrame, above: DataFrame) -> DataFrame:
    upper = above.selectExpr("tree AS _tree", "pos AS _block", "top", "above")
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.expr(f"pos div {BLOCK}") == F.col("_block"))
    return done.join(upper, same).drop("_tree", "_block")


def encoded(fields: Iterable[Column]) -> Column:
    """The text whose hash is a leaf: each value as byte count, colon and value, ``-`` for null."""
    values = [f.cast("string") for f in fields]
    return F.concat(*[F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v), F.lit(":"), v)) for v in values])


class Manifest(NamedTuple):
    """Stored leaves with their witness within their block, and what lies above the blocks."""

    leaves: DataFrame
    above: DataFrame

    def rows(self) -> DataFrame:
        """One row per leaf: its columns, the whole witness, subroot and root."""
        full = _with_above(self.leaves, self.above)
        return full.selectExpr(
            "* EXCEPT (pos, n, root, witness, above, top, digest)", "digest AS leaf", "concat(witness, above) AS witness",
            "top.subroot AS subroot", "top.root AS root",
        )


def _finished(leaves: DataFrame) -> Manifest:
    to_subroot = _to_the_top(leaves)
    subroots = to_subroot.where("pos = 0").selectExpr("tree AS name", "top AS digest")
    ordered = _in_order(subroots.selectExpr("CAST(NULL AS string) AS tree", "name", "digest"), ["name"])
    crown = _rise(ordered)
    tops = _with_above(crown, _to_the_top(crown)).selectExpr("name", "top AS the_root", "concat(witness, above) AS crown")
    joined = to_subroot.join(tops, F.col("tree").eqNullSafe(F.col("name")))
    above = joined.selectExpr("tree", "pos", "struct(top AS subroot, the_root AS root) AS top", "concat(above, crown) AS above")
    return Manifest(leaves, materialize(above, "merkle-above"))


def build(leaves: DataFrame, order: Sequence[str] = ("doc_id",)) -> Manifest:
    """The manifest of ``leaves``: columns tree, digest, those of ``order`` and any others, which are carried."""
    return _finished(_rise(_in_order(leaves, [*order, "digest"])))


def append(manifest: Manifest, leaves: DataFrame, order: Sequence[str] = ("doc_id",)) -> Manifest:
    """The manifest with ``leaves`` added, each tree's behind those it holds.

    Only the open last blocks are appended to anew; full blocks keep their witnesses.
    """
    sizes = manifest.leaves.where(f"pos % {BLOCK} = 0").select("tree", "n").distinct()
    columns = [c for c in manifest.leaves.columns if c not in ("root", "witness")]
    fresh = _in_order(leaves, [*order, "digest"], taken=sizes).select(*columns)
    grown = fresh.groupBy("tree").agg(F.max("n").alias("_n")).withColumnRenamed("tree", "_tree")
    stored = manifest.leaves.join(grown, F.col("tree").eqNullSafe(F.col("_tree")), "left")
    full = stored.withColumn("_full", F.expr(f"_n IS NULL OR (pos div {BLOCK} + 1) * {BLOCK} <= n"))
    full = full.selectExpr("* EXCEPT (_tree, _n, n)", "coalesce(_n, n) AS n")
    open_rows = full.where("NOT _full").select(*columns).unionByName(fresh)
    kept = full.where("_full").select(*manifest.leaves.columns)
    return _finished(materialize(kept.unionByName(_rise(open_rows)), "merkle-appended"))


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and a witness lead to."""
    return F.aggregate(witness, leaf, lambda acc, w: F.sha2(F.concat(w["left"], acc, w["right"]), 256))


def proof(witness: Column) -> Column:
    """The siblings of all levels as one text, the lowest level first."""
    return F.array_join(F.transform(witness, lambda w: F.concat(w["left"], w["right"])), "")


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents, a tree for each language, with the leaf a tampered text would have.

    The texts of ids whose crc32 three divides are tampered with: A-Z become a-z.
    """
    whole = [F.col(c) for c in FIELDS]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaf = F.sha2(encoded(whole), 256)
    changed = F.when(tampered, F.sha2(encoded([*whole[:-1], lower]), 256))
    kept = docs.select(F.col("lang").cast("string").alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("digest"), changed.alias("changed"))
    return materialize(kept.select("tree", "doc_id", "digest", F.coalesce("changed", "digest").alias("shown")), "merkle-leaves")


def verified_documents(manifest: Manifest) -> DataFrame:
    """One row per document: leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = manifest.rows().withColumn("folded_root", fold(F.col("shown"), F.col("witness")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("witness")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )

