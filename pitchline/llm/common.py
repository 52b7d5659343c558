"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.settings import materialize

#: ASCII white space as bytes and as a character class.
SPACE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["SPACE", "WORD", "Bits", "bits_of", "hashed_words", "held_out", "in_parts", "let_go", "materialize", "powers", "row_keys", "sample_rate", "span_hashes", "shingles", "small_batches", "table", "uniform"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_keys(docs: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``columns`` of every row, behind (part, at), a key that is the row's own and the same in every scan.

    Rows of a table that is read from files as it stands are told apart by file and place in the
    file, without a copy; any other table is written first.
    """
    chosen = [value.alias(name) for name, value in columns.items()]
    try:
        if "_metadata" not in docs.columns:
            place = [F.xxhash64("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("at")]
            return docs.select(*place, *chosen)
    except AnalysisException:  # not a scan of files with row numbers
        pass
    written = docs.select(*chosen, F.monotonically_increasing_id().alias("at"))
    return materialize(written, "rows").select(F.lit(0).cast("long").alias("part"), "at", *columns)


def let_go(stored: DataFrame) -> None:
    """Has the driver collect its garbage, here and in the JVM, once ``stored`` is written: Spark deletes the shuffles of a job when its plan is collected."""
    gc.collect()
    stored.sparkSession._jvm.System.gc()


#: Rows of text that a Python worker is handed at once; with few rows a batch stays
#: small where texts are long.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SCAN = "spark.sql.parquet.columnarReaderBatchSize"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that decodes and hands to Python at most BATCH_ROWS rows at once."""
    conf = df.sparkSession.conf
    for name in (_BATCH, _SCAN):
        if not 0 < int(conf.get(name)) <= BATCH_ROWS:
            conf.set(name, str(BATCH_ROWS))
    return df


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept out of all learning; one without an id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def uniform(key: str, salt: int = 0) -> Column:
    """A number in [0, 1) that depends on ``key`` alone."""
    return F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def sample_rate(wanted: int, present: int) -> float:
    return 1.0 if present <= wanted else wanted / present


_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_LOW = np.arange(256, dtype=np.uint64)
_LOW[65:91] += 32
_BYTE = mix(_LOW + np.uint64(1))
_BLANK = np.zeros(256, bool)
_BLANK[list(SPACE)] = True
_MARK = np.zeros(256, bool)
_MARK[list(string.punctuation.encode())] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BACK)):
            steps = np.full(1 << (n - 1).bit_length(), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def _hashed(data: np.ndarray, trim: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of a byte array."""
    outside = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], outside, [True]]).view(np.int8)))
    first, end = edge[::2], edge[1::2]
    if trim:
        core = np.flatnonzero(~outside & ~_MARK[data])
        if not len(core):
            return np.zeros(0, np.uint64), first[:0]
        left, right = np.searchsorted(core, first), np.searchsorted(core, end)
        some = left < right
        first, end = core[left[some]], core[right[some] - 1] + 1
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)), first


def hashed_words(texts: list[bytes | None], trim: bool = False, piece: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and where each text's words end.

    A-Z are read as a-z. ``trim`` leaves out ASCII marks at both ends of a word, and
    words made of them alone. Long texts are cut at white space, so the work arrays
    stay small unless a single word is long.
    """
    found, count = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        if held:
            data = np.frombuffer(b"\n".join(t for _, t in held), np.uint8)
            words, first = _hashed(data, trim)
            found.append(words)
            after = np.cumsum([len(t) + 1 for _, t in held])
            np.add.at(count, [k for k, _ in held], np.diff(np.searchsorted(first, after), prepend=0))
            held.clear()

    for k, text in enumerate(texts):
        for part in _cut(text or b"", piece):
            held.append((k, part))
            size += len(part)
            if size >= piece:
                flush()
                size = 0
    flush()
    return np.concatenate(found), np.cumsum(count)


def _cut(text: bytes, piece: int) -> Iterator[bytes]:
    at = 0
    while len(text) - at > piece:
        cut = max(text.rfind(bytes([c]), at, at + piece) for c in SPACE)
        if cut <= at:
            cut = min((x for c in SPACE if (x := text.find(bytes([c]), at + piece)) >= 0), default=len(text))
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


def in_parts(texts: list[bytes | None], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``most`` bytes together."""
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text or b"")
        if size >= most:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of all runs of ``n`` words; a shorter text is one run."""
    if not len(words):
        return words
    n = min(n, len(words))
    last = len(words) - n + 1
    out = np.full(last, n, np.uint64)
    for k in range(n):
        out = mix(out * _ODD[k % 3] + words[k : k + last] + np.uint64(k))
    return np.unique(out)


_PLAIN_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(257))


def span_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [first, end) of ``data``, by content alone."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_PLAIN_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))


MOST_BITS, LEAST_BITS, PIECE_BITS = 29, 17, 17


class Bits(NamedTuple):
    """A set of 64-bit hashes as bits: it may hold more than the set, never less."""

    bits: int
    bitmap: np.ndarray

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bit_piece(piece: pa.Table) -> pa.Table:
    at = piece.column("at").to_numpy()
    bits = np.zeros(1 << PIECE_BITS, bool)
    bits[at & ((1 << PIECE_BITS) - 1)] = True
    packed = np.packbits(bits, bitorder="little").tobytes()
    return pa.table({"piece": pa.array([int(at[0]) >> PIECE_BITS], pa.int64()), "packed": pa.array([packed], pa.binary())})


def bits_of(hashes: DataFrame, column: str, size: int) -> Bits:
    """The bits of a column of ``size`` evenly spread hashes: 16 to 32 a hash, but never more than 2^29 (64 MB).

    Pieces are built in Spark; the driver sees the finished bits alone. Beyond some
    thirty million hashes there are more false hits, which cost work, not results.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * size).bit_length()))
    places = hashes.select(F.expr(f"shiftrightunsigned({column}, {64 - bits})").alias("at"))
    pieces = places.groupBy(F.shiftright("at", PIECE_BITS).alias("piece")).applyInArrow(_bit_piece, "piece long, packed binary")
    bitmap = np.zeros(1 << bits - 3, np.uint8)
    for piece, packed in pieces.toLocalIterator():
        start = piece << PIECE_BITS - 3
        bitmap[start : start + len(packed)] = np.frombuffer(packed, np.uint8)
    return Bits(bits, bitmap)
