"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of up to ``order`` bytes. A byte that
followed a context in training costs -log2(c / (n + d)); a context that never
saw it costs its escape, -log2(d / (n + d)), and hands over to the context
shorter by one byte (method C: n occurrences, d different bytes, no exclusions),
down to one of 256 bytes. The statistics are frozen after training, so the cost
of a byte depends on its context alone, a context's costs are summed over all
languages at once, and the code length of a text is exact whatever the cuts.

Training: at most ``sample_docs`` rows a language in expectation, of at most
``sample_bytes`` each, are drawn by a hash of the id; counts are summed by Spark.
Both bounds, which bound the model too, are parameters. Every text is scored
whole.

Texts are reduced before coding: ASCII letters to lower case, runs of other ASCII
characters to one blank. Defined cases: a null text, or one without a letter of
any script, is ``und`` with score 0; equal code lengths go to the first language
in code-point order; without training rows every text is ``und``; a row without an
id is predicted like any other and not held out; columns other than those named are
not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import in_parts, small_batches, uniform

UND = "und"
_REDUCE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def reduced(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, ``order`` blanks before each; ends of the texts."""
    pad = b" " * order
    joined = np.frombuffer(b"".join(pad + t.translate(_REDUCE) for t in texts), np.uint8)
    ends = np.cumsum([order + len(t) for t in texts])
    blank = joined == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    for k in range(order):
        keep[starts + k] = True
    return joined[keep], np.cumsum(keep)[ends - 1]


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte from ``order`` on: itself below the ``order`` bytes before it."""
    out = np.zeros(max(0, len(data) - order), np.uint64)
    for k in range(order + 1):
        out = (out << np.uint64(8)) | data[k : k + len(out)].astype(np.uint64)
    return out


class Lookup:
    """An open-addressing table from 64-bit keys to row numbers, read in bulk."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where it is absent."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        at = self._home(keys)
        row = self.slots[at]
        same = (row >= 0) & (self.keys[row] == keys)
        out[same] = row[same]
        left = np.flatnonzero(~same & (row >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            row = self.slots[at]
            same = (row >= 0) & (self.keys[row] == keys[left])
            out[left[same]] = row[same]
            more = ~same & (row >= 0)
            left, at = left[more], at[more]
        return out


class PpmModel:
    """Frozen context statistics of several languages."""

    def __init__(self, languages: list[str], prior: np.ndarray, keys: np.ndarray, counts: np.ndarray, order: int):
        """``counts``: a row for each gram of ``order`` + 1 bytes, a column for each language."""
        self.languages, self.order = languages, order
        self.prior_bits = -np.log2(prior)
        self.levels: list[tuple[Lookup, np.ndarray, Lookup, np.ndarray]] = []
        below = None
        for k in range(order + 1):
            grams_k, at = np.unique(keys & np.uint64((1 << (8 * (k + 1))) - 1), return_inverse=True)
            count = np.zeros((len(grams_k), len(languages)))
            np.add.at(count, at, counts)
            contexts, of = np.unique(grams_k >> np.uint64(8), return_inverse=True)
            n, d = (np.zeros((len(contexts), len(languages))) for _ in range(2))
            np.add.at(n, of, count)
            np.add.at(d, of, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(n > 0, -np.log2(d / (n + d)), 0.0)
                direct = -np.log2(count / (n + d)[of])
            lower = 8.0 if below is None else below(grams_k & np.uint64((1 << (8 * k)) - 1))
            cost = np.where(count > 0, direct, escape[of] + lower)
            self.levels.append((Lookup(grams_k), cost.astype(np.float32), Lookup(contexts), escape.astype(np.float32)))
            below = lambda x, top=k: self.cost(x, top)

    def cost(self, keys: np.ndarray, top: int | None = None) -> np.ndarray:
        """Bits for the last byte of each gram, a column for each language."""
        top = self.order if top is None else top
        if top < 0:
            return np.full((len(keys), len(self.languages)), 8.0, np.float32)
        seen, cost, contexts, escape = self.levels[top]
        row = seen.rows(keys)
        out = cost[row]
        miss = np.flatnonzero(row < 0)
        if len(miss):
            left = keys[miss]
            context = contexts.rows(left >> np.uint64(8))
            add = escape[context]
            add[context < 0] = 0
            out[miss] = add + self.cost(left & np.uint64((1 << (8 * top)) - 1), top - 1)
        return out

    def code_lengths(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text by language, and its number of coded bytes."""
        data, ends = reduced(texts, self.order)
        starts = np.concatenate([[0], ends[:-1]])
        keys = grams(data, self.order)
        total = np.zeros((len(keys) + 1, len(self.languages)))
        for a in range(0, len(keys), 1 << 18):
            total[a + 1 : a + 1 + (1 << 18)] = self.cost(keys[a : a + (1 << 18)])
        np.cumsum(total, axis=0, out=total)
        return total[ends - self.order] - total[starts], ends - starts - self.order


def _counter(order: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                data, ends = reduced(texts, order)
                keys = grams(data, order)
                inside = np.ones(len(keys), bool)
                for end in ends[:-1]:
                    inside[end - order : end] = False
                found, n = np.unique(keys[inside], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array(found.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
                )

    return run


def train(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = 4,
    sample_docs: int = 1500,
    sample_bytes: int = 65_536,
) -> PpmModel:
    """Context statistics from the rows where ``learn`` holds."""
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6")
    rows = small_batches(docs).where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    present = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    languages = sorted(present)
    rate = F.lit(0.0)
    for lang, n in present.items():
        rate = F.when(F.col(lang_col) == lang, min(1.0, sample_docs / n)).otherwise(rate)
    sample = rows.where((uniform(id_col, 17) < rate) & (F.octet_length(text_col) <= sample_bytes))
    counted = (
        sample.select(lang_col, F.col(text_col).cast("binary"))
        .mapInArrow(_counter(order), "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    keys, at = np.unique(counted["gram"].to_numpy().astype(np.uint64), return_inverse=True)
    counts = np.zeros((len(keys), len(languages)), np.float64)
    column = pc.index_in(counted["lang"], pa.array(languages, counted["lang"].type)).to_numpy()
    counts[at, column] = counted["n"].to_numpy()
    prior = np.array([present[lang] for lang in languages], float)
    return PpmModel(languages, prior / max(1.0, prior.sum()), keys, counts, order)


_OUT = "lang_pred string, score double, bits_per_byte double"


def identify(docs: DataFrame, model: PpmModel, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a column ``name``, a struct of lang_pred, score and bits_per_byte.

    score: the posterior probability of lang_pred under the code lengths and the
    languages' shares in training. bits_per_byte: its code length for a byte.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(_OUT)
    def score(texts):
        import pandas as pd

        m = shared.value
        texts = [t or "" for t in texts]
        known = np.array([bool(m.languages) and any(map(str.isalpha, t)) for t in texts], bool)
        best, prob, rate = np.full(len(texts), UND, object), np.zeros(len(texts)), np.zeros(len(texts))
        at = np.flatnonzero(known)
        known = [texts[i].encode() for i in at]
        for a, b in in_parts(known, 1 << 20):
            bits, coded = m.code_lengths(known[a:b])
            rows = at[a:b]
            whole = bits + m.prior_bits
            choice = whole.argmin(axis=1)
            low = whole.min(axis=1)
            best[rows] = np.array(m.languages, object)[choice]
            prob[rows] = 1 / np.exp2(np.maximum(low[:, None] - whole, -1000)).sum(axis=1)
            rate[rows] = bits[np.arange(b - a), choice] / np.maximum(coded, 1)
        return pd.DataFrame({"lang_pred": best, "score": prob, "bits_per_byte": rate})

    return small_batches(docs).withColumn(name, score(F.col(text_col)))


def accepted(language: Column, most_bits: float = 8.0) -> Column:
    """Whether some language codes the text in fewer bits than plain bytes take."""
    return (language["lang_pred"] != UND) & (language["bits_per_byte"] < most_bits)
