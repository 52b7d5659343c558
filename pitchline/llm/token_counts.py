"""Token counts of a byte-level BPE tokenizer by a two-tier lookup on the map side.

A text is cut into pre-tokens by the tokenizer's own pattern; the tokens of a
text are the sum over its pre-tokens. Tier one is a compact table, from pre-token
to number of tokens, of the most frequent pre-tokens, broadcast once. Tier two is
a cache in each Python worker: what the table lacks is encoded by the library and
remembered. No pre-token is shuffled; the texts never leave their task.

The table is only a cache, so what it holds changes the speed, not the counts. It
is filled from a bounded sample (``sample_docs`` rows in expectation, of at most
``sample_bytes`` each) and has at most ``table_size`` entries.

Special strings are single tokens, as the library reads them by default. Defined
cases: a null text is empty and has no tokens; texts of any length are counted
whole; equal rows each give a row; columns other than those named are not read.
"""

from __future__ import annotations

import json
from collections import Counter

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import sample_rate, small_batches, uniform

#: The pre-token pattern of byte-level BPE as the library applies it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\p{{White_Space}}\p{{L}}\p{{N}}]").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class TokenCounter(dict):
    """Numbers of tokens of pre-tokens: table, then cache, then the library."""

    CACHE = 300_000
    LONGEST = 64

    def __init__(self, path: str, table: dict[str, int]):
        from tokenizers import Tokenizer

        super().__init__(table)
        self.table = table
        self.tokenizer = Tokenizer.from_file(path)
        self.special = special_strings(path)
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= self.LONGEST:
            if len(self) >= self.CACHE + len(self.table):
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        if self.split is not None and self.split.search(text):
            parts = self.split.split(text)
            return len(parts) - 1 + sum(self._plain(p) for p in parts)
        return self._plain(text)

    def _plain(self, text: str) -> int:
        return sum(map(self.__getitem__, _CUT.findall(text)))


def special_strings(path: str) -> list[str]:
    """Strings that the tokenizer file marks as single tokens, longest first."""
    with open(path, encoding="utf-8") as f:
        return sorted((t["content"] for t in json.load(f)["added_tokens"]), key=len, reverse=True)


_COUNTERS: dict[str, TokenCounter] = {}


def _counter(path: str, table) -> TokenCounter:
    """This worker's counter for a tokenizer; one made with an earlier table counts the same."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path, table.value)
    return _COUNTERS[path]


def frequent_table(docs: DataFrame, path: str, id_col: str, text_col: str, sample_docs: int, sample_bytes: int, table_size: int) -> dict[str, int]:
    """The most frequent pre-tokens of a bounded sample with their token counts."""
    rate = sample_rate(sample_docs, docs.count())
    sample = docs.where((uniform(id_col, 23) < rate) & (F.octet_length(text_col) <= sample_bytes)).select(text_col)
    seen: Counter[str] = Counter()
    for (text,) in sample.toLocalIterator():
        seen.update(_CUT.findall(text))
    counter = TokenCounter(path, {})
    counter.CACHE = table_size + 1
    return {piece: counter[piece] for piece, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:table_size] if len(piece) <= TokenCounter.LONGEST}


def token_counts(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    sample_docs: int = 1000,
    sample_bytes: int = 65_536,
    table_size: int = 50_000,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_table(docs, path, id_col, text_col, sample_docs, sample_bytes, table_size))

    @F.pandas_udf("long")
    def n_tokens(texts):
        counter = _counter(path, table)
        return texts.map(lambda t: counter.count(t) if t else 0)

    text = F.col(text_col)
    return small_batches(docs).select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens(text).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
