"""Small tables for the operators of the training-data pipeline."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, matches int, batch int, node long"
#: Columns with names that operators use themselves.
EXTRA = (0.5, 7, 1, 2)


def docs(spark, rows, schema=DOCS):
    """Documents from (doc_id, text[, lang[, source]]), with clashing extra columns."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, *[None] * (4 - len(row)))
        full.append((doc_id, text, lang, source, len(text or ""), *EXTRA))
    return spark.createDataFrame(full, schema)


def words(n: int, seed: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def edited(given: list[str], places: int, seed: int) -> list[str]:
    r = random.Random(seed)
    out = list(given)
    for k in r.sample(range(len(out)), places):
        out[k] = f"new{r.randrange(10**9)}"
    return out
