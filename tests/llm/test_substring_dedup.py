"""Substring deduplication against a count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import docs, words

from pitchline.llm import substring_dedup as sd
from pitchline.llm.common import Bits
from pitchline.llm.queries import op13_substring_dedup


def brute(rows):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[k : k + 35]) for _, w in split for k in range(len(w) - 34))
    out = []
    for i, w in split:
        covered = [False] * len(w)
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                covered[k : k + 35] = [True] * 35
        kept = [x for x, c in zip(w, covered) if not c]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def cases():
    passage, other = words(60, 1), words(35, 2)
    r = random.Random(3)
    rows = [(k, " ".join(words(20, 100 + k) + passage[r.randrange(20) : r.randrange(40, 61)] + words(r.randrange(50), 500 + k))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, " ".join(other)), (204, "\t".join(other)), (205, " ".join(other[:34])), (206, " ".join(w.upper() for w in other))]
    rows += [(300, "la " * 60), (301, "la " * 34), (302, "la " * 35), (303, " ".join(words(50, 7) * 2))]
    rows += [(None, "\n".join(passage)), (None, None), (3, rows[3][1]), (3, rows[3][1]), (400, " ".join(words(60_000, 9, 50) + other))]
    control = [f"\x01{k}\x00é" for k in range(40)]
    rows += [(500, " ".join(control)), (501, "x " + "\x0b".join(control)), (502, " ".join(control[:-1]) + "\x00")]
    return rows


@pytest.mark.parametrize("group_rows", [1, 20_000])
def test_against_all_windows(spark, group_rows):
    rows = cases()
    given = docs(spark, rows).selectExpr("*", "1 AS part", "2 AS at", "3 AS key", "4 AS first", "5 AS content", "6 AS hits", "7 AS windows")
    assert found(sd.substring_dedup(given.repartition(5), group_rows=group_rows)) == brute(rows)


def test_registered_query(spark, tmp_path):
    """On files: rows are told apart by their place, ids repeat and are null."""
    rows = cases()
    docs(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    assert found(op13_substring_dedup(spark, str(tmp_path))) == brute(rows)


def test_empty_table(spark):
    assert found(sd.substring_dedup(docs(spark, []))) == []


def test_equal_windows_have_equal_anchors():
    """Wherever a window stands, its first anchor is at the same place in it."""
    passage = [w.encode() for w in words(80, 4)]
    texts = [b" ".join([w.encode() for w in words(k, k)] + passage) for k in (0, 3, 40)]
    found_words = sd.words_of(texts)
    place, inside, prefix = sd.anchors(found_words)
    ends = found_words.bounds[1:]
    for k in range(46):
        seen = {(int(place[e - 80 + k] - (e - 80 + k)), int(prefix[place[e - 80 + k]])) for e in ends}
        assert len(seen) == 1 and all(inside[e - 80 + k] for e in ends)


def test_subtree_compares_words():
    common = [f"c{k}" for k in range(40)]
    slices = [" ".join(common).encode(), " ".join(["x", *common[1:36]]).encode(), " ".join(common[1:35] + ["c35x"]).encode()]
    assert [sorted(f) for f in sd.repeated_windows(slices)] == [[1], [1], []]


def test_filter_has_no_false_misses():
    r = np.random.default_rng(1)
    prefixes = r.integers(0, 2**63, 500).astype(np.uint64)
    bitmap = np.zeros(1 << 13, np.uint8)
    at = prefixes >> np.uint64(64 - 16)
    np.bitwise_or.at(bitmap, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
    seen = sd.Filter(Bits(16, bitmap), np.sort(prefixes[:5]))
    assert seen.often.may_hold(prefixes).all() and seen.is_hot(prefixes).sum() == 5
