"""Exact deduplication, the Jaccard join and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import tempfile
from collections import defaultdict

import numpy as np
import pytest
from helpers import docs, edited, words

import pitchline.llm.components as components_module
from pitchline.llm.common import BATCH_ROWS, hashed_words, materialize, small_batches
from pitchline.llm.components import components
from pitchline.llm.decontamination import align, decontaminate, find_matches
from pitchline.llm.exact_dedup import ContentTable, exact_dedup, grace_groups
from pitchline.llm.jaccard_join import JaccardJoin, least_overlap

WS = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(WS)].append((-len(t or ""), i))
    return {c: (min(g)[1], len(g), hashlib.sha256(c.encode()).hexdigest()) for c, g in groups.items()}


def test_exact_dedup(spark):
    rows = [(1, "a b"), (2, "ab"), (3, " a b "), (4, None), (5, ""), (6, " \n"), (7, "é x"), (8, "éx"), (9, "x" * 300_000), (10, "x" * 300_000)]
    rows += [(11, "same"), (11, "same"), (12, "a b")]
    found = exact_dedup(docs(spark, rows)).collect()
    expected = brute_dedup(rows)
    texts = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        assert (r.keep_id, r.group_size, r.text_sha256) == expected[(texts[r.doc_id] or "").translate(WS)]
    assert sorted(r.doc_id for r in found if r.kept) == sorted(e[0] for e in expected.values())
    assert exact_dedup(docs(spark, [])).collect() == []


def test_hot_copies_over_many_batches(spark):
    rows = [(k, "hot text" if k % 3 == 0 else f"text {k % 50}") for k in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = exact_dedup(docs(spark, rows).repartition(7)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = brute_dedup(rows)
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found} == {(i, *expected[t.translate(WS)][:2]) for i, t in rows}
    assert sum(r.kept for r in found) == len(expected)


def test_grace_spills_and_agrees():
    r = random.Random(1)
    contents = [bytes(r.choices(b"abc", k=r.randrange(1, 400))) for _ in range(300)]
    rows = []
    for k in range(1500):
        c = r.choice(contents)
        rows.append((k, 0, 0, k, len(c), 1, int.from_bytes(hashlib.md5(c).digest()[:8]) - (1 << 63), c))
    with tempfile.TemporaryDirectory() as folder:
        small = sorted(grace_groups(iter(rows), 2_000, folder))
        large = sorted(grace_groups(iter(rows), 1 << 30, folder))
    assert small == large and len(small) == len(rows)


def test_table_compares_contents_not_hashes():
    t = ContentTable(4)
    assert [t.find(5, c) for c in (b"a", b"b", b"a", b"c", b"b")] == [0, 1, 0, 2, 1]


def shingle_sets(rows, n):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        m = min(n, len(w))
        out[i] = {tuple(w[k : k + m]) for k in range(len(w) - m + 1)} if w else set()
    return out


def brute_components(sets, percent):
    low = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            m = min(low[i], low[j])
            changed |= low[i] != m or low[j] != m
            low[i] = low[j] = m
    return low


def near_corpus(groups=6, copies=14, length=90, most=8, seed=3):
    rows, r, at = [], random.Random(seed), 0
    for g in range(groups):
        base = words(length, 100 + g)
        for c in range(copies):
            rows.append((at, " ".join(edited(base, r.randrange(most), 1000 * g + c) if c else base)))
            at += 1
    rows += [(at + k, t) for k, t in enumerate(["", None, "one", "ONE", "one two", "two one", "a b c", "A  b\tC", "a b c d", " ".join(words(30_000, 9, 10**9))])]
    return rows


@pytest.mark.parametrize(("n", "percent", "hot", "cells"), [(3, 90, 100, 1 << 20), (3, 90, 4, 1 << 14), (5, 80, 3, 1 << 14), (2, 60, 5, 1 << 14)])
def test_join_is_exact(spark, n, percent, hot, cells):
    rows = near_corpus()
    sets = shingle_sets(rows, n)
    expected = brute_components(sets, percent)
    found = JaccardJoin(docs(spark, rows), ngram=n, percent=percent, hot=hot, cells=cells, block=8).result().collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(sets[i]), expected[i]) for i in sets}
    assert len(found) == len(rows)


def test_join_tells_rows_apart(spark):
    """Rows that share an id, or have none, are documents of their own."""
    near = near_corpus(groups=3, copies=6)
    r = random.Random(8)
    rows = [(r.choice([None, 5, 5, 6, 7, 1000 + k]), t) for k, (_, t) in enumerate(near)] + [(1, "a b c d")] * 2 + [(None, "lone words of none")]
    sets = shingle_sets(list(enumerate(t for _, t in rows)), 3)
    at = brute_components(sets, 90)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[at[k]] = min(i, least.get(at[k], i))
    expected = sorted(((i, len(sets[k]), least.get(at[k])) for k, (i, _) in enumerate(rows)), key=repr)
    for hot in (100, 2):
        found = JaccardJoin(docs(spark, rows), hot=hot, cells=1 << 14, block=4).result().collect()
        assert sorted((tuple(f)[:3] for f in found), key=repr) == expected


def test_join_empty(spark):
    assert JaccardJoin(docs(spark, [])).result().collect() == []


@pytest.mark.parametrize("rows", [400, 800])
def test_near_copies_give_links_in_proportion(spark, rows):
    """Pages that share all but two words: no block of theirs meets another once pivots join them."""
    shared = [f"s{k}" for k in range(40)]
    pages = [(k, " ".join([*shared, f"x{k}", f"y{k}"])) for k in range(rows)]
    join = JaccardJoin(docs(spark, pages), block=16)
    assert join.links.count() <= 2 * rows
    assert {tuple(r)[:3] for r in join.result().collect()} == {(k, 40, 0) for k in range(rows)}


def test_least_overlap():
    for percent in (60, 80, 90):
        for n in range(1, 60):
            assert least_overlap(n, percent) == min(s for s in range(1, n + 1) if 100 * s >= percent * n)


def test_components_of_a_long_chain(spark):
    r = random.Random(2)
    names = list(range(200))
    r.shuffle(names)
    links = [(names[k], names[k + 1]) for k in range(99)] + [(names[k], names[k + 1]) for k in range(100, 199)] + [(names[0], names[0])]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: min(part) for part in (names[:100], names[100:]) for x in part}


def slow_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_stars_need_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components_module, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    star = [(k % 3, k) for k in range(3, 60)] + [(k, k % 3) for k in range(3, 9)]
    found = components(spark.createDataFrame(star, "a long, b long"))
    assert {(r.node, r.component) for r in found.collect()} == {(k, k % 3) for k in range(60)} and found.count() == 60
    assert len(written) == 1  # the links themselves
    path = components(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"))
    assert {(r.node, r.component) for r in path.collect()} == {(1, 1), (2, 1), (3, 1)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_join_brings_no_rows_to_the_driver_one_by_one(spark, monkeypatch):
    def refused(self, *args, **kwargs):
        raise AssertionError("rows are pickled for the driver")

    rows = [(k, " ".join(words(40, k // 2, 4000))) for k in range(40)]
    expected = {k: k // 2 * 2 for k in range(40)}
    frame = docs(spark, rows)
    for name in ("toPandas", "toLocalIterator"):
        monkeypatch.setattr(type(frame), name, refused)
    assert {r.doc_id: r.component_id for r in JaccardJoin(frame, cells=1 << 14).result().collect()} == expected


def test_scans_decode_few_rows_at_once(spark):
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "4096")
        small_batches(spark.range(1))
        assert int(spark.conf.get(name)) == BATCH_ROWS
        spark.conf.set(name, "100")
        small_batches(spark.range(1))
        assert spark.conf.get(name) == "100"
    finally:
        spark.conf.set(name, before)


def test_alignment_is_smith_waterman():
    r = random.Random(4)
    for _ in range(300):
        a, b = ([r.randrange(1, 5) for _ in range(r.randrange(1, m))] for m in (12, 25))
        score, start, end = align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert score == slow_alignment(a, b)
        assert not score or slow_alignment(a, b[start:end]) == score


def test_edited_copies_are_found(spark):
    items = [(k, " ".join(words(30, 500 + k, 10**6))) for k in range(4)]
    items += [(9, None), (10, ""), (11, "short item"), (12, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    noise = words(200, 77, 10**6)

    def around(inner):
        return " ".join([*noise[:50], *inner, *noise[50:]])

    rows = [
        (1, around(items[0][1].split())),
        (2, around([w.upper() + "," for w in items[1][1].split()])),
        (3, around(edited(items[2][1].split(), 4, 1))),
        (4, around([w for k, w in enumerate(items[3][1].split()) if k % 9])),
        (5, " ".join(noise)),
        (6, None),
        (7, ""),
        (8, around(items[3][1].split()[:6])),
        (13, "a short item here"),
        (14, around(items[1][1].split() + noise[:100] + items[2][1].split())),
    ]
    table = docs(spark, rows)
    for block in (8 << 20, 200):
        found = find_matches(table, bench, block_bytes=block).select("doc_id", "matches").collect()
        assert {r.doc_id: sorted(m.item_id for m in r.matches) for r in found if r.matches} == {1: [0, 12], 2: [1], 3: [2], 4: [3], 13: [11], 14: [1, 2]}
    kept = decontaminate(table, bench)
    assert kept.columns == table.columns
    assert sorted((r.doc_id, r.matches) for r in kept.collect()) == [(5, 7), (6, 7), (7, 7), (8, 7)]
    assert decontaminate(docs(spark, []), bench).collect() == []
    assert decontaminate(table, bench.limit(0)).count() == len(rows)


def test_word_hashes():
    texts = [b"A b\tc  ", None, b"", b" ... *** ", b"\"a, (B) c.", b"x" * 5000 + b" a", b"ab ba aab", b"\xc3\xa9 a"]
    for piece in (1 << 20, 7):
        words, ends = hashed_words(texts, piece=piece)
        assert ends.tolist() == [3, 3, 3, 5, 8, 10, 13, 15]
        assert words[0] == words[9] == words[14] and len(set(words.tolist())) == 13
        words, ends = hashed_words(texts, trim=True, piece=piece)
        assert ends.tolist() == [3, 3, 3, 3, 6, 8, 11, 13] and (words[:3] == words[3:6]).all()
    assert hashed_words([])[0].size == 0
