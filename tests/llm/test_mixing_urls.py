"""Mixing, URL filtering, the queries against their SQL and the pipeline."""

from __future__ import annotations

import os
import sys

import duckdb
import numpy as np
import pytest
from helpers import docs, edited, words

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from pitchline.llm.mixing import in_training_order, mix, when_demanded  # noqa: E402
from pitchline.llm.queries import ORACLE, QUERIES, RULES  # noqa: E402
from pitchline.llm.url_filter import url_filter  # noqa: E402

SF = "/root/testdata/sf0.001"


def water_level(sizes, most=3, weights=(1, 2, 3)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    free, target, left = set(names), {}, float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total >= most * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in free}
        target |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def test_mix(spark):
    sizes = {"a": 60, "b": 2, None: 40, "c": 9, "e": 0, "\U0001f642": 7, "Z": 30}
    rows, at = [], 0
    for source, n in sizes.items():
        for k in range(n):
            rows.append((at, " ".join(["w"] * (1 + k % 5)), "en", source))
            at += 1
    rows += [(at, None, "en", "e"), (at + 1, " \n", "en", "e"), (0, "w", "en", "a"), (0, "w", "en", "a"), (at + 2, "w " * 100_000, "en", "c")]
    found = mix(docs(spark, rows)).collect()
    assert len(found) == len(rows)
    total = {s: sum(r["size"] for r in found if r["source"] == s) for s in sizes}
    target = water_level(total)
    for s in sizes:
        own = [r for r in found if r["source"] == s]
        assert all(r["target"] == pytest.approx(target[s]) and r["source_size"] == total[s] for r in own)
        assert sum(r["taken"] for r in own) == pytest.approx(target[s], abs=0.51)
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["taken"] > 0) == bool(r["positions"])
        assert all(0 <= p <= 1 for p in r["positions"]) and list(r["positions"]) == sorted(r["positions"])
    again = mix(docs(spark, rows).repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"], r["positions"]) for r in again) == sorted((r["doc_id"], r["taken"], r["positions"]) for r in found)
    order = [r["position"] for r in in_training_order(mix(docs(spark, rows))).collect()]
    placed = [p for p in order if p is not None]
    assert placed == sorted(placed) and order[len(placed) :] == [None] * (len(order) - len(placed))
    assert mix(docs(spark, [])).collect() == []


def test_schedule_is_inverted(spark):
    shares = [k / 20 for k in range(21)]
    rows = spark.createDataFrame([(s, a) for s in shares for a in (-0.5, 0.0, 0.5)], "share double, slope double")
    for r in rows.select("*", when_demanded(rows.share, rows.slope).alias("t")).collect():
        assert (1 - r.slope) * r.t + r.slope * r.t**2 == pytest.approx(r.share)


def test_rules_and_reputation(spark):
    pages, labels, at = [], [], 0

    def add(url, good=(), n=1):
        nonlocal at
        for k in range(n):
            pages.append((at, url, "x", "y"))
            labels.extend((at, g) for g in (good[k : k + 1] if good else ()))
            at += 1
        return at - 1

    add("https://good.site.org/a", [1] * 30, 30)
    add("https://bad.site.org/a", [0] * 30, 30)
    add("https://fine.other.org/a", [1] * 20, 20)
    new = add("https://new.other.org/b")
    bad = add("https://BAD.site.org/new?x")
    cases = {
        add("http://Example.com/en/x"): ("example.com", "/en/x", "example.com/en/", "block"),
        add("http://m.www.example.com/en/"): ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
        add("http://myexample.com/en/x"): ("myexample.com", "/en/x", "com/", "allow"),
        add("http://example.com"): ("example.com", "", None, None),
        add("x://a.net/es/#f"): ("a.net", "/es/", "net/es/", "block"),
        add("http://a.net/en?/es/"): ("a.net", "/en", None, None),
        add("ftp://x.com/a://b"): ("x.com", "/a://b", "com/", "allow"),
        add(None): ("", "", None, None),
        add("no scheme.com/"): ("", "", None, None),
    }
    labels.append((at + 5, 1))
    table = spark.createDataFrame(pages, "page_id long, url string, host string, good string")
    given = spark.createDataFrame([*labels, (0, None)], "page_id long, good int")
    found = {r.page_id: r for r in url_filter(table, given, RULES).collect()}
    assert len(found) == len(pages)
    for page, (host, path, rule, verdict) in cases.items():
        assert (found[page].host, found[page].path, found[page].rule) == (host, path, rule)
        assert verdict is None or found[page].verdict == verdict
    assert found[0].verdict == "allow" and found[30].verdict == found[bad].verdict == "block" and found[new].verdict in ("allow", "block")
    assert url_filter(table, given.limit(0), RULES).count() == len(pages)
    assert url_filter(table.limit(0), given, RULES).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    found = QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = con.execute(ORACLE[name]).df()[list(found.columns)]
    key = list(found.columns)
    a, b = (x.sort_values(key).reset_index(drop=True) for x in (found, expected))
    assert len(a) == len(b)
    for c in key:
        if a[c].dtype.kind == "f":
            assert np.allclose(a[c], b[c])
        else:
            assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


def test_pipeline_keeps_what_is_clean(spark, tmp_path):
    base = words(120, 1, 10**6)
    item = words(30, 2, 10**6)
    rows = [(k, " ".join(words(60, 50 + k, 10**6)), "en", f"s{k % 4}") for k in range(40)]
    rows += [(100, rows[3][1] + " ", "en", "s1"), (101, None, "en", "s1"), (102, "12 34", "en", "s1"), (103, " ".join(base), "en", "s2")]
    rows += [(104, " ".join(edited(base, 1, 5)), "en", "s2"), (105, " ".join(words(40, 900, 10**6) + item), "en", "s3"), (106, rows[4][1], "en", None), (106, rows[4][1], "en", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, size long, position double, keep long"
    spark.createDataFrame([(*r, 1, 2, 0.5, 3) for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    rows_out = out.collect()
    assert {(r.n_chars, r.size, r.position, r.keep) for r in rows_out} == {(1, 2, 0.5, 3)}  # columns of the table stay as they are
    ids = sorted(r.doc_id for r in rows_out)
    # of equal texts the one with more characters stays, then the smaller id
    assert ids == sorted([k for k in range(40) if k != 3] + [100, 103])
    docs_in = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs_in, str(tmp_path)).columns == docs_in.columns
        assert stage(spark, docs_in.limit(0), str(tmp_path)).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs_in.limit(0), str(tmp_path)).collect() == []


def test_pipeline_drops_rows_not_ids(spark, tmp_path):
    long, other = words(120, 31, 10**6), words(300, 32, 10**6)
    texts = [(7, words(60, 30, 10**6)), (None, words(60, 30, 10**6)), (None, words(60, 33, 10**6))]  # the copy has a null id, as a clean text has
    texts += [(8, long), (None, edited(long, 1, 5)), (None, edited(long, 1, 6))]  # near copies with null ids
    texts += [(9, other), (9, words(50, 34, 10**6)), (10, edited(other, 1, 7)), (5, edited(other, 1, 8)), (9, words(50, 34, 10**6))]  # id 9 has a near copy and a clean text
    rows = [(i, " ".join(t), "en", f"s{k % 2}") for k, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "no such item in any text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = [rows[k][:2] for k in (0, 2, 3, 7, 9)]
    assert sorted((r.doc_id or -1, r.text) for r in out) == sorted((i or -1, t) for i, t in want)
