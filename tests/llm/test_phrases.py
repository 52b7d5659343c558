"""Phrase mining against a count of all phrases in memory."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from helpers import docs

from pitchline.llm import phrases


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        listed = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in listed.items():
            inside = [b for q, b in listed.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in inside):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, text, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, text.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, n=250):
    r = random.Random(seed)
    vocabulary = ["a", "b", "c", "d", "é", "le", "tion", "X", "x\x01", "\xa0", "_"]
    marks = [" ", " ", " ", "\t", ". ", ",", "\n", "; ", "\r\n", " ! "]
    rows = []
    for k in range(n):
        text = "".join(r.choice(vocabulary) + r.choice(marks) for _ in range(r.randrange(40)))
        rows.append((k, text + " Red herring soup of day" * (k % 4 == 0), r.choice(["en", "en", "en", "de", None, "und"])))
    rows += [(1000, None, "en"), (1001, "", None), (1002, "word", "solo"), (None, "a b c d " * 40, "en"), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2])]
    return [*rows, (1003, "hot phrase " * 30_000, "fr")]


def found(df):
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("block_entries, pass_blocks, least, top", [(250_000, 4, 30, 2000), (40, 3, 5, 25)])
def test_against_all_phrases(spark, block_entries, pass_blocks, least, top):
    rows = texts(1)
    given = docs(spark, rows).selectExpr("*", "1 AS phrase", "2 AS hash", "3 AS n", "4 AS block", "5 AS state").repartition(4)
    got = found(phrases.collocations(given, least=least, top=top, block_entries=block_entries, pass_blocks=pass_blocks))
    assert got == brute(rows, least, top) and len(got) > 5


def test_empty_table(spark):
    assert found(phrases.collocations(docs(spark, []))) == []


def test_trie_steps():
    r = random.Random(2)
    paths = sorted({tuple(f"w{int(r.paretovariate(0.6)) % 300}" for _ in range(r.randrange(1, 5))) for _ in range(3000)})
    trie, ends = phrases.build_trie(paths)
    number = {label: k for k, label in enumerate(trie.labels)}
    assert len(set(ends)) == len(paths)
    known = {p[:k] for p in paths for k in range(1, len(p) + 1)}
    for path, end in zip(paths, ends, strict=True):
        state = np.zeros(1, np.int64)
        for label in path:
            state = trie.step(state, np.array([number[label]], np.int64))
        assert state[0] == end
        for label in ("w1", "w2", "w299"):
            goes_on = label in number and trie.step(state, np.array([number[label]], np.int64))[0] >= 0
            assert goes_on == ((*path, label) in known)
    assert trie.step(np.zeros(1, np.int64), np.array([-1], np.int64))[0] == -1


def test_a_position_is_looked_up_in_the_blocks_of_its_first_words_alone(monkeypatch):
    r = random.Random(3)
    texts = [" ".join(f"w{int(r.paretovariate(0.8)) % 60}" for _ in range(60)) + ". w1" for _ in range(80)]
    counts = Counter(tuple(w[i : i + k]) for t in texts for p in t.split(".") for w in [p.split()] for k in range(1, 5) for i in range(len(w) - k + 1))
    listed = sorted(" ".join(p) for p in counts)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array([t.encode() for t in texts])], names=["lang", "content"])
    work = Counter()
    step = phrases.Trie.step

    def counted(self, state, label):
        work[blocks] += len(state)
        return step(self, state, label)

    monkeypatch.setattr(phrases.Trie, "step", counted)
    for blocks in (1, 20):
        entries = pa.RecordBatch.from_arrays([pa.array(["en"] * len(listed)), pa.array(listed)], names=["lang", "phrase"])
        dealt = pa.Table.from_batches(phrases._deal(blocks)([entries]))
        built = [phrases._build_block(dealt.filter(pc.equal(dealt["block"], k))) for k in sorted(set(dealt["block"].to_pylist()))]
        found, tries = {}, []
        for t in built:
            rows = t.to_pylist()
            tries.append((rows[-1]["block"], rows[-1]["trie"]))
            found |= {(x["block"], x["state"]): x["phrase"] for x in rows[:-1]}
        got = Counter()
        for b in phrases._count_blocks(SimpleNamespace(value=(blocks, tries)))([batch]):
            for x in pa.Table.from_batches(phrases._add_shards([b])).to_pylist():
                if (x["block"], x["state"]) in found:
                    got[found[x["block"], x["state"]]] += x["f"]
        assert got == {" ".join(p): n for p, n in counts.items()}
    assert len(built) > 10 and work[20] < 1.2 * work[1]


def test_scores_beyond_64_bits(spark):
    """The arithmetic of the score on counts whose products pass 64 bits."""
    a, left, right = 9 * 10**15, 10**16 + 1, 10**16
    expr = f"CAST((2000000 * {phrases._exact('a')}) div ({phrases._exact('l')} + {phrases._exact('r')}) AS BIGINT)"
    row = spark.sql(f"SELECT {a}L AS a, {left}L AS l, {right}L AS r").selectExpr(f"{expr} AS s").first()
    assert row.s == 2_000_000 * a // (left + right)
