"""The Merkle manifest against trees built level by level in memory."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from helpers import docs

from pitchline.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    text = row.text
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """Top digest and the siblings (left, right) of every leaf, from the whole list."""
    ways = [[] for _ in digests]
    below = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        above, covered = [], []
        for start in range(0, len(digests), 8):
            run = digests[start : start + 8]
            for k in range(len(run)):
                for w in below[start + k]:
                    ways[w].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            covered.append([w for members in below[start : start + 8] for w in members])
        digests, below = above, covered
    return digests[0], ways


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded) of every row."""
    if not rows:
        return []
    langs = sorted({r.lang for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    grouped = {v: sorted((r for r in rows if r.lang == v), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r))) for v in langs}
    trees = {v: tree([leaf(r) for r in grouped[v]]) for v in langs}
    root, crowns = tree([trees[v][0] for v in langs])
    out = []
    for v, crown in zip(langs, crowns, strict=True):
        for r, way in zip(grouped[v], trees[v][1], strict=True):
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            folded = leaf(r, tampered)
            for left, right in way + crown:
                folded = sha(left + folded + right)
            out.append((r.doc_id, leaf(r), trees[v][0], root, sha("".join(a + b for a, b in way + crown)), folded, folded == root))
    return sorted(out, key=str)


def found(spark, manifest):
    return sorted((tuple(r) for r in merkle.verified_documents(manifest).collect()), key=str)


def many(n, start=0):
    """Documents of a hot language, a few others, one without a language and a small one."""
    langs = ["en"] * 5 + ["de", "fr", None]
    return [(start + k, f"Text {k} ü", langs[k % 8], None if k % 5 else f"s{k % 3}") for k in range(n)]


def test_manifest_against_whole_trees(spark):
    given = docs(spark, [*many(400), (None, None, "de"), (None, None, "de"), (None, "Null id", "de"), (3, "Text 3", "en"), (7, "x" * 200_000, "xx"), (5, "", "")])
    assert found(spark, merkle.build(merkle.document_leaves(given))) == brute(given.collect())


@pytest.mark.parametrize("n", [0, 1, 9, 65])
def test_small_trees(spark, n):
    given = docs(spark, [(k, f"Row {k}", "en") for k in range(n)])
    assert found(spark, merkle.build(merkle.document_leaves(given))) == brute(given.collect())


def test_blocks_and_appended_rows(spark):
    """More than one block a tree; rows added later give the same manifest, and full blocks keep their witnesses."""
    first, later = many(7000), many(9000)[7000:] + [(9001, "new language", "nl")]
    whole = docs(spark, first + later)
    manifest = merkle.build(merkle.document_leaves(docs(spark, first)))
    grown = merkle.append(manifest, merkle.document_leaves(docs(spark, later)))
    assert found(spark, grown) == brute(whole.collect())
    full = "pos < 4096 AND tree = 'en'"
    before, after = (m.leaves.where(full).select("doc_id", "root", "witness") for m in (manifest, grown))
    assert before.count() == 4096 and before.exceptAll(after).count() == 0


def test_open_subtrees_extend_witnesses():
    """A node's witness holds the siblings before it at once and gains each later one as it completes."""
    edge = merkle.OpenSubtrees(2)
    digests = [sha(str(k)) for k in range(11)]
    for k, d in enumerate(digests[:3]):
        edge.append(d)
        assert edge.witness[0] == [["", digests[1 : k + 1]]]
    for d in digests[3:]:
        edge.append(d)
    assert edge.witness[9][0] == [digests[8], [digests[10]]]
    assert edge.witness[0][1] == ["", []]
    top = edge.close()
    assert edge.witness[0][1][1] == [sha("".join(digests[8:]))]
    assert top == tree(digests)[0]


def test_a_changed_text_is_found(spark):
    given = docs(spark, many(200))
    rows = merkle.verified_documents(merkle.build(merkle.document_leaves(given))).collect()
    for r in rows:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0)
    assert merkle.height(4096) == 4 and merkle.height(4097) == 5
