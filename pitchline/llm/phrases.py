"""Collocations: phrases of two to four words, counted with broadcast double-array tries.

Candidates are found level by level, Apriori-safe: a phrase can only reach
``LEAST`` occurrences if the phrases within it do. Words are counted by hash, then
pairs of words that reached the bound, then phrases of three and four words all of
whose pairs did. Sums by 64-bit hash are upper bounds (two phrases may share one), and
the sets go to the tasks as bits (``common.bits_of``, at most 64 MB, which may hold
too much); so nothing frequent is lost, and what is kept too much is settled by the
counts that follow.

The candidates and all their parts are then spelled out and dealt into blocks of
about ``block_entries`` by language and first words. A task builds the double-array
trie of a block: from state s the label c leads to t = base[s] + c if check[t] = s.
Blocks are broadcast ``pass_blocks`` at a time, a bounded size, each group with a
pass of its own. In a pass a text position is looked up in the block of its first word
and in that of its first two alone, so the work does not grow with the number of
blocks. numpy advances the states of all positions of a block at once, one level for
each word, and counts the states reached; a task sends
its sums as arrays, a row for ``RUN_STATES`` states, and Spark brings the rows of the
same states together to be added. These counts are exact.

Texts are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and line ends, and
pieces into words at blanks and tabs; phrases do not cross pieces. Everything is
per language. Defined cases: a null text is empty, a null language is ``und``;
repeated rows count as often as they are there; ties rank by phrase; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import pickle
import string
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchline.llm.common import Bits, bits_of, in_parts, let_go, materialize, mix, small_batches, span_hashes

LEAST = 30
LONGEST = 4
TOP = 2000
UNKNOWN = "und"
PART_BYTES = 2 << 20
_SALTS = 64

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """The words of some texts: spans in ``data``, text numbers, and whether the next word follows in the same piece."""

    data: np.ndarray
    first: np.ndarray
    end: np.ndarray
    text: np.ndarray
    joined: np.ndarray


def words_of(texts: Sequence[bytes | None]) -> Words:
    data = np.frombuffer(b"".join((t or b"") + b"\n" for t in texts).translate(_LOWER), np.uint8)
    kind = _KIND[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], kind > 0, [True]]).view(np.int8)))
    first, end = edge[::2], edge[1::2]
    piece = np.cumsum(kind == 2)[first]
    ends = np.cumsum([len(t or b"") + 1 for t in texts])
    joined = np.zeros(len(first), bool)
    joined[:-1] = piece[1:] == piece[:-1]
    return Words(data, first, end, np.searchsorted(ends, first, side="right"), joined)


def phrase_hashes(words: Words, langs: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one to LONGEST words: a hash of the phrase that starts at each word, with its language, and whether it lies in one piece."""
    n = len(words.first)
    plain = span_hashes(words.data, words.first, words.end)
    salts = {lang: xxhash.xxh3_64_intdigest(lang.encode()) for lang in set(langs)}
    found = mix(plain + np.array([salts[lang] for lang in langs], np.uint64)[words.text])
    whole = np.ones(n, bool)
    yield found, whole
    for k in range(1, LONGEST):
        found = mix(found * _STEP + np.concatenate([plain[k:], np.zeros(min(k, n), np.uint64)])[:n])
        whole = whole & np.concatenate([words.joined[k - 1 :], np.zeros(min(k - 1, n), bool)])[:n]
        yield found, whole


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in in_parts(texts, PART_BYTES):
            yield words_of(texts[a:b]), langs[a:b]


_COUNTED = "lang string, hash long, n long"


def _counted(hashes: np.ndarray, totals: dict[str, int]) -> pa.RecordBatch:
    found, n = np.unique(hashes, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([None] * len(found) + list(totals), pa.string()),
            pa.array([*found.view(np.int64).tolist(), *[0] * len(totals)], pa.int64()),
            pa.array([*n.tolist(), *totals.values()], pa.int64()),
        ],
        names=["lang", "hash", "n"],
    )


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by hash, and the number of words of every language."""
    for words, langs in _parts(batches):
        found, _ = next(phrase_hashes(words, langs))
        per_text = np.bincount(words.text, minlength=len(langs))
        totals: dict[str, int] = {}
        for lang, n in zip(langs, per_text.tolist(), strict=True):
            totals[lang] = totals.get(lang, 0) + n
        yield _counted(found, totals)


def _shifted(flags: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([flags[by:], np.zeros(min(by, len(flags)), bool)])[: len(flags)]


def _count_pairs(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in _parts(batches):
            (one, _), (two, whole) = islice(phrase_hashes(words, langs), 2)
            often = shared.value.may_hold(one)
            yield _counted(two[whole & often & _shifted(often, 1)], {})

    return run


def _count_longer(shared):
    """Phrases of three and four words all of whose pairs may be frequent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in _parts(batches):
            _, (two, pair), (three, _), (four, _) = phrase_hashes(words, langs)
            often = pair & shared.value.may_hold(two)
            triple = often & _shifted(often, 1)
            quad = triple & _shifted(often, 2)
            yield _counted(np.concatenate([three[triple], four[quad]]), {})

    return run


#: Hashes a task remembers as spelled; beyond, it forgets them and may spell again.
REMEMBERED = 4_000_000


def _letters(words: Words) -> tuple[bytes, np.ndarray]:
    """The words with one blank after each, and where each starts."""
    keep = _KIND[words.data] == 0
    keep[words.end] = True  # every text ends with a mark, so there is a byte behind every word
    start = np.concatenate([[0], np.cumsum(words.end - words.first + 1)])
    return np.where(_KIND[words.data] == 0, words.data, np.uint8(32))[keep].tobytes(), start


def _spell(shared):
    """The candidates that the texts hold, spelled out once a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: Bits = shared.value
        known = np.zeros(0, np.uint64)
        for words, langs in _parts(batches):
            text, start = _letters(words)
            lang_out, phrase_out, hash_out = [], [], []
            for k, (found, whole) in enumerate(phrase_hashes(words, langs)):
                if k == 0:
                    continue
                at = np.flatnonzero(whole)
                at = at[bits.may_hold(found[at])]
                hashes, where = np.unique(found[at], return_index=True)
                if len(known):
                    new = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] != hashes
                    hashes, where = hashes[new], where[new]
                at = at[where]
                phrase_out += [text[a:b] for a, b in zip(start[at].tolist(), (start[at + k + 1] - 1).tolist(), strict=True)]
                lang_out += [langs[t] for t in words.text[at].tolist()]
                hash_out.append(hashes)
            fresh = np.concatenate(hash_out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang_out, pa.string()), pa.array(phrase_out, pa.binary()).cast(pa.string()), pa.array(fresh.view(np.int64))],
                names=["lang", "phrase", "hash"],
            )
            known = np.sort(np.concatenate([known, fresh]) if len(known) < REMEMBERED else fresh)

    return run


def candidates(texts: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """All phrases (lang, phrase) of two words or more that may occur ``least`` times, and the words n of every lang."""

    def frequent(counter, name: str) -> tuple[DataFrame, Bits]:
        sums = texts.mapInArrow(counter, _COUNTED).groupBy("lang", "hash").agg(F.sum("n").alias("n"))
        kept = materialize(sums.where((F.col("n") >= least) | F.col("lang").isNotNull()), name)
        let_go(kept)
        hashes = kept.where("lang IS NULL")
        return kept, bits_of(hashes, "hash", hashes.count())

    context = texts.sparkSession.sparkContext
    words, bits = frequent(_count_words, "phrase-words")
    pairs, bits = frequent(_count_pairs(context.broadcast(bits)), "phrase-pairs")
    longer, _ = frequent(_count_longer(context.broadcast(bits)), "phrase-longer")
    every = pairs.unionByName(longer).select("hash")
    all_bits = context.broadcast(bits_of(every, "hash", every.count()))
    # Stored, so that each phrase meets the sums once and not once a task.
    spelled = materialize(texts.mapInArrow(_spell(all_bits), "lang string, phrase string, hash long").distinct(), "phrase-spelled")
    let_go(spelled)
    found = spelled.join(every, "hash", "left_semi").select("lang", "phrase")
    return materialize(found, "phrase-candidates"), words.where("lang IS NOT NULL").select("lang", "n")


class Trie(NamedTuple):
    """A double-array trie over label numbers; state 0 is the root."""

    labels: list[str]
    base: np.ndarray
    check: np.ndarray

    def step(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The states that ``label`` leads to, -1 where it leads nowhere."""
        to = self.base[state] + label
        inside = (label >= 0) & (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == state), to, -1)


def build_trie(paths: Sequence[Sequence[str]]) -> tuple[Trie, list[int]]:
    """The trie of ``paths`` and the state at the end of each.

    Nodes with many children are placed first, each at a base that leaves its children's
    places free; the nodes with one child share out the places left over.
    """
    labels: dict[str, int] = {}
    children: list[dict[int, int]] = [{}]
    ends = []
    for path in paths:
        node = 0
        for label in path:
            number = labels.setdefault(label, len(labels))
            below = children[node].get(number)
            if below is None:
                below = children[node][number] = len(children)
                children.append({})
            node = below
        ends.append(node)
    used = np.zeros(2 * len(children) + len(labels) + 2, bool)
    used[0] = True
    state = np.zeros(len(children), np.int64)
    bases = np.zeros(len(children), np.int64)
    begin = 1
    for node in sorted((k for k, c in enumerate(children) if len(c) > 1), key=lambda k: -len(children[k])):
        wanted = np.array(sorted(children[node]), np.int64)
        start = begin
        while True:
            if start + wanted[-1] - wanted[0] + 1024 >= len(used):
                used = np.concatenate([used, np.zeros(len(used) + int(wanted[-1]) + 2048, bool)])
            free = start + np.flatnonzero(~used[start : start + 1024])
            fits = ~used[free[:, None] + (wanted - wanted[0])].any(axis=1)
            if fits.any():
                base = int(free[np.argmax(fits)] - wanted[0])
                break
            start += 1024
        # What lies behind is nearly full; it is left to the nodes with one child.
        begin = max(begin, start - 4096)
        used[base + wanted] = True
        bases[node] = base
        for label, below in children[node].items():
            state[below] = base + label
    lone = [k for k, c in enumerate(children) if len(c) == 1]
    used = np.concatenate([used, np.zeros(len(lone), bool)])
    free = np.flatnonzero(~used)[: len(lone)]
    label, below = (np.array(x, np.int64) for x in zip(*[next(iter(children[k].items())) for k in lone], strict=True)) if lone else (free, free)
    state[below] = free
    bases[lone] = free - label
    last = int(state.max()) + 1
    base_of, check = np.zeros(last, np.int32), np.full(last, -1, np.int32)
    base_of[state] = bases
    for node, below in enumerate(children):
        for child in below.values():
            check[state[child]] = state[node]
    return Trie(list(labels), base_of, check), state[ends].tolist()


def _language(lang: str) -> str:
    return " " + lang  # no word holds a blank


def _build_block(entries: pa.Table) -> pa.Table:
    block = entries.column("block")[0].as_py()
    langs, phrases = entries.column("lang").to_pylist(), entries.column("phrase").to_pylist()
    trie, ends = build_trie([[_language(lang), *phrase.split(" ")] for lang, phrase in zip(langs, phrases, strict=True)])
    packed = zlib.compress(pickle.dumps((trie.labels, trie.base.tobytes(), trie.check.tobytes())), 1)  # many places are free
    n = len(phrases)
    return pa.table(
        {
            "block": pa.array([block] * (n + 1), pa.int32()),
            "state": pa.array([*ends, None], pa.int32()),
            "lang": pa.array([*langs, None], pa.string()),
            "phrase": pa.array([*phrases, None], pa.string()),
            "trie": pa.array([None] * n + [packed], pa.binary()),
        }
    )


def _dealt(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return (hashes % np.uint64(blocks)).astype(np.int64)


def _deal(blocks: int):
    """The block of each entry, by language and its first two words (its one word, if it has no other)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in in_parts(batch.column(1).to_pylist(), PART_BYTES):
                here = batch.slice(a, b - a)
                words = words_of([x.encode() for x in here.column(1).to_pylist()])
                (one, _), (two, whole) = islice(phrase_hashes(words, here.column(0).to_pylist()), 2)
                first = np.searchsorted(words.text, np.arange(b - a))
                block = _dealt(np.where(whole, two, one)[first], blocks)
                yield pa.RecordBatch.from_arrays([*here.columns[:2], pa.array(block, pa.int32())], names=["lang", "phrase", "block"])

    return run


def _word_array(words: Words) -> pa.Array:
    spans = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(_KIND[words.data] == 0, out=spans[1:])
    letters = words.data[_KIND[words.data] == 0].tobytes()
    offsets = np.append(spans[words.first], spans[-1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(words.first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters)])


def count_states(trie: Trie, words: Words, start: np.ndarray, word: np.ndarray, label: np.ndarray, at: np.ndarray, levels: range, counts: np.ndarray) -> None:
    """Add to ``counts`` how often the positions ``at`` reach each state on ``levels``: all advance together, a word a level.

    ``start`` holds the state of each text's language, ``word`` the number of each word and ``label`` the trie's label of each number.
    """
    state = start[words.text[at]]
    at, state = at[state >= 0], state[state >= 0]
    for level in range(levels.stop):
        if level:
            goes_on = words.joined[at + level - 1]
            at, state = at[goes_on], state[goes_on]
        state = trie.step(state, label[word[at + level]])
        alive = state >= 0
        at, state = at[alive], state[alive]
        if level in levels:
            np.add.at(counts, state, 1)


#: States whose sums travel in one row, as the places that a task has reached and their sums.
RUN_STATES = 1024
_SUMS = "block int, run int, places binary, sums binary"


def _by_slot(at: np.ndarray, slot: np.ndarray, slots: int) -> list[np.ndarray]:
    """The positions ``at`` of each slot; those of slot -1 are in none."""
    order = np.argsort(slot, kind="stable")
    return np.split(at[order], np.searchsorted(slot[order], np.arange(slots + 1)))[1:-1]


def _count_blocks(shared):
    """Counts in the tries of one pass; a position is looked up in the block of its first word and in that of its first two words alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, packed = shared.value
        slot_of = np.full(blocks, -1)
        names, tries, counts = [], [], []
        for slot, (block, trie) in enumerate(packed):
            labels, base, check = pickle.loads(zlib.decompress(trie))
            slot_of[block] = slot
            names.append(pa.array([x.encode() for x in labels], pa.binary()))
            tries.append(Trie(labels, np.frombuffer(base, np.int32), np.frombuffer(check, np.int32)))
            counts.append(np.zeros(len(check) // 4, np.int64))
        every = pa.chunked_array(names, pa.binary()).unique()  # a word is looked up once, not once a block
        number = [np.full(len(every) + 1, -1) for _ in names]  # the last is for words that no trie has
        for own, of_block in zip(names, number, strict=True):
            of_block[pc.index_in(own, value_set=every).to_numpy()] = np.arange(len(own))
        for words, langs in _parts(batches):
            if not len(words.first):
                continue
            word = pc.fill_null(pc.index_in(_word_array(words), value_set=every), -1).to_numpy().astype(np.int64)
            of_lang = pc.fill_null(pc.index_in(pa.array([_language(x).encode() for x in langs], pa.binary()), value_set=every), -1).to_numpy().astype(np.int64)
            (one, _), (two, whole) = islice(phrase_hashes(words, langs), 2)
            single = np.flatnonzero(word >= 0)
            double = np.flatnonzero(whole & (word >= 0) & _shifted(word >= 0, 1))
            singles = _by_slot(single, slot_of[_dealt(one[single], blocks)], len(tries))
            doubles = _by_slot(double, slot_of[_dealt(two[double], blocks)], len(tries))
            for slot, trie in enumerate(tries):
                start = trie.step(np.zeros(len(langs), np.int64), number[slot][of_lang])
                count_states(trie, words, start, word, number[slot], singles[slot], range(1), counts[slot])
                count_states(trie, words, start, word, number[slot], doubles[slot], range(1, LONGEST), counts[slot])
        for (block, _), n in zip(packed, counts, strict=True):
            reached = np.flatnonzero(n)
            runs, first = np.unique(reached // RUN_STATES, return_index=True)
            spans = list(zip(first.tolist(), [*first.tolist()[1:], len(reached)], strict=True)) if len(first) else []
            places, sums = (reached % RUN_STATES).astype(np.int16), n[reached]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(runs), pa.int32()),
                    pa.array(runs.astype(np.int32)),
                    pa.array([places[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([sums[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names=["block", "run", "places", "sums"],
            )

    return run


def _add_shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the shards' sums of each run of states, which come together, and give the states that were reached."""
    current, total = None, np.zeros(RUN_STATES, np.int64)

    def out() -> pa.RecordBatch:
        reached = np.flatnonzero(total)
        block, run = current
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * len(reached), pa.int32()), pa.array((reached + run * RUN_STATES).astype(np.int32)), pa.array(total[reached])],
            names=["block", "state", "f"],
        )

    for batch in batches:
        for block, run, places, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (block, run) != current:
                if current is not None:
                    yield out()
                current, total = (block, run), np.zeros(RUN_STATES, np.int64)
            total[np.frombuffer(places, np.int16)] += np.frombuffer(sums, np.int64)
    if current is not None:
        yield out()


def exact_counts(texts: DataFrame, entries: DataFrame, block_entries: int = 250_000, pass_blocks: int = 16) -> DataFrame:
    """How often each entry (lang, phrase) occurs: lang, phrase, f. The entries must be distinct."""
    size = entries.count()
    blocks = max(1, -(-size // block_entries))
    dealt = entries.select("lang", "phrase").mapInArrow(_deal(blocks), "lang string, phrase string, block int")
    built = materialize(dealt.groupBy("block").applyInArrow(_build_block, "block int, state int, lang string, phrase string, trie binary"), "phrase-tries")
    spark, counted = texts.sparkSession, None
    for start in range(0, blocks, pass_blocks):
        here = built.where(F.col("trie").isNotNull() & F.col("block").between(start, start + pass_blocks - 1))
        tries = here.select("block", "trie").toArrow()  # a bounded number of bounded size
        shared = spark.sparkContext.broadcast((blocks, list(zip(*(c.to_pylist() for c in tries.columns), strict=True))))
        shards = texts.mapInArrow(_count_blocks(shared), _SUMS).repartition("block", "run").sortWithinPartitions("block", "run")
        sums = materialize(shards.mapInArrow(_add_shards, "block int, state int, f long"), "phrase-counts")
        shared.destroy()  # the sums are stored
        let_go(sums)
        counted = sums if counted is None else counted.unionByName(sums)
    return built.where("trie IS NULL").join(counted, ["block", "state"]).select("lang", "phrase", "f")


def _exact(value: str) -> str:
    return f"CAST({value} AS DECIMAL(20, 0))"


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP,
    block_entries: int = 250_000, pass_blocks: int = 16,
) -> DataFrame:
    """The first ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    texts = small_batches(docs).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("binary").alias("content")
    )
    found, sizes = candidates(texts, least)
    # Prefixes are on the way of their phrase; the rests after a cut are entries of their own.
    words = F.split("phrase", " ")
    rests = F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, k, F.size(words)), " "))
    starts = F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, F.lit(1), k), " "))
    entries = materialize(found.select("lang", F.explode(F.array_union(rests, starts)).alias("phrase")).distinct(), "phrase-entries")
    f = materialize(exact_counts(texts, entries, block_entries, pass_blocks), "phrase-f")
    listed = f.where(F.col("f") >= least).selectExpr("lang", "phrase", "f AS a", "split(phrase, ' ') AS w").where("size(w) > 1")

    cuts = listed.selectExpr("lang", "phrase", "a", "w", "explode(sequence(1, size(w) - 1)) AS k").selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(w, 1, k), ' ') AS head", "array_join(slice(w, k + 1, size(w)), ' ') AS rest"
    )
    left, right = f.selectExpr("lang", "phrase AS head", "f AS l"), f.selectExpr("lang", "phrase AS rest", "f AS r")
    scored = cuts.join(left, ["lang", "head"]).join(right, ["lang", "rest"]).selectExpr(
        "*", f"CAST((2000000 * {_exact('a')}) div ({_exact('l')} + {_exact('r')}) AS BIGINT) AS score"
    )
    best = scored.groupBy("lang", "phrase", "a").agg(F.expr("min_by(struct(l, r, score), struct(score, k)) AS cut"))

    inner = listed.where("size(w) > 2").selectExpr("lang", "a", "w", "explode(sequence(2, size(w) - 1)) AS m").selectExpr(
        "lang", "a", "w", "m", "explode(sequence(1, size(w) - m + 1)) AS start"
    )
    longer = inner.selectExpr("lang", "array_join(slice(w, start, m), ' ') AS phrase", "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * {_exact('longer')} < 80 * {_exact('a')}")
    kept = kept.selectExpr("lang", "phrase", "a", "cut.l AS l", "cut.r AS r", "cut.score AS score")

    # First within salted parts of a language, then among their winners.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
