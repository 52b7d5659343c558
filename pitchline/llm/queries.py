"""The queries of this subpackage and, where SQL can express them, the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm import merkle, quality
from pitchline.llm.common import held_out, table
from pitchline.llm.decontamination import find_matches
from pitchline.llm.exact_dedup import exact_dedup
from pitchline.llm.html_text import main_text
from pitchline.llm.jaccard_join import JaccardJoin
from pitchline.llm.language_id import identify, train
from pitchline.llm.mixing import in_training_order, mix
from pitchline.llm.phrases import collocations
from pitchline.llm.pii import find_pii
from pitchline.llm.substring_dedup import substring_dedup
from pitchline.llm.token_counts import token_counts
from pitchline.llm.url_filter import Rule, url_filter


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, ~held_out())
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.score", "m.start", "m.end")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JaccardJoin(table(spark, sf_dir, "documents")).result().select("doc_id", "n_shingles", "component_id")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.features(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").where(F.col("quality").isin(0, 1) & ~held_out()).select("doc_id", F.col("quality").alias("y"))
    scored = quality.scores(found, quality.train(found.join(labels, "doc_id")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = in_training_order(mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")
    return url_filter(table(spark, sf_dir, "pages"), labels.select(F.col("doc_id").alias("page_id"), good.alias("good")), RULES)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(merkle.build(merkle.document_leaves(table(spark, sf_dir, "documents"))))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_decontamination": op3_decontamination,
    "op4_html_extraction": op4_html_extraction,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_mixing": op7_mixing,
    "op8_url_filter": op8_url_filter,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pii": op10_pii,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_substring_dedup": op13_substring_dedup,
}

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"

def _concentration_sql(units: str, parent: str) -> str:
    """Scalar: how strongly the rates of ``units`` are drawn towards their parents'."""
    return f"""(
      WITH s AS (SELECT {parent} AS parent, sum(n) AS pn, sum(good) AS pg FROM {units} GROUP BY 1), a AS (
        SELECT sum(n) AS n, sum(n * (good / n - pg / pn) * (good / n - pg / pn)) AS b, sum(n * (good / n) * (1 - good / n)) AS w,
               count(*) AS units, count(*) - count(DISTINCT parent) AS free, sum(n * n / pn) AS squares
        FROM {units} u JOIN s ON u.{parent} = s.parent
      ), v AS (
        SELECT free, n, units, b / free AS b, w / (n - units) AS w, (n - squares) / free AS k FROM a
      ), r AS (
        SELECT free, n, units, b + (k - 1) * w AS total, greatest(0.0, (b - w) / (b + (k - 1) * w)) AS rho FROM v
      )
      SELECT CASE WHEN coalesce(free, 0) <= 0 OR n <= units OR total <= 0 THEN 1.0
                  WHEN rho <= 1 / 1001.0 THEN 1000.0 ELSE greatest(1.0, 1 / rho - 1) END FROM r)"""


_TWO = "('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in')"


def _tail_sql(host: str, labels: int) -> str:
    return f"array_to_string(list_slice(string_split({host}, '.'), -{labels}, -1), '.')"


_PARTS_SQL = f"""
        parts AS (
          SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
        ), named AS (
          SELECT *, CASE WHEN {_tail_sql("host", 2)} IN {_TWO} THEN {_tail_sql("host", 3)} ELSE {_tail_sql("host", 2)} END AS domain,
                 CASE WHEN {_tail_sql("host", 2)} IN {_TWO} THEN {_tail_sql("host", 2)} ELSE {_tail_sql("host", 1)} END AS suffix
          FROM parts
        ), hosts AS (
          SELECT host, domain, suffix, count(*)::DOUBLE AS n,
                 sum(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END)::DOUBLE AS good
          FROM named JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL GROUP BY ALL
        ), domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL
        ), suffixes AS (SELECT suffix, 1 AS everything, sum(n) AS n, sum(good) AS good FROM domains GROUP BY ALL)"""

def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_field_sql(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


# CRC-32 bit by bit: the reflected polynomial is a fixed value.
_BYTE_STEP = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
_CRC_SQL = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                 lambda crc, byte: {_BYTE_STEP}), 4294967295)"""


def _levels_sql(name: str, levels: int, tree: str) -> str:
    """Levels of 8-ary trees: nodes with their siblings and the node above, up to the top, which stays as it is."""
    parts = []
    for k in range(levels):
        over = f"PARTITION BY {tree}, pos // 8 ORDER BY pos ROWS BETWEEN"
        parts.append(f"""{name}s{k} AS (
          SELECT *, CASE WHEN n = 1 THEN NULL ELSE coalesce(string_agg(h, '') OVER ({over} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS lft,
                 CASE WHEN n = 1 THEN NULL ELSE coalesce(string_agg(h, '') OVER ({over} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS rgt
          FROM {name}{k}
        ), {name}{k + 1} AS (
          SELECT {tree}, pos // 8 AS pos, (max(n) + 7) // 8 AS n,
                 CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
          FROM {name}{k} GROUP BY {tree}, pos // 8
        )""")
    return ", ".join(parts)


_LEAF_LEVELS, _TREE_LEVELS = 10, 3


def _manifest_sql() -> str:
    way = [f"l{k}" for k in range(_LEAF_LEVELS)] + [f"t{k}" for k in range(_TREE_LEVELS)]
    joins, steps = [], []
    for k in range(_LEAF_LEVELS):
        joins.append(f"JOIN ls{k} l{k} ON l{k}.lang IS NOT DISTINCT FROM d.lang AND l{k}.pos = d.pos // {8**k}")
    joins.append("JOIN t0 tree ON tree.lang IS NOT DISTINCT FROM d.lang")
    for k in range(_TREE_LEVELS):
        joins.append(f"JOIN ts{k} t{k} ON t{k}.pos = tree.pos // {8**k}")
    for k, name in enumerate(way):
        source = "j" if k == 0 else f"f{k - 1}"
        steps.append(f"f{k} AS (SELECT * REPLACE (CASE WHEN {name}_l IS NULL THEN shown ELSE sha256({name}_l || shown || {name}_r) END AS shown) FROM {source})")
    sides = ", ".join(f"{a}.lft AS {a}_l, {a}.rgt AS {a}_r" for a in way)
    proof = " || ".join(f"coalesce({a}.lft || {a}.rgt, '')" for a in way)
    return f"""
        WITH d AS (
          SELECT doc_id, lang, {_leaf_sql("text")} AS h,
                 CASE WHEN doc_id IS NOT NULL AND {_CRC_SQL} % 3 = 0
                      THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed,
                 row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
          FROM documents WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {_leaf_sql("text")})
        ), l0 AS (SELECT lang, pos, n, h FROM d), {_levels_sql("l", _LEAF_LEVELS, "lang")},
        t0 AS (SELECT 1 AS one, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, h FROM l{_LEAF_LEVELS}),
        {_levels_sql("t", _TREE_LEVELS, "one")},
        j AS (
          SELECT d.doc_id, d.h AS leaf, tree.h AS subroot, top.h AS root, sha256({proof}) AS proof_sha256, coalesce(changed, d.h) AS shown, {sides}
          FROM d {" ".join(joins)}, t{_TREE_LEVELS} top
        ), {", ".join(steps)}
        SELECT doc_id, leaf, subroot, root, proof_sha256, shown AS folded_root, shown = root AS verified FROM f{len(way) - 1}"""


_PHRASES_SQL = r"""
        WITH texts AS (
          SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
        ), pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
        ), words AS (SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
        ), spread AS (SELECT piece, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM words
        ), runs AS (
          SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
          FROM spread WINDOW p AS (PARTITION BY piece ORDER BY i)
        ), grams AS (
          SELECT lang, 1 AS m, w1 AS phrase FROM runs UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
          UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
          UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
        ), f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
        ), listed AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1
        ), cuts AS (
          SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
          FROM (SELECT *, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, m), ' ') AS rest
                FROM listed, range(1, 4) ks(k) WHERE k < m) c
          JOIN f l ON l.lang = c.lang AND l.phrase = head JOIN f r ON r.lang = c.lang AND r.phrase = rest
        ), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_phrases AS (
          SELECT lang, array_to_string(list_slice(w, i, i + q - 1), ' ') AS phrase, max(a) AS longer
          FROM listed, range(2, 4) qs(q), range(1, 4) starts(i) WHERE q < m AND i + q - 1 <= m GROUP BY ALL
        ), kept AS (
          SELECT best.* FROM best LEFT JOIN inner_phrases USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
        )
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

ORACLE = {
    "op11_phrase_collocations": _PHRASES_SQL,
    "op12_merkle_manifest": _manifest_sql(),
    "op7_mixing": r"""
        WITH d AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
        ), s AS (
          SELECT source, sum(size)::BIGINT AS source_size,
                 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM d GROUP BY source
        ), f AS (
          SELECT *, 3 * source_size / weight AS full_at,
                 (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER
                    (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s
        ), t AS (
          SELECT source, source_size,
                 CASE WHEN full_at <= max(level) OVER () THEN 3.0::DOUBLE * source_size ELSE max(level) OVER () * weight END AS target FROM f
        ), c AS (
          SELECT d.*, sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start FROM d
        ), j AS (
          SELECT c.*, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0) AS times
          FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
               (times * size + least(size, greatest(0, floor(target - times * source_size + 0.5) - start)))::BIGINT AS taken FROM j""",
    "op8_url_filter": f"""
        WITH {_PARTS_SQL}, m AS (
          SELECT {_concentration_sql("hosts", "domain")} AS mh, {_concentration_sql("domains", "suffix")} AS md,
                 {_concentration_sql("suffixes", "everything")} AS ms,
                 coalesce((SELECT (sum(good) + 1) / (sum(n) + 2) FROM suffixes), 0.5) AS p
        ), sm AS (SELECT suffix, (ms * p + good) / (ms + n) AS p FROM suffixes, m
        ), dm AS (SELECT domain, (md * sm.p + good) / (md + n) AS p FROM domains JOIN sm USING (suffix), m
        ), hm AS (SELECT host, n, (mh * dm.p + good) / (mh + n) AS p FROM hosts JOIN dm USING (domain), m
        ), j AS (
          SELECT page_id, host, path, coalesce(hm.p, dm.p, sm.p, m.p) AS p, coalesce(hm.n, 0) AS n, mh,
                 CASE WHEN host = 'www.example.com' OR ends_with(host, '.www.example.com') THEN starts_with(path, '/en/') ELSE false END AS r1,
                 (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') AS r2,
                 (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') AS r3,
                 (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') AS r4,
                 (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') AS r5
          FROM named LEFT JOIN hm USING (host) LEFT JOIN dm USING (domain) LEFT JOIN sm USING (suffix), m
        )
        SELECT page_id, host, path,
               CASE WHEN r1 THEN 'www.example.com/en/' WHEN r2 THEN 'example.com/en/' WHEN r3 THEN 'net/es/'
                    WHEN r4 THEN 'net/fr/' WHEN r5 THEN 'com/' END AS rule,
               CASE WHEN r1 THEN 'allow' WHEN r2 OR r3 OR r4 THEN 'block' WHEN r5 THEN 'allow'
                    WHEN p - 1.645 * sqrt(p * (1 - p) / (mh + n + 1)) >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
        FROM j""",
    "op9_exact_dedup": f"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n, sha256({_NORMAL}) AS text_sha256 FROM documents
        ), r AS (
          SELECT doc_id, text_sha256,
                 count(*) OVER (PARTITION BY text_sha256) AS group_size,
                 first_value(doc_id) OVER w AS keep_id, row_number() OVER w = 1 AS kept
          FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
        )
        SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r""",
}
