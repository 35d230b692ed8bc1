"""Registered queries of the operators, with production parameters over whole tables, and their SQL.

A query takes only the columns its operator needs, runs the operator, and
derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import (
    decontaminate,
    hard_negatives,
    html_extract,
    jaccard_join,
    language_id,
    lexical_search,
    mixing,
    quality_rules,
    sanitise,
    sharding,
    token_counts,
    toxicity,
    url_rules,
)
from tallyframe.llm.common import id_crc32
from tallyframe.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"


def op1_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text", "lang")
    held_out = id_crc32() % 4 == 2
    profiles = language_id.train(docs.filter(~held_out))
    out, info = language_id.with_language(docs.select("doc_id", "text"), profiles)
    found = F.col(info)
    return out.select("doc_id", held_out.alias("held_out"), found["lang"].alias("lang_pred"), found["score"].alias("score"))


def op2_url_filters(spark: SparkSession, root: str) -> DataFrame:
    pages = read_table(spark, root, "pages").select("page_id", "url")
    out, info = url_rules.with_verdicts(pages)
    v = F.col(info)
    return out.select("page_id", *[v[c].alias(c) for c in ("host", "path", "rule", "verdict", "template")])


def op3_html_extraction(spark: SparkSession, root: str) -> DataFrame:
    pages = read_table(spark, root, "pages").select("page_id", "url", "html")
    out, text = html_extract.with_main_text(pages)
    return out.select("page_id", "url", F.col(text).alias("text"), F.length(text).cast("bigint").alias("n_chars"))


def op4_decontamination(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    benchmark = read_table(spark, root, "benchmark").select("item_id", "text")
    out, info = decontaminate.with_hits(docs, benchmark)
    h = F.col(info)
    listed = F.sha2(F.concat_ws(",", h["item_ids"]).cast("binary"), 256)
    return out.select("doc_id", h["n_words"].alias("n_words"), h["n_hit"].alias("n_hit"),
                      F.size(h["item_ids"]).cast("bigint").alias("n_items"), listed.alias("items_sha256"),
                      h["contaminated"].alias("contaminated"))


def op5_token_counts(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    out, n = token_counts.with_token_counts(docs, public_tokenizers.path(TOKENIZER))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return out.select("doc_id", n_bytes.alias("n_bytes"), F.col(n).alias("n_tokens"),
                      (F.col(n) > token_counts.LIMIT).alias("over_limit"))


def op6_sharding(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    out, info = sharding.assign_shards(docs)
    s = F.col(info)
    return out.select("doc_id", s["size"].alias("size"), s["text_crc32"].alias("text_crc32"), F.lit("bytes").alias("law"),
                      s["shard"].alias("shard"), s["slot"].alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    labels = read_table(spark, root, "labels").select("doc_id", "toxic")
    held_out = id_crc32() % 5 == 0
    model = toxicity.train(docs, labels.filter(~held_out))
    out, score = toxicity.with_score(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), F.col(score).alias("score"), (F.col(score) >= 0.5).cast("int").alias("predicted"))


def op8_mixing(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text", "source")
    out, info = mixing.mix(docs)
    m = F.col(info)
    return out.select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"),
                      m["target"].alias("target"), m["taken"].alias("taken"))


def op9_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    out = jaccard_join.component_rows(docs)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op10_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    out, ledger = quality_rules.with_ledger(docs)
    x = F.col(ledger)
    return out.select(
        "doc_id", *[x[m].alias(m) for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~quality_rules.passes(ledger, "base")).alias("base_failed"),
        quality_rules.passes(ledger).alias("kept"),
        x["failures"].alias("failures"),
    )


def op11_pii_sanitisation(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    out, info = sanitise.with_spans(docs)
    base, spans = F.col(info)["base"], F.col(info)["spans"]
    n = lambda of, kind: F.size(F.filter(of, lambda s: s["kind"] == kind)).cast("bigint")
    return out.select(
        "doc_id", *[n(base, k.name).alias(f"n_{k.name}") for k in sanitise.KINDS],
        F.sha2(sanitise.listed(base).cast("binary"), 256).alias("base_sha256"), sanitise.listed(spans).alias("spans"),
        n(spans, sanitise.TERM).alias("n_terms"),
    )


def op12_lexical_search(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    items = read_table(spark, root, "benchmark").select("item_id", "text")
    return lexical_search.search(docs, items)


def op13_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    vectors = read_table(spark, root, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.clean_rows(vectors, "vec_id", label, "embedding")
    return hard_negatives.mine(rows, rows.filter(F.col("id") % 100 == 0))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_url_filters": op2_url_filters,
    "op3_html_extraction": op3_html_extraction,
    "op4_decontamination": op4_decontamination,
    "op5_token_counts": op5_token_counts,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_pii_sanitisation": op11_pii_sanitisation,
    "op12_lexical_search": op12_lexical_search,
    "op13_hard_negatives": op13_hard_negatives,
}

_WORDS = r"[^\x20\x09-\x0D]+"

_BENCH_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The patterns of personal data, and what a match must satisfy to count.
_PRIVATE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "TRUE", "lower(value)"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len([x FOR x IN string_split(value, '.') IF x::HUGEINT > 255]) = 0", "value"),
    ("card", r"[0-9]([\x20-]?[0-9])+", """length(digits) BETWEEN 12 AND 19 AND list_sum([
        CASE WHEN i % 2 = 1 THEN digits[-i]::INT WHEN digits[-i]::INT > 4 THEN 2 * digits[-i]::INT - 9 ELSE 2 * digits[-i]::INT END
        FOR i IN range(1, length(digits) + 1)]) % 10 = 0""", "digits"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) BETWEEN 9 AND 15", "digits"),
)


def _matches(rows: str, text: str, pattern: str) -> str:
    """r, start and value of every match of a pattern in the texts of ``rows``."""
    return f"""
    SELECT r, v[i] AS value, regexp_replace(v[i], '[^0-9]', '', 'g') AS digits,
           (list_sum([length(x) FOR x IN b[1:i]]) + coalesce(list_sum([length(x) FOR x IN v[1:i - 1]]), 0))::INT AS start
    FROM (SELECT r, regexp_extract_all({text}, '{pattern}') AS v, string_split_regex({text}, '{pattern}') AS b FROM {rows}),
         unnest(range(1, len(v) + 1)) AS u(i)"""


_BASE_SPANS = " UNION ALL ".join(
    f"SELECT r, {place} AS place, '{kind}' AS kind, start, start + length(value) AS stop, '{kind}:' || {entity} AS entity "
    f"FROM ({_matches('t', 'text', pattern)}) WHERE {holds}"
    for place, (kind, pattern, holds, entity) in enumerate(_PRIVATE)
)


def _url_level(level: int) -> str:
    """The tree of path templates with one more level merged: table t<level + 1> from t<level>."""
    return f"""
nodes{level} AS (
    SELECT host, array_to_string(template[1:{level}], '/') AS prefix, template[{level + 1}] AS child,
           coalesce(template[{level + 2}], '') AS below, sum(b) AS b, sum(l) AS l
    FROM t{level} WHERE len(template) > {level} AND template[{level + 1}] <> '**' GROUP BY ALL
), branches{level} AS (
    SELECT host, prefix, child, sum(b) AS b, sum(l) AS l,
           CASE WHEN count(*) > 16 THEN '*' ELSE string_agg(below, '/' ORDER BY below) END AS kids
    FROM nodes{level} GROUP BY host, prefix, child
), named{level} AS (
    SELECT host, prefix, child,
           CASE WHEN count(*) OVER w = 1 THEN child WHEN count(*) OVER w > 16 THEN '*' ELSE '*~' || min(child) OVER w END AS name
    FROM (SELECT *, kids || ':' || CASE WHEN l = 0 THEN 'none' ELSE round(4 * (b + 2.0) / (l + 4.0))::INT::VARCHAR END AS look
          FROM branches{level})
    WINDOW w AS (PARTITION BY host, prefix, look)
), t{level + 1} AS (
    SELECT t.host, shape, n, b, l,
           CASE WHEN name IS NULL THEN template
                ELSE list_concat(list_concat(template[1:{level}], [name]), template[{level + 2}:]) END AS template
    FROM t{level} t LEFT JOIN named{level} m
      ON t.host = m.host AND array_to_string(template[1:{level}], '/') = m.prefix AND template[{level + 1}] = m.child
)"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": rf"""
WITH a AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM a
), r AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
        [CASE WHEN regexp_matches(x, '^[0-9a-fA-F-]{{16,}}$') THEN '{{hex}}' ELSE regexp_replace(x, '[0-9]+', '{{n}}', 'g') END
         FOR x IN string_split(path, '/') IF x <> ''] AS parts
    FROM p
), s AS (
    SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS ruled,
           CASE WHEN len(parts) > 3 THEN list_concat(parts[1:3], ['**']) ELSE parts END AS shape
    FROM r
), t0 AS (
    SELECT host, shape, shape AS template, count(*) AS n, count(*) FILTER (WHERE ruled = 'block') AS b, count(ruled) AS l
    FROM s GROUP BY host, shape
), {_url_level(0)}, {_url_level(1)}, {_url_level(2)},
judged AS (
    SELECT host, shape, template, (sum(b) OVER w + 2.0) / (sum(l) OVER w + 4.0) >= 0.75 AS rejected
    FROM t3 WINDOW w AS (PARTITION BY host, template)
)
SELECT page_id, s.host, path, rule, coalesce(ruled, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict,
       '/' || array_to_string(template, '/') AS template
FROM s JOIN judged j ON s.host = j.host AND s.shape = j.shape
""",
    "op4_decontamination": rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all({_LOWER_AZ}, '{_BENCH_WORDS}') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all({_LOWER_AZ}, '{_BENCH_WORDS}') AS w FROM benchmark
), iw AS (
    SELECT DISTINCT item_id, len, array_to_string(w[i:i + len - 1], ' ') AS win
    FROM (SELECT item_id, w, least(len(w), 13) AS len, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
          FROM b WHERE len(w) > 0)
), dw AS (
    SELECT doc_id, i, l.len, array_to_string(w[i:i + l.len - 1], ' ') AS win
    FROM (SELECT DISTINCT len FROM iw) l, d, unnest(range(1, len(w) - l.len + 2)) AS u(i)
), hit AS (
    SELECT doc_id, i, dw.len, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.len = iw.len
), h AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + len)) AS p FROM hit) GROUP BY doc_id
), it AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op8_mixing": rf"""
WITH d AS (
    SELECT doc_id, source, len(coalesce(regexp_extract_all(text, '{_WORDS}'), []))::BIGINT AS size,
           ('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 15))::BIGINT AS k
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM d GROUP BY source
), f AS (
    SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS fill,
           row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS place
    FROM s
), g AS (
    SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()
              - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM f
), l AS (
    SELECT first(rest / open_weight ORDER BY place) AS level, min(place) AS place
    FROM g WHERE rest / open_weight * weight <= cap
), t AS (
    SELECT source, source_size,
           CASE WHEN g.place < l.place THEN cap ELSE level * weight END AS target
    FROM g, l
), b AS (
    SELECT d.*, source_size, target,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           floor(target + 1e-6)::BIGINT AS words
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE words // source_size * size + greatest(0, least(size, words % source_size - before)) END)::BIGINT AS taken
FROM b
""",
    "op9_jaccard_join": rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({_LOWER_AZ}, '{_WORDS}') AS w FROM documents
), sh AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), p AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), e AS (
    SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), r(doc_id, reach) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reach
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
""",
    "op10_quality_rules": rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w,
           [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{_WORDS}')] AS lines
    FROM documents
), g AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
), m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
           length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(lines) AS n_lines,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_az,
           length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters_az
    FROM d LEFT JOIN covered USING (doc_id)
), b AS (
    SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
             + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
             + CASE WHEN 2 * upper_az > letters_az THEN 8 ELSE 0 END
             + CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 16 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 32 ELSE 0 END)::BIGINT AS failures
    FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
FROM b
""",
    "op11_pii_sanitisation": rf"""
WITH t AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_LOWER_AZ} AS lower FROM documents
), base AS (
    {_BASE_SPANS}
), held AS (
    SELECT * FROM t WHERE r IN (SELECT r FROM base)
), marks AS (
    SELECT r, start, 0 AS o, stop, NULL::VARCHAR AS term, entity FROM base
    UNION ALL
    SELECT r, start, 1, start + length(value), value, NULL FROM ({_matches('held', 'lower', _TERMS)})
), kept AS (
    SELECT * FROM (
        SELECT *, coalesce(max(CASE WHEN entity IS NOT NULL THEN stop END) OVER (w ROWS UNBOUNDED PRECEDING) > start, FALSE)
               OR coalesce(lead(CASE WHEN entity IS NOT NULL THEN start END) OVER w < stop, FALSE) AS touched
        FROM marks WINDOW w AS (PARTITION BY r ORDER BY start, o, stop, entity))
    WHERE entity IS NOT NULL OR NOT touched
), near AS (
    SELECT r, term, list_distinct(coalesce(list(entity) FILTER (WHERE entity IS NOT NULL) OVER (
               PARTITION BY r ORDER BY start, o, stop, entity ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING), [])) AS entities
    FROM kept
), beside AS (
    SELECT entity, term, count(*) AS n_beside, count(DISTINCT text) AS n_texts
    FROM (SELECT r, term, unnest(entities) AS entity FROM near WHERE term IS NOT NULL) JOIN t USING (r) GROUP BY ALL
), mass AS (
    SELECT entity, sum(n_beside) AS n_entity FROM beside GROUP BY entity
), counts AS (
    SELECT term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower, '{_TERMS}')) AS term FROM t) GROUP BY term
), total AS (
    SELECT sum(n)::DOUBLE AS n_words FROM counts
), telling AS (
    SELECT entity, term FROM beside JOIN counts USING (term) JOIN mass USING (entity), total
    WHERE n_texts >= 3 AND n_entity < n_words AND 1 - ln(n_beside::DOUBLE / n) / ln(n_entity::DOUBLE / n_words) >= 0.9
), spans AS (
    SELECT r, start, place, kind, stop FROM base
    UNION ALL
    SELECT DISTINCT r, start, 4, 'term', stop FROM kept JOIN telling USING (term)
    WHERE (r, telling.entity) IN (SELECT (r, entity) FROM base)
), listed AS (
    SELECT r, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (WHERE place < 4) AS base,
           {', '.join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in ('email', 'ip', 'card', 'phone', 'term'))}
    FROM spans GROUP BY r
)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in ('email', 'ip', 'card', 'phone'))},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_term, 0)::BIGINT AS n_terms
FROM t LEFT JOIN listed USING (r)
""",
    "op12_lexical_search": rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER_AZ}, '{_TERMS}') AS w FROM documents
), i AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all({_LOWER_AZ}, '{_TERMS}') AS w
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), totals AS (
    SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0
), q AS (
    SELECT item, item_id, t, count(*) AS c FROM (SELECT item, item_id, unnest(w) AS t FROM i) GROUP BY ALL
), tf AS (
    SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d)
    WHERE t IN (SELECT t FROM q) GROUP BY ALL
), w AS (
    SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, totals GROUP BY t
), s AS (
    SELECT item, item_id, r, doc_id,
           sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score,
           any_value(100 - 25 + (25 * n * n_docs) // n_terms)::BIGINT AS m
    FROM tf JOIN q USING (t) JOIN w USING (t), totals GROUP BY ALL
), bags AS (
    SELECT r, string_agg(t || ' ' || tf, ' ' ORDER BY t) || ' ' || (100 - 25 + (25 * any_value(n) * any_value(n_docs)) // any_value(n_terms)) AS bag
    FROM tf, totals GROUP BY r
), sizes AS (
    SELECT r, count(*) OVER (PARTITION BY bag) AS members FROM bags
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score, members FROM ranked JOIN sizes USING (r) WHERE rank <= 20
""",
    "op13_hard_negatives": """
WITH e AS (
    SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::INT AS label,
           [floor(256 * v::DOUBLE)::BIGINT::DOUBLE FOR v IN embedding] AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([v FOR v IN embedding IF v IS NULL OR NOT isfinite(v::DOUBLE)]) = 0
), a AS (
    SELECT row_number() OVER () AS q, * FROM e WHERE vec_id % 100 = 0
), s AS (
    SELECT q, a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_dot_product(a.x, e.x)::BIGINT AS score
    FROM a JOIN e ON a.vec_id IS DISTINCT FROM e.vec_id
), p AS (
    SELECT q, anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST) AS place
    FROM s WHERE same
), n AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.q, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
    FROM p JOIN s ON p.q = s.q AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
    WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""",
}
