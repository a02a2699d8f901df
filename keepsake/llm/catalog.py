"""The numbered queries over the given tables, and their SQL counterparts where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake.llm import (
    cotraining,
    decontaminate,
    filter_audit,
    html_extract,
    lattice_lm,
    packing,
    piece_codec,
    prefix_trie,
    quality_rules,
    sharding,
    simhash,
    suffix_dedup,
    url_rules,
)
from keepsake.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), word_tokenizer(), max_len=2048, end_id=0)


@query
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(read(spark, folder, "documents"), length=200)


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply(read(spark, folder, "documents")).drop("rejected_by")


@query
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_lm.score(read(spark, folder, "documents"), piece_vocabulary())


@query
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.scan(read(spark, folder, "documents"), read(spark, folder, "benchmark"), window=10)
    return decontaminate.digest(found)


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(read(spark, folder, "documents"), shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"), size=3, threshold=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(read(spark, folder, "pages"))


@query
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = cotraining.train(docs, read(spark, folder, "labels"))
    return cotraining.score(docs, model).select("doc_id", "score", "kept")


@query
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(read(spark, folder, "pages"), read(spark, folder, "labels"))


@query
def op11_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    return piece_codec.digest(read(spark, folder, "documents"), piece_vocabulary())


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(read(spark, folder, "conversations"))


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))


_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = f"regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL["op5_benchmark_decontamination"] = f"""
WITH items AS MATERIALIZED (SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark),
patterns AS MATERIALIZED (
  SELECT DISTINCT item_id, words[k : k + 9] AS win
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS k
        FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT len(win) AS m FROM patterns),
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS words FROM documents),
ends AS (SELECT r, words, unnest(generate_series(1, len(words))) AS k FROM docs WHERE len(words) > 0),
wins AS (SELECT r, k, m, words[k : k + m - 1] AS win FROM ends, lengths WHERE k + m - 1 <= len(words)),
found AS MATERIALIZED (SELECT r, k, m, item_id FROM wins JOIN patterns USING (win)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit
         FROM (SELECT r, unnest(generate_series(k, k + m - 1)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

# Windows of a text are numbered; one is repeated if the text has it at another place too.
ORACLE_SQL["op3_quality_rules"] = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
cut AS MATERIALIZED (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
wins AS (
  SELECT r, k, array_to_string(words[k : k + 7], ' ') AS win
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - 7)) AS k FROM cut WHERE len(words) >= 8)),
again AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, win) AS n FROM wins) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(k, k + 7)) AS p FROM again) GROUP BY r),
counted AS (
  SELECT doc_id, words, text, lines, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN repeated USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR 10 * n_symbols > n_words
            OR 2 * n_dup_lines > len(lines)
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > word_chars
            OR 5 * len(regexp_extract_all(text, '!!')) > n_words
            OR 4 * len(list_filter(range(2, n_words + 1), lambda k: words[k] = words[k - 1])) > n_words) AS kept
FROM judged
"""

# CRC-32 bit by bit: of each character its code, then eight shifts.
_CRC32 = """list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
  lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END)"""

ORACLE_SQL["op12_prefix_trie"] = f"""
WITH turns AS MATERIALIZED (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
           md5(strlen(role) || ':' || role || text)) AS r
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
sizes AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 5 AS base, n, xor({_CRC32.format("conv_id::VARCHAR")}, 4294967295) % 9 AS h
  FROM (SELECT conv_id, max(r) AS n FROM turns GROUP BY conv_id)),
rebuilt AS (
  SELECT s.conv_id, r AS depth, role, text FROM sizes s JOIN turns t ON t.conv_id = s.base AND r <= h
  UNION ALL
  SELECT s.conv_id, r - s.h + least(s.h, coalesce(b.n, 0)), role, text
  FROM sizes s JOIN turns t ON t.conv_id = s.conv_id AND r > h LEFT JOIN sizes b ON b.conv_id = s.base),
paths AS MATERIALIZED (
  SELECT conv_id, depth, strlen(text) AS bytes,
         list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM rebuilt UNION ALL SELECT conv_id, 0, 0, [] FROM sizes),
nodes AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved
  FROM paths GROUP BY path, depth),
children AS MATERIALIZED (SELECT path[: depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
totals AS (
  SELECT a.path, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves, sum(v.saved) AS saved
  FROM nodes v JOIN paths a ON a.conv_id = v.conv_id AND a.depth <= v.depth LEFT JOIN children c ON c.path = v.path
  GROUP BY a.path),
ends AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(c.n_children, 0) AS n_children,
       t.n_leaves, t.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes v JOIN totals t ON t.path = v.path LEFT JOIN children c ON c.path = v.path LEFT JOIN ends e ON e.path = v.path
LEFT JOIN nodes p ON v.depth > 0 AND p.path = v.path[: v.depth - 1]
"""

ORACLE_SQL["op13_filter_audit"] = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM texts),
marks AS (
  SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN cut.doc_id > least THEN 'E' ELSE '' END AS fails
  FROM cut LEFT JOIN marks ON marks.doc_id = cut.doc_id),
cells AS MATERIALIZED (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, left(filter_order, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
applied AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS bad, fails = f AS alone,
         translate(fails, before, '') = fails AS reached
  FROM cells, steps),
summed AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (WHERE reached AND NOT bad), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE reached AND bad), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE NOT reached AND bad), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE alone), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (WHERE reached AND bad), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE reached AND bad), 0)::BIGINT AS toxic_lost
  FROM applied GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM summed
"""
