"""The opN_ queries and the pipeline, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of pages that a feed tracker points to (syndicated copies)."""
    from .url_filter import canonical, judge

    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(pages.url.contains("utm_source=")).select(canonical(pages.url).alias("url_key"))
    return judge(pages, listed, URL_RULES)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_read(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contamination

    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import components

    return components(_read(spark, sf_dir, "documents"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_model import score

    return score(_read(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import score

    return score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge

    return judge(_read(spark, sf_dir, "documents"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_output import token_output

    return token_output(_read(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import chat_format

    return chat_format(_read(spark, sf_dir, "conversations"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import digest

    return digest(_read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_decontamination": op3_decontamination,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_language_model": op5_language_model,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_output": op8_token_output,
    "op9_chat_format": op9_chat_format,
    "op10_substring_dedup": op10_substring_dedup,
    "pipeline": pipeline,
}

_HOST = "translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP1_SQL = f"""
WITH cut AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id, url, rest, coalesce({_HOST}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         list_filter(string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)=')) AS params
  FROM cut),
keyed AS (
  SELECT page_id, url, host, path,
         CASE WHEN rest IS NOT NULL THEN regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/$', '') || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS url_key
  FROM parts),
listed_keys AS (SELECT DISTINCT url_key FROM keyed WHERE url LIKE '%utm_source=%' AND url_key IS NOT NULL),
rules(verdict, rule, rule_host, rule_path) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'), ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
fit AS (
  SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS k
  FROM keyed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT k.page_id, host, path, f.rule, coalesce(f.verdict, CASE WHEN l.url_key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.url_key IS NOT NULL AS listed
FROM keyed k LEFT JOIN listed_keys l ON k.url_key = l.url_key LEFT JOIN fit f ON f.page_id = k.page_id AND f.k = 1
"""
OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> '') AS ws FROM d),
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
ll AS (SELECT doc_id, source, line, list_filter(regexp_split_to_array(line, '[ \t-\r]+'), lambda x: x <> '') AS ws FROM l),
lw AS (SELECT doc_id, source, line, len(ws) AS n, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000') AS norm FROM ll WHERE len(ws) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw GROUP BY doc_id),
common AS (SELECT source, norm FROM lw GROUP BY source, norm HAVING count(DISTINCT doc_id) > 100),
lost AS (SELECT lw.doc_id, sum(n) AS n_boilerplate FROM lw JOIN common c ON lw.norm = c.norm AND lw.source IS NOT DISTINCT FROM c.source GROUP BY lw.doc_id),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, sum(least(3, i - coalesce(p, i - 3))) AS n FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM r) GROUP BY doc_id),
b AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_boilerplate, 0)::BIGINT AS n_boilerplate
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND n_boilerplate <= 0.5 * n_words AS kept FROM f
"""

ORACLE_SQL: dict[str, str] = {"op1_url_filter": OP1_SQL, "op7_quality_rules": OP7_SQL}
