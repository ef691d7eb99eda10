"""The registered queries of this subpackage, over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    byte_convolution,
    decontaminate,
    html_text,
    line_dedup,
    mixing,
    periodic_runs,
    pii,
    quality,
    secrets,
    simhash,
    url_filter,
    warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])


@query
def op2_secret_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@query
def op4_mixing_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op5_decontamination_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


@query
def op6_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), "url", ["page_id"])


@query
def op7_html_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"), "html", ["page_id", "url"])


@query
def op8_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


@query
def op10_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query
def op11_whitening_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "embedding", ["vec_id"])


def held_out(id: Column) -> Column:
    """The fold that nothing is learned from."""
    return F.crc32(id.cast("string")) % 4 == 2


@query
def op12_byte_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_convolution.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out, ["doc_id"])


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), "text", ["doc_id"], id="doc_id", rearrange=periodic_runs.planted_tail)
    return periodic_runs.digests(found, ["doc_id"])


ORACLE["op3_line_dedup"] = rf"""
WITH lines AS (
    SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS at
    FROM documents
), pages AS (
    SELECT source, line, count(DISTINCT doc_id) AS pages FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line
), boilerplate AS (
    SELECT p.source, p.line FROM pages p JOIN (SELECT source, count(*) AS total FROM documents GROUP BY source) t ON p.source = t.source
    WHERE p.pages >= {line_dedup.MIN_PAGES} AND p.pages > {line_dedup.RATIO} * t.total
), marked AS (
    SELECT l.*, b.line IS NOT NULL AS dropped, regexp_matches(l.line, '[^\x20\x09-\x0D]') AS worded
    FROM lines l LEFT JOIN boilerplate b ON l.source = b.source AND l.line = b.line
), whole AS (
    SELECT *, bool_and(dropped) FILTER (WHERE worded) OVER (PARTITION BY doc_id) AS copied FROM marked
)
SELECT d.doc_id, d.source,
    CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(string_agg(w.line, chr(10) ORDER BY w.at) FILTER (WHERE copied OR NOT dropped), '') END AS text,
    CASE WHEN d.text IS NULL THEN NULL ELSE count(w.line) END AS n_lines,
    CASE WHEN d.text IS NULL THEN NULL ELSE count(*) FILTER (WHERE dropped AND NOT copied) END AS n_dropped
FROM documents d LEFT JOIN whole w ON d.doc_id = w.doc_id
GROUP BY d.doc_id, d.source, d.text
"""

def glob_pattern(glob: str) -> str:
    """A glob as a regular expression of the SQL engine."""
    kinds = {"run": "[^/]*", "runs": ".*", "any": "[^/]"}
    return "".join(kinds.get(t) or re.escape(t).replace("'", "''") for t in url_filter.tokens(glob))


ORACLE["op6_url_automaton"] = rf"""
WITH parts AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), hosts AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM parts
), split AS (
    SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
    FROM hosts
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM split
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_full_match(host || path, '(?s){"|".join(map(glob_pattern, url_filter.BLOCKING_GLOBS))}') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

ORACLE["op9_warc_capture_index"] = rf"""
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT *, CASE WHEN bytes >= {warc.LEAST} THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM payloads)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM firsts
"""
