"""Registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wareline.llm import (
    bpe,
    fingerprints,
    html_blocks,
    line_dedup,
    near_duplicates,
    neighbours,
    packing,
    periodic_runs,
    pii,
    quality,
    revisits,
    spelling,
    toxicity,
)
from wareline.llm.common import fold, table
from wareline.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.ToxicityModel:
    return toxicity.fit(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        keep=lambda doc_id: fold(doc_id, 5) != 0,
    )


def quality_model(spark: SparkSession, sf_dir: str) -> quality.QualityModel:
    return quality.fit(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        keep=lambda doc_id: fold(doc_id, 3) != 1,
    )


@query("op1_toxicity")
def _toxicity(spark, sf_dir):
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    held_out = fold(F.col("doc_id"), 5) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op2_quality_classifier")
def _quality(spark, sf_dir):
    scored = quality.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    held_out = fold(F.col("doc_id"), 3) == 1
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op3_html_extraction")
def _html(spark, sf_dir):
    return html_blocks.extract(table(spark, sf_dir, "pages"))


@query("op4_nearest_neighbours")
def _neighbours(spark, sf_dir):
    return neighbours.search(
        table(spark, sf_dir, "embeddings"), is_query=lambda vec_id: vec_id % 100 == 0, k=10
    )


@query("op5_fingerprints")
def _fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return fingerprints.compare_with_edits(docs, fingerprints.lexicon(docs))


@query("op6_best_fit_packing")
def _packing(spark, sf_dir):
    """Documents in bins of 2048 words; equal texts but for case and edges are a cluster."""
    docs = table(spark, sf_dir, "documents")
    cluster = F.xxhash64(F.lower(F.trim(F.coalesce("text", F.lit("")))))
    return packing.pack(packing.items(docs, cluster), rows=docs.count())


@query("op7_pii")
def _pii(spark, sf_dir):
    return pii.summary(table(spark, sf_dir, "documents"), pii.fit(spark))


def archive_records(pages: DataFrame) -> DataFrame:
    """A full response and a later revisit for every page.

    The revisit of page p asks at time p + 1000 with an entity tag that is
    stale for every seventh page and weak for every fifth.
    """
    page, tag = F.col("page_id"), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16)
    day = F.concat(F.lit("day "), (page % 30).cast("string"))
    quoted = F.concat(F.lit('"'), tag, F.lit('"'))

    def headers(**values):
        return F.create_map(
            *[x for name, v in values.items() for x in (F.lit(name.replace("_", "-")), v)]
        )

    response = pages.select(
        (page * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        page.alias("captured"),
        F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"),
        headers(
            content_type=F.lit("text/html"),
            server=F.lit("s1"),
            cache_control=F.lit("max-age=60"),
            etag=quoted,
            last_modified=day,
        ).alias("headers"),
    )
    asked = F.when(page % 7 == 0, F.lit('"stale"')).when(
        page % 5 == 0, F.concat(F.lit("W/"), quoted)
    ).otherwise(quoted)
    revisit = pages.select(
        (page * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        "url",
        (page + 1000).alias("captured"),
        F.lit(None).cast("string").alias("digest"),
        headers(
            etag=asked,
            date=F.concat(F.lit("at "), page.cast("string")),
            cache_control=F.lit("max-age=90"),
            server=F.lit("s2"),
        ).alias("headers"),
    )
    return response.unionByName(revisit)


REVISIT_SQL = r"""
WITH bare AS (
  SELECT page_id, coalesce(html, '') AS html, regexp_replace(regexp_replace(trim(url), '#.*$', ''),
    '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages),
parts AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), ':(80|443)$', ''),
      '^(www|m)\.', '') AS host,
    regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p,
        '^(utm_[a-z]+|gclid|fbclid|ref|session_?id|sid)='))), '&') AS asked FROM bare),
canon AS (
  SELECT page_id, html,
    nullif(host || path || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END, '') AS page,
    substr(md5(html), 1, 16) AS tag FROM parts),
records AS (
  SELECT page_id * 2 AS record_id, page, page_id AS captured, true AS full_one, page_id FROM canon
  UNION ALL
  SELECT page_id * 2 + 1, page, page_id + 1000, false, page_id FROM canon),
looked AS (
  SELECT *, last_value(CASE WHEN full_one AND page IS NOT NULL THEN record_id END IGNORE NULLS) OVER (
    PARTITION BY page ORDER BY captured, record_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS refers_to FROM records),
checked AS (
  SELECT l.*, n.tag AS new_tag, o.tag AS old_tag, o.html AS old_html, o.page_id AS old_page,
    CASE WHEN l.refers_to IS NULL THEN 'no_response'
      WHEN l.page_id % 7 <> 0 AND n.tag = o.tag THEN 'resolved'
      ELSE 'validator_mismatch' END AS status
  FROM looked l JOIN canon n ON n.page_id = l.page_id
  LEFT JOIN canon o ON o.page_id * 2 = l.refers_to WHERE NOT full_one)
SELECT record_id, page, captured, status, refers_to,
  CASE WHEN status = 'resolved' THEN sha256(old_html) END AS digest,
  CASE WHEN status = 'resolved' THEN 'cache-control: max-age=90' || chr(10) ||
    'content-type: text/html' || chr(10) || 'date: at ' || page_id || chr(10) || 'etag: ' ||
    CASE WHEN page_id % 5 = 0 THEN 'W/' ELSE '' END || '"' || new_tag || '"' || chr(10) ||
    'last-modified: day ' || (old_page % 30) || chr(10) || 'server: s1' END AS headers
FROM checked"""


@query("op10_warc_revisits", REVISIT_SQL)
def _revisits(spark, sf_dir):
    resolved = revisits.resolve(archive_records(table(spark, sf_dir, "pages")))
    return resolved.withColumn("headers", revisits.headers_text(F.col("headers")))


@query("op8_bpe")
def _bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """The tokenizer file of the installed collection, at one path on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op9_minhash")
def _minhash(spark, sf_dir):
    return near_duplicates.components(table(spark, sf_dir, "documents"), words=4)


@query("op11_periodic_runs")
def _periodic_runs(spark, sf_dir):
    return periodic_runs.report(table(spark, sf_dir, "documents"))


LINES_SQL = r"""
WITH rows AS (
  SELECT row_number() OVER () AS row_no, doc_id,
    string_split(coalesce(text, ''), chr(10)) AS found FROM documents),
cut AS (
  SELECT row_no, doc_id, unnest(found) AS line, generate_subscripts(found, 1) AS pos FROM rows),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM cut),
blocked AS (
  SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT m.*, coalesce(m.doc_id <> b.owner, false) AS gone
  FROM keyed m LEFT JOIN blocked b ON b.k = m.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
    AS kept_sha256
FROM marked GROUP BY row_no"""


@query("op12_line_dedup", LINES_SQL)
def _line_dedup(spark, sf_dir):
    cleaned = line_dedup.dedup(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("text"), 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_lines", "n_dropped", kept)


@query("op13_spelling_variants")
def _spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))
