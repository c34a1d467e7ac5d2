"""Queries over search, answers, vectors and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wareline.functions import text as X
from wareline.operators import search as S
from wareline.plans import adapters as D
from wareline.plans.catalog_queries import FACT_SQL, SNAPSHOT, snapshot
from wareline.plans.registry import query, with_ctes

TOP_SQL = f"""
shared AS (
  SELECT q.query_id, d.id AS product_id, sum(d.w * q.w) AS raw
  FROM doc_weights d JOIN query_weights q ON q.term = d.term GROUP BY ALL),
candidates AS (
  SELECT coalesce(s.query_id, e.query_id) AS query_id,
    coalesce(s.product_id, e.product_id) AS product_id,
    round(coalesce(raw, 0), 6) AS score, e.query_id IS NOT NULL AS exact_match
  FROM shared s FULL JOIN exact e
    ON e.query_id = s.query_id AND e.product_id = s.product_id
  WHERE e.query_id IS NOT NULL OR raw >= {S.THRESHOLD}),
hits AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id
    ORDER BY exact_match DESC, score DESC, product_id) AS INT) AS rank
  FROM candidates QUALIFY rank <= 5)"""


def terms_sql(name: str, source: str, stop_words=X.STOP_WORDS) -> str:
    """Words and pairs of ``source(id, text)``, with their counts."""
    stops = "[" + ", ".join(f"'{word}'" for word in stop_words) + "]"
    return f"""
{name}_words AS (
  SELECT id, list_filter(regexp_extract_all(strip_accents(lower(text)),
    '[\\pL\\pN_]{{2,}}'), lambda w: NOT list_contains({stops}, w)) AS words
  FROM {source}),
{name}_terms AS (
  SELECT id, unnest(list_concat(words, list_transform(range(1, len(words)),
    lambda i: words[i] || ' ' || words[i + 1]))) AS term FROM {name}_words),
{name}_counts AS (SELECT id, term, count(*) AS tf FROM {name}_terms GROUP BY ALL)"""


def lexical_sql(docs: str, queries: str) -> list[str]:
    """CTEs ranking ``docs(id, text)`` for ``queries(id, text)``."""
    return [
        f"corpus AS ({docs})",
        f"asked AS ({queries})",
        terms_sql("d", "corpus"),
        terms_sql("q", "asked"),
        """
vocabulary AS (
  SELECT term, ln((1 + (SELECT count(*) FROM corpus)) / (1 + count(*))) + 1 AS idf
  FROM d_counts GROUP BY term),
d_raw AS (SELECT id, term, tf * idf AS w FROM d_counts JOIN vocabulary USING (term)),
q_raw AS (SELECT id, term, tf * idf AS w FROM q_counts JOIN vocabulary USING (term)),
doc_weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM d_raw),
query_weights AS (
  SELECT id AS query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM q_raw),
tokens AS (
  SELECT DISTINCT id AS query_id,
    unnest(regexp_extract_all(lower(text), '[\\pL\\pN_-]+')) AS token FROM asked),
exact AS (
  SELECT query_id, id AS product_id FROM corpus JOIN tokens ON token = lower(id))""",
        TOP_SQL,
    ]


DOCS_SQL = "SELECT 'D' || doc_id AS id, text FROM documents"
BENCHMARK_SQL = "SELECT item_id AS id, text FROM benchmark"
PRODUCT_TEXT_SQL = (
    "SELECT product_id AS id, concat_ws(' ', product_name, category, about_product) "
    "AS text FROM snapshot"
)
QUESTIONS_SQL = """
SELECT main_category AS id, 'Tell me about ' || min(product_id) || ' or a '
  || min(product_name) || ' of ' || main_category AS text
FROM snapshot GROUP BY main_category"""


def benchmark_queries(spark, sf) -> DataFrame:
    return D.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )


def category_questions(rows: DataFrame) -> DataFrame:
    """One question per main category, naming its first product."""
    return rows.groupBy(F.col("main_category").alias("query_id")).agg(
        F.concat(
            F.lit("Tell me about "),
            F.min("product_id"),
            F.lit(" or a "),
            F.min("product_name"),
            F.lit(" of "),
            F.col("main_category"),
        ).alias("query")
    )


@query(
    "lexical_search",
    with_ctes(*lexical_sql(DOCS_SQL, BENCHMARK_SQL), select="SELECT * FROM hits"),
)
def _(spark, sf):
    """Whole documents ranked for every benchmark text."""
    index = S.fit_lexical(D.documents(spark, sf))
    return S.lexical_search(index, benchmark_queries(spark, sf))


@query(
    "product_search",
    with_ctes(
        D.PRODUCTS_SQL,
        D.INVENTORY_SQL,
        SNAPSHOT,
        *lexical_sql(PRODUCT_TEXT_SQL, QUESTIONS_SQL),
        select="SELECT * FROM hits",
    ),
)
def _(spark, sf):
    """Products ranked for one question per category, named ids first."""
    rows = snapshot(spark, sf)
    index = S.fit_lexical(rows)
    return S.lexical_search(index, category_questions(rows))


@query(
    "lexical_answers",
    with_ctes(
        D.PRODUCTS_SQL,
        D.INVENTORY_SQL,
        SNAPSHOT,
        *lexical_sql(PRODUCT_TEXT_SQL, QUESTIONS_SQL),
        select=f"""
SELECT query_id, string_agg({FACT_SQL}, chr(10) ORDER BY rank)
    || chr(10) || 'These are stored catalog facts; other claims are not verified.' AS answer,
  string_agg(product_id, ',' ORDER BY rank) AS source_ids
FROM hits JOIN snapshot USING (product_id) WHERE rank <= 3 GROUP BY query_id""",
    ),
)
def _(spark, sf):
    """Cited facts per category question, from the lexical ranking."""
    rows = snapshot(spark, sf)
    questions = category_questions(rows)
    hits = S.lexical_search(S.fit_lexical(rows), questions, 3)
    answers = S.facts_answers(rows, hits, questions)
    return answers.withColumn("source_ids", F.array_join("source_ids", ","))


@query("hybrid_search")
def _(spark, sf):
    """Whole documents ranked by the mixed score for every benchmark text."""
    index = S.fit_search(D.documents(spark, sf))
    return S.search(index, benchmark_queries(spark, sf))


@query("facts_answers")
def _(spark, sf):
    """Cited facts per category question, from the mixed ranking."""
    rows = snapshot(spark, sf)
    questions = category_questions(rows)
    hits = S.search(S.fit_search(rows), questions, 3)
    return S.facts_answers(rows, hits, questions)


@query("search_in_stock")
def _(spark, sf):
    """The mixed ranking among products in stock below a price."""
    rows = snapshot(spark, sf)
    index = S.fit_search(rows)
    return S.search(
        index, category_questions(rows), 10, max_price=900.0, in_stock=True
    )


VECTORS_SQL = """
flat AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
    unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings),
means AS (SELECT label, pos, avg(x) AS m FROM flat GROUP BY ALL),
mean_length AS (SELECT label, sqrt(sum(m * m)) AS n FROM means GROUP BY label),
lengths AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM flat GROUP BY vec_id),
cosines AS (
  SELECT m.label AS query_id, 'V' || f.vec_id AS product_id,
    round(sum(f.x * m.m) / (any_value(l.n) * any_value(ml.n)), 6) AS score
  FROM flat f JOIN means m ON m.pos = f.pos JOIN lengths l ON l.vec_id = f.vec_id
    JOIN mean_length ml ON ml.label = m.label
  GROUP BY m.label, f.vec_id),
hits AS (
  SELECT *, false AS exact_match, CAST(row_number() OVER (PARTITION BY query_id
    ORDER BY score DESC, product_id) AS INT) AS rank
  FROM cosines WHERE score >= 0 QUALIFY rank <= 10)"""
RELEVANT_SQL = """
cases AS (
  SELECT h.query_id, min(CASE WHEN e.label = h.query_id THEN h.rank END) AS rank,
    string_agg(h.product_id, ',' ORDER BY h.rank) AS returned_ids
  FROM hits h JOIN embeddings e ON 'V' || e.vec_id = h.product_id GROUP BY h.query_id)"""


def _vectors(spark, sf) -> DataFrame:
    return D.table(spark, sf, "embeddings").select(
        F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("product_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        "label",
    )


def _label_means(vectors: DataFrame) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    cells = vectors.select("label", F.posexplode("vector").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.avg("x").alias("m"))
    # As many cells per label as a vector has positions.
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda c: c["m"]
        ).alias("vector")
    )


def _nearest(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    vectors = _vectors(spark, sf)
    queries = _label_means(vectors)
    return S.dense_search(vectors, queries, 10), vectors, queries


@query("latent_topk", with_ctes(VECTORS_SQL, select="SELECT * FROM hits"))
def _(spark, sf):
    """Ten nearest vectors to the mean of each label."""
    return _nearest(spark, sf)[0]


def _cases(spark, sf) -> DataFrame:
    hits, vectors, queries = _nearest(spark, sf)
    relevant = vectors.select(F.col("label").alias("query_id"), "product_id")
    return S.evaluate_search(hits, relevant, queries)


@query("search_cases", with_ctes(VECTORS_SQL, RELEVANT_SQL, select="SELECT * FROM cases"))
def _(spark, sf):
    """First relevant rank and returned ids per label."""
    return _cases(spark, sf).withColumn(
        "returned_ids", F.array_join("returned_ids", ",")
    )


@query(
    "search_eval",
    with_ctes(
        VECTORS_SQL,
        RELEVANT_SQL,
        select="""
SELECT count(*) AS queries, 10 AS k, round(count(rank) / count(*), 9) AS hit_rate_at_k,
  round(avg(coalesce(1.0::DOUBLE / rank, 0)), 9) AS mrr_at_k FROM cases""",
    ),
)
def _(spark, sf):
    """Hit rate and mean reciprocal rank over all labels."""
    scores = S.search_scores(_cases(spark, sf), 10)
    return scores.withColumns(
        {c: F.round(c, 9) for c in ("hit_rate_at_k", "mrr_at_k")}
    )


CITED_SQL = """
generated AS (
  SELECT doc_id, text AS answer, ['D' || doc_id, 'D' || (doc_id + 1), lang] AS source_ids,
    CASE doc_id % 4 WHEN 0 THEN [] WHEN 1 THEN ['D' || doc_id]
      WHEN 2 THEN ['D' || doc_id, 'FAKE'] ELSE [lang, 'D' || (doc_id + 1)] END AS cited_ids
  FROM documents)"""


@query(
    "citation_check",
    with_ctes(
        CITED_SQL,
        select="""
SELECT doc_id, len(cited_ids) > 0 AND list_has_all(source_ids, cited_ids)
  AND length(answer) BETWEEN 1 AND 5000 AS accepted FROM generated""",
    ),
)
def _(spark, sf):
    """Generated answers whose citations were retrieved."""
    own = F.concat(F.lit("D"), F.col("doc_id").cast("string"))
    following = F.concat(F.lit("D"), (F.col("doc_id") + 1).cast("string"))
    kind = F.col("doc_id") % 4
    cited = (
        F.when(kind == 0, F.array().cast("array<string>"))
        .when(kind == 1, F.array(own))
        .when(kind == 2, F.array(own, F.lit("FAKE")))
        .otherwise(F.array(F.col("lang"), following))
    )
    answers = D.table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("answer"),
        F.array(own, following, F.col("lang")).alias("source_ids"),
        cited.alias("cited_ids"),
    )
    return S.citation_check(answers).select("doc_id", "accepted")
