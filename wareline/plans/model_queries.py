"""Queries over training data, the classifier, its figures, and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wareline.operators import artifact as A
from wareline.operators import classify as C
from wareline.operators import monitor as M
from wareline.operators.features import spread
from wareline.operators.postings import corpus_terms, unknown_share
from wareline.plans import adapters as D
from wareline.plans.catalog_queries import SNAPSHOT, redact_sql, snapshot
from wareline.plans.registry import query, with_ctes
from wareline.plans.text_queries import terms_sql
from wareline.session import scratch_path, written

LABELLED = f"""
usable AS (
  SELECT trim(product_id) AS product_id, {redact_sql('trim(product_name)')} AS product_name,
    trim(split_part(trim(category), '|', 1)) AS label
  FROM products WHERE category IS NOT NULL),
keyed AS (
  SELECT *, regexp_replace(lower(product_name), '\\s+', ' ', 'g') AS name_key FROM usable
  WHERE label <> ''),
by_name AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY name_key ORDER BY product_id) = 1),
labelled AS (
  SELECT * FROM by_name QUALIFY count(*) OVER (PARTITION BY label) >= 5)"""
SPLIT = """
shuffled AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(product_id || '#42')) AS place,
    greatest(1, CAST(floor(count(*) OVER (PARTITION BY label) * 0.2) AS BIGINT)) AS held
  FROM labelled),
parted AS (
  SELECT product_id, label, CASE WHEN place <= held THEN 'test'
    WHEN place <= 2 * held THEN 'validation' ELSE 'train' END AS split FROM shuffled)"""


@query(
    "training_rows",
    with_ctes(
        D.PRODUCTS_SQL,
        LABELLED,
        select="SELECT product_id, product_name, label, name_key FROM labelled",
    ),
)
def _(spark, sf):
    """Training rows, one per product and name, of labels that are not rare."""
    return C.training_rows(D.products(spark, sf))[0]


@query(
    "stratified_split",
    with_ctes(D.PRODUCTS_SQL, LABELLED, SPLIT, select="SELECT * FROM parted"),
)
def _(spark, sf):
    """Train, validation and test rows, by label."""
    rows, _ = C.training_rows(D.products(spark, sf))
    return C.stratified_split(rows).select("product_id", "label", "split")


@query(
    "data_fingerprint",
    with_ctes(
        D.PRODUCTS_SQL,
        LABELLED,
        select="""
SELECT count(*) AS row_count, CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(31),
  product_id, product_name, label)), 1, 15) AS BIGINT)::HUGEINT) AS VARCHAR) AS fingerprint
FROM labelled""",
    ),
)
def _(spark, sf):
    """Hash of the training rows."""
    return C.data_fingerprint(C.training_rows(D.products(spark, sf))[0])


LANG_SHARES = """
now AS (SELECT lang AS label, count(*) AS rows FROM documents GROUP BY lang),
shares AS (SELECT label, rows, rows / (SELECT count(*) FROM documents) AS share FROM now)"""


@query("label_distribution", with_ctes(LANG_SHARES, select="SELECT * FROM shares"))
def _(spark, sf):
    """Share of each language among the documents."""
    return C.label_distribution(D.table(spark, sf, "documents"), "lang")


# The baseline of each source is what the other documents look like.
@query(
    "category_drift",
    with_ctes(
        LANG_SHARES,
        """
base AS (
  SELECT label, count(*) / (SELECT count(*) FROM documents d JOIN labels USING (doc_id)) AS share
  FROM (SELECT lang AS label FROM documents JOIN labels USING (doc_id)) GROUP BY label)""",
        select="""
SELECT round(sum(abs(coalesce(s.share, 0) - coalesce(b.share, 0))) / 2, 12)
  AS category_total_variation
FROM shares s FULL JOIN base b ON b.label = s.label""",
    ),
)
def _(spark, sf):
    """Language mix of all documents against the labelled ones."""
    documents = D.table(spark, sf, "documents")
    labelled = documents.join(D.table(spark, sf, "labels"), "doc_id", "left_semi")
    shift = M.category_shift(
        C.label_distribution(documents, "lang"), C.label_distribution(labelled, "lang")
    )
    return M.total_variation(shift).withColumn(
        "category_total_variation", F.round("category_total_variation", 12)
    )


@query(
    "monitor_report",
    with_ctes(
        D.PRODUCTS_SQL,
        D.INVENTORY_SQL,
        SNAPSHOT,
        LABELLED,
        """
now AS (
  SELECT main_category AS label, count(*) / (SELECT count(*) FROM snapshot) AS share
  FROM snapshot GROUP BY 1),
base AS (
  SELECT label, count(*) / (SELECT count(*) FROM labelled) AS share FROM labelled GROUP BY 1),
drift AS (
  SELECT sum(abs(coalesce(n.share, 0) - coalesce(b.share, 0))) / 2 AS d
  FROM now n FULL JOIN base b ON b.label = n.label)""",
        select=f"""
SELECT count(*) AS products,
  count(*) FILTER (discounted_price IS NULL) AS missing_price,
  count(*) FILTER (rating IS NULL) AS missing_rating,
  count(*) FILTER (stock_quantity IS NULL) AS unknown_inventory,
  (SELECT round(d, 12) FROM drift) AS category_total_variation,
  CASE WHEN (SELECT d FROM drift) > 0.2 THEN '{M.DRIFT_ALERT}' ELSE '' END AS alerts
FROM snapshot""",
    ),
)
def _(spark, sf):
    """Health of the catalog and drift from the training rows."""
    baseline = C.label_distribution(C.training_rows(D.products(spark, sf))[0])
    return M.monitor(snapshot(spark, sf), baseline).withColumns(
        {
            "category_total_variation": F.round("category_total_variation", 12),
            "alerts": F.array_join("alerts", "; "),
        }
    )


PREDICTED = """
predicted AS (
  SELECT CAST(quality AS VARCHAR) AS label, CASE WHEN n_chars > 2000 THEN '1'
    WHEN n_chars > 300 THEN '0' ELSE 'short' END AS guess
  FROM labels JOIN documents USING (doc_id)),
confusion AS (SELECT label, guess AS predicted, count(*) AS rows FROM predicted GROUP BY ALL),
names AS (SELECT label FROM confusion UNION SELECT predicted FROM confusion),
figures AS (
  SELECT n.label, coalesce(sum(rows) FILTER (c.label = n.label AND c.predicted = n.label), 0) AS tp,
    coalesce(sum(rows) FILTER (c.label = n.label), 0) AS support,
    coalesce(sum(rows) FILTER (c.predicted = n.label), 0) AS guessed
  FROM names n JOIN confusion c ON n.label IN (c.label, c.predicted) GROUP BY n.label),
classes AS (
  SELECT label, CASE WHEN guessed > 0 THEN tp / guessed ELSE 0.0 END::DOUBLE AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END::DOUBLE AS recall,
    (2 * tp / (support + guessed))::DOUBLE AS f1, CAST(support AS BIGINT) AS support, tp
  FROM figures)"""


def _guessed(spark, sf) -> DataFrame:
    """Document quality against a rule on the length."""
    rule = (
        F.when(F.col("n_chars") > 2000, "1")
        .when(F.col("n_chars") > 300, "0")
        .otherwise("short")
    )
    labelled = D.table(spark, sf, "labels").join(
        D.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    return C.confusion_counts(
        labelled.select(F.col("quality").alias("label"), rule.alias("category"))
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


@query(
    "classification_metrics",
    with_ctes(
        PREDICTED,
        select="SELECT round(sum(tp) / sum(support), 9) AS accuracy, "
        "round(avg(f1), 9) AS macro_f1 FROM classes",
    ),
)
def _(spark, sf):
    """Accuracy and macro F1 of the rule."""
    return _rounded(C.metrics(_guessed(spark, sf)), "accuracy", "macro_f1")


@query(
    "classification_report",
    with_ctes(
        PREDICTED,
        select="""
SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall,
  round(f1, 9) AS f1, support FROM classes
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9),
  round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM classes
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
  round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
  CAST(sum(support) AS BIGINT) FROM classes""",
    ),
)
def _(spark, sf):
    """Figures per label with their averages."""
    report = C.classification_report(_guessed(spark, sf))
    return _rounded(report, "precision", "recall", "f1")


@query(
    "confusion_matrix",
    with_ctes(
        PREDICTED,
        select="""
SELECT label, CAST(coalesce(sum(rows) FILTER (predicted = '0'), 0) AS BIGINT) AS "0",
  CAST(coalesce(sum(rows) FILTER (predicted = '1'), 0) AS BIGINT) AS "1",
  CAST(coalesce(sum(rows) FILTER (predicted = 'short'), 0) AS BIGINT) AS short
FROM confusion GROUP BY label""",
    ),
)
def _(spark, sf):
    """True against predicted labels."""
    return C.confusion_matrix(_guessed(spark, sf), ["0", "1", "short"])


@query(
    "majority_baseline",
    """SELECT lang AS label, count(*) AS rows FROM documents GROUP BY lang
ORDER BY rows DESC, label LIMIT 1""",
)
def _(spark, sf):
    """Most frequent language."""
    return C.majority_label(D.table(spark, sf, "documents"), "lang")


def _named(spark, sf) -> DataFrame:
    """Products whose category is the last word of the part name, so that a
    name tells its category."""
    noun = F.element_at(F.split(F.split_part("product_name", F.lit(" Brand"), F.lit(1)), " "), -1)
    return spread(D.products(spark, sf)).withColumn(
        "category", F.concat_ws("|", F.initcap(noun), F.col("category"))
    )


def _trained(spark, sf):
    rows = written(C.training_rows(_named(spark, sf))[0], "training")
    C.require_labels(rows)
    return C.train_classifier(C.stratified_split(rows))


def _names(spark, sf) -> DataFrame:
    """Product names; many lie in one file, so they are dealt to all cores."""
    return spread(D.products(spark, sf).select("product_id", "product_name"))


NAMED_SQL = """
named AS (
  SELECT * REPLACE (concat_ws('|', upper(noun[1]) || lower(noun[2:]), category) AS category)
  FROM (SELECT *, string_split(split_part(product_name, ' Brand', 1), ' ')[-1] AS noun
    FROM products))"""
NAMED_LABELLED = LABELLED.replace("FROM products", "FROM named")


def _saved(spark, sf) -> tuple[C.CategoryModel, str]:
    """A model trained on the products, and the folder it was saved to."""
    kept, excluded = C.training_rows(_named(spark, sf))
    rows, path = written(kept, "training"), scratch_path(spark, "model")
    C.require_labels(rows)
    model, frames = C.train_classifier(C.stratified_split(rows))
    A.save_model(model, path, rows, frames, excluded)
    return model, path


@query(
    "model_report",
    with_ctes(
        D.PRODUCTS_SQL,
        NAMED_SQL,
        NAMED_LABELLED,
        SPLIT,
        """
trained AS (SELECT label, count(*) AS rows FROM parted WHERE split = 'train' GROUP BY label),
majority AS (SELECT label FROM trained ORDER BY rows DESC, label LIMIT 1)""",
        select="""
SELECT label, rows, round(rows / (SELECT sum(rows) FROM trained), 12) AS share,
  (SELECT count(*) FROM parted WHERE split = 'validation') AS validation_rows,
  (SELECT count(*) FROM parted WHERE split = 'test') AS test_rows,
  (SELECT round(avg(CASE WHEN p.label = m.label THEN 1.0::DOUBLE ELSE 0 END), 12)
    FROM parted p, majority m WHERE split = 'test') AS baseline_accuracy,
  (SELECT CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(31), product_id, product_name,
    label)), 1, 15) AS BIGINT)::HUGEINT) AS VARCHAR) FROM labelled) AS data_fingerprint
FROM trained""",
    ),
)
def _(spark, sf):
    """What was saved with a model: its labels, the split, the baseline, its data."""
    _, path = _saved(spark, sf)
    about = A.describe(spark, path)
    sizes = A.report_table(spark, path, "split").agg(
        *[
            F.count_if(F.col("split") == name).alias(f"{name}_rows")
            for name in ("validation", "test")
        ]
    )
    baseline = A.report_table(spark, path, "baseline").select(F.round("accuracy", 12))
    return A.training_distribution(spark, path).select(
        "label",
        "rows",
        F.round("share", 12).alias("share"),
        sizes.select("validation_rows").scalar().alias("validation_rows"),
        sizes.select("test_rows").scalar().alias("test_rows"),
        baseline.scalar().alias("baseline_accuracy"),
        F.lit(about["data_fingerprint"]).alias("data_fingerprint"),
    )


@query(
    "predictions_from_saved_model",
    with_ctes(
        D.PRODUCTS_SQL,
        select="""
SELECT product_id, true AS category_agrees, true AS probabilities_agree, false AS abstained
FROM products""",
    ),
)
def _(spark, sf):
    """Every product name predicted by a saved and reloaded model, held against
    the model as it was trained."""
    model, path = _saved(spark, sf)
    names = _names(spark, sf)
    fresh = C.predict_categories(model, names).select(
        "product_id", F.struct("category", "probabilities").alias("fresh")
    )
    loaded = C.predict_categories(A.load_model(spark, path), names)
    return loaded.join(fresh, "product_id").select(
        "product_id",
        F.col("category").eqNullSafe(F.col("fresh.category")).alias("category_agrees"),
        F.col("probabilities").eqNullSafe(F.col("fresh.probabilities")).alias("probabilities_agree"),
        "abstained",
    )


@query("classifier_predictions")
def _(spark, sf):
    """Category predicted for every product name and every whole document."""
    model, _ = _trained(spark, sf)
    names = _names(spark, sf)
    texts = D.documents(spark, sf).select("product_id", "product_name")
    predicted = C.predict_categories(model, names).unionByName(
        C.predict_categories(model, texts, max_length=None)
    )
    return predicted.drop("product_name")


@query("classifier_evaluation")
def _(spark, sf):
    """Figures of the training run in one row."""
    return C.evaluation_report(*_trained(spark, sf))


@query(
    "unknown_vocabulary",
    with_ctes(
        "corpus AS (SELECT doc_id AS id, text FROM documents)",
        "names AS (SELECT page_id AS id, html AS text FROM pages)",
        terms_sql("d", "corpus", ()),
        terms_sql("q", "names", ()),
        """
vocabulary AS (
  SELECT DISTINCT term FROM d_counts),
known AS (SELECT DISTINCT id FROM q_counts JOIN vocabulary USING (term))""",
        select="""
SELECT 1 - (SELECT count(*) FROM known) / count(*) AS unknown_vocabulary_fraction
FROM pages""",
    ),
)
def _(spark, sf):
    """Share of pages without a term known from the documents."""
    documents = D.table(spark, sf, "documents")
    known = corpus_terms(documents, F.col("text"))
    return unknown_share(known, D.table(spark, sf, "pages"), "html")
