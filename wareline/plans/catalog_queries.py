"""Queries over cleaning, quality, analytics, browsing and merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from wareline.functions import text as X
from wareline.operators import analytics as A
from wareline.operators import browse as B
from wareline.operators import cleaning as C
from wareline.operators import merge as M
from wareline.operators import quality as Q
from wareline.operators.catalog import public_snapshot
from wareline.plans import adapters as D
from wareline.plans.registry import query, with_ctes
from wareline.schema import PRODUCT_COLUMNS

P, RAW = D.PRODUCTS_SQL, D.RAW_SQL
ALL = ", ".join(PRODUCT_COLUMNS)


def mean2(value: str, scale: int = 100) -> str:
    """SQL for a mean rounded half-up to cents, in whole-number arithmetic.

    ``scale`` turns the value into an integer.
    """
    total = f"sum(CAST(round(({value}) * {scale}) AS BIGINT))"
    count, unit = f"count({value})", scale // 100
    up = f"(2 * abs({total}) + {count} * {unit}) // (2 * {count} * {unit})"
    if scale < 100:
        up = f"(2 * abs({total}) * {100 // scale} + {count}) // (2 * {count})"
    return (
        f"CASE WHEN {count} > 0 THEN CAST(sign({total}) * ({up}) AS DOUBLE) / 100 END"
    )


VIEW = """
view AS (
  SELECT product_id, product_name, category,
    CASE WHEN category IS NULL OR trim(category) = '' THEN 'Uncategorized'
         ELSE split_part(category, '|', 1) END AS main_category,
    actual_price, discounted_price, discount_percentage,
    round(actual_price - discounted_price, 2) AS savings_inr, rating, rating_count,
    CASE WHEN rating IS NULL THEN 'Unknown' WHEN rating >= 4.5 THEN 'Excellent'
         WHEN rating >= 4.0 THEN 'Good' WHEN rating >= 3.0 THEN 'Average' ELSE 'Low' END
      AS rating_level,
    CAST(actual_price IS NULL AS INT) + CAST(discounted_price IS NULL AS INT)
      + CAST(discount_percentage IS NULL AS INT) + CAST(rating IS NULL AS INT)
      + CAST(rating_count IS NULL AS INT) AS missing_numeric_fields
  FROM products)"""
RANKED = """
ranked AS (
  SELECT *, CASE WHEN rating IS NOT NULL THEN dense_rank() OVER (
    PARTITION BY main_category ORDER BY rating DESC NULLS LAST) END AS rating_rank
  FROM view)"""


@query("clean_products", with_ctes(RAW, select=f"SELECT {ALL}, _ord FROM cleaned"))
def _(spark, sf):
    """Cleaning of the raw rows, copies dropped."""
    return C.clean_products(D.raw_products(spark, sf))


@query("prepare_unique", with_ctes(RAW, select=f"SELECT {ALL}, _ord FROM prepared"))
def _(spark, sf):
    """One best row per product."""
    return C.prepare_unique(C.clean_products(D.raw_products(spark, sf)))


def _check(position, name, severity, count):
    return (
        f"SELECT {position} AS position, '{name}' AS name, '{severity}' AS severity, "
        f"CAST(({count}) AS BIGINT) AS invalid_count, ({count}) = 0 AS passed"
    )


def _quality_sql(rows: str) -> str:
    checks = [
        ("required_columns", "error", "SELECT 0"),
        ("nonempty_batch", "error", f"SELECT CAST(count(*) = 0 AS INT) FROM {rows}"),
        ("no_user_identifiers", "error", "SELECT 2"),
    ]
    for name in ("product_id", "product_name"):
        checks.append(
            (
                f"{name}_present",
                "error",
                f"SELECT count(*) FROM {rows} WHERE coalesce(trim({name}), '') = ''",
            )
        )
    checks.append(
        (
            "unique_product_ids",
            "error",
            f"SELECT count(*) - count(DISTINCT trim(product_id)) FROM {rows}",
        )
    )
    for name in D.PRODUCT_SCHEMA.fieldNames()[3:8]:
        top = {"rating": 5, "discount_percentage": 100}.get(name, "1e300")
        checks.append(
            (
                f"{name}_valid",
                "error",
                f"SELECT count(*) FROM {rows} WHERE {name} NOT BETWEEN 0 AND {top}",
            )
        )
        checks.append(
            (
                f"{name}_missing",
                "warning",
                f"SELECT count(*) FROM {rows} WHERE {name} IS NULL",
            )
        )
    checks.append(
        (
            "discounted_price_not_above_actual",
            "error",
            f"SELECT count(*) FROM {rows} WHERE discounted_price > actual_price",
        )
    )
    return " UNION ALL ".join(_check(i, *c) for i, c in enumerate(checks))


@query("quality_report", with_ctes(RAW, select=_quality_sql("cleaned")))
def _(spark, sf):
    """Seventeen checks over the cleaned rows, before ids are made unique."""
    raw = D.raw_products(spark, sf)
    return Q.quality_report(C.clean_products(raw), source_columns=raw.columns)


@query(
    "quality_summary",
    with_ctes(
        RAW,
        f"checks AS ({_quality_sql('cleaned')})",
        select="""
SELECT count(*) FILTER (severity = 'error' AND NOT passed) AS failed_checks,
  count(*) FILTER (severity = 'warning' AND NOT passed) AS warning_checks,
  CASE WHEN count(*) FILTER (severity = 'error' AND NOT passed) > 0 THEN 'failed'
    ELSE 'passed' END AS status
FROM checks""",
    ),
)
def _(spark, sf):
    """The report rolled up to one row."""
    raw = D.raw_products(spark, sf)
    report = Q.quality_report(C.clean_products(raw), source_columns=raw.columns)
    return Q.report_summary(report).drop("checks")


@query(
    "profile",
    with_ctes(
        RAW,
        "r AS (SELECT * EXCLUDE (_ord) FROM raw)",
        select="""
SELECT CAST((SELECT count(*) FROM r) AS BIGINT) AS row_count, 16 AS column_count,
  CAST((SELECT count(*) FROM r) - (SELECT count(*) FROM (SELECT DISTINCT * FROM r)) AS BIGINT)
    AS duplicate_rows""",
    ),
)
def _(spark, sf):
    """Rows, columns and whole-row copies of the raw data."""
    return Q.profile(D.raw_products(spark, sf).drop("_ord")).drop("dtypes")


@query(
    "profile_missing",
    with_ctes(
        RAW,
        select="SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS missing FROM raw WHERE {c} IS NULL"
            for c in [*PRODUCT_COLUMNS, "user_id", "user_name"]
        )
        + ") WHERE missing > 0",
    ),
)
def _(spark, sf):
    """Missing cells per column of the raw data."""
    return Q.missing_values(D.raw_products(spark, sf).drop("_ord"))


@query(
    "safe_preview",
    with_ctes(
        RAW,
        select="SELECT * EXCLUDE (user_id, user_name) FROM raw ORDER BY _ord LIMIT 100",
    ),
)
def _(spark, sf):
    """First 100 raw rows without the user columns."""
    return Q.preview(D.raw_products(spark, sf), "_ord", 100)


@query("product_analytics", with_ctes(P, VIEW, select="SELECT * FROM view"))
def _(spark, sf):
    """The analytics view."""
    return A.product_analytics(D.products(spark, sf))


@query("category_rankings", with_ctes(P, VIEW, RANKED, select="SELECT * FROM ranked"))
def _(spark, sf):
    """Rating rank of every product inside its category."""
    return A.category_rankings(D.products(spark, sf))


@query(
    "top3_with_ties",
    with_ctes(
        P,
        VIEW,
        RANKED,
        select="SELECT main_category, product_id, product_name, rating, rating_rank "
        "FROM ranked WHERE rating_rank <= 3",
    ),
)
def _(spark, sf):
    """Best three rating ranks per category."""
    return A.top_ranks_with_ties(D.products(spark, sf))


@query(
    "total_and_mean_rating",
    with_ctes(
        P,
        select=f"SELECT count(*) AS total_products, {mean2('rating', 10)} "
        "AS average_rating FROM products",
    ),
)
def _(spark, sf):
    """Number of products and their mean rating."""
    rows = D.products(spark, sf)
    return A.total_products(rows).withColumn(
        "average_rating", A.average_rating(rows).scalar()
    )


@query(
    "rating_level_counts",
    with_ctes(
        P,
        VIEW,
        select="SELECT rating_level, count(*) AS product_count FROM view GROUP BY ALL",
    ),
)
def _(spark, sf):
    """Products per rating level."""
    return A.rating_level_counts(D.products(spark, sf))


@query(
    "category_prices",
    with_ctes(
        P,
        VIEW,
        select=f"""SELECT main_category, count(*) AS product_count,
  {mean2('discounted_price')} AS average_price_inr,
  {mean2('savings_inr')} AS average_savings_inr
FROM view GROUP BY main_category""",
    ),
)
def _(spark, sf):
    """Mean price and savings per main category."""
    return A.category_prices(D.products(spark, sf))


@query(
    "category_summary_top10",
    with_ctes(
        P,
        select=f"""SELECT category, count(*) AS product_count,
  {mean2('discounted_price')} AS average_price, {mean2('rating', 10)} AS average_rating
FROM products WHERE category IS NOT NULL GROUP BY category
ORDER BY product_count DESC, category LIMIT 10""",
    ),
)
def _(spark, sf):
    """Ten largest categories."""
    return A.category_summary(D.products(spark, sf))


@query(
    "top_popular",
    with_ctes(
        P,
        select="""SELECT product_id, product_name, rating, rating_count FROM products
WHERE rating_count >= 1000
ORDER BY rating DESC NULLS LAST, rating_count DESC, product_id LIMIT 10""",
    ),
)
def _(spark, sf):
    """Ten best rated popular products."""
    return A.top_popular(D.products(spark, sf))


@query(
    "top_discounts",
    with_ctes(
        P,
        select="""SELECT product_name, actual_price, discounted_price, discount_percentage
FROM products WHERE discount_percentage IS NOT NULL
ORDER BY discount_percentage DESC, product_id LIMIT 10""",
    ),
)
def _(spark, sf):
    """Ten largest discounts."""
    return A.top_discounts(D.products(spark, sf))


@query(
    "incomplete_rows",
    with_ctes(
        P,
        VIEW,
        select="SELECT product_id, product_name, missing_numeric_fields FROM view "
        "WHERE missing_numeric_fields > 0",
    ),
)
def _(spark, sf):
    """Products with missing numbers."""
    return A.incomplete_rows(D.products(spark, sf))


@query(
    "price_inversions",
    with_ctes(
        P,
        select="SELECT product_id, actual_price, discounted_price FROM products "
        "WHERE discounted_price > actual_price",
    ),
)
def _(spark, sf):
    """Products sold above their list price."""
    return A.price_inversions(D.products(spark, sf))


@query(
    "spark_sql_views",
    with_ctes(
        P,
        VIEW,
        RANKED,
        select="SELECT main_category, rating_level, count(*) AS products, "
        "max(rating_rank) AS worst_rank FROM ranked GROUP BY ALL",
    ),
)
def _(spark, sf):
    """SQL text over the registered views."""
    A.register_views(D.products(spark, sf))
    return spark.sql(
        "SELECT main_category, rating_level, count(*) AS products, "
        "max(rating_rank) AS worst_rank FROM category_product_rankings "
        "GROUP BY main_category, rating_level"
    )


FILTERED = """
filtered AS (
  SELECT * FROM view
  WHERE (contains(lower(product_name), 'ring') OR contains(lower(product_id), 'ring'))
    AND main_category IN ('ECONOMY', 'STANDARD', 'Uncategorized')
    AND (rating >= 2.5 OR rating IS NULL))"""


def _filtered(spark, sf):
    view = A.product_analytics(D.products(spark, sf))
    return B.filter_products(
        view, "RING", ["ECONOMY", "STANDARD", "Uncategorized"], 2.5
    )


@query("filter_products", with_ctes(P, VIEW, FILTERED, select="SELECT * FROM filtered"))
def _(spark, sf):
    """Search text, categories and minimum rating together."""
    return _filtered(spark, sf)


@query(
    "filtered_kpis",
    with_ctes(
        P,
        VIEW,
        FILTERED,
        select=f"""SELECT count(*) AS products, {mean2('rating', 10)} AS average_rating,
  round(median(discounted_price), 4) AS median_price FROM filtered""",
    ),
)
def _(spark, sf):
    """Figures over the filtered products."""
    return B.kpis(_filtered(spark, sf))


@query(
    "category_value_counts",
    with_ctes(
        P,
        VIEW,
        select="SELECT main_category, count(*) AS product_count FROM view GROUP BY ALL",
    ),
)
def _(spark, sf):
    """Products per main category."""
    return B.value_counts(A.product_analytics(D.products(spark, sf)), "main_category")


@query(
    "page_products",
    with_ctes(
        P,
        VIEW,
        select="SELECT *, (SELECT count(*) FROM view) AS total FROM view "
        "ORDER BY product_id LIMIT 50 OFFSET 120",
    ),
)
def _(spark, sf):
    """One page in id order."""
    return B.page_products(A.product_analytics(D.products(spark, sf)), 120, 50)


@query(
    "lookup_product",
    with_ctes(P, select="SELECT * FROM products WHERE product_id = 'P42'"),
)
def _(spark, sf):
    """One product by id."""
    return B.lookup_product(D.products(spark, sf), "P42")


EXPORT = """
risky AS (
  SELECT * REPLACE (CASE WHEN substr(product_id, 2)::BIGINT % 11 = 0
    THEN ' =' || product_name ELSE product_name END AS product_name) FROM view)"""


@query(
    "export_safe",
    with_ctes(
        P,
        VIEW,
        EXPORT,
        select="SELECT * REPLACE (CASE WHEN regexp_matches(ltrim(product_name), '^[=+@-]') "
        "THEN '''' || product_name ELSE product_name END AS product_name) FROM risky",
    ),
)
def _(spark, sf):
    """Formula-like names are quoted on export."""
    view = A.product_analytics(D.products(spark, sf))
    key = F.substring("product_id", 2, 20).cast("bigint")
    risky = F.when(key % 11 == 0, F.concat(F.lit(" ="), F.col("product_name")))
    return B.export_safe(
        view.withColumn("product_name", F.coalesce(risky, F.col("product_name")))
    )


WORD_SQL = r"\pL\pN_"
EMAIL_SQL = rf"[{WORD_SQL}.+-]+@[{WORD_SQL}.-]+\.[A-Za-z]{{2,}}"
PHONE_SQL = rf"(^|[^{WORD_SQL}])(\+?\d[\d ()-]{{7,}}\d)($|[^{WORD_SQL}])"


def redact_sql(col: str) -> str:
    return (
        f"regexp_replace(regexp_replace(coalesce({col}, ''), '{EMAIL_SQL}', "
        rf"'[email removed]', 'g'), '{PHONE_SQL}', '\1[phone removed]\3', 'g')"
    )


@query("redact_documents", f"SELECT doc_id, {redact_sql('text')} AS text FROM documents")
def _(spark, sf):
    """Contact details masked in whole documents."""
    return D.table(spark, sf, "documents").select(
        "doc_id", X.redact(F.col("text")).alias("text")
    )


@query("redact_pages", f"SELECT page_id, {redact_sql('html')} AS html FROM pages")
def _(spark, sf):
    """Contact details masked in whole pages."""
    return D.table(spark, sf, "pages").select(
        "page_id", X.redact(F.col("html")).alias("html")
    )


SNAPSHOT = f"""
public AS (
  SELECT p.product_id, {redact_sql('product_name')} AS product_name,
    {redact_sql('category')} AS category, discounted_price, actual_price, rating,
    rating_count, {redact_sql('about_product')} AS about_product, stock_quantity
  FROM products p LEFT JOIN inventory i ON i.product_id = p.product_id),
snapshot AS (
  SELECT *, CASE WHEN trim(split_part(category, '|', 1)) = '' THEN 'Uncategorized'
    ELSE trim(split_part(category, '|', 1)) END AS main_category FROM public)"""


def snapshot(spark, sf):
    return public_snapshot(D.products(spark, sf), D.inventory(spark, sf))


@query(
    "public_snapshot",
    with_ctes(P, D.INVENTORY_SQL, SNAPSHOT, select="SELECT * FROM snapshot"),
)
def _(spark, sf):
    """What readers may see of the catalog."""
    return snapshot(spark, sf)


FACT_SQL = """'[' || product_id || '] ' || product_name || ': price '
  || CASE WHEN discounted_price IS NULL THEN 'unknown'
     ELSE 'INR ' || format('{:.2f}', discounted_price) END
  || '; rating ' || coalesce(CAST(rating AS VARCHAR), 'unknown') || '; stock '
  || CASE WHEN stock_quantity IS NULL THEN 'unknown' WHEN stock_quantity = 0
     THEN 'out of stock' ELSE stock_quantity || ' units' END || '.'"""


@query(
    "fact_lines",
    with_ctes(
        P,
        D.INVENTORY_SQL,
        SNAPSHOT,
        select=f"SELECT product_id, {FACT_SQL} AS fact FROM snapshot",
    ),
)
def _(spark, sf):
    """One sentence of facts per product."""
    return snapshot(spark, sf).select("product_id", X.fact_line().alias("fact"))


# The second batch: a new price for every product with an odd key, two ids
# that are new.
SECOND_SQL = """
second AS (
  SELECT * REPLACE (
    CASE WHEN substr(product_id, 2)::BIGINT % 1000 < 2 THEN 'N' || product_id
      ELSE product_id END AS product_id, CAST(90 AS DOUBLE) AS discounted_price,
    CAST(NULL AS DOUBLE) AS rating)
  FROM products WHERE substr(product_id, 2)::BIGINT % 2 = 1)"""


def second_batch(spark, sf):
    rows = D.products(spark, sf)
    key = F.substring("product_id", 2, 20).cast("bigint")
    return rows.where(key % 2 == 1).withColumns(
        {
            "product_id": F.when(
                key % 1000 < 2, F.concat(F.lit("N"), F.col("product_id"))
            ).otherwise(F.col("product_id")),
            "discounted_price": F.lit(90.0),
            "rating": F.lit(None).cast("double"),
            "_ord": key,
        }
    )


MERGED_SQL = """
merged AS (
  SELECT * FROM products WHERE product_id NOT IN (SELECT product_id FROM second)
  UNION ALL SELECT * FROM second)"""


@query(
    "upsert_merge",
    with_ctes(P, SECOND_SQL, MERGED_SQL, select=f"SELECT {ALL} FROM merged"),
)
def _(spark, sf):
    """Stored products after a second batch."""
    return M.merge_batch(D.products(spark, sf), second_batch(spark, sf))


@query(
    "upsert_verify",
    with_ctes(P, SECOND_SQL, select="SELECT count(*) AS verified_rows FROM second"),
)
def _(spark, sf):
    """Read-back of the second batch, NULLs equal."""
    batch = second_batch(spark, sf)
    return M.verified_rows(M.merge_batch(D.products(spark, sf), batch), batch)


@query(
    "batch_changes",
    with_ctes(
        P,
        SECOND_SQL,
        select="""
SELECT (SELECT count(*) FROM products) + row_number() OVER (ORDER BY
    ltrim(s.product_id, 'NP')::BIGINT) AS change_id, s.product_id,
  CASE WHEN p.product_id IS NULL THEN 'products_insert' ELSE 'products_update' END AS operation
FROM second s LEFT JOIN products p ON p.product_id = s.product_id""",
    ),
)
def _(spark, sf):
    """Feed rows of the second batch, after the first took one revision each."""
    rows = D.products(spark, sf)
    changes = M.batch_changes(rows, second_batch(spark, sf)).drop("changed_at")
    return changes.withColumn(
        "change_id", F.col("change_id") + rows.select(F.count("*")).scalar()
    )
