"""The catalog shapes, derived from the supplied test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wareline.operators.events import payload_hash
from wareline.operators.features import spread
from wareline.schema import EVENT_SCHEMA, PAYLOAD_SCHEMA, PRODUCT_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_every(n: int, key: Column, value: Column) -> Column:
    return F.when(key % n != 0, value)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fourteen-column products from ``part`` and ``lineitem``."""
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.count("*").alias("lines"))
    )
    percent = F.when(k % 97 == 0, F.lit(120)).otherwise(100 - k % 60)
    whole = F.expr("(CAST(round(p_retailprice * 100) AS BIGINT) * pct) div 100")
    values = {
        "product_id": F.concat(F.lit("P"), k.cast("string")),
        "product_name": F.concat_ws(" ", "p_name", "p_brand"),
        "category": _null_every(41, k, F.concat_ws("|", "p_type", "p_brand")),
        "actual_price": _null_every(23, k, F.col("p_retailprice")),
        "discounted_price": _null_every(29, k, whole.cast("double") / 100),
        "discount_percentage": _null_every(31, k, (k % 60).cast("double")),
        "rating": _null_every(17, k, ((k * 7) % 51).cast("double") / 10),
        "rating_count": F.col("lines") * (k % 300),
        "about_product": F.when(
            k % 2 == 0,
            F.concat(F.lit("Contact seller"), k.cast("string"), F.lit("@example.com")),
        ),
    }
    joined = part.join(lines, part.p_partkey == lines.l_partkey, "left").withColumn(
        "pct", percent
    )
    return joined.select(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in PRODUCT_SCHEMA.fields
        ]
    )


PRODUCTS_SQL = """
lines AS (SELECT l_partkey, count(*) AS lines FROM lineitem GROUP BY l_partkey),
products AS (
  SELECT 'P' || p_partkey AS product_id,
         p_name || ' ' || p_brand AS product_name,
         CASE WHEN p_partkey % 41 <> 0 THEN p_type || '|' || p_brand END AS category,
         CASE WHEN p_partkey % 29 <> 0 THEN
           CAST((CAST(round(p_retailprice * 100) AS BIGINT)
             * CASE WHEN p_partkey % 97 = 0 THEN 120 ELSE 100 - p_partkey % 60 END) // 100
             AS DOUBLE) / 100 END AS discounted_price,
         CASE WHEN p_partkey % 23 <> 0 THEN p_retailprice END AS actual_price,
         CASE WHEN p_partkey % 31 <> 0 THEN CAST(p_partkey % 60 AS DOUBLE) END
           AS discount_percentage,
         CASE WHEN p_partkey % 17 <> 0 THEN CAST((p_partkey * 7) % 51 AS DOUBLE) / 10 END
           AS rating,
         CAST(lines * (p_partkey % 300) AS BIGINT) AS rating_count,
         CASE WHEN p_partkey % 2 = 0
           THEN 'Contact seller' || p_partkey || '@example.com' END AS about_product,
         CAST(NULL AS VARCHAR) AS review_id, CAST(NULL AS VARCHAR) AS review_title,
         CAST(NULL AS VARCHAR) AS review_content, CAST(NULL AS VARCHAR) AS img_link,
         CAST(NULL AS VARCHAR) AS product_link
  FROM part LEFT JOIN lines ON l_partkey = p_partkey)"""


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy text rows: currency signs, padded ids, copies and variants."""
    key = F.substring("product_id", 2, 20).cast("bigint")
    base = products(spark, sf_dir).withColumn("k", key)
    money = {
        name: F.concat(F.lit("₹"), F.format_number(name, 2))
        for name in ("discounted_price", "actual_price")
    }
    text = base.withColumns(
        {
            **money,
            "product_id": F.concat(F.lit(" "), F.col("product_id"), F.lit(" ")),
            "discount_percentage": F.concat(
                F.col("discount_percentage").cast("int").cast("string"), F.lit("%")
            ),
            "rating": F.when(F.col("k") % 19 == 0, "|").otherwise(
                F.col("rating").cast("string")
            ),
            "user_id": F.concat(F.lit("U"), (F.col("k") % 7).cast("string")),
            "user_name": F.lit("Private name"),
        }
    )
    copies = F.array_compact(
        F.array(
            F.lit(0),
            F.when(F.col("k") % 10 == 0, 1),
            F.when(F.col("k") % 13 == 0, 2),
        )
    )
    return (
        text.withColumn("copy", F.explode(copies))
        .withColumn(
            "rating_count",
            F.when(
                F.col("copy") == 2, F.format_number(F.col("rating_count") + 1500, 0)
            ).otherwise(F.format_number("rating_count", 0)),
        )
        .withColumn("_ord", F.col("k") + F.col("copy") * 1000000)
        .drop("k", "copy")
    )


RAW_SQL = (
    PRODUCTS_SQL
    + """,
spelled AS (
  SELECT CAST(substr(product_id, 2) AS BIGINT) AS k, unnest(list_filter([0,
      CASE WHEN CAST(substr(product_id, 2) AS BIGINT) % 10 = 0 THEN 1 END,
      CASE WHEN CAST(substr(product_id, 2) AS BIGINT) % 13 = 0 THEN 2 END],
      lambda x: x IS NOT NULL)) AS copy, *
  FROM products),
raw AS (
  SELECT ' ' || product_id || ' ' AS product_id, product_name, category,
    '₹' || format('{:,.2f}', discounted_price) AS discounted_price,
    '₹' || format('{:,.2f}', actual_price) AS actual_price,
    CAST(CAST(discount_percentage AS INT) AS VARCHAR) || '%' AS discount_percentage,
    CASE WHEN k % 19 = 0 THEN '|' ELSE CAST(rating AS VARCHAR) END AS rating,
    format('{:,}', rating_count + CASE WHEN copy = 2 THEN 1500 ELSE 0 END) AS rating_count,
    about_product, review_id, review_title, review_content, img_link, product_link,
    'U' || (k % 7) AS user_id, 'Private name' AS user_name,
    k + copy * 1000000 AS _ord
  FROM spelled),
trimmed AS (
  SELECT DISTINCT ON (product_id, product_name, category, discounted_price, actual_price,
      discount_percentage, rating, rating_count, about_product, user_id, user_name)
    trim(product_id) AS product_id, * EXCLUDE (product_id)
  FROM raw
  ORDER BY _ord),
parsed AS (
  SELECT product_id, product_name, category,
    TRY_CAST(replace(replace(discounted_price, '₹', ''), ',', '') AS DOUBLE) AS discounted_price,
    TRY_CAST(replace(replace(actual_price, '₹', ''), ',', '') AS DOUBLE) AS actual_price,
    TRY_CAST(replace(discount_percentage, '%', '') AS DOUBLE) AS discount_percentage,
    TRY_CAST(rating AS DOUBLE) AS rating,
    TRY_CAST(replace(rating_count, ',', '') AS BIGINT) AS rating_count,
    about_product, review_id, review_title, review_content, img_link, product_link, _ord
  FROM trimmed),
cleaned AS (
  SELECT product_id, product_name, category,
    CASE WHEN discounted_price >= 0 THEN discounted_price END AS discounted_price,
    CASE WHEN actual_price >= 0 THEN actual_price END AS actual_price,
    CASE WHEN discount_percentage BETWEEN 0 AND 100 THEN discount_percentage END
      AS discount_percentage,
    CASE WHEN rating BETWEEN 0 AND 5 THEN rating END AS rating,
    CASE WHEN rating_count >= 0 THEN rating_count END AS rating_count,
    about_product, review_id, review_title, review_content, img_link, product_link, _ord
  FROM parsed WHERE product_id <> '' AND product_name <> ''),
prepared AS (
  SELECT * FROM cleaned
  QUALIFY row_number() OVER (PARTITION BY product_id
    ORDER BY rating_count DESC NULLS LAST, _ord) = 1)"""
)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per product from ``part``: some unknown, some without a row."""
    k = F.col("p_partkey")
    return (
        table(spark, sf_dir, "part")
        .where(k % 3 != 0)
        .select(
            F.concat(F.lit("P"), k.cast("string")).alias("product_id"),
            F.when(k % 5 != 0, F.col("p_size").cast("bigint") % 12).alias(
                "stock_quantity"
            ),
        )
    )


INVENTORY_SQL = """
inventory AS (
  SELECT 'P' || p_partkey AS product_id,
    CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS BIGINT) % 12 END AS stock_quantity
  FROM part WHERE p_partkey % 3 <> 0)"""


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed product events from ``events``, with retries and conflicts."""
    e = F.col("event_id")
    upsert = F.col("event_type") != "error"
    provided = F.col("event_type").isin("purchase", "view")
    cents = F.round(F.col("value") * 100).cast("bigint")
    payload = {
        "product_name": F.concat(F.lit("Item "), F.col("props")),
        "category": F.concat_ws("|", F.lit("Stream"), "event_type"),
        "discounted_price": cents / 100,
    }
    base = spread(table(spark, sf_dir, "events")).select(
        e.alias("ord"),
        F.concat(F.lit("e"), e.cast("string")).alias("event_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("product_id"),
        (1 + F.floor(e / 100) + (e * 37) % 40).cast("bigint").alias("version"),
        F.when(upsert, "upsert").otherwise("delete").alias("operation"),
        F.when(
            upsert,
            F.struct(
                *[
                    payload.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in PAYLOAD_SCHEMA.fields
                ]
            ),
        ).alias("product"),
        provided.alias("inventory_provided"),
        F.when(F.col("event_type") == "purchase", F.floor("value"))
        .cast("bigint")
        .alias("stock_quantity"),
    )
    copies = F.array_compact(
        F.array(
            F.lit(0),
            F.when(F.col("ord") % 50 == 0, 1),
            F.when(F.col("ord") % 70 == 0, 2),
        )
    )
    return (
        base.withColumn("copy", F.explode(copies))
        .withColumn("ord", F.col("ord") + F.col("copy") * 1000000)
        .withColumn(
            "version", F.col("version") + F.when(F.col("copy") == 2, 1).otherwise(0)
        )
        .withColumn("payload_hash", payload_hash())
        .select(EVENT_SCHEMA.fieldNames())
    )


EVENTS_SQL = """
typed AS (
  SELECT event_id AS base, unnest(list_filter([0,
      CASE WHEN event_id % 50 = 0 THEN 1 END,
      CASE WHEN event_id % 70 = 0 THEN 2 END], lambda x: x IS NOT NULL)) AS copy,
    'e' || event_id AS event_id, 'U' || user_id AS product_id,
    1 + event_id // 100 + (event_id * 37) % 40 AS v,
    CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS operation,
    event_type, 'Item ' || props AS product_name, 'Stream|' || event_type AS category,
    CAST(round(value * 100) AS BIGINT) AS cents,
    event_type IN ('purchase', 'view') AS provided,
    CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END AS stock
  FROM events),
ev AS (
  SELECT base + copy * 1000000 AS ord, event_id, product_id,
    v + CASE WHEN copy = 2 THEN 1 ELSE 0 END AS version, operation, product_name,
    category, cents, provided, stock
  FROM typed),
hashed AS (
  SELECT *, md5(concat_ws('|', event_id, product_id, version, operation,
    CASE WHEN operation = 'upsert' THEN concat_ws('|', product_name, category, cents) END,
    provided, coalesce(CAST(stock AS VARCHAR), 'null'))) AS h FROM ev),
firsts AS (
  SELECT *, first_value(h) OVER by_id AS first_h, row_number() OVER by_id AS use_no
  FROM hashed WINDOW by_id AS (PARTITION BY event_id ORDER BY ord)),
fresh AS (
  SELECT *, max(version) OVER (PARTITION BY product_id ORDER BY ord
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
  FROM firsts WHERE use_no = 1),
decided AS (
  SELECT *, CASE WHEN newest IS NULL OR version > newest THEN 'applied' ELSE 'stale' END
    AS status FROM fresh),
applied AS (
  SELECT *, lag(operation) OVER by_product AS prev_op,
    last_value(CASE WHEN operation = 'delete' THEN 0 WHEN provided THEN 1 END IGNORE NULLS)
      OVER (PARTITION BY product_id ORDER BY ord
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_stock
  FROM decided WHERE status = 'applied'
  WINDOW by_product AS (PARTITION BY product_id ORDER BY ord)),
opped AS (
  SELECT *, list_filter(
    CASE WHEN operation = 'upsert' THEN
      [CASE WHEN prev_op = 'upsert' THEN 'products_update' ELSE 'products_insert' END,
       CASE WHEN provided THEN CASE WHEN prev_stock = 1 THEN 'inventory_update'
         ELSE 'inventory_insert' END END]
    ELSE [CASE WHEN prev_stock = 1 THEN 'inventory_delete' END,
          CASE WHEN prev_op = 'upsert' THEN 'products_delete' END] END,
    lambda x: x IS NOT NULL) AS ops
  FROM applied),
feed AS (
  SELECT row_number() OVER (ORDER BY ord, pos) AS change_id, product_id, operation
  FROM (SELECT ord, product_id, unnest(ops) AS operation,
          unnest(range(len(ops))) AS pos FROM opped)),
revisions AS (
  SELECT d.ord, d.event_id, d.status,
    sum(coalesce(len(o.ops), 0)) OVER (ORDER BY d.ord) AS revision
  FROM decided d LEFT JOIN opped o ON o.ord = d.ord),
outcomes AS (
  SELECT f.ord, f.event_id,
    CASE WHEN f.use_no = 1 THEN r.status WHEN f.h = f.first_h THEN 'duplicate'
      ELSE 'conflict' END AS status,
    CASE WHEN f.use_no > 1 AND f.h = f.first_h THEN r.status END AS original_status,
    CASE WHEN f.use_no = 1 THEN CAST(r.revision AS BIGINT) END AS revision
  FROM firsts f JOIN revisions r ON r.event_id = f.event_id),
last_event AS (
  SELECT * FROM applied
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ord DESC) = 1),
last_touch AS (
  SELECT * FROM applied WHERE operation = 'delete' OR provided
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ord DESC) = 1),
catalog_rows AS (
  SELECT product_id, product_name, category, CAST(cents AS DOUBLE) / 100 AS discounted_price,
    version AS source_version
  FROM last_event WHERE operation = 'upsert'),
stock_rows AS (
  SELECT product_id, stock AS stock_quantity FROM last_touch WHERE operation = 'upsert')"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as public catalog rows."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("product_id"),
        F.col("text").alias("product_name"),
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("about_product"),
        F.col("lang").alias("main_category"),
        F.lit(None).cast("double").alias("discounted_price"),
        F.lit(None).cast("double").alias("rating"),
        F.lit(None).cast("bigint").alias("stock_quantity"),
    )
