"""Not-modified revisits of a web archive.

A revisit record says that a page had not changed since an earlier capture and
has no body of its own. It is resolved by an as-of join: the latest full
response of the same canonical URL captured before it (of equal times the
largest record id below its own counts as earlier). The validators of both
are compared, the entity tag first, without its weak mark, then the date of
last change. A resolved revisit takes the body's digest of that response and
its headers, updated by those headers that a not-modified answer may carry.

The join looks back over the captures of a URL. Time is cut into ranges with
about as many captures each; a window runs inside one URL and range, and one
small row for each of them carries its latest response to the later ranges. A
URL with a third of all captures so is spread over many tasks.

Records without URL (null, blank or nothing but a scheme) or time are never joined: as revisits they come back as
``no_response``. Repeated records each give a row. An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wareline.llm.common import range_borders, range_of

#: The headers that a 304 answer may update.
UPDATABLE = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that only follow a visitor.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref|session_?id|sid)="


def canonical_url(url: Column) -> Column:
    """Host and path in one spelling.

    Scheme, ``www.`` and ``m.``, the default port, the fragment, tracking
    parameters and a closing slash go; host in lower case; parameters sorted.
    NULL where nothing is left, as of a blank text or a bare scheme.
    """
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    asked = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(F.lit("")))
    return F.when(whole != "", whole)


def as_of(rows: DataFrame, full: Column) -> DataFrame:
    """The rows that are not ``full``, with the latest earlier ``full`` one as ``found``."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    borders = range_borders(rows, "captured", parts)
    told = F.struct("captured", "record_id", "digest", "headers")
    work = rows.withColumn("range", range_of(F.col("captured"), borders)).withColumn(
        "told",
        F.when(full & F.col("page").isNotNull() & F.col("captured").isNotNull(), told),
    )
    latest = (
        work.where(F.col("told").isNotNull())
        .groupBy("page", "range")
        .agg(F.max_by("told", F.struct("captured", "record_id")).alias("told"))
    )
    wanted = work.where(~full).select("page", "range").distinct()
    earlier = Window.partitionBy("page").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        latest.join(wanted, ["page", "range"], "full")
        .withColumn("carried", F.last("told", ignorenulls=True).over(earlier))
        .select("page", "range", "carried")
    )
    inside = Window.partitionBy("page", "range").orderBy("captured", "record_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    timed = F.col("captured").isNotNull()
    return (
        work.withColumn("near", F.last("told", ignorenulls=True).over(inside))
        .where(~full)
        .join(carried, ["page", "range"], "left")
        .withColumn("found", F.when(timed, F.coalesce("near", "carried")))
        .drop("near", "carried", "told", "range")
    )


def _tag(headers: Column) -> Column:
    return F.regexp_replace(F.try_element_at(headers, F.lit("etag")), "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row for every revisit record.

    ``records``: record_id long, kind ``response`` or ``revisit``, url,
    captured long (any unit), digest, headers map with lower-case names.
    """
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        "kind",
        canonical_url(F.col("url")).alias("page"),
        F.col("captured").cast("long").alias("captured"),
        F.col("digest").alias("digest"),
        F.col("headers").alias("headers"),
    )
    full = F.col("kind") == "response"
    joined = as_of(rows, full)
    known = joined["found"].isNotNull()
    old, new = F.col("found.headers"), F.col("headers")
    tags = _tag(old) == _tag(new)
    dates = F.try_element_at(old, F.lit("last-modified")) == F.try_element_at(
        new, F.lit("last-modified")
    )
    # A missing validator on either side leaves the decision to the other one.
    agrees = F.coalesce(tags, dates, F.lit(False))
    status = (
        F.when(~known, "no_response").when(agrees, "resolved").otherwise("validator_mismatch")
    )
    update = F.map_filter(
        F.coalesce(new, F.create_map().cast("map<string,string>")),
        lambda name, _: name.isin(*UPDATABLE),
    )
    rest = F.map_filter(
        F.coalesce(old, F.create_map().cast("map<string,string>")),
        lambda name, _: ~F.array_contains(F.map_keys(update), name),
    )
    resolved = F.col("status") == "resolved"
    return joined.withColumn("status", status).select(
        "record_id",
        "page",
        "captured",
        "status",
        F.col("found.record_id").alias("refers_to"),
        F.when(resolved, F.col("found.digest")).alias("digest"),
        F.when(resolved, F.map_concat(rest, update)).alias("headers"),
    )


def headers_text(headers: Column) -> Column:
    """``name: value`` lines in the order of names, for comparing."""
    entries = F.array_sort(
        F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    )
    return F.array_join(entries, "\n")
