"""The batch job: raw CSV to published catalog."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession, functions as F

from wareline.operators.cleaning import (
    ORD,
    clean_products,
    prepare_unique,
    require_rows,
)
from wareline.operators.quality import quality_report, report_summary, require_quality
from wareline.schema import missing_columns, require_columns
from wareline.session import configure
from wareline.sources.files import read_raw_products, write_report, write_sample
from wareline.sources.store import CatalogStore


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def run_batch(spark: SparkSession, raw_path: str, root: str) -> dict:
    """Clean, gate, merge and publish one CSV; returns the row counts.

    Every run writes below its own ``runs/<id>``; the catalog only changes
    when the gate has passed and the merge has read back equal. The quality
    report is stored before the gate may stop the run.
    """
    configure(spark)
    started = time.perf_counter()
    run = {"run_id": uuid.uuid4().hex, "started_at": _now()}
    place = f"{root.rstrip('/')}/runs/{run['run_id']}"
    store = CatalogStore(spark, f"{root.rstrip('/')}/catalog")
    write_report(spark, {**run, "status": "running"}, f"{place}/run/running")
    try:
        summary = _steps(spark, raw_path, place, run["run_id"], store)
    except Exception as error:
        failed = {"status": "failed", "error_type": type(error).__name__}
        write_report(
            spark, {**run, **failed, "finished_at": _now()}, f"{place}/run/failed"
        )
        raise
    completed = {
        "status": "completed",
        "summary": summary,
        "finished_at": _now(),
        "duration_seconds": time.perf_counter() - started,
    }
    write_report(spark, {**run, **completed}, f"{place}/run/completed")
    return {**summary, "run_id": run["run_id"]}


def _steps(spark, raw_path, place, run_id, store) -> dict:
    raw = read_raw_products(spark, raw_path)
    require_rows(raw, "The raw dataset contains no rows.")
    cleaned = clean_products(raw)
    require_columns(cleaned)
    # Later steps read these copies; the CSV is parsed once for them all.
    cleaned.write.parquet(f"{place}/cleaned")
    cleaned = spark.read.schema(cleaned.schema).parquet(f"{place}/cleaned")
    require_rows(cleaned, "No usable products remain after cleaning.")
    prepared = prepare_unique(cleaned)
    prepared.write.parquet(f"{place}/prepared")
    prepared = spark.read.schema(prepared.schema).parquet(f"{place}/prepared")

    batch = prepared.drop(ORD)
    source = [c for c in cleaned.columns if c != ORD]
    report = quality_report(batch, source_columns=source)
    # Seventeen rows at most.
    checked = report_summary(report).first().asDict(recursive=True)
    write_report(
        spark,
        {
            **checked,
            "run_id": run_id,
            "generated_at": _now(),
            "rows_checked": prepared.count(),
            "missing_columns": missing_columns(batch),
        },
        f"{place}/quality",
    )
    require_quality(report)
    write_sample(cleaned, f"{place}/sample")
    verified = store.load_batch(prepared, run_id)
    counts = {
        "raw_rows": raw.agg(F.count("*")).first()[0],
        "cleaned_rows": cleaned.count(),
        "batch_rows": verified,
        "database_rows": store.product_count(),
    }
    return {
        **counts,
        "removed_rows": counts["raw_rows"] - counts["cleaned_rows"],
        "duplicate_product_ids": counts["cleaned_rows"] - verified,
    }
