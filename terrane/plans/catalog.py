"""Upstream tables written once per session and read back as parquet.

Like the layered warehouse it replaces, each model reads its upstream table
instead of recomputing it: the raw (bronze) lines and the silver table are
written to the session's shared checkpoint folder the first time a query
needs them.  The write also cuts the lineage, so a lost executor costs a
re-read, not a recomputation of the layers below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import freed_shuffles, scratch_dir

_WRITTEN: dict[tuple[str, str, str], str] = {}


def materialized(spark: SparkSession, name: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` written once per (application, name, source), then read back."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        app = spark.conf.get("spark.app.id", "session")
    key = (app, name, source)
    path = _WRITTEN.get(key)
    if path is None:
        path = scratch_dir(spark, name)
        rows = build()
        with freed_shuffles(spark):
            rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(path)
