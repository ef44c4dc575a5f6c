"""Catalog manifests: which remote archives exist, which are already landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..domain import ARCHIVE_TOKEN

CATALOG_SCHEMA = StructType([
    StructField("resources", ArrayType(StructType([StructField("url", StringType())]))),
])

PENDING, SKIPPED = "pending", "skipped"


def read_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Catalog JSON documents ``{"resources": [{"url": ...}, ...]}``."""
    return spark.read.schema(CATALOG_SCHEMA).option("multiLine", multi_line).json(path)


def manifest_filter(catalog: DataFrame, suffix: str = ".zip", contains: str = ARCHIVE_TOKEN) -> DataFrame:
    """Resource URLs ending with ``suffix`` and containing ``contains`` -> (url, name)."""
    items = catalog.select(F.explode("resources").alias("r")).select(F.col("r.url").alias("url"))
    items = items.filter(F.col("url").endswith(suffix) & F.col("url").contains(contains))
    return items.select("url", F.element_at(F.split("url", "/"), -1).alias("name"))


def year_windows(name: Column) -> Column:
    """Every 4-character window of ``name`` that reads 20dd."""
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.length(name) - 3, F.lit(1))),
                          lambda i: F.substring(name, i, 4))
    return F.filter(windows, lambda s: s.rlike("^20[0-9]{2}$"))


def manifest_diff(items: DataFrame, landed: DataFrame, mode: str = "casefold", suffix: str = ".zip") -> DataFrame:
    """Mark each item ``skipped`` when it is already landed, else ``pending``.

    ``items`` and ``landed`` each have a ``name`` column.
    * ``casefold``: the item name minus its last ``len(suffix)`` characters, lower-cased,
      equals a lower-cased landed name;
    * ``exact``: the item name equals a landed name (case-sensitive);
    * ``year``: some landed name contains the item's first ``20dd`` year; an item
      without a year is never skipped.
    The landed side is reduced to distinct keys first; AQE broadcasts it when small.
    """
    if mode == "casefold":
        ikey = F.lower(F.substring(F.col("name"), F.lit(1), F.length("name") - F.lit(len(suffix))))
        keys = landed.select(F.lower("name").alias("__key"))
    elif mode == "exact":
        ikey = F.col("name")
        keys = landed.select(F.col("name").alias("__key"))
    elif mode == "year":
        ikey = F.nullif(F.regexp_extract("name", r"20\d{2}", 0), F.lit(""))
        keys = landed.select(F.explode(year_windows(F.col("name"))).alias("__key"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    keys = keys.distinct().withColumn("__hit", F.lit(True))
    tagged = items.withColumn("__key", ikey).join(keys, "__key", "left")
    status = F.when(F.col("__hit"), F.lit(SKIPPED)).otherwise(F.lit(PENDING))
    return tagged.select(*[c for c in items.columns], status.alias("status"))


def manifest_summary(diff: DataFrame) -> DataFrame:
    """Item counts per status plus a ``total`` row (the names stay in ``diff``)."""
    per_status = diff.groupBy("status").agg(F.count(F.lit(1)).alias("files"))
    total = diff.agg(F.lit("total").alias("status"), F.count(F.lit(1)).alias("files"))
    return per_status.unionByName(total)
