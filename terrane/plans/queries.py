"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They run the property plans on inputs derived from the benchmark tables (see
``tables``); ``oracle`` holds the equivalent SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import gold, silver, star
from .catalog import materialized
from .tables import bronze_from_tables, seed_from_tables

Query = Callable[[SparkSession, str], DataFrame]


def bronze_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines derived from the tables, as a written table."""
    return materialized(spark, "bronze", sf_dir, lambda: bronze_from_tables(spark, sf_dir))


def _silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_of(spark, sf_dir)
    return silver.silver_rows(bronze, n_rows=bronze.count())  # the footers of the written table tell


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table built from the raw lines, as a written table."""
    return materialized(spark, "silver", sf_dir, lambda: _silver_rows(spark, sf_dir))


def calendar_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar from the first to the last sale date, written once per session."""
    return materialized(spark, "dim_date", sf_dir, lambda: star.calendar_of_dates(silver_of(spark, sf_dir)))


def fact_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table, written once per session."""
    return materialized(spark, "fact_mutations", sf_dir, lambda: star.fact(silver_of(spark, sf_dir)))


def geo_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The geography dimension, written once per session."""
    return materialized(spark, "dim_geography", sf_dir,
                        lambda: star.dim_geography(silver_of(spark, sf_dir), seed_from_tables(spark, sf_dir)))


def _gold(fn) -> Query:
    return lambda spark, sf_dir: fn(silver_of(spark, sf_dir))


def q_silver_build(spark, sf_dir):
    """The full silver build (distinct, clean, rank, validate, key) from the raw table."""
    return _silver_rows(spark, sf_dir)


def q_calendar_dim(spark, sf_dir):
    return calendar_of(spark, sf_dir)


def q_dim_geo(spark, sf_dir):
    return star.dim_geography(silver_of(spark, sf_dir), seed_from_tables(spark, sf_dir))


def q_dim_type(spark, sf_dir):
    return star.dim_type(silver_of(spark, sf_dir))


def q_dim_nature(spark, sf_dir):
    return star.dim_nature(silver_of(spark, sf_dir))


def q_fact_build(spark, sf_dir):
    return star.fact(silver_of(spark, sf_dir))


def _star_inputs(spark, sf_dir):
    return fact_of(spark, sf_dir), geo_of(spark, sf_dir), calendar_of(spark, sf_dir)


def q_agg_year(spark, sf_dir):
    f, _, cal = _star_inputs(spark, sf_dir)
    return star.agg_year(f, cal)


def q_agg_month(spark, sf_dir):
    f, _, cal = _star_inputs(spark, sf_dir)
    return star.agg_month(f, cal)


def q_agg_region_year(spark, sf_dir):
    f, g, cal = _star_inputs(spark, sf_dir)
    return star.agg_region_year(f, g, cal)


def q_agg_geo_year(spark, sf_dir):
    f, g, cal = _star_inputs(spark, sf_dir)
    return star.agg_geo_year(f, g, cal)


QUERIES: dict[str, Query] = {
    "silver_build": q_silver_build,
    "global_kpis": _gold(gold.global_kpis),
    "yoy_change": _gold(gold.yoy_change),
    "avg_median_by_group": _gold(gold.avg_median_by_group),
    "avg_ratio_by_group": _gold(gold.avg_ratio_by_group),
    "region_benchmark": _gold(gold.region_benchmark),
    "volume_by_month": _gold(gold.volume_by_month),
    "type_distribution": _gold(gold.type_distribution),
    "price_by_bin": _gold(gold.price_by_bin),
    "top_groups": _gold(gold.top_communes),
    "calendar_dim": q_calendar_dim,
    "dim_geo": q_dim_geo,
    "dim_type": q_dim_type,
    "dim_nature": q_dim_nature,
    "fact_build": q_fact_build,
    "agg_year": q_agg_year,
    "agg_month": q_agg_month,
    "agg_region_year": q_agg_region_year,
    "agg_geo_year": q_agg_geo_year,
}
