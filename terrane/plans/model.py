"""The whole property model as named, lazily built DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from . import gold, star


def builders(silver: DataFrame, seed: DataFrame, calendar: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Silver, the nine business aggregates and the star schema, by table name.

    Values are zero-argument builders, so asking for one table plans only it.
    """
    geo = lambda: star.dim_geography(silver, seed)
    fact = lambda: star.fact(silver)
    return {
        "silver_mutation_f": lambda: silver,
        "gold_kpis": lambda: gold.global_kpis(silver),
        "evolution_annuelle": lambda: gold.yoy_change(silver),
        "prix_moyen_commune": lambda: gold.avg_median_by_group(silver),
        "prix_m2_commune": lambda: gold.avg_ratio_by_group(silver),
        "prix_par_departement": lambda: gold.region_benchmark(silver),
        "volume_mensuel": lambda: gold.volume_by_month(silver),
        "repartition_types": lambda: gold.type_distribution(silver),
        "surface_vs_prix": lambda: gold.price_by_bin(silver),
        "top_communes": lambda: gold.top_communes(silver),
        "dim_date": lambda: calendar,
        "dim_geography": geo,
        "dim_type_bien": lambda: star.dim_type(silver),
        "dim_nature_mutation": lambda: star.dim_nature(silver),
        "fact_mutations": fact,
        "agg_annuel_type_bien": lambda: star.agg_year(fact(), calendar),
        "agg_mensuel_type_bien": lambda: star.agg_month(fact(), calendar),
        "agg_departement_type_bien": lambda: star.agg_region_year(fact(), geo(), calendar),
        "agg_commune_type_bien": lambda: star.agg_geo_year(fact(), geo(), calendar),
    }


def datasets(silver: DataFrame, seed: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    """Every table of the model, built (lazily planned DataFrames)."""
    return {name: build() for name, build in builders(silver, seed, calendar).items()}
