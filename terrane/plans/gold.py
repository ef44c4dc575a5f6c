"""Business aggregates over the silver table (one function per dataset)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import domain as D
from ..functions.measures import avg_ratio, count_distinct, exact_avg, exact_sum, rows
from ..functions.scalars import month_start, safe_ratio
from ..operators.aggregates import aggregate, top_groups
from ..operators.windows import pct_change

PRICE = "valeur_fonciere"
RATIO_SCALE = 6  # decimals kept when averaging a price ratio exactly


def _ratio():
    return safe_ratio(PRICE, "surface_reelle_bati")


def _avg_ratio():
    return avg_ratio(PRICE, "surface_reelle_bati", RATIO_SCALE)


def global_kpis(silver: DataFrame) -> DataFrame:
    """One row of country-wide indicators."""
    s = silver.filter(F.col(PRICE).isNotNull())
    return aggregate(s, [], [
        rows().alias("total_transactions"),
        count_distinct("commune").alias("nb_communes"),
        count_distinct("code_departement").alias("nb_departements"),
        F.min("date_mutation").alias("date_premiere_transaction"),
        F.max("date_mutation").alias("date_derniere_transaction"),
        exact_sum(PRICE).alias("volume_financier_total"),
        exact_avg(PRICE).alias("prix_moyen_france"),
        _avg_ratio().alias("prix_m2_moyen_france"),
    ], medians={"prix_median_france": PRICE}).select(
        "total_transactions", "nb_communes", "nb_departements", "date_premiere_transaction",
        "date_derniere_transaction", "volume_financier_total", "prix_moyen_france", "prix_median_france",
        "prix_m2_moyen_france")


def yoy_change(silver: DataFrame) -> DataFrame:
    """Year x type indicators with the change against the previous year present."""
    s = silver.filter(F.col(PRICE).isNotNull() & F.col("date_mutation").isNotNull())
    annual = aggregate(s, [F.year("date_mutation").alias("annee"), "type_local"], [
        rows().alias("nb_transactions"),
        exact_avg(PRICE).alias("prix_moyen"),
        _avg_ratio().alias("prix_m2_moyen"),
        exact_sum(PRICE).alias("volume_financier"),
    ], medians={"prix_median": PRICE})
    out = pct_change(annual, {"prix_moyen": "variation_prix_pct", "nb_transactions": "variation_volume_pct"},
                     ["type_local"], "annee")
    out = out.select("annee", "type_local", "nb_transactions", "prix_moyen", "prix_median", "prix_m2_moyen",
                     "volume_financier", "variation_prix_pct", "variation_volume_pct")
    return out.orderBy(F.col("annee").asc_nulls_last(), F.col("type_local").asc_nulls_last())


def avg_median_by_group(silver: DataFrame) -> DataFrame:
    """Average and median price by commune x postcode x type."""
    s = silver.filter(F.col(PRICE).isNotNull())
    return aggregate(s, ["commune", "code_postal", "type_local"], [
        rows().alias("nb_transactions"),
        exact_avg(PRICE).alias("prix_moyen"),
    ], medians={"prix_median": PRICE})


def avg_ratio_by_group(silver: DataFrame) -> DataFrame:
    """Average price per built m2 by commune x postcode x type."""
    s = silver.filter((F.col("surface_reelle_bati") > 0) & F.col(PRICE).isNotNull())
    return aggregate(s, ["commune", "code_postal", "type_local"], [
        rows().alias("nb_transactions"),
        _avg_ratio().alias("prix_m2_moyen"),
    ])


def region_benchmark(silver: DataFrame) -> DataFrame:
    """Department x type indicators."""
    s = silver.filter(F.col(PRICE).isNotNull() & F.col("code_departement").isNotNull())
    out = aggregate(s, ["code_departement", "type_local"], [
        rows().alias("nb_transactions"),
        exact_avg(PRICE).alias("prix_moyen"),
        _avg_ratio().alias("prix_m2_moyen"),
        exact_sum(PRICE).alias("volume_financier"),
    ], medians={"prix_median": PRICE})
    return out.select("code_departement", "type_local", "nb_transactions", "prix_moyen", "prix_median",
                      "prix_m2_moyen", "volume_financier")


def volume_by_month(silver: DataFrame) -> DataFrame:
    """Monthly count and volume; undated rows form the NULL month."""
    out = aggregate(silver, [month_start("date_mutation").alias("mois")], [
        rows().alias("nb_transactions"),
        exact_sum(PRICE).alias("volume_financier"),
    ])
    return out.orderBy(F.col("mois").asc_nulls_last())


def type_distribution(silver: DataFrame) -> DataFrame:
    """Row count per property type, largest first."""
    out = aggregate(silver, ["type_local"], [rows().alias("nb_transactions")])
    return out.orderBy(F.col("nb_transactions").desc_nulls_first(), F.col("type_local").asc_nulls_last())


def price_by_bin(silver: DataFrame, digits: int = 1) -> DataFrame:
    """Count and average price per type x rounded built surface."""
    s = silver.filter(F.col("surface_reelle_bati") > 0)
    out = aggregate(s, ["type_local", F.round("surface_reelle_bati", digits).cast("double").alias("tranche_surface")], [
        rows().alias("nb_transactions"),
        exact_avg(PRICE).alias("prix_moyen"),
    ])
    return out.orderBy(F.col("tranche_surface").asc_nulls_last(), F.col("type_local").asc_nulls_last())


def top_communes(silver: DataFrame, min_count: int = D.TOP_MIN_COUNT, k: int = D.TOP_K) -> DataFrame:
    """The k dearest communes among those with more than ``min_count`` sales."""
    return top_groups(silver, ["commune", "code_postal"], exact_avg(PRICE), "prix_moyen", min_count, k)
