"""Star schema: calendar, dimensions, fact and pre-aggregated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import domain as D
from ..functions.measures import count_distinct, count_if, exact_avg, exact_sum, flag_sum, rows
from ..functions.scalars import date_key, first_match, initcap_words, month_start, surrogate_key
from ..operators.aggregates import aggregate
from ..operators.joins import checked_broadcast, lookup
from ..operators.windows import pct_change

PRICE = "valeur_fonciere"
RATIO_SCALE = 6


# --------------------------------------------------------------------------- calendar
def calendar(spark: SparkSession, start: str = D.CALENDAR_START, end: str = D.CALENDAR_END,
             week_start: int = 0) -> DataFrame:
    """One row per day in [start, end] with its calendar attributes.

    ``week_start=0`` numbers days 0 = Sunday ... 6 = Saturday (so only Saturday is a
    weekend day under the ``IN (6, 7)`` test); ``1`` numbers 1 = Monday ... 7 = Sunday.
    Its size is fixed by the span, so it is safe to broadcast.
    """
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("first_day"), F.to_date(F.lit(end)).alias("last_day"))
    return calendar_between(bounds, week_start)


def calendar_of_dates(dates: DataFrame, column: str = "date_mutation", week_start: int = 0) -> DataFrame:
    """The calendar from the first to the last date of a column (no rows if it has no date)."""
    return calendar_between(dates.agg(F.min(column).alias("first_day"), F.max(column).alias("last_day")), week_start)


def calendar_between(bounds: DataFrame, week_start: int = 0) -> DataFrame:
    """The calendar of a one-row span (first_day, last_day)."""
    d = F.col("date_complete")
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date_complete"))
    dow = (F.dayofweek(d) - 1) if week_start == 0 else (F.weekday(d) + 1)
    q = F.quarter(d)
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("annee"),
        q.alias("trimestre_num"),
        F.concat(F.lit("T"), q.cast("string")).alias("trimestre_libelle"),
        F.month(d).alias("mois_num"),
        F.date_format(d, "MMMM").alias("mois_nom"),
        F.date_format(d, "MMM yyyy").alias("mois_annee"),
        F.weekofyear(d).alias("semaine_annee"),
        dow.cast("int").alias("jour_semaine_num"),
        F.date_format(d, "E").alias("jour_semaine_nom"),
        dow.isin(6, 7).alias("is_weekend"),
        F.concat(F.lit("T"), q.cast("string"), F.lit(" "), F.year(d).cast("string")).alias("libelle_trimestre_annee"),
        F.when(F.month(d) <= 6, F.lit("S1")).otherwise(F.lit("S2")).alias("semestre"),
    )


# --------------------------------------------------------------------------- dimensions
def geo_key(unknown_member: bool = False) -> Column:
    parts = ["commune", "code_postal", "code_departement"]
    if unknown_member:
        return surrogate_key(*[F.coalesce(F.col(p), F.lit(D.GEO_DEFAULTS[p])) for p in parts])
    return surrogate_key(*parts)


def dim_geography(silver: DataFrame, seed: DataFrame) -> DataFrame:
    """Distinct commune x postcode x department, named from the seed, with zones.

    ``seed`` has ``code_departement, nom_departement, region``.
    """
    places = silver.select(*[F.coalesce(F.col(p), F.lit(v)).alias(p) for p, v in D.GEO_DEFAULTS.items()]).distinct()
    seed = seed.select("code_departement", F.col("nom_departement").alias("__nom"), F.col("region").alias("__region"))
    enriched = lookup(places, seed, "code_departement")
    dep = F.col("code_departement")
    return enriched.select(
        surrogate_key("commune", "code_postal", "code_departement").alias("geo_key"),
        "commune", "code_postal", "code_departement",
        F.coalesce(F.col("__nom"), F.concat(F.lit(D.DEPARTMENT_NAME_PREFIX), dep)).alias("nom_departement"),
        F.coalesce(F.col("__region"), F.lit(D.REGION_DEFAULT)).alias("region"),
        first_match(dep, D.ZONES, F.coalesce(F.col("__region"), F.lit(D.ZONE_FALLBACK))).alias("zone_analytique"),
    )


def dim_type(silver: DataFrame) -> DataFrame:
    """Distinct property types (NULL is a member) with category, label and order."""
    t = F.col("type_local")
    types = silver.select("type_local").distinct()
    # Ordered chains over the members; the NULL member is tested after them.
    category = label = order = None
    for value, cat, lab, rank in D.TYPE_MEMBERS:
        hit = t == value
        category = F.when(hit, F.lit(cat)) if category is None else category.when(hit, F.lit(cat))
        label = F.when(hit, F.lit(lab)) if label is None else label.when(hit, F.lit(lab))
        order = F.when(hit, F.lit(rank)) if order is None else order.when(hit, F.lit(rank))
    category = category.when(t.isNull(), F.lit(D.TYPE_NULL_CATEGORY)).otherwise(F.lit(D.TYPE_OTHER_CATEGORY))
    label = label.when(t.isNull(), F.lit(D.TYPE_NULL_LABEL)).otherwise(initcap_words(t))
    order = order.otherwise(F.lit(D.TYPE_OTHER_ORDER))
    return types.select(
        surrogate_key(t).alias("type_bien_key"),
        F.coalesce(t, F.lit(D.TYPE_NULL_NAME)).alias("type_local"),
        category.alias("categorie"),
        label.alias("libelle"),
        order.cast("int").alias("ordre_affichage"),
    )


def dim_nature(silver: DataFrame) -> DataFrame:
    """Distinct transaction natures with family and market-sale flag."""
    n = F.col("nature_mutation")
    natures = silver.select("nature_mutation").distinct()
    family = None
    for token, fam in D.NATURE_FAMILIES:
        family = F.when(n.contains(token), F.lit(fam)) if family is None else family.when(n.contains(token), F.lit(fam))
    family = family.when(n.isNull(), F.lit(D.NATURE_NULL_FAMILY)).otherwise(F.lit(D.NATURE_OTHER_FAMILY))
    market = None
    for token in D.MARKET_SALE_TOKENS:
        market = n.contains(token) if market is None else (market | n.contains(token))
    return natures.select(
        surrogate_key(n).alias("nature_key"),
        F.coalesce(n, F.lit(D.NATURE_NULL_NAME)).alias("nature_mutation"),
        family.alias("famille"),
        F.when(market, F.lit(True)).otherwise(F.lit(False)).alias("is_vente_marchande"),
    )


# --------------------------------------------------------------------------- fact
def fact(silver: DataFrame, unknown_member: bool = False) -> DataFrame:
    """One row per dated mutation with dimension keys, measures and 0/1 flags.

    The geography key hashes the raw parts (a NULL part never finds its dimension
    row) unless ``unknown_member`` hashes the same defaults as the dimension.
    """
    s = silver.filter(F.col("date_mutation").isNotNull())
    return s.select(
        "mutation_id",
        date_key("date_mutation").alias("date_key"),
        geo_key(unknown_member).alias("geo_key"),
        surrogate_key("type_local").alias("type_bien_key"),
        surrogate_key("nature_mutation").alias("nature_key"),
        PRICE, "surface_reelle_bati", "surface_terrain", "nombre_pieces_principales", "prix_metre_carre",
        F.when(F.col(PRICE).isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("est_vente_avec_prix"),
        F.when(F.col("surface_reelle_bati") > 0, F.lit(1)).otherwise(F.lit(0)).alias("est_bien_bati"),
    )


# --------------------------------------------------------------------------- aggregates
def _price_measures() -> list[Column]:
    return [
        rows().alias("nb_transactions"),
        count_if(F.col("est_vente_avec_prix") == 1).alias("nb_ventes"),
        exact_sum(PRICE).alias("volume_financier"),
        exact_avg(PRICE).alias("prix_moyen"),
    ]


MEDIANS = {"prix_median": PRICE}


PRICE_COLUMNS = ["nb_transactions", "nb_ventes", "volume_financier", "prix_moyen", "prix_median"]


def _with_calendar(fact_df: DataFrame, cal: DataFrame, cols: list[str]) -> DataFrame:
    # A calendar of an ordinary span is broadcast, without a shuffle of the fact; one stretched by an outlying date isn't.
    return fact_df.join(checked_broadcast(cal.select("date_key", *cols)), "date_key", "inner")


def agg_year(fact_df: DataFrame, cal: DataFrame) -> DataFrame:
    """Type x year with min/max, surface, active places and three YoY changes."""
    f = _with_calendar(fact_df, cal, ["annee"])
    base = aggregate(f, ["type_bien_key", "annee"], _price_measures() + [
        F.min(PRICE).alias("prix_min"),
        F.max(PRICE).alias("prix_max"),
        exact_avg("prix_metre_carre", RATIO_SCALE).alias("prix_m2_moyen"),
        exact_avg("surface_reelle_bati").alias("surface_moyenne"),
        count_distinct("geo_key").alias("nb_communes_actives"),
    ], medians=MEDIANS)
    out = pct_change(base, {"prix_moyen": "variation_prix_yoy_pct",
                            "nb_transactions": "variation_volume_yoy_pct",
                            "volume_financier": "variation_volume_financier_yoy_pct"},
                     ["type_bien_key"], "annee")
    out = out.select("type_bien_key", "annee", *PRICE_COLUMNS, "prix_min", "prix_max", "prix_m2_moyen",
                     "surface_moyenne", "nb_communes_actives", "variation_prix_yoy_pct", "variation_volume_yoy_pct",
                     "variation_volume_financier_yoy_pct")
    return out.orderBy(F.col("annee").asc_nulls_last(), F.col("type_bien_key").asc_nulls_last())


def agg_month(fact_df: DataFrame, cal: DataFrame) -> DataFrame:
    """Type x month with calendar labels and the built-property count."""
    f = _with_calendar(fact_df, cal, ["date_complete", "annee", "trimestre_num", "trimestre_libelle",
                                      "mois_num", "mois_nom", "semestre"])
    m = month_start("date_complete")
    keys = ["type_bien_key", date_key(m).alias("date_mois_key"), m.alias("mois"), "annee", "trimestre_num",
            "trimestre_libelle", "mois_num", "mois_nom", "semestre"]
    out = aggregate(f, keys, _price_measures() + [
        exact_avg("prix_metre_carre", RATIO_SCALE).alias("prix_m2_moyen"),
        exact_avg("surface_reelle_bati").alias("surface_moyenne"),
        flag_sum("est_bien_bati").alias("nb_biens_batis"),
    ], medians=MEDIANS)
    return out.select("type_bien_key", "date_mois_key", "mois", "annee", "trimestre_num", "trimestre_libelle",
                      "mois_num", "mois_nom", "semestre", *PRICE_COLUMNS, "prix_m2_moyen", "surface_moyenne",
                      "nb_biens_batis")


def agg_region_year(fact_df: DataFrame, geo: DataFrame, cal: DataFrame) -> DataFrame:
    """Department x type x year with two YoY changes.

    The geography join is a plain equi-join: AQE broadcasts the dimension when its
    measured size is small and keeps a shuffle join (with skew splitting) otherwise.
    """
    f = _with_calendar(fact_df, cal, ["annee"])
    g = geo.select("geo_key", "code_departement", "nom_departement", "region")
    f = f.join(g, "geo_key", "inner")
    base = aggregate(f, ["code_departement", "nom_departement", "region", "type_bien_key", "annee"],
                     _price_measures() + [exact_avg("prix_metre_carre", RATIO_SCALE).alias("prix_m2_moyen")],
                     medians=MEDIANS)
    out = pct_change(base, {"prix_moyen": "variation_prix_yoy_pct", "nb_transactions": "variation_volume_yoy_pct"},
                     ["code_departement", "type_bien_key"], "annee")
    return out.select("code_departement", "nom_departement", "region", "type_bien_key", "annee", *PRICE_COLUMNS,
                      "prix_m2_moyen", "variation_prix_yoy_pct", "variation_volume_yoy_pct")


def agg_geo_year(fact_df: DataFrame, geo: DataFrame, cal: DataFrame,
                 min_count: int = D.GEO_YEAR_MIN_COUNT) -> DataFrame:
    """Place x type x year for groups of at least ``min_count`` rows.

    Every geography attribute depends on ``geo_key`` alone and ``geo_key`` is unique
    in the dimension, so the fact is aggregated by key first and the (much smaller)
    result joined to the dimension afterwards: same rows as join-then-group, but the
    big side never goes through the join.
    """
    f = _with_calendar(fact_df, cal, ["annee"])
    base = aggregate(f, ["geo_key", "type_bien_key", "annee"], _price_measures() + [
        F.min(PRICE).alias("prix_min"),
        F.max(PRICE).alias("prix_max"),
        exact_avg("prix_metre_carre", RATIO_SCALE).alias("prix_m2_moyen"),
        exact_avg("surface_reelle_bati").alias("surface_moyenne"),
    ], having=F.col("nb_transactions") >= min_count, medians=MEDIANS)
    g = geo.select("geo_key", "commune", "code_postal", "code_departement", "nom_departement", "region")
    out = base.join(g, "geo_key", "inner")
    return out.select("geo_key", "commune", "code_postal", "code_departement", "nom_departement", "region",
                      "type_bien_key", "annee", "nb_transactions", "nb_ventes", "volume_financier", "prix_moyen",
                      "prix_median", "prix_min", "prix_max", "prix_m2_moyen", "surface_moyenne")
