"""Queries for the single steps of the silver build (projections, parsers, keys, ranks).

Each step runs on the raw lines derived from the benchmark tables; ``SQL`` has
the DuckDB statement producing the same rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import domain as D
from ..functions.scalars import (
    content_hash, date_key, first_match, initcap_words, parse_date, parse_decimal, parse_int, surrogate_key,
)
from ..functions.measures import count_if, rows
from ..operators.clean import positive_filter, validate_by_category
from ..operators.windows import DEALT, dealt_by_key, keep_first_per_key, rank_distinct_rows, rank_within_key, row_code
from . import oracle as O
from . import silver
from .queries import bronze_of, silver_of


def _staged(spark, sf_dir):
    return silver.staging(bronze_of(spark, sf_dir))


def _cleaned(spark, sf_dir, keep_raw=True):
    return silver.clean_projection(_staged(spark, sf_dir).distinct(), keep_raw=keep_raw)


def _cleaned_by_lot(spark, sf_dir, hot_threshold=None):
    """As ``_cleaned``, with one shuffle by the lot key for the distinct rows and what follows within a key."""
    rows = dealt_by_key(_staged(spark, sf_dir), silver.raw_rank_key(), F.md5(row_code(silver.SRC_COLUMNS)), hot_threshold,
                        n_rows=bronze_of(spark, sf_dir).count())  # the footers of the written table tell
    return silver.clean_projection(rows.distinct(), keep=DEALT)


def _ranked(spark, sf_dir, hot_threshold=None):
    return rank_distinct_rows(silver.clean_projection(_staged(spark, sf_dir)), silver.rank_key(), silver.RAW_CODE,
                              "lot_rank", hot_threshold)


CLEAN_COLS = ["no_disposition", "identifiant_document", "date_mutation", "nature_mutation", "valeur_fonciere",
              "code_postal", "commune", "code_departement", "type_local", "surface_reelle_bati",
              "nombre_pieces_principales", "surface_terrain"]


def q_rename_projection(spark, sf_dir):
    return _staged(spark, sf_dir)


def q_distinct_rows(spark, sf_dir):
    return _staged(spark, sf_dir).distinct()


def q_clean_projection(spark, sf_dir):
    return _cleaned(spark, sf_dir, keep_raw=False)


def q_parse_decimal_comma(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return s.select("identifiant_document", "no_disposition", "reference_document",
                    F.col("valeur_fonciere").alias("raw_valeur_fonciere"),
                    parse_decimal("valeur_fonciere").alias("valeur_fonciere"),
                    F.col("surface_reelle_bati").alias("raw_surface_reelle_bati"),
                    parse_decimal("surface_reelle_bati").alias("surface_reelle_bati"),
                    parse_int("surface_terrain").alias("surface_terrain"))


def q_parse_date(spark, sf_dir):
    s = _staged(spark, sf_dir)
    return s.select("identifiant_document", "no_disposition", "reference_document",
                    F.col("date_mutation").alias("raw_date_mutation"),
                    parse_date("date_mutation", D.DATE_FORMATS).alias("date_mutation"))


def q_null_defaults(spark, sf_dir):
    return silver_of(spark, sf_dir).select(
        *[F.coalesce(F.col(p), F.lit(v)).alias(p) for p, v in D.GEO_DEFAULTS.items()]).distinct()


def q_category_case(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    t, n = F.col("type_local"), F.col("nature_mutation")
    cat = None
    for value, c, _, _ in D.TYPE_MEMBERS:
        cat = F.when(t == value, F.lit(c)) if cat is None else cat.when(t == value, F.lit(c))
    cat = cat.when(t.isNull(), F.lit(D.TYPE_NULL_CATEGORY)).otherwise(F.lit(D.TYPE_OTHER_CATEGORY))
    fam = first_match(n, [((tok,), f) for tok, f in D.NATURE_FAMILIES],
                      F.when(n.isNull(), F.lit(D.NATURE_NULL_FAMILY)).otherwise(F.lit(D.NATURE_OTHER_FAMILY)),
                      how="contains")
    zone = first_match(F.col("code_departement"), D.ZONES, F.lit(D.ZONE_FALLBACK))
    return s.select("mutation_id", cat.alias("categorie"), fam.alias("famille"), zone.alias("zone_analytique"))


def q_predicate_mix(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    t, n, sb = F.col("type_local"), F.col("nature_mutation"), F.col("surface_reelle_bati")
    return s.agg(
        rows().alias("n_rows"),
        count_if(t.isin(D.TYPE_HOUSE, D.TYPE_FLAT)).alias("n_residential"),
        count_if(~t.isin(D.TYPE_HOUSE, D.TYPE_FLAT)).alias("n_not_residential"),
        count_if(n.contains("vente") | n.contains("adjudication")).alias("n_market_sale"),
        count_if((sb >= 9) | sb.isNull()).alias("n_surface_ok"),
        count_if(~((sb >= 9) | sb.isNull())).alias("n_surface_small"),
        count_if(F.col("code_departement").isin("06", "13", "83", "84")).alias("n_paca"),
        count_if(t.isNull()).alias("n_type_null"),
    )


def q_initcap_words(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    vals = s.select(F.col("nature_mutation").alias("value")).union(s.select(F.col("type_local").alias("value")))
    return vals.distinct().select("value", initcap_words("value").alias("libelle"))


def q_unit_price(spark, sf_dir):
    return silver_of(spark, sf_dir).select("mutation_id", "type_local", "valeur_fonciere", "surface_reelle_bati",
                                           "surface_terrain", "prix_metre_carre")


def q_positive_filter(spark, sf_dir):
    c = positive_filter(_cleaned(spark, sf_dir, keep_raw=False), "valeur_fonciere")
    return c.select("identifiant_document", "no_disposition", "type_local", "valeur_fonciere")


def q_validate_by_category(spark, sf_dir):
    c = positive_filter(_cleaned(spark, sf_dir, keep_raw=False), "valeur_fonciere")
    rules, default = silver.validity_rules()
    return validate_by_category(c, "type_local", rules, default).select(
        "identifiant_document", "no_disposition", "type_local", "valeur_fonciere", "surface_reelle_bati")


def q_content_hash(spark, sf_dir):
    r = _ranked(spark, sf_dir)
    return r.select("no_disposition", "identifiant_document", "lot_rank",
                    content_hash(D.HASH_FIELDS, tail=["lot_rank"]).alias("mutation_id"))


def q_surrogate_key(spark, sf_dir):
    s = silver_of(spark, sf_dir).select("commune", "code_postal", "code_departement").distinct()
    return s.select("commune", "code_postal", "code_departement",
                    surrogate_key("commune", "code_postal", "code_departement").alias("geo_key"))


def q_date_key(spark, sf_dir):
    """Integer keys of the distinct sale dates (NULL in, NULL out is unit-tested)."""
    s = silver_of(spark, sf_dir).select("date_mutation").filter(F.col("date_mutation").isNotNull()).distinct()
    return s.select("date_mutation", date_key("date_mutation").alias("date_key"))


def q_rank_within_key(spark, sf_dir):
    """Distinct raw rows numbered inside their lot key (one shuffle)."""
    return _ranked(spark, sf_dir).select(*CLEAN_COLS, "raw_code", "lot_rank")


def q_rank_within_key_split(spark, sf_dir):
    """Same ranks with every key of two or more rows split into hash-range salts."""
    return _ranked(spark, sf_dir, hot_threshold=1).select(*CLEAN_COLS, "raw_code", "lot_rank")


def q_rank_within_window(spark, sf_dir):
    """The general operator: a window over already distinct rows, hot keys salted."""
    r = rank_within_key(_cleaned_by_lot(spark, sf_dir, hot_threshold=1), silver.rank_key(), [F.col(silver.RAW_CODE)], "lot_rank",
                        spread=F.md5(F.col(silver.RAW_CODE)), hot_threshold=1)
    return r.select(*CLEAN_COLS, "raw_code", "lot_rank")


def q_keep_first_per_key(spark, sf_dir):
    k = keep_first_per_key(_cleaned_by_lot(spark, sf_dir), ["identifiant_document", "no_disposition", *silver.rank_key()[2:]], silver.rank_order())
    return k.select(*CLEAN_COLS, "raw_code")


QUERIES = {
    "rename_projection": q_rename_projection,
    "distinct_rows": q_distinct_rows,
    "clean_projection": q_clean_projection,
    "parse_decimal_comma": q_parse_decimal_comma,
    "parse_date": q_parse_date,
    "null_defaults": q_null_defaults,
    "category_case": q_category_case,
    "predicate_mix": q_predicate_mix,
    "initcap_words": q_initcap_words,
    "unit_price": q_unit_price,
    "positive_filter": q_positive_filter,
    "validate_by_category": q_validate_by_category,
    "content_hash": q_content_hash,
    "surrogate_key": q_surrogate_key,
    "date_key": q_date_key,
    "rank_within_key": q_rank_within_key,
    "rank_within_key_split": q_rank_within_key_split,
    "rank_within_window": q_rank_within_window,
    "keep_first_per_key": q_keep_first_per_key,
}

# ------------------------------------------------------------------ oracle SQL
_clean_sel = ", ".join(CLEAN_COLS)
_type_cat = " ".join(f"WHEN type_local = {O._sql_str(v)} THEN {O._sql_str(c)}" for v, c, _, _ in D.TYPE_MEMBERS)
_fam = " ".join(f"WHEN nature_mutation LIKE {O._sql_str('%' + t + '%')} THEN {O._sql_str(f)}"
                for t, f in D.NATURE_FAMILIES)
_zone = " ".join(f"WHEN code_departement IN {O._in(c)} THEN {O._sql_str(z)}" for c, z in D.ZONES)

SQL = {
    "rename_projection": O.with_ctes("SELECT * FROM staging", upto="staging"),
    "distinct_rows": O.with_ctes("SELECT DISTINCT * FROM staging", upto="staging"),
    "clean_projection": O.with_ctes(f"SELECT {_clean_sel} FROM cleaned", upto="cleaned"),
    "parse_decimal_comma": O.with_ctes(
        "SELECT identifiant_document, no_disposition, reference_document, valeur_fonciere AS raw_valeur_fonciere, "
        + O.PARSE_DEC.format(c="valeur_fonciere") + " AS valeur_fonciere, "
        "surface_reelle_bati AS raw_surface_reelle_bati, "
        + O.PARSE_DEC.format(c="surface_reelle_bati") + " AS surface_reelle_bati, "
        "TRY_CAST(" + O.PARSE_DEC.format(c="surface_terrain") + " AS INTEGER) AS surface_terrain FROM staging",
        upto="staging"),
    "parse_date": O.with_ctes(
        "SELECT identifiant_document, no_disposition, reference_document, date_mutation AS raw_date_mutation, "
        + O.PARSE_DATE.format(c="date_mutation") + " AS date_mutation FROM staging", upto="staging"),
    "null_defaults": O.with_ctes(
        "SELECT DISTINCT " + ", ".join(f"COALESCE({p}, {O._sql_str(v)}) AS {p}" for p, v in D.GEO_DEFAULTS.items())
        + " FROM silver"),
    "category_case": O.with_ctes(
        f"SELECT mutation_id, CASE {_type_cat} WHEN type_local IS NULL THEN {O._sql_str(D.TYPE_NULL_CATEGORY)} "
        f"ELSE {O._sql_str(D.TYPE_OTHER_CATEGORY)} END AS categorie, "
        f"CASE {_fam} WHEN nature_mutation IS NULL THEN {O._sql_str(D.NATURE_NULL_FAMILY)} "
        f"ELSE {O._sql_str(D.NATURE_OTHER_FAMILY)} END AS famille, "
        f"CASE {_zone} ELSE {O._sql_str(D.ZONE_FALLBACK)} END AS zone_analytique FROM silver"),
    "predicate_mix": O.with_ctes(
        "SELECT COUNT(*) AS n_rows, "
        "COUNT(CASE WHEN type_local IN ('maison', 'appartement') THEN 1 END) AS n_residential, "
        "COUNT(CASE WHEN NOT (type_local IN ('maison', 'appartement')) THEN 1 END) AS n_not_residential, "
        "COUNT(CASE WHEN nature_mutation LIKE '%vente%' OR nature_mutation LIKE '%adjudication%' THEN 1 END) AS n_market_sale, "
        "COUNT(CASE WHEN surface_reelle_bati >= 9 OR surface_reelle_bati IS NULL THEN 1 END) AS n_surface_ok, "
        "COUNT(CASE WHEN NOT (surface_reelle_bati >= 9 OR surface_reelle_bati IS NULL) THEN 1 END) AS n_surface_small, "
        "COUNT(CASE WHEN code_departement IN ('06', '13', '83', '84') THEN 1 END) AS n_paca, "
        "COUNT(CASE WHEN type_local IS NULL THEN 1 END) AS n_type_null FROM silver"),
    "initcap_words": O.with_ctes(
        "SELECT value, " + O._initcap_sql("value") + " AS libelle FROM (SELECT nature_mutation AS value FROM silver "
        "UNION SELECT type_local AS value FROM silver) v"),
    "unit_price": O.with_ctes(
        "SELECT mutation_id, type_local, valeur_fonciere, surface_reelle_bati, surface_terrain, prix_metre_carre "
        "FROM silver"),
    "positive_filter": O.with_ctes(
        "SELECT identifiant_document, no_disposition, type_local, valeur_fonciere FROM cleaned "
        "WHERE valeur_fonciere IS NOT NULL AND valeur_fonciere > 0", upto="cleaned"),
    "validate_by_category": O.with_ctes(
        "SELECT identifiant_document, no_disposition, type_local, valeur_fonciere, surface_reelle_bati FROM cleaned "
        "WHERE valeur_fonciere IS NOT NULL AND valeur_fonciere > 0 AND " + O.RULE_CASE, upto="cleaned"),
    "content_hash": O.with_ctes(
        f"SELECT no_disposition, identifiant_document, lot_rank, {O.HASH} AS mutation_id FROM ranked", upto="ranked"),
    "surrogate_key": O.with_ctes(
        "SELECT commune, code_postal, code_departement, " + O.surrogate("commune", "code_postal", "code_departement")
        + " AS geo_key FROM (SELECT DISTINCT commune, code_postal, code_departement FROM silver) g"),
    "date_key": O.with_ctes(
        "SELECT date_mutation, CAST(year(date_mutation) * 10000 + month(date_mutation) * 100 + day(date_mutation) "
        "AS INTEGER) AS date_key FROM (SELECT DISTINCT date_mutation FROM silver WHERE date_mutation IS NOT NULL) d"),
    "rank_within_key": O.with_ctes(f"SELECT {_clean_sel}, raw_code, lot_rank FROM ranked", upto="ranked"),
    "rank_within_key_split": O.with_ctes(f"SELECT {_clean_sel}, raw_code, lot_rank FROM ranked", upto="ranked"),
    "rank_within_window": O.with_ctes(f"SELECT {_clean_sel}, raw_code, lot_rank FROM ranked", upto="ranked"),
    "keep_first_per_key": O.with_ctes(f"SELECT {_clean_sel}, raw_code FROM ranked WHERE lot_rank = 1",
                                      upto="ranked"),
}
