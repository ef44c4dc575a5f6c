"""Queries for quality checks and incremental loads on the derived property tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import domain as D
from ..operators.quality import Check, run_checks, summarize
from ..operators.upsert import full_refresh, newer_than_target, upsert_table
from ..session import scratch_dir
from . import gold
from . import oracle as O
from .catalog import materialized
from .model import builders
from . import silver, star
from .runner import BI_TABLES, export_bi
from ..functions.scalars import parse_date
from .queries import bronze_of, calendar_of, fact_of, geo_of, silver_of
from .tables import BRONZE_SQL
from .tables import seed_from_tables

# Split date of the incremental scenario: the target holds rows up to it, the
# update batch re-sends the last half year (corrections) and everything newer.
TARGET_END = "1999-06-30"
UPDATES_FROM = "1999-01-01"


def _tables(spark, sf_dir, checks):
    """The tables under test, each written once per session (checks read built tables)."""
    build = builders(silver_of(spark, sf_dir), seed_from_tables(spark, sf_dir), calendar_of(spark, sf_dir))
    written = {"silver_mutation_f": lambda: silver_of(spark, sf_dir), "fact_mutations": lambda: fact_of(spark, sf_dir),
               "dim_geography": lambda: geo_of(spark, sf_dir), "dim_date": lambda: calendar_of(spark, sf_dir)}
    names = sorted({c.table for c in checks} | {c.to_table for c in checks if c.to_table})
    return {n: written[n]() if n in written else materialized(spark, n, sf_dir, build[n]) for n in names}


def _checks(kind: str | None = None) -> list[Check]:
    out = [Check(t, c, test, sev, where) for t, c, test, sev, where in D.DATA_TESTS]
    out += [Check(t, c, "relationships", "warn", None, pt, pc) for t, c, pt, pc in D.RELATIONSHIP_TESTS]
    if kind == "not_null":
        return [c for c in out if c.test == "not_null" and c.where is None]
    if kind == "not_null_where":
        return [c for c in out if c.test == "not_null" and c.where is not None]
    if kind in ("unique", "relationships"):
        return [c for c in out if c.test == kind]
    return out


def _report(kind=None):
    def q(spark, sf_dir):
        checks = _checks(kind)
        return run_checks(_tables(spark, sf_dir, checks), checks)
    return q


def q_quality_summary(spark, sf_dir):
    checks = _checks()
    return summarize(run_checks(_tables(spark, sf_dir, checks), checks))


def q_high_water_mark(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    target = s.filter(F.col("date_mutation") <= F.lit(TARGET_END).cast("date"))
    return newer_than_target(s, target, "date_mutation")


def _stale_target(s):
    d = F.col("date_mutation")
    stale = F.when(F.year(d) == 1999, F.col("valeur_fonciere") + 1).otherwise(F.col("valeur_fonciere"))
    return (s.filter(d <= F.lit(TARGET_END).cast("date"))
            .withColumn("valeur_fonciere", stale.cast("decimal(38,0)")))


def q_incremental_upsert(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    root = scratch_dir(spark, "silver-upsert")
    lean = {"carried": {"__id": F.unhex("mutation_id")}, "derived": {"mutation_id": F.lower(F.hex("__id"))}}  # an MD5 in hex digits
    upsert_table(_stale_target(s), root, "mutation_id", **lean)
    updates = s.filter(F.col("date_mutation") >= F.lit(UPDATES_FROM).cast("date"))
    return upsert_table(updates, root, "mutation_id", **lean)


def _first_load(b):
    d = parse_date(F.col("`Date mutation`"), D.DATE_FORMATS)
    return b.filter((d <= F.lit(TARGET_END).cast("date")) | d.isNull())


def _silver_incremental(restrict: bool):
    def q(spark, sf_dir):
        b = bronze_of(spark, sf_dir)
        root = scratch_dir(spark, "silver-incremental")
        silver.incremental_build(_first_load(b), root)
        return silver.incremental_build(b, root, restrict_to_new_keys=restrict)
    return q


LATE_DAYS = 120


def _shared_documents(b):
    """The raw lines with forty orders to a document, so that lots share their key."""
    doc = (F.col("`Identifiant de document`").cast("long") / 40).cast("long").cast("string")
    return b.withColumn("Identifiant de document", doc)


def q_silver_incremental_lookback(spark, sf_dir):
    """A load, then the rest with a lookback: a third of the last months' lines come late, into keys that exist."""
    b = _shared_documents(bronze_of(spark, sf_dir))
    d = parse_date(F.col("`Date mutation`"), D.DATE_FORMATS)
    late = (d > F.date_sub(F.lit(TARGET_END).cast("date"), LATE_DAYS // 2)) & (F.col("`Reference document`").cast("long") % 3 == 0)
    root = scratch_dir(spark, "silver-lookback")
    silver.incremental_build(_first_load(b).filter(~F.coalesce(late, F.lit(False))), root)
    return silver.incremental_build(b, root, lookback_days=LATE_DAYS)


def q_bi_export(spark, sf_dir):
    """Rows of every table exported for the dashboards, as written."""
    geo, fact, cal, s = geo_of(spark, sf_dir), fact_of(spark, sf_dir), calendar_of(spark, sf_dir), silver_of(spark, sf_dir)
    built = {n: b() for n, b in builders(s, seed_from_tables(spark, sf_dir), cal).items() if n not in
             ("silver_mutation_f", "fact_mutations", "dim_geography") and not n.startswith("agg_")}
    built |= {"dim_geography": geo, "agg_annuel_type_bien": star.agg_year(fact, cal), "agg_mensuel_type_bien": star.agg_month(fact, cal),
              "agg_departement_type_bien": star.agg_region_year(fact, geo, cal), "agg_commune_type_bien": star.agg_geo_year(fact, geo, cal)}
    return export_bi(built, scratch_dir(spark, "bi-export")).select("table_name", "row_count")


def q_full_refresh(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    root = scratch_dir(spark, "volume-mensuel")
    full_refresh(gold.volume_by_month(s.filter(F.col("valeur_fonciere") < 0)), root)  # an older, empty version
    return full_refresh(gold.volume_by_month(s), root)


QUERIES = {
    "test_not_null": _report("not_null"),
    "test_not_null_where": _report("not_null_where"),
    "test_unique": _report("unique"),
    "test_relationship": _report("relationships"),
    "quality_report": _report(None),
    "quality_summary": q_quality_summary,
    "high_water_mark": q_high_water_mark,
    "incremental_upsert": q_incremental_upsert,
    "full_refresh": q_full_refresh,
    "silver_incremental": _silver_incremental(True),
    "silver_incremental_all_keys": _silver_incremental(False),
    "silver_incremental_lookback": q_silver_incremental_lookback,
    "bi_export": q_bi_export,
}

# ------------------------------------------------------------------ oracle SQL
TABLE_SQL = {
    "silver_mutation_f": O.with_ctes("SELECT * FROM silver"),
    "gold_kpis": O.GOLD["global_kpis"],
    "evolution_annuelle": O.GOLD["yoy_change"],
    "prix_moyen_commune": O.GOLD["avg_median_by_group"],
    "prix_m2_commune": O.GOLD["avg_ratio_by_group"],
    "prix_par_departement": O.GOLD["region_benchmark"],
    "volume_mensuel": O.GOLD["volume_by_month"],
    "top_communes": O.GOLD["top_groups"],
    "dim_date": O.STAR["calendar_dim"],
    "dim_geography": O.STAR["dim_geo"],
    "dim_type_bien": O.STAR["dim_type"],
    "dim_nature_mutation": O.STAR["dim_nature"],
    "fact_mutations": O.STAR["fact_build"],
}


def _check_sql(c: Check) -> str:
    head = (f"SELECT {O._sql_str(c.table)} AS table_name, {O._sql_str(c.column)} AS column_name, "
            f"{O._sql_str(c.test)} AS test, {O._sql_str(c.severity)} AS severity, CAST(COUNT(*) AS BIGINT) AS failures ")
    t = f"t_{c.table}"
    if c.test == "not_null":
        return head + f"FROM {t} WHERE {c.column} IS NULL" + (f" AND ({c.where})" if c.where else "")
    if c.test == "unique":
        return head + (f"FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL GROUP BY {c.column} "
                       "HAVING COUNT(*) > 1) d")
    return head + (f"FROM {t} c WHERE c.{c.column} IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM t_{c.to_table} p WHERE p.{c.to_column} = c.{c.column})")


def report_sql(checks: list[Check]) -> str:
    names = sorted({c.table for c in checks} | {c.to_table for c in checks if c.to_table})
    ctes = ",\n".join(f"t_{n} AS (\n{TABLE_SQL[n]}\n)" for n in names)
    union = "\nUNION ALL\n".join(_check_sql(c) for c in checks)
    return (f"WITH {ctes}\nSELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
            f"ELSE 'fail' END AS status FROM (\n{union}\n) r")


_SILVER_COLS = ", ".join(D.SILVER_COLUMNS)

SQL = {
    "test_not_null": report_sql(_checks("not_null")),
    "test_not_null_where": report_sql(_checks("not_null_where")),
    "test_unique": report_sql(_checks("unique")),
    "test_relationship": report_sql(_checks("relationships")),
    "quality_report": report_sql(_checks()),
    "quality_summary": ("SELECT COUNT(CASE WHEN status = 'pass' THEN 1 END) AS pass_count, "
                        "COUNT(CASE WHEN status = 'warn' THEN 1 END) AS warn_count, "
                        "COUNT(CASE WHEN status = 'fail' THEN 1 END) AS fail_count, COUNT(*) AS total_count "
                        "FROM (" + report_sql(_checks()) + ") q"),
    "high_water_mark": O.with_ctes(
        "SELECT * FROM silver WHERE date_mutation > (SELECT MAX(date_mutation) FROM silver "
        f"WHERE date_mutation <= DATE '{TARGET_END}')"),
    "incremental_upsert": O.with_ctes(
        f"SELECT {_SILVER_COLS} FROM target t WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.mutation_id = t.mutation_id) "
        f"UNION ALL SELECT {_SILVER_COLS} FROM upd",
        [("target", _SILVER_COLS.replace(
            "valeur_fonciere,",
            "CAST(CASE WHEN year(date_mutation) = 1999 THEN valeur_fonciere + 1 ELSE valeur_fonciere END "
            "AS DECIMAL(38,0)) AS valeur_fonciere,", 1).join(["SELECT ", " FROM silver "
                                                              f"WHERE date_mutation <= DATE '{TARGET_END}'"])),
         ("upd", f"SELECT * FROM silver WHERE date_mutation >= DATE '{UPDATES_FROM}'")]),
    "full_refresh": O.GOLD["volume_by_month"],
}

_FIRST = ("SELECT * FROM (" + BRONZE_SQL + ") b WHERE " + O.PARSE_DATE.format(c='"Date mutation"')
          + f" <= DATE '{TARGET_END}' OR " + O.PARSE_DATE.format(c='"Date mutation"') + " IS NULL")
_INCR = ("WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in
                               O.silver_chain("s1_", _FIRST) + O.silver_chain("s2_", BRONZE_SQL)) +
         ",\nfresh AS (SELECT * FROM s2_silver WHERE date_mutation > (SELECT MAX(date_mutation) FROM s1_silver))\n"
         f"SELECT {_SILVER_COLS} FROM s1_silver t WHERE NOT EXISTS "
         "(SELECT 1 FROM fresh f WHERE f.mutation_id = t.mutation_id)\n"
         f"UNION ALL SELECT {_SILVER_COLS} FROM fresh")
SQL["silver_incremental"] = _INCR
SQL["silver_incremental_all_keys"] = _INCR

_SHARED = ("SELECT * REPLACE (CAST(CAST(\"Identifiant de document\" AS BIGINT) // 40 AS VARCHAR) AS \"Identifiant de document\") FROM ("
           + BRONZE_SQL + ") b")
_DAY = O.PARSE_DATE.format(c='"Date mutation"')
_EARLY = (f"SELECT * FROM ({_SHARED}) b WHERE ({_DAY} <= DATE '{TARGET_END}' OR {_DAY} IS NULL) AND NOT COALESCE("
          f"{_DAY} > DATE '{TARGET_END}' - {LATE_DAYS // 2} AND CAST(\"Reference document\" AS BIGINT) % 3 = 0, FALSE)")
_LOT = ("COALESCE(identifiant_document, chr(0)) || chr(1) || COALESCE(no_disposition, chr(0)) || chr(1) || COALESCE(type_local, '') || chr(1) "
        "|| COALESCE(CAST(surface_reelle_bati AS VARCHAR), '')")
# Keys with a raw line in the reopened days take all their rows from a rebuild, the others keep theirs.
SQL["silver_incremental_lookback"] = (
    "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in O.silver_chain("s1_", _EARLY) + O.silver_chain("s2_", _SHARED))
    + f",\nreopened AS (SELECT DISTINCT {_LOT} AS lot FROM s2_cleaned WHERE date_mutation >= "
      f"(SELECT MAX(date_mutation) FROM s1_silver) - {LATE_DAYS})\n"
      f"SELECT {_SILVER_COLS} FROM s1_silver WHERE {_LOT} NOT IN (SELECT lot FROM reopened) "
      f"UNION ALL SELECT {_SILVER_COLS} FROM s2_silver WHERE {_LOT} IN (SELECT lot FROM reopened)")

_BI_SQL = TABLE_SQL | {
    "repartition_types": O.GOLD["type_distribution"], "surface_vs_prix": O.GOLD["price_by_bin"],
    "agg_annuel_type_bien": O.STAR["agg_year"], "agg_mensuel_type_bien": O.STAR["agg_month"],
    "agg_departement_type_bien": O.STAR["agg_region_year"], "agg_commune_type_bien": O.STAR["agg_geo_year"],
}
SQL["bi_export"] = "\nUNION ALL\n".join(
    f"SELECT {O._sql_str(n)} AS table_name, COUNT(*) AS row_count FROM (\n{_BI_SQL[n]}\n) t" for n in BI_TABLES)
