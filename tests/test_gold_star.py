"""Gold and star datasets on small hand-made silver tables."""

import datetime as dt
from contextlib import contextmanager
from decimal import Decimal

import pytest
from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, StringType, StructField, StructType

from terrane import domain as D
from terrane.plans import gold, star
from terrane.plans.model import datasets

SILVER_SCHEMA = StructType([
    StructField("no_disposition", StringType()), StructField("identifiant_document", StringType()),
    StructField("date_mutation", DateType()), StructField("nature_mutation", StringType()),
    StructField("valeur_fonciere", DecimalType(38, 0)), StructField("code_postal", StringType()),
    StructField("commune", StringType()), StructField("code_departement", StringType()),
    StructField("type_local", StringType()), StructField("surface_reelle_bati", DecimalType(38, 0)),
    StructField("nombre_pieces_principales", StringType()), StructField("surface_terrain", IntegerType()),
    StructField("mutation_id", StringType()), StructField("prix_metre_carre", DoubleType()),
])


@contextmanager
def partitions(spark, n):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def srow(i, date, price, commune="paris", cp="75001", dep="75", typ="maison", surface=50, nature="vente"):
    d = dt.date.fromisoformat(date) if date else None
    ppm = price / surface if surface else None
    return ("1", f"doc{i}", d, nature, Decimal(price), cp, commune, dep, typ,
            Decimal(surface) if surface is not None else None, "3", 100, f"id{i}", ppm)


@pytest.fixture
def silver_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, SILVER_SCHEMA)
    return make


@pytest.fixture
def seed(spark):
    rows = [("01", "Ain", "Auvergne-Rhône-Alpes"), ("13", "Bouches-du-Rhône", "Provence-Alpes-Côte d'Azur"),
            ("2A", "Corse-du-Sud", "Corse"), ("75", "Paris", "Île-de-France"), ("971", "Guadeloupe", "Guadeloupe")]
    return spark.createDataFrame(rows, ["code_departement", "nom_departement", "region"])


def test_global_kpis(silver_df):
    s = silver_df([srow(1, "2021-01-01", 100000), srow(2, "2021-06-01", 200000, commune="lyon", dep="69"),
                   srow(3, None, 300000)])
    r = gold.global_kpis(s).collect()[0]
    assert r.total_transactions == 3 and r.nb_communes == 2 and r.nb_departements == 2
    assert r.prix_moyen_france == 200000.0 and r.prix_median_france == 200000.0
    assert r.date_premiere_transaction == dt.date(2021, 1, 1)


def test_yoy_uses_previous_row_even_with_a_gap(silver_df):
    s = silver_df([srow(1, "2020-05-01", 100000), srow(2, "2022-05-01", 150000), srow(3, "2022-06-01", 150000)])
    rows = {r.annee: r for r in gold.yoy_change(s).collect()}
    assert rows[2020].variation_prix_pct is None
    assert rows[2022].variation_prix_pct == 50.0 and rows[2022].variation_volume_pct == 100.0


def test_volume_by_month_keeps_null_month(silver_df):
    s = silver_df([srow(1, "2021-01-05", 1000), srow(2, "2021-01-20", 2000), srow(3, None, 5000)])
    rows = {r.mois: r.nb_transactions for r in gold.volume_by_month(s).collect()}
    assert rows == {dt.date(2021, 1, 1): 2, None: 1}


@pytest.mark.parametrize("n,expected", [(50, 0), (51, 1)])
def test_top_groups_needs_more_than_50(silver_df, n, expected):
    s = silver_df([srow(i, "2021-01-01", 1000 + i) for i in range(n)])
    assert gold.top_communes(s).count() == expected


def test_dim_geography_defaults_and_zones(silver_df, seed):
    s = silver_df([srow(1, "2021-01-01", 1000, dep="13"), srow(2, "2021-01-01", 1000, dep="99", commune="x"),
                   srow(3, "2021-01-01", 1000, dep="2A", commune="ajaccio"),
                   srow(4, "2021-01-01", 1000, dep=None, commune=None, cp=None)])
    g = {r.code_departement: r for r in star.dim_geography(s, seed).collect()}
    assert g["13"].zone_analytique == "PACA"
    assert g["99"].nom_departement == "Département 99" and g["99"].region == "Inconnue"
    assert g["99"].zone_analytique == "Autre"
    assert g["2A"].zone_analytique == "Corse"
    assert g["XX"].commune == "Inconnu" and g["XX"].code_postal == "XXXXX"


def test_null_parts_are_orphans_in_the_fact(spark, silver_df, seed):
    from terrane.operators.quality import Check, run_checks
    s = silver_df([srow(1, "2021-01-01", 1000), srow(2, "2021-01-01", 1000, commune=None)])
    t = {"fact": star.fact(s), "geo": star.dim_geography(s, seed)}
    r = run_checks(t, [Check("fact", "geo_key", "relationships", "warn", None, "geo", "geo_key")]).collect()[0]
    assert r.failures == 1 and r.status == "warn"
    t2 = {"fact": star.fact(s, unknown_member=True), "geo": t["geo"]}
    assert run_checks(t2, [Check("fact", "geo_key", "relationships", "warn", None, "geo", "geo_key")]).collect()[0].failures == 0


def test_dim_type_and_nature(silver_df):
    s = silver_df([srow(1, "2021-01-01", 1000, typ=None), srow(2, "2021-01-01", 1000, typ="terrain à bâtir"),
                   srow(3, "2021-01-01", 1000, nature=None), srow(4, "2021-01-01", 1000, nature="adjudication")])
    t = {r.type_local: r for r in star.dim_type(s).collect()}
    assert t["non renseigné"].categorie == "Non renseigné (terrain)"
    assert t["terrain à bâtir"].libelle == "Terrain À Bâtir" and t["terrain à bâtir"].ordre_affichage == 5
    n = {r.nature_mutation: r for r in star.dim_nature(s).collect()}
    assert n["inconnue"].famille == "Inconnue" and n["inconnue"].is_vente_marchande is False
    assert n["adjudication"].famille == "Vente judiciaire" and n["adjudication"].is_vente_marchande is True


def test_calendar_and_weekend(spark):
    cal = star.calendar(spark)
    assert cal.count() == 2557
    r = {x.date_complete: x for x in cal.filter("date_complete between '2021-01-01' and '2021-01-03'").collect()}
    assert r[dt.date(2021, 1, 1)].semaine_annee == 53
    assert r[dt.date(2021, 1, 2)].is_weekend is True          # Saturday
    assert r[dt.date(2021, 1, 3)].is_weekend is False         # Sunday = 0
    assert r[dt.date(2021, 1, 1)].mois_nom == "January" and r[dt.date(2021, 1, 1)].jour_semaine_nom == "Fri"


def test_facts_outside_calendar_are_lost_and_geo_threshold(silver_df, seed, spark):
    rows = [srow(i, "2021-03-01", 1000 + i) for i in range(5)] + [srow(10 + i, "2021-03-01", 1000, commune="b")
                                                                  for i in range(4)]
    rows += [srow(100, "2019-12-31", 1000), srow(101, "2027-01-01", 1000)]
    s = silver_df(rows)
    f, g, cal = star.fact(s), star.dim_geography(s, seed), star.calendar(spark)
    assert f.count() == 11
    years = {r.annee for r in star.agg_year(f, cal).collect()}
    assert years == {2021}
    geo = star.agg_geo_year(f, g, cal).collect()
    assert [(r.commune, r.nb_transactions) for r in geo] == [("paris", 5)]


def test_model_builds_every_table(silver_df, seed, spark):
    s = silver_df([srow(i, "2021-03-01", 1000 + i) for i in range(6)])
    t = datasets(s, seed, star.calendar(spark))
    assert set(t) >= {"gold_kpis", "fact_mutations", "agg_commune_type_bien"}
    for name, df in t.items():
        df.count()
    assert {c for c, *_ in D.DATA_TESTS} <= set(t)


def test_hot_group_medians_match_percentile(spark, silver_df):
    import random

    from pyspark.sql import functions as F

    random.seed(7)
    rows = [srow(i, "2021-03-01", random.randint(1000, 1200)) for i in range(400)]
    rows += [srow(1000 + i, "2021-03-01", random.randint(1000, 9000), commune=f"c{i % 9}") for i in range(90)]
    s = silver_df(rows)
    ref = {(r.commune, r.code_postal, r.type_local): r.m for r in s.groupBy("commune", "code_postal", "type_local")
           .agg(F.median(F.col("valeur_fonciere").cast("double")).alias("m")).collect()}
    for parts in (1, 30):  # groups inside one range of values, and across many
        with partitions(spark, parts):
            got = {(r.commune, r.code_postal, r.type_local): r.prix_median for r in gold.avg_median_by_group(s).collect()}
        assert got == ref
    kpi = gold.global_kpis(s).collect()[0].prix_median_france
    assert kpi == s.agg(F.median(F.col("valeur_fonciere").cast("double"))).collect()[0][0]


def test_hot_median_path_with_expression_keys(spark, silver_df, seed):
    import random

    random.seed(3)
    rows = [srow(i, f"202{i % 3}-0{1 + i % 9}-1{i % 10}", random.randint(1000, 1100),
                 commune=("paris" if i % 4 else "lyon"), typ=("maison" if i % 3 else None)) for i in range(300)]
    s = silver_df(rows)
    f, g, cal = star.fact(s), star.dim_geography(s, seed), star.calendar(spark)

    def run():
        return {
            "yoy": sorted(tuple(r) for r in gold.yoy_change(s).collect()),
            "month": sorted(tuple(r) for r in star.agg_month(f, cal).collect()),
            "region": sorted(tuple(r) for r in star.agg_region_year(f, g, cal).collect()),
        }
    with partitions(spark, 1):
        plain = run()
    with partitions(spark, 30):
        assert run() == plain


def test_a_calendar_stretched_by_an_outlying_date_is_not_broadcast(spark, silver_df):
    s = silver_df([srow(i, d, 1000 + i) for i, d in enumerate(["0001-01-03", "2021-03-01", "2021-04-01", "9999-12-31"])])
    f, cal = star.fact(s), star.calendar_of_dates(s)
    assert cal.count() > 3_000_000
    out = star._with_calendar(f, cal, ["annee"])
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.annee for r in out.select("annee").collect()) == [1, 2021, 2021, 9999]
    assert "strategy=broadcast" in star._with_calendar(f, star.calendar(spark), ["annee"])._jdf.queryExecution().optimizedPlan().toString()


def test_small_groups_are_gathered_and_large_ones_counted_with_the_same_result(spark):
    from statistics import median

    from terrane.functions.measures import count_distinct, rows
    from terrane.operators.aggregates import aggregate
    from terrane.session import scratch_scope
    data = [(k, None if i % 7 == 0 else (i * 37) % 101, i % 3) for k, n in (("a", 200), ("b", 3), (None, 150), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, v int, w int")
    want = {}
    for k in ("a", "b", None, "c"):
        own = [r for r in data if r[0] == k]
        vs = [float(v) for _, v, _ in own if v is not None]
        want[k] = (len(own), len({w for *_, w in own}), median(vs) if vs else None, median([float(w) for *_, w in own]))
    written = {}
    for limit in ("1000000", "20", "1"):
        spark.conf.set("terrane.groupRows", limit)
        try:
            with scratch_scope() as made:
                out = aggregate(df, ["k"], [rows().alias("n"), count_distinct("w").alias("d")], medians={"m": "v", "mw": "w"})
                assert out.columns == ["k", "n", "d", "m", "mw"]
                assert {r.k: (r.n, r.d, r.m, r.mw) for r in out.collect()} == want, limit
                written[limit] = any("value-counts" in p for p in made)
        finally:
            spark.conf.unset("terrane.groupRows")
    assert written == {"1000000": False, "20": True, "1": True}  # small groups' values are not counted, ranged and written


def test_tasks_follow_the_rows_and_not_only_the_sessions_partitions(spark):
    from terrane.session import task_count
    spark.conf.set("terrane.taskRows", "10")
    try:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert task_count(spark, 10 * parts) == [] and task_count(spark, 10 * parts + 1) == [parts + 1]
    finally:
        spark.conf.unset("terrane.taskRows")
