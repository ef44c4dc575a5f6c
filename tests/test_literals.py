"""Fixed values and types, stated as literals: a wrong constant in the library would show here."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from terrane.functions.scalars import content_hash, initcap_words, surrogate_key
from terrane.plans import gold, silver, star
from tests.conftest import raw_row


def _rows(src_df, *rows):
    return silver.silver_rows(src_df([raw_row(**r) for r in rows]), already_staged=True)


def test_price_and_surface_rules_by_type(src_df):
    cases = [("Maison", "1000", "9", True), ("Maison", "999", "9", False), ("Maison", "1000", "8", False), ("Maison", "1000", None, True),
             ("Appartement", "1000", "9", True), ("Appartement", "1000", "8", False), ("Dépendance", "500", "1", True),
             ("Dépendance", "499", None, False), ("Local industriel. commercial ou assimilé", "1000", "5", True),
             ("Local industriel. commercial ou assimilé", "1000", "4", False), (None, "1000", "1", True), (None, "999", None, False),
             ("Terrain", "1000", None, True), ("Maison", "0", "9", False), ("Maison", "abc", "9", False)]
    out = _rows(src_df, *[dict(identifiant_document=str(i), type_local=t, valeur_fonciere=p, surface_reelle_bati=s)
                          for i, (t, p, s, _) in enumerate(cases)])
    assert {int(r.identifiant_document) for r in out.collect()} == {i for i, c in enumerate(cases) if c[3]}


def test_mutation_id_hashes_these_fields_in_this_order(src_df):
    import hashlib
    row = dict(no_disposition="1", identifiant_document="D9", date_mutation="05/03/2021", nature_mutation="Vente", valeur_fonciere="250000,00",
               code_postal="75001", commune="PARIS", code_departement="75", type_local="Maison", surface_reelle_bati="80",
               nombre_pieces_principales="4", surface_terrain="120")
    got = _rows(src_df, row).collect()[0].mutation_id
    assert got == hashlib.md5("1D92021-03-0525000075001parismaison8012041".encode()).hexdigest()


def test_zones_and_defaults(spark, src_df):
    s = _rows(src_df, *[dict(identifiant_document=str(i), valeur_fonciere="5000", commune="x", code_postal=str(i), code_departement=d)
                        for i, d in enumerate(["75", "95", "13", "06", "69", "33", "59", "99", None])])
    seed = spark.createDataFrame([("59", "Nord", "Hauts-de-France"), ("75", "Paris", "Île-de-France")],
                                 "code_departement string, nom_departement string, region string")
    got = {r.code_departement: (r.zone_analytique, r.nom_departement, r.region) for r in star.dim_geography(s, seed).collect()}
    assert got == {"75": ("Île-de-France", "Paris", "Île-de-France"), "95": ("Île-de-France", "Département 95", "Inconnue"),
                   "13": ("PACA", "Département 13", "Inconnue"), "06": ("PACA", "Département 06", "Inconnue"),
                   "69": ("Grandes métropoles", "Département 69", "Inconnue"), "33": ("Grandes métropoles", "Département 33", "Inconnue"),
                   "59": ("Hauts-de-France", "Nord", "Hauts-de-France"), "99": ("Autre", "Département 99", "Inconnue"),
                   "XX": ("Autre", "Département XX", "Inconnue")}


def test_scalar_literals(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    row = df.select(surrogate_key("x", "y").alias("k"), content_hash(["x", "y"]).alias("h"),
                    initcap_words(F.lit("sol-bâti (neuf) l'été a_b/c.d")).alias("i")).collect()[0]
    import hashlib
    assert row.k == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert row.h == hashlib.md5(b"a").hexdigest()
    assert row.i == "Sol-Bâti (Neuf) L'été A_B/C.D"


def test_money_stays_decimal_and_dates_stay_dates(spark, src_df):
    s = _rows(src_df, *[dict(identifiant_document=str(i), valeur_fonciere=v, date_mutation="2021-01-05", type_local="Maison",
                             surface_reelle_bati="10") for i, v in enumerate(["9007199254740993", "9007199254740993"])])
    types = dict(s.dtypes)
    assert types["valeur_fonciere"] == "decimal(38,0)" and types["date_mutation"] == "date" and types["surface_terrain"] == "int"
    kpis = gold.global_kpis(s)
    assert dict(kpis.dtypes)["volume_financier_total"].startswith("decimal") and dict(kpis.dtypes)["date_premiere_transaction"] == "date"
    row = kpis.collect()[0]
    assert row.volume_financier_total == Decimal("18014398509481986")  # beyond what a double holds
    assert row.date_premiere_transaction == dt.date(2021, 1, 5)


def test_calendar_spans_the_dates_and_its_attributes(spark):
    dates = spark.createDataFrame([(dt.date(2020, 12, 30),), (dt.date(2021, 1, 4),), (None,)], "date_mutation date")
    rows = {r.date_key: r for r in star.calendar_of_dates(dates).collect()}
    assert sorted(rows) == [20201230, 20201231, 20210101, 20210102, 20210103, 20210104]
    sat, fri = rows[20210102], rows[20210101]
    assert (sat.semaine_annee, sat.jour_semaine_num, sat.jour_semaine_nom, sat.is_weekend) == (53, 6, "Sat", True)
    assert (fri.mois_nom, fri.mois_annee, fri.trimestre_libelle, fri.semestre) == ("January", "Jan 2021", "T1", "S1")
    assert rows[20210103].jour_semaine_num == 0 and rows[20201231].libelle_trimestre_annee == "T4 2020"
    assert star.calendar_of_dates(dates.limit(0)).count() == 0
