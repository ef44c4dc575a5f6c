"""Reference SQL (DuckDB dialect) for every registered query.

Each query is a CTE chain over the pre-registered benchmark views, written
independently from the DataFrame code so the two can be compared.
"""

from __future__ import annotations

from .. import domain as D
from .tables import BRONZE_SQL, SEED_SQL, _sql_str

SRC = list(D.RENAME_MAP.values())


def _in(values) -> str:
    return "(" + ", ".join(_sql_str(v) for v in values) + ")"


STAGING = "SELECT " + ", ".join(f'"{k}" AS {v}' for k, v in D.RENAME_MAP.items()) + " FROM bronze"

PARSE_DATE = ("CAST(COALESCE(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%d/%m/%Y')) AS DATE)")
PARSE_DEC = "TRY_CAST(replace({c}, ',', '.') AS DECIMAL(38,0))"

CLEAN = (
    "SELECT no_disposition, identifiant_document, "
    + PARSE_DATE.format(c="date_mutation") + " AS date_mutation, "
    "lower(nature_mutation) AS nature_mutation, "
    + PARSE_DEC.format(c="valeur_fonciere") + " AS valeur_fonciere, "
    "code_postal, lower(commune) AS commune, code_departement, lower(type_local) AS type_local, "
    + PARSE_DEC.format(c="surface_reelle_bati") + " AS surface_reelle_bati, "
    "nombre_pieces_principales, "
    "TRY_CAST(" + PARSE_DEC.format(c="surface_terrain") + " AS INTEGER) AS surface_terrain, "
    + "concat_ws('|', " + ", ".join(f"COALESCE(CAST(length({c}) AS VARCHAR) || ':' || {c}, '-')" for c in SRC)
    + ") AS raw_code FROM (SELECT DISTINCT * FROM staging) d"
)

# The rank of a row is one more than the rows of its key that sort before it: counted by a join of the key with
# itself, with no window.
RANKED = (
    "SELECT c.*, 1 + COALESCE(n.smaller, 0) AS lot_rank FROM cleaned c LEFT JOIN (SELECT a.raw_code, COUNT(*) AS smaller "
    "FROM cleaned a JOIN cleaned b ON a.no_disposition IS NOT DISTINCT FROM b.no_disposition "
    "AND a.identifiant_document IS NOT DISTINCT FROM b.identifiant_document AND COALESCE(a.type_local, '') = COALESCE(b.type_local, '') "
    "AND COALESCE(CAST(a.surface_reelle_bati AS VARCHAR), '') = COALESCE(CAST(b.surface_reelle_bati AS VARCHAR), '') "
    "WHERE md5(b.raw_code) || b.raw_code < md5(a.raw_code) || a.raw_code GROUP BY a.raw_code) n ON c.raw_code = n.raw_code"
)

_rules = []
for types, min_price, min_surface in D.VALIDITY_RULES:
    pred = f"valeur_fonciere >= {min_price}"
    if min_surface is not None:
        pred += f" AND (surface_reelle_bati >= {min_surface} OR surface_reelle_bati IS NULL)"
    _rules.append(f"WHEN type_local IN {_in(types)} THEN {pred}")
RULE_CASE = "CASE " + " ".join(_rules) + f" ELSE valeur_fonciere >= {D.DEFAULT_MIN_PRICE} END"

FILTERED = "SELECT * FROM ranked WHERE valeur_fonciere IS NOT NULL AND valeur_fonciere > 0 AND " + RULE_CASE

HASH = ("md5(" + " || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in D.HASH_FIELDS)
        + " || CAST(lot_rank AS VARCHAR))")

UNIT_PRICE = (
    f"CASE WHEN type_local IN {_in(D.BUILT_TYPES)} AND surface_reelle_bati > 0 "
    "THEN CAST(valeur_fonciere AS DOUBLE) / NULLIF(CAST(surface_reelle_bati AS DOUBLE), 0) "
    f"WHEN type_local = {_sql_str(D.TYPE_OUTBUILDING)} THEN CAST(valeur_fonciere AS DOUBLE) / "
    "NULLIF(CAST(COALESCE(CAST(surface_reelle_bati AS DECIMAL(38,0)), CAST(surface_terrain AS DECIMAL(38,0))) AS DOUBLE), 0) "
    "ELSE NULL END"
)

SILVER_BODY = (
    "SELECT no_disposition, identifiant_document, date_mutation, nature_mutation, valeur_fonciere, "
    "code_postal, commune, code_departement, type_local, surface_reelle_bati, nombre_pieces_principales, "
    f"surface_terrain, {HASH} AS mutation_id, {UNIT_PRICE} AS prix_metre_carre FROM filtered"
)

BASE_CTES = [
    ("bronze", BRONZE_SQL),
    ("staging", STAGING),
    ("cleaned", CLEAN),
    ("ranked", RANKED),
    ("filtered", FILTERED),
    ("silver", SILVER_BODY),
]


def silver_chain(prefix: str, bronze_sql: str) -> list[tuple[str, str]]:
    """The silver CTE chain with every name prefixed, over another raw source."""
    import re
    names = [n for n, _ in BASE_CTES]
    out = []
    for name, sql in BASE_CTES:
        body = bronze_sql if name == "bronze" else sql
        if name != "bronze":
            for n in names:
                body = re.sub(rf"\b{n}\b", prefix + n, body)
        out.append((prefix + name, body))
    return out


def with_ctes(body: str, extra: list[tuple[str, str]] | None = None, upto: str = "silver") -> str:
    ctes = []
    for name, sql in BASE_CTES:
        ctes.append((name, sql))
        if name == upto:
            break
    ctes += extra or []
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes) + "\n" + body


def exact_avg(x: str, scale: int | None = None) -> str:
    v = x if scale is None else f"CAST({x} AS DECIMAL(28,{scale}))"
    return f"CAST(SUM({v}) AS DOUBLE) / COUNT({v})"


RATIO = "CAST(valeur_fonciere AS DOUBLE) / NULLIF(CAST(surface_reelle_bati AS DOUBLE), 0)"


def median_sql(x: str) -> str:
    """The median from the ordered values themselves: the mean of the one or two in the middle."""
    values = f"list_sort(list(CAST({x} AS DOUBLE)) FILTER (WHERE {x} IS NOT NULL))"
    return f"0.5 * {values}[(COUNT({x}) + 1) // 2] + 0.5 * {values}[(COUNT({x}) + 2) // 2]"


MEDIAN = median_sql("valeur_fonciere")


def pct(cur: str, prev: str) -> str:
    return f"round((CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) / NULLIF(CAST({prev} AS DOUBLE), 0) * 100, 2)"


# ------------------------------------------------------------------ gold
GOLD = {
    "global_kpis": with_ctes(
        "SELECT COUNT(*) AS total_transactions, COUNT(DISTINCT commune) AS nb_communes, "
        "COUNT(DISTINCT code_departement) AS nb_departements, MIN(date_mutation) AS date_premiere_transaction, "
        "MAX(date_mutation) AS date_derniere_transaction, SUM(valeur_fonciere) AS volume_financier_total, "
        f"{exact_avg('valeur_fonciere')} AS prix_moyen_france, {MEDIAN} AS prix_median_france, "
        f"{exact_avg(RATIO, 6)} AS prix_m2_moyen_france FROM silver WHERE valeur_fonciere IS NOT NULL"),
    "yoy_change": with_ctes(
        "SELECT now.annee, now.type_local, now.nb_transactions, now.prix_moyen, now.prix_median, now.prix_m2_moyen, "
        f"now.volume_financier, {pct('now.prix_moyen', 'before.prix_moyen')} AS variation_prix_pct, "
        f"{pct('now.nb_transactions', 'before.nb_transactions')} AS variation_volume_pct "
        "FROM annual now LEFT JOIN previous link ON link.annee = now.annee AND link.type_local IS NOT DISTINCT FROM now.type_local "
        "LEFT JOIN annual before ON before.annee = link.last AND before.type_local IS NOT DISTINCT FROM now.type_local "
        "ORDER BY now.annee, now.type_local",
        [("annual",
          "SELECT CAST(year(date_mutation) AS INTEGER) AS annee, type_local, COUNT(*) AS nb_transactions, "
          f"{exact_avg('valeur_fonciere')} AS prix_moyen, {MEDIAN} AS prix_median, "
          f"{exact_avg(RATIO, 6)} AS prix_m2_moyen, SUM(valeur_fonciere) AS volume_financier "
          "FROM silver WHERE valeur_fonciere IS NOT NULL AND date_mutation IS NOT NULL GROUP BY 1, 2"),
         ("previous", "SELECT a.annee, a.type_local, MAX(b.annee) AS last FROM annual a JOIN annual b "
                      "ON b.annee < a.annee AND b.type_local IS NOT DISTINCT FROM a.type_local GROUP BY 1, 2")]),
    "avg_median_by_group": with_ctes(
        "SELECT commune, code_postal, type_local, COUNT(*) AS nb_transactions, "
        f"{exact_avg('valeur_fonciere')} AS prix_moyen, {MEDIAN} AS prix_median "
        "FROM silver WHERE valeur_fonciere IS NOT NULL GROUP BY commune, code_postal, type_local"),
    "avg_ratio_by_group": with_ctes(
        "SELECT commune, code_postal, type_local, COUNT(*) AS nb_transactions, "
        f"{exact_avg(RATIO, 6)} AS prix_m2_moyen FROM silver "
        "WHERE surface_reelle_bati > 0 AND valeur_fonciere IS NOT NULL GROUP BY commune, code_postal, type_local"),
    "region_benchmark": with_ctes(
        "SELECT code_departement, type_local, COUNT(*) AS nb_transactions, "
        f"{exact_avg('valeur_fonciere')} AS prix_moyen, {MEDIAN} AS prix_median, "
        f"{exact_avg(RATIO, 6)} AS prix_m2_moyen, SUM(valeur_fonciere) AS volume_financier FROM silver "
        "WHERE valeur_fonciere IS NOT NULL AND code_departement IS NOT NULL GROUP BY code_departement, type_local"),
    "volume_by_month": with_ctes(
        "SELECT CAST(date_trunc('month', date_mutation) AS DATE) AS mois, COUNT(*) AS nb_transactions, "
        "SUM(valeur_fonciere) AS volume_financier FROM silver GROUP BY 1 ORDER BY 1 NULLS LAST"),
    "type_distribution": with_ctes(
        "SELECT type_local, COUNT(*) AS nb_transactions FROM silver GROUP BY type_local "
        "ORDER BY nb_transactions DESC, type_local"),
    "price_by_bin": with_ctes(
        "SELECT type_local, CAST(round(surface_reelle_bati, 1) AS DOUBLE) AS tranche_surface, "
        f"COUNT(*) AS nb_transactions, {exact_avg('valeur_fonciere')} AS prix_moyen FROM silver "
        "WHERE surface_reelle_bati > 0 GROUP BY 1, 2 ORDER BY 2, 1"),
    "top_groups": with_ctes(
        f"SELECT commune, code_postal, {exact_avg('valeur_fonciere')} AS prix_moyen FROM silver "
        f"GROUP BY commune, code_postal HAVING COUNT(*) > {D.TOP_MIN_COUNT} "
        f"ORDER BY prix_moyen DESC NULLS FIRST, commune NULLS LAST, code_postal NULLS LAST LIMIT {D.TOP_K}"),
}


# ------------------------------------------------------------------ star
def _calendar_sql() -> str:
    d = "CAST(gs AS DATE)"
    return (
        f"SELECT CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER) AS date_key, {d} AS date_complete, "
        f"CAST(year({d}) AS INTEGER) AS annee, CAST(quarter({d}) AS INTEGER) AS trimestre_num, "
        f"'T' || CAST(quarter({d}) AS VARCHAR) AS trimestre_libelle, CAST(month({d}) AS INTEGER) AS mois_num, "
        f"strftime({d}, '%B') AS mois_nom, strftime({d}, '%b %Y') AS mois_annee, "
        f"CAST(weekofyear({d}) AS INTEGER) AS semaine_annee, CAST(dayofweek({d}) AS INTEGER) AS jour_semaine_num, "
        f"strftime({d}, '%a') AS jour_semaine_nom, dayofweek({d}) IN (6, 7) AS is_weekend, "
        f"'T' || CAST(quarter({d}) AS VARCHAR) || ' ' || CAST(year({d}) AS VARCHAR) AS libelle_trimestre_annee, "
        f"CASE WHEN month({d}) <= 6 THEN 'S1' ELSE 'S2' END AS semestre "
        "FROM (SELECT unnest(generate_series(MIN(date_mutation), MAX(date_mutation), INTERVAL 1 DAY)) AS gs FROM silver) t"
    )


CALENDAR_SQL = _calendar_sql()
SURR_NULL = "'_dbt_utils_surrogate_key_null_'"


def surrogate(*cols: str) -> str:
    return "md5(" + " || '-' || ".join(f"COALESCE(CAST({c} AS VARCHAR), {SURR_NULL})" for c in cols) + ")"


_zone = " ".join(f"WHEN c.code_departement IN {_in(codes)} THEN {_sql_str(z)}" for codes, z in D.ZONES)
DIM_GEO_SQL = (
    "SELECT " + surrogate("c.commune", "c.code_postal", "c.code_departement") + " AS geo_key, "
    "c.commune, c.code_postal, c.code_departement, "
    f"COALESCE(d.nom_departement, {_sql_str(D.DEPARTMENT_NAME_PREFIX)} || c.code_departement) AS nom_departement, "
    f"COALESCE(d.region, {_sql_str(D.REGION_DEFAULT)}) AS region, "
    f"CASE {_zone} ELSE COALESCE(d.region, {_sql_str(D.ZONE_FALLBACK)}) END AS zone_analytique "
    "FROM (SELECT DISTINCT " + ", ".join(f"COALESCE({p}, {_sql_str(v)}) AS {p}" for p, v in D.GEO_DEFAULTS.items())
    + " FROM silver) c LEFT JOIN seed d ON c.code_departement = d.code_departement"
)


# Characters after which INITCAP begins a new word, besides white space (fixed values, stated here a second time).
INITCAP_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def _initcap_sql(x: str) -> str:
    """Letter by letter: upper case at the start and after white space or a breaking character, else lower case."""
    return (f"array_to_string(list_transform(generate_series(1, length({x})), lambda i: CASE WHEN i = 1 "
            f"OR regexp_matches(substr({x}, i - 1, 1), '\\s') OR contains({_sql_str(INITCAP_BREAKS)}, substr({x}, i - 1, 1)) "
            f"THEN upper(substr({x}, i, 1)) ELSE lower(substr({x}, i, 1)) END), '')")


_type_cat = " ".join(f"WHEN type_local = {_sql_str(v)} THEN {_sql_str(c)}" for v, c, _, _ in D.TYPE_MEMBERS)
_type_lab = " ".join(f"WHEN type_local = {_sql_str(v)} THEN {_sql_str(lb)}" for v, _, lb, _ in D.TYPE_MEMBERS)
_type_ord = " ".join(f"WHEN type_local = {_sql_str(v)} THEN {o}" for v, _, _, o in D.TYPE_MEMBERS)
DIM_TYPE_SQL = (
    "SELECT " + surrogate("type_local") + " AS type_bien_key, "
    f"COALESCE(type_local, {_sql_str(D.TYPE_NULL_NAME)}) AS type_local, "
    f"CASE {_type_cat} WHEN type_local IS NULL THEN {_sql_str(D.TYPE_NULL_CATEGORY)} "
    f"ELSE {_sql_str(D.TYPE_OTHER_CATEGORY)} END AS categorie, "
    f"CASE {_type_lab} WHEN type_local IS NULL THEN {_sql_str(D.TYPE_NULL_LABEL)} "
    f"ELSE {_initcap_sql('type_local')} END AS libelle, "
    f"CAST(CASE {_type_ord} ELSE {D.TYPE_OTHER_ORDER} END AS INTEGER) AS ordre_affichage "
    "FROM (SELECT DISTINCT type_local FROM silver) t"
)

_fam = " ".join(f"WHEN nature_mutation LIKE {_sql_str('%' + tok + '%')} THEN {_sql_str(f)}" for tok, f in D.NATURE_FAMILIES)
_market = " OR ".join(f"nature_mutation LIKE {_sql_str('%' + tok + '%')}" for tok in D.MARKET_SALE_TOKENS)
DIM_NATURE_SQL = (
    "SELECT " + surrogate("nature_mutation") + " AS nature_key, "
    f"COALESCE(nature_mutation, {_sql_str(D.NATURE_NULL_NAME)}) AS nature_mutation, "
    f"CASE {_fam} WHEN nature_mutation IS NULL THEN {_sql_str(D.NATURE_NULL_FAMILY)} "
    f"ELSE {_sql_str(D.NATURE_OTHER_FAMILY)} END AS famille, "
    f"CASE WHEN {_market} THEN TRUE ELSE FALSE END AS is_vente_marchande "
    "FROM (SELECT DISTINCT nature_mutation FROM silver) n"
)

FACT_SQL = (
    "SELECT mutation_id, CAST(year(date_mutation) * 10000 + month(date_mutation) * 100 + day(date_mutation) AS INTEGER) "
    "AS date_key, " + surrogate("commune", "code_postal", "code_departement") + " AS geo_key, "
    + surrogate("type_local") + " AS type_bien_key, " + surrogate("nature_mutation") + " AS nature_key, "
    "valeur_fonciere, surface_reelle_bati, surface_terrain, nombre_pieces_principales, prix_metre_carre, "
    "CASE WHEN valeur_fonciere IS NOT NULL THEN 1 ELSE 0 END AS est_vente_avec_prix, "
    "CASE WHEN surface_reelle_bati > 0 THEN 1 ELSE 0 END AS est_bien_bati "
    "FROM silver WHERE date_mutation IS NOT NULL"
)

STAR_CTES = [("seed", SEED_SQL), ("dim_geo", DIM_GEO_SQL), ("fact", FACT_SQL)]


def _yearly(keys: str, extra: str = "", where: str = "") -> str:
    """Fact rows grouped by ``keys`` and the year that their date key begins with."""
    return (f"SELECT {keys}, date_key // 10000 AS annee, COUNT(*) AS nb_transactions, COUNT(valeur_fonciere) AS nb_ventes, "
            f"SUM(valeur_fonciere) AS volume_financier, {exact_avg('valeur_fonciere')} AS prix_moyen, {MEDIAN} AS prix_median, "
            f"{exact_avg('prix_metre_carre', 6)} AS prix_m2_moyen{extra} FROM fact {where} GROUP BY {keys}, date_key // 10000")


def _changes(base: str, keys: list[str], measures: dict[str, str], columns: list[str]) -> str:
    """``columns`` of ``base`` and the change of each measure against the row of the latest earlier year of the keys."""
    same = " AND ".join(f"p.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    return ("SELECT " + ", ".join(f"b.{c}" for c in columns) + ", "
            + ", ".join(f"{pct('b.' + m, 'p.' + m)} AS {name}" for m, name in measures.items())
            + f" FROM {base} b LEFT JOIN {base} p ON {same} AND p.annee = (SELECT MAX(q.annee) FROM {base} q WHERE "
            + " AND ".join(f"q.{k} IS NOT DISTINCT FROM b.{k}" for k in keys) + " AND q.annee < b.annee)")


_RANGE = ", MIN(valeur_fonciere) AS prix_min, MAX(valeur_fonciere) AS prix_max"
_SURFACE = f", {exact_avg('surface_reelle_bati')} AS surface_moyenne"

AGG_YEAR_SQL = with_ctes(
    _changes("base", ["type_bien_key"],
             {"prix_moyen": "variation_prix_yoy_pct", "nb_transactions": "variation_volume_yoy_pct",
              "volume_financier": "variation_volume_financier_yoy_pct"},
             ["type_bien_key", "annee", "nb_transactions", "nb_ventes", "volume_financier", "prix_moyen", "prix_median",
              "prix_min", "prix_max", "prix_m2_moyen", "surface_moyenne", "nb_communes_actives"]),
    STAR_CTES + [("base", _yearly("type_bien_key", _RANGE + _SURFACE + ", COUNT(DISTINCT geo_key) AS nb_communes_actives"))])

_MONTH = "make_date(date_key // 10000, date_key // 100 % 100, 1)"
AGG_MONTH_SQL = with_ctes(
    "SELECT *, date_mois_key // 10000 AS annee, (date_mois_key // 100 % 100 + 2) // 3 AS trimestre_num, "
    "'T' || CAST((date_mois_key // 100 % 100 + 2) // 3 AS VARCHAR) AS trimestre_libelle, date_mois_key // 100 % 100 AS mois_num, "
    "strftime(mois, '%B') AS mois_nom, CASE WHEN date_mois_key // 100 % 100 < 7 THEN 'S1' ELSE 'S2' END AS semestre FROM months",
    STAR_CTES + [("months",
                  f"SELECT type_bien_key, date_key // 100 * 100 + 1 AS date_mois_key, {_MONTH} AS mois, COUNT(*) AS nb_transactions, "
                  f"COUNT(valeur_fonciere) AS nb_ventes, SUM(valeur_fonciere) AS volume_financier, "
                  f"{exact_avg('valeur_fonciere')} AS prix_moyen, {MEDIAN} AS prix_median, "
                  f"{exact_avg('prix_metre_carre', 6)} AS prix_m2_moyen{_SURFACE}, "
                  "COUNT(CASE WHEN surface_reelle_bati > 0 THEN 1 END) AS nb_biens_batis FROM fact "
                  f"GROUP BY type_bien_key, date_key // 100 * 100 + 1, {_MONTH}")])

# A place's attributes are looked up in the dimension per row, before or after the grouping as the keys ask for it.
_PLACED = ("(SELECT f.*, g.code_departement, g.nom_departement, g.region FROM fact f, dim_geo g WHERE g.geo_key = f.geo_key)")
AGG_REGION_YEAR_SQL = with_ctes(
    _changes("base", ["code_departement", "type_bien_key"],
             {"prix_moyen": "variation_prix_yoy_pct", "nb_transactions": "variation_volume_yoy_pct"},
             ["code_departement", "nom_departement", "region", "type_bien_key", "annee", "nb_transactions", "nb_ventes",
              "volume_financier", "prix_moyen", "prix_median", "prix_m2_moyen"]),
    STAR_CTES + [("base", _yearly("code_departement, nom_departement, region, type_bien_key").replace("FROM fact ", f"FROM {_PLACED} placed "))])

AGG_GEO_YEAR_SQL = with_ctes(
    "SELECT y.*, (SELECT g.commune FROM dim_geo g WHERE g.geo_key = y.geo_key) AS commune, "
    "(SELECT g.code_postal FROM dim_geo g WHERE g.geo_key = y.geo_key) AS code_postal, "
    "(SELECT g.code_departement FROM dim_geo g WHERE g.geo_key = y.geo_key) AS code_departement, "
    "(SELECT g.nom_departement FROM dim_geo g WHERE g.geo_key = y.geo_key) AS nom_departement, "
    "(SELECT g.region FROM dim_geo g WHERE g.geo_key = y.geo_key) AS region "
    f"FROM years y WHERE y.nb_transactions >= {D.GEO_YEAR_MIN_COUNT} AND y.geo_key IN (SELECT geo_key FROM dim_geo)",
    STAR_CTES + [("years", _yearly("geo_key, type_bien_key", _RANGE + _SURFACE))])

STAR = {
    "calendar_dim": with_ctes(CALENDAR_SQL),
    "dim_geo": with_ctes("SELECT * FROM dim_geo", [("seed", SEED_SQL), ("dim_geo", DIM_GEO_SQL)]),
    "dim_type": with_ctes(DIM_TYPE_SQL),
    "dim_nature": with_ctes(DIM_NATURE_SQL),
    "fact_build": with_ctes(FACT_SQL),
    "agg_year": AGG_YEAR_SQL,
    "agg_month": AGG_MONTH_SQL,
    "agg_region_year": AGG_REGION_YEAR_SQL,
    "agg_geo_year": AGG_GEO_YEAR_SQL,
}
