"""Domain configuration for property-transaction tables.

Everything here is plain data consumed by the generic operators; a table of
another domain plugs in its own values.
"""

from __future__ import annotations


# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the source pipeline's for identical results.
# ---------------------------------------------------------------------------

# Raw file header, in file order (42 names) plus "Date mutation", which the
# staging layer reads although the raw table definition omits it.
BRONZE_COLUMNS = [
    "No disposition",
    "Identifiant de document",
    "Reference document",
    "1 Articles CGI",
    "2 Articles CGI",
    "3 Articles CGI",
    "4 Articles CGI",
    "5 Articles CGI",
    "Motif de la non-price",
    "Nature mutation",
    "Valeur fonciere",
    "No voie",
    "B/T/Q",
    "Type de voie",
    "Code voie",
    "Voie",
    "Code postal",
    "Commune",
    "Code departement",
    "Code commune",
    "Section",
    "No plan",
    "No Volume",
    "1er lot",
    "Surface Carrez du 1er lot",
    "2eme lot",
    "Surface Carrez du 2eme lot",
    "3eme lot",
    "Surface Carrez du 3eme lot",
    "4eme lot",
    "Surface Carrez du 4eme lot",
    "5eme lot",
    "Surface Carrez du 5eme lot",
    "Nombre de lots",
    "Code type local",
    "Type local",
    "Identifiant local",
    "Surface reelle bati",
    "Nombre pieces principales",
    "Nature culture",
    "Nature culture speciale",
    "Surface terrain",
    "Date mutation",
]

# Staging rename: raw header -> column name.
RENAME_MAP = {
    "No disposition": "no_disposition",
    "Identifiant de document": "identifiant_document",
    "Reference document": "reference_document",
    "Date mutation": "date_mutation",
    "Nature mutation": "nature_mutation",
    "Valeur fonciere": "valeur_fonciere",
    "Code postal": "code_postal",
    "Commune": "commune",
    "Code departement": "code_departement",
    "Type local": "type_local",
    "Surface reelle bati": "surface_reelle_bati",
    "Nombre pieces principales": "nombre_pieces_principales",
    "Surface terrain": "surface_terrain",
}

# Token every archive of the dataset carries in its name (catalog filter).
ARCHIVE_TOKEN = "valeursfoncieres"

# Accepted date text formats, tried in order.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")

# Property types (lower-cased values as they appear after cleaning).
TYPE_HOUSE = "maison"
TYPE_FLAT = "appartement"
TYPE_OUTBUILDING = "dépendance"
TYPE_COMMERCIAL = "local industriel. commercial ou assimilé"

# Validity rules: (types, minimum price, minimum built surface or None).
# Rows of other / NULL type need DEFAULT_MIN_PRICE.
VALIDITY_RULES = [
    ((TYPE_HOUSE, TYPE_FLAT), 1000, 9),
    ((TYPE_OUTBUILDING,), 500, None),
    ((TYPE_COMMERCIAL,), 1000, 5),
]
DEFAULT_MIN_PRICE = 1000

# Types whose unit price uses the built surface; outbuildings fall back to land.
BUILT_TYPES = (TYPE_HOUSE, TYPE_FLAT, TYPE_COMMERCIAL)

# Property-type dimension: (type, category, label, display order).
TYPE_MEMBERS = [
    (TYPE_HOUSE, "Résidentiel", "Maison", 1),
    (TYPE_FLAT, "Résidentiel", "Appartement", 2),
    (TYPE_COMMERCIAL, "Commercial", "Local commercial", 3),
    (TYPE_OUTBUILDING, "Dépendance", "Dépendance", 4),
]
TYPE_NULL_NAME = "non renseigné"
TYPE_NULL_CATEGORY = "Non renseigné (terrain)"
TYPE_NULL_LABEL = "Terrain / Non renseigné"
TYPE_OTHER_CATEGORY = "Autre"
TYPE_OTHER_ORDER = 5

# Transaction-nature families, first substring match wins.
NATURE_FAMILIES = [
    ("vente", "Vente"),
    ("adjudication", "Vente judiciaire"),
    ("expropriation", "Expropriation"),
    ("échange", "Échange"),
    ("donation", "Donation"),
]
NATURE_NULL_NAME = "inconnue"
NATURE_NULL_FAMILY = "Inconnue"
NATURE_OTHER_FAMILY = "Autre"
MARKET_SALE_TOKENS = ("vente", "adjudication")

# Analytic zones by department code, first match wins ('13' is in two lists).
ZONES = [
    (("75", "77", "78", "91", "92", "93", "94", "95"), "Île-de-France"),
    (("06", "13", "83", "84"), "PACA"),
    (("33", "31", "34", "13", "69"), "Grandes métropoles"),
]
ZONE_FALLBACK = "Autre"

# Geography defaults for missing parts.
GEO_DEFAULTS = {"commune": "Inconnu", "code_postal": "XXXXX", "code_departement": "XX"}
DEPARTMENT_NAME_PREFIX = "Département "
REGION_DEFAULT = "Inconnue"

# Calendar span of the date dimension.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2026-12-31"

# Group-size thresholds.
TOP_MIN_COUNT = 50      # strictly more than this many rows
TOP_K = 50
GEO_YEAR_MIN_COUNT = 5  # at least this many rows

# ---------------------------------------------------------------------------

SILVER_COLUMNS = [
    "no_disposition", "identifiant_document", "date_mutation", "nature_mutation",
    "valeur_fonciere", "code_postal", "commune", "code_departement", "type_local",
    "surface_reelle_bati", "nombre_pieces_principales", "surface_terrain",
    "mutation_id", "prix_metre_carre",
]

# Content-hash fields of a silver row, in order, followed by the lot rank.
HASH_FIELDS = [
    "no_disposition", "identifiant_document", "date_mutation", "valeur_fonciere",
    "code_postal", "commune", "type_local", "surface_reelle_bati", "surface_terrain",
    "nombre_pieces_principales",
]


# ---------------------------------------------------------------------------
# FIXED VALUES — the declared data tests: (table, column, test, severity, where).
# ---------------------------------------------------------------------------
DATA_TESTS = [
    ("silver_mutation_f", "mutation_id", "unique", "error", None),
    ("silver_mutation_f", "mutation_id", "not_null", "error", None),
    ("silver_mutation_f", "valeur_fonciere", "not_null", "warn", None),
    ("silver_mutation_f", "prix_metre_carre", "not_null", "warn", "surface_reelle_bati > 0"),
    ("prix_moyen_commune", "commune", "not_null", "error", None),
    ("prix_moyen_commune", "type_local", "not_null", "warn", None),
    ("prix_moyen_commune", "prix_moyen", "not_null", "error", None),
    ("prix_m2_commune", "commune", "not_null", "error", None),
    ("prix_m2_commune", "prix_m2_moyen", "not_null", "error", None),
    ("volume_mensuel", "mois", "not_null", "error", None),
    ("volume_mensuel", "nb_transactions", "not_null", "error", None),
    ("top_communes", "commune", "not_null", "error", None),
    ("top_communes", "prix_moyen", "not_null", "error", None),
    ("gold_kpis", "total_transactions", "not_null", "error", None),
    ("gold_kpis", "prix_moyen_france", "not_null", "error", None),
    ("gold_kpis", "volume_financier_total", "not_null", "error", None),
    ("prix_par_departement", "code_departement", "not_null", "error", None),
    ("prix_par_departement", "nb_transactions", "not_null", "error", None),
    ("prix_par_departement", "prix_moyen", "not_null", "error", None),
    ("evolution_annuelle", "annee", "not_null", "error", None),
    ("evolution_annuelle", "nb_transactions", "not_null", "error", None),
    ("evolution_annuelle", "prix_moyen", "not_null", "error", None),
    ("dim_date", "date_key", "unique", "error", None),
    ("dim_date", "date_key", "not_null", "error", None),
    ("dim_date", "date_complete", "unique", "error", None),
    ("dim_date", "date_complete", "not_null", "error", None),
    ("dim_date", "annee", "not_null", "error", None),
    ("dim_geography", "geo_key", "unique", "error", None),
    ("dim_geography", "geo_key", "not_null", "error", None),
    ("dim_geography", "commune", "not_null", "error", None),
    ("dim_geography", "code_departement", "not_null", "error", None),
    ("dim_geography", "region", "not_null", "error", None),
    ("dim_type_bien", "type_bien_key", "unique", "error", None),
    ("dim_type_bien", "type_bien_key", "not_null", "error", None),
    ("dim_type_bien", "categorie", "not_null", "error", None),
    ("dim_nature_mutation", "nature_key", "unique", "error", None),
    ("dim_nature_mutation", "nature_key", "not_null", "error", None),
    ("dim_nature_mutation", "famille", "not_null", "error", None),
    ("fact_mutations", "mutation_id", "unique", "error", None),
    ("fact_mutations", "mutation_id", "not_null", "error", None),
    ("fact_mutations", "date_key", "not_null", "error", None),
    ("fact_mutations", "geo_key", "not_null", "error", None),
    ("fact_mutations", "type_bien_key", "not_null", "error", None),
    ("fact_mutations", "nature_key", "not_null", "error", None),
]

# Our addition: foreign keys of the fact (orphans are reported, severity warn).
RELATIONSHIP_TESTS = [
    ("fact_mutations", "date_key", "dim_date", "date_key"),
    ("fact_mutations", "geo_key", "dim_geography", "geo_key"),
    ("fact_mutations", "type_bien_key", "dim_type_bien", "type_bien_key"),
    ("fact_mutations", "nature_key", "dim_nature_mutation", "nature_key"),
]
