"""Staging and silver layers: raw strings -> cleaned, ranked, validated, keyed rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import domain as D
from ..functions.scalars import content_hash, parse_date, parse_decimal, parse_int, safe_ratio
from ..operators.clean import min_price_min_surface_rules, positive_filter, rename, validate_by_category
from ..operators.windows import keep_first_per_key, rank_distinct_rows, row_code

RAW_CODE = "raw_code"
SRC_COLUMNS = list(D.RENAME_MAP.values())


def staging(bronze: DataFrame) -> DataFrame:
    """The rename layer: 13 raw columns under their snake_case names."""
    return rename(bronze, D.RENAME_MAP)


def clean_projection(src: DataFrame, date_formats: Sequence[str] = D.DATE_FORMATS,
                     scale: int = 0, keep_raw: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Lower-case the text, parse numbers (decimal comma) and dates.

    ``keep_raw`` adds ``raw_code``, an injective encoding of the raw row: it tells
    distinct raw rows apart and gives the lot rank a total order.  ``keep`` names other columns to pass on.
    """
    raw = [row_code(SRC_COLUMNS).alias(RAW_CODE)] if keep_raw else []
    return src.select(*clean_columns(date_formats, scale), *raw, *keep)


def clean_columns(date_formats: Sequence[str] = D.DATE_FORMATS, scale: int = 0) -> list[Column]:
    """The cleaned columns, from staging's."""
    c = F.col
    return [
        c("no_disposition"),
        c("identifiant_document"),
        parse_date("date_mutation", date_formats).alias("date_mutation"),
        F.lower(c("nature_mutation")).alias("nature_mutation"),
        parse_decimal("valeur_fonciere", scale).alias("valeur_fonciere"),
        c("code_postal"),
        F.lower(c("commune")).alias("commune"),
        c("code_departement"),
        F.lower(c("type_local")).alias("type_local"),
        parse_decimal("surface_reelle_bati", scale).alias("surface_reelle_bati"),
        c("nombre_pieces_principales"),
        parse_int("surface_terrain").alias("surface_terrain"),
    ]


def rank_key() -> list[Column]:
    """Lot-rank key: document, disposition, type and built surface (NULL as '').

    The document leads: the key order does not change the partitioning, but the
    window sort compares a prefix of the first key, and the document is the most
    selective part.
    """
    return [F.col("identifiant_document"), F.col("no_disposition"),
            F.coalesce(F.col("type_local"), F.lit("")),
            F.coalesce(F.col("surface_reelle_bati").cast("string"), F.lit(""))]


def rank_order() -> list[Column | str]:
    """Total order inside a key: MD5 of the raw-row code (uniform, so hot keys can be
    split into hash ranges), then the code itself."""
    return [F.md5(F.col(RAW_CODE)), RAW_CODE]


def validity_rules() -> tuple[list, Column]:
    rules = min_price_min_surface_rules("valeur_fonciere", "surface_reelle_bati", D.VALIDITY_RULES)
    return rules, F.col("valeur_fonciere") >= F.lit(D.DEFAULT_MIN_PRICE)


def unit_price() -> Column:
    """Price per m2: built surface for built types, land as fallback for outbuildings."""
    price, built, land = F.col("valeur_fonciere"), F.col("surface_reelle_bati"), F.col("surface_terrain")
    return (F.when(F.col("type_local").isin(*D.BUILT_TYPES) & (built > 0), safe_ratio(price, built))
            .when(F.col("type_local") == D.TYPE_OUTBUILDING,
                  safe_ratio(price, F.coalesce(built.cast("decimal(38,0)"), land.cast("decimal(38,0)"))))
            .otherwise(F.lit(None).cast("double")))


def mutation_id(rank_col: str = "lot_rank") -> Column:
    return content_hash(D.HASH_FIELDS, tail=[rank_col])


def open_keys(src: DataFrame, current: DataFrame, date_formats: Sequence[str] = D.DATE_FORMATS,
              lookback_days: int = 0) -> DataFrame:
    """Lot keys (named as in silver) of the raw rows past the high-water mark, reopened by ``lookback_days``.

    Written once: the probe reads the key and date columns, and the size of the written
    table tells Spark whether the semi-join with the raw rows can be a broadcast.
    """
    from ..session import freed_shuffles, scratch_dir
    spark = src.sparkSession
    path = scratch_dir(spark, "silver-open-keys")
    keys = _open_rows(src, current, date_formats, lookback_days).distinct()
    with freed_shuffles(spark):
        keys.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(keys.schema).parquet(path)


def _open_rows(src: DataFrame, current: DataFrame, date_formats: Sequence[str], lookback_days: int = 0) -> DataFrame:
    """The lot keys of ``open_keys``, one for every raw row."""
    from ..operators.upsert import newer_than_target
    probe = src.select(*[k.alias(n) for k, n in zip(raw_rank_key(), KEY_COLUMNS)],
                       parse_date("date_mutation", date_formats).alias("date_mutation"))
    return newer_than_target(probe, current, "date_mutation", lookback_days).select(*KEY_COLUMNS)


def _of_keys(rows: DataFrame, key: Sequence[Column], keys: DataFrame, exact: bool = True) -> DataFrame:
    """The rows whose lot key is among ``keys``: a Bloom filter in the scan, then the exact semi-join.

    Without ``exact`` only the filter: all rows of a few other lot keys may be there too.
    If the keys are too many to broadcast, the semi-join shuffles the rows that passed the filter,
    in proportion to the batch and not to the raw table.  The rows are written, so that what looks for
    heavy keys among them and what ranks them read the batch and not the raw table again.
    """
    from ..operators.joins import may_be_among
    from ..session import freed_shuffles, scratch_dir
    named = [f"__nk{i}" for i in range(len(KEY_COLUMNS))]
    wanted = keys.select(*[F.col(c).alias(n) for c, n in zip(KEY_COLUMNS, named)])
    found = rows.where(may_be_among(list(key), wanted, named))
    if exact:  # by the key's expressions: the shuffled rows carry no second copy of it
        found = found.join(wanted, reduce(and_, [k.eqNullSafe(F.col(n)) for k, n in zip(key, named)]), "left_semi")
    path = scratch_dir(rows.sparkSession, "silver-batch")
    with freed_shuffles(rows.sparkSession):
        found.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def new_rows(bronze_or_src: DataFrame, current: DataFrame, already_staged: bool = False,
             date_formats: Sequence[str] = D.DATE_FORMATS, restrict_to_new_keys: bool = True,
             hot_threshold: int | None = None, n_rows: int = 0) -> DataFrame:
    """Silver rows newer than the current table's high-water mark (the incremental run).

    Ranking still sees every raw row of a key, as a full build does.  With
    ``restrict_to_new_keys`` only the lot keys that received a row past the mark are
    ranked: the window partitions on the key, so their ranks are unchanged while
    the rest of the raw table is neither shuffled nor sorted.  A Bloom filter finds them; other
    keys that it lets pass are ranked too, and have no row past the mark.
    """
    from ..operators.upsert import newer_than_target
    src = (bronze_or_src if already_staged else staging(bronze_or_src)).select(*SRC_COLUMNS)
    if restrict_to_new_keys:
        src = _of_keys(src, raw_rank_key(), _open_rows(src, current, date_formats), exact=False)
        n_rows = src.count()
    rows = silver_rows(src, already_staged=True, date_formats=date_formats, hot_threshold=hot_threshold, n_rows=n_rows)
    return newer_than_target(rows, current, "date_mutation")


def raw_rank_key() -> list[Column]:
    """The lot key computed from raw (staging) columns, equal to ``rank_key`` after cleaning."""
    return [F.col("identifiant_document"), F.col("no_disposition"),
            F.coalesce(F.lower(F.col("type_local")), F.lit("")),
            F.coalesce(parse_decimal("surface_reelle_bati", 0).cast("string"), F.lit(""))]


def silver_rows(bronze_or_src: DataFrame, already_staged: bool = False,
                date_formats: Sequence[str] = D.DATE_FORMATS, first_only: bool = False,
                hot_threshold: int | None = None, n_rows: int = 0) -> DataFrame:
    """distinct -> clean -> lot rank -> price and rule filters -> id and unit price.

    The DISTINCT and the lot rank share one shuffle (``rank_distinct_rows``).
    ``first_only`` keeps only rank 1 per key (the de-duplication the documentation
    describes) instead of keeping every lot with its rank (what the SQL does).
    ``n_rows``, if known, bounds the rows that a task of the ranking sorts.
    """
    src = (bronze_or_src if already_staged else staging(bronze_or_src)).select(*SRC_COLUMNS)
    if first_only:
        cleaned = clean_projection(src, date_formats)
        ranked = keep_first_per_key(cleaned, ["identifiant_document", "no_disposition", *rank_key()[2:]], rank_order()).withColumn("lot_rank", F.lit(1))
    else:
        # The raw columns are shuffled, which are narrower than the cleaned ones with their code.
        ranked = rank_distinct_rows(src, ["identifiant_document", "no_disposition", *raw_rank_key()[2:]], row_code(SRC_COLUMNS), "lot_rank", hot_threshold,
                                    project=clean_columns(date_formats), n_rows=n_rows)
    valid = positive_filter(ranked, "valeur_fonciere")
    rules, default = validity_rules()
    valid = validate_by_category(valid, "type_local", rules, default)
    cols = [c for c in D.SILVER_COLUMNS if c not in ("mutation_id", "prix_metre_carre")]
    return valid.select(*cols, mutation_id().alias("mutation_id"), unit_price().alias("prix_metre_carre"))


PARTITION_COL = "mois_mutation"
# The lot key in silver terms: document, disposition, type ('' for NULL) and built surface as text ('' for NULL).
KEY_COLUMNS = ["cle_document", "cle_disposition", "cle_type", "cle_surface"]


def incremental_build(bronze_or_src: DataFrame, path: str, already_staged: bool = False,
                      restrict_to_new_keys: bool = True, lookback_days: int = 0,
                      hot_threshold: int | None = None) -> DataFrame:
    """Create the silver table at ``path`` (partitioned by sale month), or merge into it.

    Strict mode (``lookback_days=0``) adds the rows newer than the high-water mark.  With
    a lookback, every lot key that has a raw row inside the reopened days is replaced
    as a whole: a late row shifts the ranks of its key, and with them the ids, so the
    key's stored rows are deleted and all its rows inserted anew, in whatever months they
    lie.  Only touched months are rewritten.  Returns the silver columns.
    """
    from ..operators.upsert import current_version, merge_partitions, read_partitions
    spark = bronze_or_src.sparkSession
    month = F.trunc(F.col("date_mutation"), "month").alias(PARTITION_COL)
    key = [k.alias(n) for k, n in zip(rank_key(), KEY_COLUMNS)]
    if current_version(spark, path) is None:
        rows, gone = silver_rows(bronze_or_src, already_staged, hot_threshold=hot_threshold, n_rows=bronze_or_src.count()), None
    else:
        current = read_partitions(spark, path)
        if lookback_days:
            src = (bronze_or_src if already_staged else staging(bronze_or_src)).select(*SRC_COLUMNS)
            gone = open_keys(src, current, lookback_days=lookback_days)
            batch = _of_keys(src, raw_rank_key(), gone)
            rows = silver_rows(batch, already_staged=True, hot_threshold=hot_threshold, n_rows=batch.count())
        else:
            rows, gone = new_rows(bronze_or_src, current, already_staged, restrict_to_new_keys=restrict_to_new_keys,
                                  hot_threshold=hot_threshold, n_rows=0 if restrict_to_new_keys else bronze_or_src.count()), None
    # Not shuffled to their month: the id's hex digits and what other columns tell.
    carried = {"__id": F.unhex("mutation_id")}
    derived = {"mutation_id": F.lower(F.hex("__id")), "prix_metre_carre": unit_price(), PARTITION_COL: month} | dict(zip(KEY_COLUMNS, rank_key()))
    out = merge_partitions(rows.select("*", *key, month), path, "mutation_id", PARTITION_COL, gone, carried=carried, derived=derived)
    return out.select(*D.SILVER_COLUMNS)
