"""Grouped aggregates, thresholds and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import rows
from ..functions.scalars import ColumnOrName, col
from ..session import scratch_dir, setting, task_count
from .joins import null_safe_join

# Groups above about this many rows have their values counted and ordered in ranges; smaller ones are gathered.
GROUP_ROWS = 20_000
GROUP_SAMPLE = 200  # rows of such a group in the sample that finds it


def aggregate(df: DataFrame, keys: Sequence[ColumnOrName], measures: Sequence[Column],
              having: Column | None = None, medians: dict[str, ColumnOrName] | None = None) -> DataFrame:
    """GROUP BY keys (columns or aliased expressions) with optional HAVING.

    ``having`` may reference the output names of ``measures``.  An empty ``keys``
    gives the one-row global aggregate.  ``medians`` maps output names to value
    columns whose exact median (NULLs ignored, interpolated as ``percentile`` does) is
    added without gathering or ordering a large group's values in one task:

    1. a written sample of the keys' hashes tells which groups may have more than about
       ``GROUP_ROWS`` rows (knob ``groupRows``), and how many rows there are;
    2. the rows of all other groups, with only the columns needed, are shuffled once by key, and
       a task computes the measures and medians of its groups;
    3. the measures of the large groups combine before their shuffle, and so do the counts of
       every (group, value), which are range-partitioned and written with their partition.  The counts
       of a group's partitions tell in which of them its middle ranks lie; only there are values
       put in order, and a task orders part of one partition.

    Which way a group takes does not change its row.
    """
    if medians:
        out = _aggregate_with_medians(df, keys, measures, medians)
    else:
        out = df.groupBy(*[col(k) for k in keys]).agg(*measures) if keys else df.agg(*measures)
    return out.filter(having) if having is not None else out


def _aggregate_with_medians(df: DataFrame, keys: Sequence[ColumnOrName], measures: Sequence[Column],
                            medians: dict[str, ColumnOrName]) -> DataFrame:
    exprs = [k for k in keys if not isinstance(k, str)]
    keyed = df.select("*", *exprs) if exprs else df
    added = iter(keyed.columns[len(df.columns):])
    names = [k if isinstance(k, str) else next(added) for k in keys]
    # No keys: all rows are one group, under a key of its own.
    kn = [f"__k{i}" for i in range(len(names))] or ["__k0"]
    own = [F.col(f"`{n}`").alias(k) for n, k in zip(names, kn)] or [F.lit(0).alias(kn[0])]
    values = {name: col(v).cast("double") for name, v in medians.items()}
    rows_of = keyed.select("*", *own)
    if not names:
        out = _large_groups(rows_of, kn, measures, values)
        outputs = [c for c in out.columns if c not in kn]
        # No row at all still gives one: the aggregate of nothing.
        none = df.limit(0).agg(*measures, *[F.lit(None).cast("double").alias(m) for m in medians])
        both = out.select(*outputs, F.lit(1).alias("__some")).unionByName(none.withColumn("__some", F.lit(0)))
        picked = both.agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in none.columns]), "__some").alias("__row"))
        return picked.select("__row.*")
    large, n_large, n_rows = _sampled_groups(rows_of, kn)
    tagged = rows_of.withColumn("__h", F.xxhash64(*kn))
    few = tagged.join(F.broadcast(large), "__h", "left_anti").drop("__h") if n_large else rows_of
    own_tasks = few.repartition(*task_count(df.sparkSession, n_rows), *kn)
    out = own_tasks.groupBy(*kn).agg(*measures, *[F.median(v).alias(name) for name, v in values.items()])
    if n_large:
        # Written too: what the caller reads are results and counts, never the source again.
        path, schema = scratch_dir(df.sparkSession, "small-groups"), out.schema
        out.write.option("compression", "zstd").parquet(path)
        out = df.sparkSession.read.schema(schema).parquet(path)
        many = tagged.join(F.broadcast(large), "__h", "left_semi").drop("__h")
        out = out.unionByName(_large_groups(many, kn, measures, values))
    return out.select(*[F.col(k).alias(n) for k, n in zip(kn, names)], *[F.col(f"`{c}`") for c in out.columns if c not in kn])


def _sampled_groups(rows_of: DataFrame, kn: Sequence[str]) -> tuple[DataFrame, int, int]:
    """Hashes (``__h``) of the groups that may be large, their number, and about how many rows there are.

    The sample is written, so that every reader finds the same list, of at most the rows over half the limit.
    """
    spark = rows_of.sparkSession
    limit = max(1, setting(spark, "groupRows", GROUP_ROWS))
    rate = min(1.0, GROUP_SAMPLE / limit)
    path = scratch_dir(spark, "group-sample")
    seen = rows_of.select(F.xxhash64(*kn).alias("__h")).sample(rate, seed=17).groupBy("__h").agg(rows().alias("__n"))
    seen.write.parquet(path)
    written = spark.read.schema(seen.schema).parquet(path)
    is_large = F.col("__n") > (limit * rate / 2 if rate < 1 else limit)
    n_large, n_seen = written.agg(F.count_if(is_large), F.coalesce(F.sum("__n"), F.lit(0))).first()
    return written.where(is_large).select("__h"), n_large, int(n_seen / rate)


def _large_groups(rows_of: DataFrame, kn: Sequence[str], measures: Sequence[Column], values: dict[str, Column]) -> DataFrame:
    """Key ``kn``, measures and medians of few groups of any size."""
    spark = rows_of.sparkSession
    grouped = rows_of.groupBy(*kn).agg(*measures).withColumn("__id", F.monotonically_increasing_id())
    at = scratch_dir(spark, "large-groups")
    grouped.write.parquet(at)
    groups = spark.read.schema(grouped.schema).parquet(at)
    listed = rows_of.select(*kn, F.array(*values.values()).alias("__v"))
    split = null_safe_join(listed, F.broadcast(groups.select("__id", *kn)), kn).select("__id", F.posexplode("__v").alias("__t", "__x"))
    counted = split.where(F.col("__x").isNotNull()).groupBy("__id", "__t", "__x").agg(rows().alias("__c"))
    path = scratch_dir(spark, "value-counts")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = counted.repartitionByRange(parts, "__t", "__id", "__x").withColumn("__p", F.spark_partition_id())
    ranged.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(ranged.schema).parquet(path)
    out = groups
    for i, name in enumerate(values):
        out = out.join(_middles(written.where(F.col("__t") == i).select("__id", "__x", "__c", "__p"), ["__id"], name), "__id", "left")
    return out.drop("__id")


def _middles(values: DataFrame, kn: Sequence[str], name: str) -> DataFrame:
    """Per key ``kn`` the median, as ``name``, of values ``__x`` that occur ``__c`` times and lie in range partition ``__p``.

    Few keys: two rows of each at most, and one more for every partition in between, are broadcast.
    """
    sizes = values.groupBy(*kn, "__p").agg(F.sum("__c").alias("__n"))
    spans = sizes.groupBy(*kn).agg(F.array_sort(F.collect_list(F.struct("__p", "__n"))).alias("__s"), F.sum("__n").alias("__all"))
    first, last = F.shiftright(F.col("__all") - 1, 1), F.shiftright("__all", 1)
    ranks = spans.withColumn("__lo", first).withColumn("__hi", last)

    def step(seen: Column, span: Column) -> Column:
        at = seen["at"]
        holds = (at <= F.col("__hi")) & (at + span["__n"] > F.col("__lo"))
        return F.struct((at + span["__n"]).alias("at"), F.when(holds, F.array_append(seen["hit"], F.struct(
            span["__p"].alias("p"), at.alias("before")))).otherwise(seen["hit"]).alias("hit"))

    none = F.array().cast("array<struct<p:int,before:bigint>>")
    found = F.aggregate("__s", F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("hit")), step)["hit"]
    wanted = ranks.select(*kn, "__lo", "__hi", F.inline(found)).withColumnRenamed("p", "__p")
    near = null_safe_join(values, F.broadcast(wanted), [*kn, "__p"], "inner")
    until = F.col("before") + F.sum("__c").over(Window.partitionBy(*kn, "__p").orderBy("__x"))
    ranked = near.select(*kn, "__x", "__lo", "__hi", (until - F.col("__c")).alias("__from"), until.alias("__to"))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("__from") <= F.col(rank)) & (F.col(rank) < F.col("__to")), F.col("__x")))

    both = ranked.groupBy(*kn).agg(at("__lo").alias("__a"), at("__hi").alias("__b"))
    return both.select(*kn, F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise(
        F.lit(0.5) * F.col("__a") + F.lit(0.5) * F.col("__b")).alias(name))


def top_groups(df: DataFrame, keys: Sequence[str], measure: Column, measure_name: str,
               min_count: int, k: int, strict: bool = True) -> DataFrame:
    """Groups with more than (``strict``) / at least ``min_count`` rows, best ``k`` by measure.

    Ordered by the measure descending (NULLs first, as the warehouse does) and then by
    the keys, so ties are broken deterministically.  Spark plans this as a per-task
    top-k followed by one merge of k rows per task (no global sort).
    """
    n = "__group_rows"
    agg = df.groupBy(*keys).agg(measure.alias(measure_name), rows().alias(n))
    agg = agg.filter(F.col(n) > min_count if strict else F.col(n) >= min_count).drop(n)
    order = [F.col(measure_name).desc_nulls_first()] + [F.col(c).asc_nulls_last() for c in keys]
    return agg.orderBy(*order).limit(k)


def grouped_median(df: DataFrame, keys: Sequence[ColumnOrName], value: ColumnOrName, name: str = "median") -> DataFrame:
    """Exact interpolated median of ``value`` per group that has one (NULLs ignored); with no keys, one row."""
    out = aggregate(df, keys, [], medians={name: value})
    return out.filter(F.col(name).isNotNull()) if keys else out
