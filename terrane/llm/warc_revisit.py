"""Resolution of WARC not-modified revisits.

A revisit record of the server-not-modified kind carries a URI, a date and the
headers of a 304 answer, but no payload.  It is resolved by an as-of join: among
the full responses of its canonical URL, the latest one that is strictly earlier
(of several at that date the one with the largest record_id).  The validators
must agree: ETags by weak comparison if both records have one, else
Last-Modified.  The resolved record has the response's payload and its headers,
updated by the permitted headers of the revisit; header names ignore case.

The as-of join runs on a timeline without payloads: one row per URL and date with the
greatest response of that date, so records of one moment count once.  The timeline is
range-partitioned by (URL, date) into parts of equal numbers of rows.  Within a part a
window finds the latest response, and the parts before hand on their last one, so a hot
URL is spread over many tasks, however its dates lie.  Revisits look up their date, and
those with a response then join its payload by record_id; the others skip that join.  Both
are plain equi-joins with a unique side, which Spark splits where a key is hot.

Defined results: outcome is resolved, no_earlier_response, no_validator or
validator_mismatch; only resolved rows have a payload and headers.  A NULL URI or
date gives no_earlier_response, NULL headers count as none; repeated revisits
each get their row, repeated response ids count as one response (its smallest
payload); a response without a record_id is never met; long payloads and URLs are kept whole;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

# What a 304 answer may update (fixed values).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without trailing slashes, sorted query without tracking."""
    bare = F.regexp_replace(url, "#.*$", "")
    host = F.lower(F.regexp_extract(bare, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    rest = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^([^?]*)", 1), "/+$", "")
    query = F.filter(F.split(F.regexp_extract(rest, "[?](.*)$", 1), "&"), lambda p: (F.length(p) > 0) & ~p.rlike(TRACKING))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(query), "&"))).otherwise(F.lit("")))


def lower_names(headers: Column) -> Column:
    """Headers with lower-case names; values of names that differ only in case are joined by a comma."""
    entries = F.transform(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
                          lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v")))
    names = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(
        F.transform(F.filter(entries, lambda e: e["k"] == n), lambda e: e["v"]), ", ")))


def as_of(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """(key, at, latest) of every different (key, at) of ``rows`` (key, at, candidate as struct or NULL).

    ``latest`` is the greatest candidate of the greatest earlier ``at`` of the key that has one.
    Candidates must begin with their ``at``.  ``parts``: range partitions, as many as the session's shuffles have.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moments = rows.groupBy("key", "at").agg(F.max("candidate").alias("candidate"))
    line = stored(moments.repartitionByRange(parts, "key", "at").withColumn("part", F.spark_partition_id()), "timeline")
    handed = line.groupBy("key", "part").agg(F.max("candidate").alias("last")).withColumn("handed_on", F.max("last").over(
        W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1))).select("key", "part", "handed_on")
    earlier = F.max("candidate").over(W.partitionBy("key", "part").orderBy("at").rowsBetween(W.unboundedPreceding, -1))
    inside = line.withColumn("inside", earlier)
    return inside.join(handed, ["key", "part"]).select("key", "at", F.coalesce("inside", "handed_on").alias("latest"))


def resolve_revisits(records: DataFrame, permitted: Sequence[str] = PERMITTED, parts: int | None = None) -> DataFrame:
    """One row per revisit of ``records`` (record_id, warc_type, uri, date timestamp, headers map, payload).

    Returns record_id, canonical_url, outcome, response_id, status, headers, payload.
    """
    names = lower_names(F.col("headers"))
    rows = records.select(F.col("record_id").cast("long").alias("record_id"), "warc_type", canonical_url(F.col("uri")).alias("key"),
                          F.unix_micros(F.col("date").cast("timestamp")).alias("at"), names.alias("headers"))
    response = F.col("warc_type") == "response"
    dated = rows.where("key IS NOT NULL AND at IS NOT NULL AND warc_type IN ('response', 'revisit')").select(
        "key", "at", F.when(response, F.struct("at", "record_id")).alias("candidate"))
    line = as_of(dated, parts)
    asked = rows.where("warc_type = 'revisit'").select("record_id", "key", "at", F.col("headers").alias("own"))
    found = asked.where("key IS NOT NULL AND at IS NOT NULL").join(line, ["key", "at"]).select(
        "record_id", "key", "own", F.col("latest.record_id").alias("response_id"))
    undated = asked.where("key IS NULL OR at IS NULL").select("record_id", "key", "own", F.lit(None).cast("long").alias("response_id"))
    full = records.where("warc_type = 'response'").select(
        F.col("record_id").cast("long").alias("response_id"), F.struct("payload", F.map_entries(names).alias("h")).alias("f")).groupBy(
        "response_id").agg(F.min("f").alias("f")).select("response_id", F.col("f.payload").alias("_payload"),
                                                         F.map_from_entries("f.h").alias("_headers"))
    found = stored(found.unionByName(undated), "revisits")
    met = found.where("response_id IS NOT NULL").join(full, "response_id")
    unmet = found.where("response_id IS NULL").withColumn("_payload", F.lit(None).cast("string")).withColumn(
        "_headers", F.lit(None).cast("map<string,string>"))
    joined = met.unionByName(unmet)
    tag = lambda h: F.regexp_replace(F.try_element_at(h, F.lit("etag")), "^W/", "")
    changed = lambda h: F.try_element_at(h, F.lit("last-modified"))
    own, base = F.col("own"), F.col("_headers")
    agrees = F.coalesce(tag(own) == tag(base), changed(own) == changed(base))
    outcome = (F.when(F.col("response_id").isNull(), "no_earlier_response").when(agrees.isNull(), "no_validator")
               .when(agrees, "resolved").otherwise("validator_mismatch"))
    joined = joined.withColumn("outcome", outcome)
    allowed = list(permitted)
    merged = F.map_concat(F.map_filter(base, lambda k, _: ~(k.isin(allowed) & F.map_contains_key(own, k))),
                          F.map_filter(own, lambda k, _: k.isin(allowed)))
    done = F.col("outcome") == "resolved"
    return joined.select("record_id", F.col("key").alias("canonical_url"), "outcome", "response_id",
                         F.when(done, F.lit(200)).alias("status"), F.when(done, merged).alias("headers"),
                         F.when(done, F.col("_payload")).alias("payload"))
