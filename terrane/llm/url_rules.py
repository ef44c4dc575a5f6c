"""URL filtering by association rules over URL tokens.

A URL is a set of tokens: host labels and their hyphenated parts, path words,
file extension, parameter names and whether it has a fragment.  A page's label says
something about the page itself (``page_labels``): the verdict of a fixed rule that fits its
URL, else whether what its html shows fails the base rules of text (fewer than
``MIN_WORDS`` words, or more than a symbol to ``WORDS_A_SYMBOL`` words).  FP-growth mines
the token sets of all labelled pages together with their label; rules "tokens
imply bad" that reach a minimum support, count and confidence remain, if so many bad
pages are no chance at the labelled pages' rate of bad ones (Chernoff bound of the
binomial tail, times the number of token sets looked at, at most ``ALPHA``), without
those that have a part of their tokens as an equally confident rule.  Each rule is entered
in an inverted index under its rarest token; a URL meets only the rules entered
under one of its tokens, and a rule matches if the URL has all its tokens.

A fixed list of host and path rules goes first: the longest fitting rule decides,
and only URLs that none fits are left to the mined rules.

Distinct URLs are matched once.  Everything is DataFrame operations and Spark
ML's FP-growth.

Defined results: a NULL URL or one without ``://`` has an empty host and path, no
token and the verdict allow; a NULL html shows no word; repeated rows each get their row and
count as pages of their own; without labelled pages nothing is mined; URLs and pages of any
length are read whole; ties between rules that match go by name; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
MIN_COUNT = 5  # bad pages of a rule, however few pages are labelled
ALPHA = 0.05  # chance that any rule is there although no token says anything about the label
BAD = "label:bad"
MIN_WORDS = 50
WORDS_A_SYMBOL = 10
_HIDDEN = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
_SYMBOLS = "#*$%&|<>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or NULL.  ``rules``: (verdict, "host/path")."""
    fits = []
    for verdict, rule in rules:
        own, slash, rest = rule.partition("/")
        ok = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        fits.append(F.when(ok, F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL; digits become #, so numbers of one shape are one token."""
    host, path = host_and_path(url)
    mask = lambda c: F.regexp_replace(F.lower(c), "[0-9]+", "#")
    tag = lambda name, parts: F.transform(F.filter(parts, lambda t: F.length(t) > 0), lambda t: F.concat(F.lit(name), mask(t)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    parts = F.concat(
        tag("host:", F.split(host, r"[.:@]")), tag("host:", F.filter(F.split(host, r"[.:@-]"), lambda _: F.contains(host, F.lit("-")))),
        tag("path:", F.split(F.regexp_replace(path, r"\.[A-Za-z0-9]{1,5}$", ""), "[/_.-]")),
        tag("ext:", F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))),
        tag("query:", F.transform(F.split(query, "[&;]"), lambda p: F.regexp_extract(p, "^([^=]*)", 1))),
        F.when(F.contains(F.coalesce(url, F.lit("")), F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(parts))


def page_labels(pages: DataFrame, fixed: Sequence[tuple[str, str]], min_words: int = MIN_WORDS,
                words_a_symbol: int = WORDS_A_SYMBOL) -> DataFrame:
    """(page_id, url, bad) of every page row (page_id, url, html); see the module."""
    host, path = host_and_path(F.col("url"))
    shown = F.regexp_replace(F.coalesce(F.col("html"), F.lit("")), _HIDDEN, " ")
    rows = pages.select("page_id", "url", fixed_rule(host, path, fixed)["verdict"].alias("told"), shown.alias("shown"))
    words = F.size(F.filter(F.split("shown", "[ \t\n\x0b\f\r]+"), lambda w: w != ""))
    symbols = F.length("shown") - F.length(F.translate("shown", _SYMBOLS, ""))
    return rows.select("page_id", "url", F.coalesce(
        F.col("told") == "block", (words < min_words) | (symbols * words_a_symbol > words)).alias("bad"))


def tail_bound(n: Column, share: Column, rate: float) -> Column:
    """Logarithm of the Chernoff bound on the chance of ``share`` or more bad ones of ``n`` at the rate ``rate``."""
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    return F.when(share > rate, -n * (share * F.log(share / rate) + rest)).otherwise(0.0)


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_count: int = MIN_COUNT, alpha: float = ALPHA) -> DataFrame:
    """Rules (tokens, confidence, support, entry) from the rows (url, bad) of ``labelled``.

    ``entry`` is the rule's rarest token among the labelled pages, under which it is indexed.
    """
    spark = labelled.sparkSession
    known = labelled.select(tokens(F.col("url")).alias("tokens"), "bad").where(F.size("tokens") > 0)
    known = stored(known.select("tokens", "bad"), "url-labelled")
    empty = "tokens array<string>, confidence double, support double, entry string"
    total, n_bad = known.agg(F.count("*"), F.count_if("bad")).first()
    if n_bad < max(min_count, 1):
        return spark.createDataFrame([], empty)
    min_support = max(min_support, (min_count - 0.5) / total)
    items = known.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    looked_at = model.freqItemsets.where(~F.array_contains("items", BAD)).count()
    n_pages = F.round(F.col("support") * total / F.col("confidence"))
    chance = tail_bound(n_pages, F.col("confidence"), n_bad / total) + math.log(max(looked_at, 1))
    rules = model.associationRules.where((F.col("consequent") == F.array(F.lit(BAD))) & (chance <= math.log(alpha))).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    rules = stored(rules, "url-mined")
    # A rule is idle if a rule on a part of its tokens is at least as confident: found under the shorter rule's tokens.
    rule_entry = F.col("tokens")[0]
    longer = rules.select(F.col("tokens").alias("t"), F.col("confidence").alias("c"), F.explode("tokens").alias("first"))
    shorter = rules.select(F.col("tokens").alias("s"), F.col("confidence").alias("sc"), rule_entry.alias("first"))
    idle = longer.join(shorter, "first").where(
        (F.size("s") < F.size("t")) & (F.col("sc") >= F.col("c")) & (F.size(F.array_except("s", "t")) == 0)).select(
        F.col("t").alias("tokens")).distinct()
    rules = rules.join(idle, "tokens", "left_anti")
    often = known.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rarest = rules.select("tokens", F.explode("tokens").alias("token")).join(often, "token").groupBy("tokens").agg(
        F.min(F.struct("n", "token")).alias("r")).select("tokens", F.col("r.token").alias("entry"))
    return stored(rules.join(rarest, "tokens"), "url-rules")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined_rule) of the distinct ``urls`` that a rule matches; the most confident one is named."""
    own = urls.select("url").where("url IS NOT NULL").distinct().select("url", tokens(F.col("url")).alias("own"))
    index = rules.select("entry", "confidence", F.col("tokens").alias("rule"))
    met = own.select("url", "own", F.explode("own").alias("entry")).join(index, "entry").where(
        F.size(F.array_except("rule", "own")) == 0)
    return met.groupBy("url").agg(F.max(F.struct("confidence", F.array_join("rule", " ").alias("name"))).alias("m")).select(
        "url", F.col("m.name").alias("mined_rule"))


def judge(pages: DataFrame, rules: DataFrame, fixed: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict, mined_rule."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumns({"host": host, "path": path}).withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), fixed))
    found = match(rows.where(F.col("fixed").isNull()), rules).withColumnRenamed("url", "_url")
    return rows.join(found, F.col("url") == F.col("_url"), "left").select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("fixed").isNull(), F.col("mined_rule")).alias("mined_rule"))
