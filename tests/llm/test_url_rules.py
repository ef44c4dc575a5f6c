import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from terrane.llm import url_rules
from terrane.llm.queries import URL_RULES, op5_url_rules

URLS = [None, "", "no scheme/net/", "http://A.Example.NET/en/x?y=1#z", "http://example.net/en", "https://example.net/de/", "x://net/",
        "http://net", "http://net?x", "http://badnet/", "http://a.example.com/de/1", "http://a.example.com/en/1", "http://é.org/fr/ü",
        "http://ORG/fr/", "http://user@x.org:80/FR/", "https://m.example.org/fr?q", "a://b://c/net/", "http://x.net/" + "p" * 50000]


def brute(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):]).group()


def brute_rule(host, path):
    best = None
    for verdict, rule in URL_RULES:
        own, rest = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


SHOWN = "<html><script>a | b</script><p>" + "word " * 60 + "</p><!-- | --></html>"


@pytest.fixture
def tables(spark, tmp_path):
    def write(urls, html=()):
        rows = [(i, u, h, "block", "x") for i, (u, h) in enumerate(itertools.zip_longest(urls, html, fillvalue=SHOWN))]
        spark.createDataFrame(rows, "page_id long, url string, html string, verdict string, told string").write.parquet(str(tmp_path / "pages.parquet"))
        return str(tmp_path)
    return write


def test_host_path_and_rules(spark, tables):
    rows = op5_url_rules(spark, tables(URLS)).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = brute(URLS[r.page_id])
        rule, verdict = brute_rule(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), URLS[r.page_id]


def mined(sets, bad):
    """Token sets that suffice for support, count, confidence and the bound on chance, without idle ones."""
    known = [i for i in bad if sets[i]]
    total, n_bad = len(known), sum(bad[i] for i in known)
    rate, counts = n_bad / total, {}
    for s in {s for i in known for n in range(1, len(sets[i]) + 1) for s in itertools.combinations(sorted(sets[i]), n)}:
        counts[s] = sum(set(s) <= sets[i] for i in known), sum(set(s) <= sets[i] and bad[i] for i in known)
    least = max(url_rules.MIN_SUPPORT, (url_rules.MIN_COUNT - 0.5) / total) * total
    looked_at, confidence = sum(n >= least for n, _ in counts.values()), {}
    for s, (n, k) in counts.items():
        if k >= least and k / n >= url_rules.MIN_CONFIDENCE and k / n > rate:
            c = k / n
            bound = -n * (c * math.log(c / rate) + ((1 - c) * math.log((1 - c) / (1 - rate)) if c < 1 else 0))
            if bound + math.log(looked_at) <= math.log(url_rules.ALPHA):
                confidence[s] = c
    return {s for s in confidence if not any(set(t) < set(s) and confidence[t] >= confidence[s] for t in confidence)}


def test_mined_rules_against_all_token_sets(spark, tables):
    rnd = random.Random(8)
    urls, html = [], []
    for _ in range(400):
        spam, lang = rnd.random() < 0.3, rnd.choice(["en", "de"])
        host = rnd.choice(["cheap-pills", "pills"]) if spam else rnd.choice(["news", "blog", "pills"])
        urls.append(f"http://{host}.site.info/{lang}/{rnd.randrange(99)}")
        bad = spam and lang == "en" and host == "cheap-pills" or rnd.random() < 0.05
        html.append(rnd.choice(["<p>" + "a | " * 60, "too short", None]) if bad else SHOWN)
    urls += [urls[0]] * 30 + [None, "http://x.example.com/de/1", "http://x.example.net/en/1", "http://y.net/a"]
    html += [html[0]] * 30
    d = tables(urls, html)
    pages = spark.read.parquet(f"{d}/pages.parquet")
    labels = url_rules.page_labels(pages, URL_RULES)
    bad = {r.page_id: r.bad for r in labels.collect()}
    assert len(bad) == len(urls) and [bad[i] for i in (431, 432, 433)] == [True, False, True]
    assert all(bad[i] == (h != SHOWN) for i, h in enumerate(html))
    sets = {r.page_id: frozenset(r.t) for r in pages.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect()}
    want = mined(sets, bad)
    assert {tuple(r.tokens) for r in url_rules.mine(labels).collect()} == want and want
    for r in op5_url_rules(spark, d).collect():
        hit = any(set(s) <= sets[r.page_id] for s in want)
        if r.rule is None:
            assert (r.verdict == "block") == hit and (r.mined_rule is not None) == hit
        else:
            assert r.mined_rule is None and r.verdict == dict((b, a) for a, b in URL_RULES)[r.rule]


def test_rules_mined_from_some_pages_find_bad_ones_among_the_others(spark):
    """The given pages: the rules of three quarters, without the fixed ones, on the last quarter."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    labels = url_rules.page_labels(pages, URL_RULES)
    held = F.pmod(F.xxhash64("page_id"), F.lit(4)) == 0
    rules = url_rules.mine(labels.where(~held))
    assert rules.count() > 0
    found = url_rules.match(labels.where(held), rules).withColumnRenamed("url", "_url")
    rows = labels.where(held).join(found, F.col("url") == F.col("_url"), "left").select("bad", F.col("_url").isNotNull().alias("hit")).collect()
    bad, hit, both = sum(r.bad for r in rows), sum(r.hit for r in rows), sum(r.bad and r.hit for r in rows)
    print("held out", len(rows), "bad", bad, "hit", hit, "both", both)
    assert both / hit > 2 * bad / len(rows) and both / bad > 0.3


def test_labels_that_say_nothing_about_the_url_give_no_rule(spark):
    """Rare token sets that are bad by chance block nothing; a token that does say something still does."""
    rnd = random.Random(5)
    urls = [f"http://{rnd.choice(['m', 'www', 'blog'])}.{rnd.choice('abcdefghijklmnop')}x.info/{rnd.choice(['en', 'de'])}/{rnd.choice('klmnopqrst')}"
            for _ in range(600)]
    chance = [(i, rnd.random() < 0.26) for i in range(len(urls))]
    label = lambda rows: spark.createDataFrame([(urls[i], b) for i, b in rows], "url string, bad boolean")
    assert url_rules.mine(label(chance)).count() == 0
    told = [(i, b or ".ax." in urls[i]) for i, b in chance]
    assert [tuple(r.tokens) for r in url_rules.mine(label(told)).collect()] == [("host:ax",)]


def test_empty_tables(spark, tables):
    assert op5_url_rules(spark, tables([])).count() == 0
