import datetime as dt
import random

from pyspark.sql import functions as F

from terrane.llm import warc_revisit as wr

SCHEMA = "record_id long, warc_type string, uri string, date timestamp, headers map<string,string>, payload string, latest string"


def at(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=n)


def resolve(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return {r.record_id: r for r in wr.resolve_revisits(df, **options).collect()}


def test_canonical_urls(spark):
    urls = {"HTTP://www.A.com:80/x/?utm_source=f&b=2&a=1#top": "a.com/x?a=1&b=2", "https://a.com": "a.com", "https://a.com/": "a.com",
            "http://a.com?ref=z": "a.com", "http://a.com/X?reference=1": "a.com/X?reference=1", "": "", "no/scheme": "no/scheme"}
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", wr.canonical_url(F.col("u")).alias("c"))
    assert {r.u: r.c for r in df.collect()} == urls


def test_headers_and_outcomes(spark):
    base = {"ETag": 'W/"1"', "Content-Type": "t", "Content-Length": "5", "X-Own": "a"}
    rows = [
        (1, "response", "http://a.com/", at(10), base, "old"), (2, "response", "https://www.a.com", at(20), {"etag": '"2"', "Vary": "v"}, "new"),
        (3, "revisit", "http://a.com/#f", at(15), {"ETAG": '"1"', "Content-Length": "0", "Date": "d", "x-own": "b", "Cache-Control": "c"}, None),
        (4, "revisit", "http://a.com/", at(20), {"ETag": '"1"'}, None), (5, "revisit", "http://a.com/", at(21), {"ETag": '"1"'}, None),
        (6, "revisit", "http://a.com/", at(10), {"ETag": '"1"'}, None), (7, "revisit", "http://a.com/", at(99), None, None),
        (8, "revisit", None, at(99), {}, None), (9, "revisit", "http://a.com/", None, {}, None), (10, "revisit", "http://b.com/", at(99), {}, None),
        (11, "response", "http://c.com/", at(1), {"Last-Modified": "m"}, "c1"), (12, "response", "http://c.com/", at(1), {"last-modified": "n"}, "c2"),
        (13, "revisit", "http://c.com/", at(2), {"LAST-modified": "n", "ETag": "e"}, None), (14, "metadata", "http://c.com/", at(1), None, None)]
    got = resolve(spark, rows)
    assert {k: (r.outcome, r.response_id) for k, r in got.items()} == {
        3: ("resolved", 1), 4: ("resolved", 1), 5: ("validator_mismatch", 2), 6: ("no_earlier_response", None), 7: ("no_validator", 2),
        8: ("no_earlier_response", None), 9: ("no_earlier_response", None), 10: ("no_earlier_response", None), 13: ("resolved", 12)}
    assert got[3].payload == "old" and got[3].status == 200 and got[5].payload is None and got[5].headers is None
    assert got[3].headers == {"etag": '"1"', "content-type": "t", "content-length": "5", "x-own": "a", "date": "d", "cache-control": "c"}
    assert got[13].payload == "c2" and got[13].headers == {"last-modified": "n", "etag": "e"}


def test_hot_moment_and_hot_response(spark):
    """Most records at one moment of one URL, and most revisits of one response, beside dates far apart."""
    rows = [(i, "revisit", "http://hot.com/", at(50), {"ETag": "1"}, None) for i in range(2000)]
    rows += [(5000 + i, "response", "http://hot.com/", at(50), {"ETag": "1"}, f"q{i}") for i in range(50)]
    rows += [(6000, "response", "http://hot.com/", at(-10 ** 8), {"ETag": "1"}, "first"), (6001, "revisit", "http://hot.com/", at(10 ** 8), {"ETag": "1"}, None)]
    got = resolve(spark, rows, parts=7)
    assert len(got) == 2001 and {got[i].payload for i in range(2000)} == {"first"} and got[6001].payload == "q49"


def test_hot_url_in_time_parts_against_brute_force(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(900):
        url = "http://hot.com/" if rnd.random() < 0.5 else f"http://h{rnd.randrange(40)}.com/"
        kind = "response" if rnd.random() < 0.3 else "revisit"
        rows.append((i, kind, url, at(rnd.randrange(200)), {"ETag": "1"}, f"p{i}" if kind == "response" else None))
    rows += [(10_000, "revisit", "http://hot.com/", at(500), {"ETag": "1"}, None)] * 3
    got = resolve(spark, rows, parts=20)
    for i, kind, url, when, _, _ in rows:
        if kind == "revisit":
            before = [(r[3], r[0]) for r in rows if r[1] == "response" and r[2] == url and r[3] < when]
            assert got[i].response_id == (max(before)[1] if before else None)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert wr.resolve_revisits(df, parts=20).count() == sum(r[1] == "revisit" for r in rows)
    assert wr.resolve_revisits(df.limit(0)).count() == 0
