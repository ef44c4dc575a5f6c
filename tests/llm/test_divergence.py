import random
import re
from collections import Counter

from terrane.llm import divergence
from terrane.llm.queries import op11_divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, ordinal int"


def brute(rows, least=3, top=200):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted((t for t in seen if seen[t] >= least), key=str.encode)
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if seen[t] >= least) for s in {d[1] for d in own}}
        rate = lambda c: {t: 1 + divergence.SCALE * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p = {s: rate(c) for s, c in counts.items()}
        q = rate(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s in counts:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def corpus(n=160):
    rnd = random.Random(11)
    words = ["Apfel", "öl", "Zebra", "zebra", "a", "b", "ß", "漢字", "É", "é", "x" * 500, "Q"]
    rows = []
    for _ in range(n):
        lang = rnd.choice(["en", "en", "en", "de", "", None])
        source = rnd.choice(["hot", "hot", "hot", "s1", "s2", "é", "", None, "s%d" % rnd.randrange(9)])
        text = "".join(rnd.choice(words) + rnd.choice([" ", "-", "\n", "1", "[", "`"]) for _ in range(rnd.randrange(40)))
        rows.append((text, lang, source))
    rows += [rows[0]] * 30 + [(None, "fr", "a"), ("", "fr", "b"), ("only once", "it", "c"), ("zebra " * 20000, "en", "hot"), (None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, s, "clash", 1) for i, (t, g, s) in enumerate(rows)], SCHEMA)


def test_against_brute_force_in_one_and_many_blocks(spark):
    rows = corpus()
    want = brute(rows)
    assert {r[2] for r in want} == {"pair", "term"} and ("fr", "a", "pair", "b", 0, 1) in want
    for options in ({}, {"shard_bytes": 300, "block_bytes": 15_000, "chunk": 3, "sources": 2}):
        got = divergence.audit(frame(spark, rows).repartition(5), **options)
        assert sorted(map(tuple, got.collect())) == want


def test_top_and_ties(spark):
    rows = [(" ".join(chr(97 + i) + chr(97 + j) for i in range(6) for j in range(6)), "en", "a")] * 3 + [("zz " * 50, "en", "b")] * 3
    got = sorted(map(tuple, divergence.audit(frame(spark, rows), top=5).collect()))
    assert got == brute(rows, top=5) and [r[3] for r in got if r[1] == "a" and r[2] == "term"] == ["aa", "ab", "ac", "ad", "ae"]


def test_counts_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 0, 10 ** 11), ("en", "b", 1, 5)], "lang string, source string, ordinal long, count long")
    groups = spark.createDataFrame([("en", "a", 10 ** 11, 2), ("en", "b", 5, 2)], "lang string, source string, n long, v long")
    got = {(r.source, r.item): r.value for r in divergence._pair_sums(counts, groups, 4096, 64).collect()}
    p = {"a": [1 + 10 ** 9 * (10 ** 11 + 1) // (10 ** 11 + 2), 1 + 10 ** 9 // (10 ** 11 + 2)], "b": [1 + 10 ** 9 // 7, 1 + 10 ** 9 * 6 // 7]}
    assert got == {(x, y): sum((u - v) ** 2 // v for u, v in zip(p[x], p[y])) for x, y in (("a", "b"), ("b", "a"))}


def test_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert op11_divergence(spark, str(tmp_path)).collect() == []
