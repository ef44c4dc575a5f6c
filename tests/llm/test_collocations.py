import random
import re
from collections import Counter

from terrane.llm import collocations
from terrane.llm.queries import op13_collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n string, seen int"


def brute(rows, least=30, top=2000):
    out = []
    for lang in {"und" if x is None else x for _, x in rows}:
        f, total = Counter(), 0
        for text, x in rows:
            if ("und" if x is None else x) != lang:
                continue
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            for piece in re.split("[.,;:!?\x0a-\x0d]", low):
                w = re.findall("[^\x20\x09]+", piece)
                total += len(w)
                f.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        found = []
        for p, a in candidates.items():
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                       for q, b in candidates.items()):
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, total, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def corpus(n=900):
    rnd = random.Random(2)
    words = ["the", "The", "new", "York", "city", "a\x00b", "É", "é", "x" * 70, "of", "(in", "zz", "漢字"]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rnd.randrange(30)):
            text += rnd.choice(words) if rnd.random() < 0.6 else "New York city hall"
            text += rnd.choice([" ", " ", " ", "\t", "  ", " \n ", ". ", ",", ";\x0b", "\r\n", "!?"])
        rows.append((text, rnd.choice(["en", "en", "de", "", None])))
    return rows + [rows[5]] * 40 + [(None, "en"), ("", "fr"), (" . ", "fr"), ("long run " * 30000, "en"), ("İ i " * 40, "tr")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "clash", "x", 1) for i, (t, g) in enumerate(rows)], SCHEMA)


def test_against_brute_force_in_one_and_many_blocks(spark):
    rows = corpus()
    want = brute(rows)
    assert len(want) > 40 and len({r[0] for r in want}) >= 4
    for options in ({}, {"shard_bytes": 1500, "block_bytes": 60_000}):
        got = collocations.mine(frame(spark, rows).repartition(4), **options)
        assert sorted(map(tuple, got.collect())) == want


def test_top_ties_and_dropped_phrases(spark):
    # p q r s always together: only the whole stays; u v also occurs alone often enough.
    rows = [("p q r s. u v w", "en")] * 30 + [("u v", "en")] * 10 + [("b a. d c", "en")] * 30
    got = sorted(map(tuple, collocations.mine(frame(spark, rows)).collect()))
    assert got == brute(rows)
    assert {r[2] for r in got} == {"p q r s", "u v", "u v w", "b a", "d c"}
    assert sorted(map(tuple, collocations.mine(frame(spark, rows), top=2).collect())) == brute(rows, top=2)


def test_empty_table_and_no_frequent_phrase(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert op13_collocations(spark, str(tmp_path)).collect() == []
    assert collocations.mine(frame(spark, [("a b", "en"), (None, None)])).collect() == []
    assert collocations.mine(frame(spark, [("a. b", "en")] * 40)).collect() == []


def test_tables_of_seen_positions_go_when_the_next_one_is_written(spark, monkeypatch):
    import os

    rows, seen, most = corpus(), [], []

    def writes(df, name, *more):
        found, path = written(df, name, *more)
        if name.startswith("seen"):
            seen.append(path)
            most.append(sum(map(os.path.exists, (p.removeprefix("file:") for p in seen))))
        return found, path

    written = collocations.written
    monkeypatch.setattr(collocations, "written", writes)
    got = collocations.mine(frame(spark, rows).repartition(4), shard_bytes=500, block_bytes=20_000)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert len(seen) > 4 and max(most) == 2
    assert not any(os.path.exists(p.removeprefix("file:")) for p in seen)
