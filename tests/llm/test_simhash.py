import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from terrane.llm import simhash
from terrane.llm.queries import op3_simhash


def brute_print(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return 0
    grams = [w] if len(w) < 4 else [w[i:i + 4] for i in range(len(w) - 3)]
    h = [xxhash.xxh64_intdigest(" ".join(g).encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(ids, prints, bits=4):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(ids))]


def sample_docs():
    rnd = random.Random(7)
    vocabulary = ["w%d" % i for i in range(300)]
    docs = []
    for d in range(60):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 40, 400]))]
        docs.append(" ".join(base))
        for _ in range(rnd.randrange(4)):
            near = list(base)
            near[rnd.randrange(len(near))] = "Changed"
            docs.append("\t".join(near))
    docs += [None, "", " \n", "One two", "one  TWO", "É x y"] + ["the same text over and over again"] * 40 + [" ".join(vocabulary * 60)]
    ids = list(range(len(docs)))
    rnd.shuffle(ids)
    return list(zip(ids, docs))


def test_fingerprints_match_spark_and_brute_force(spark):
    texts = [t for _, t in sample_docs()]
    got = simhash.fingerprints([t.encode() if t else None for t in texts])
    assert [int(x) for x in got] == [brute_print(t) for t in texts]
    row = spark.sql("SELECT xxhash64('é one two') AS h").first()
    assert row.h & simhash._U64 == xxhash.xxh64_intdigest("é one two".encode(), seed=42)


def test_components_against_all_pairs(spark, tmp_path):
    docs = sample_docs() + [(None, "nobody knows this text"), (3, "a second row of id three")]
    spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, fp string").write.parquet(
        str(tmp_path / "documents.parquet"))
    prints = [brute_print(t) for _, t in docs]
    want = sorted(zip([d for d, _ in docs], ["%016x" % p for p in prints], brute_components([d for d, _ in docs], prints)), key=str)
    got = op3_simhash(spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_large_groups_lose_no_link(spark):
    """A dense cloud of fingerprints with a tiny group limit: the same components as all pairs."""
    rnd = random.Random(3)
    centre, far = rnd.getrandbits(64), rnd.getrandbits(64)
    cloud = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(9))) for c in (centre, far) for _ in range(150)}
    ids = sorted(cloud)
    want = dict(zip(ids, brute_components(list(range(len(ids))), ids)))
    prints = spark.createDataFrame([(i, int(np.array(p, np.uint64).view(np.int64))) for i, p in enumerate(ids)], "doc_id long, fp long")
    got = {r.fp & simhash._U64: r.component_id for r in simhash.classes(prints, group_limit=16).collect()}
    assert got == want


def test_one_row_per_class_stays(spark):
    docs = [(5, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (2, "quite another text stands here"), (1, "quite another text stands here"),
            (7, "alone in the world it is"), (None, "no id at all here"), (None, "no id at all here"), (9, None), (8, "")]
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, component_id string")
    left = simhash.one_per_class(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(2, "a b c d e"), (1, "quite another text stands here"), (7, "alone in the world it is"), (None, "no id at all here"), (8, "")], key=str)


def test_classes_under_one_id_or_none_each_keep_a_row(spark):
    docs = [(None, "no id at all here"), (None, "no id at all here"), (None, "nor has this other text an id"), (None, ""),
            (2, "a b c d e"), (2, "quite another text stands here"), (2, "quite another text stands here"),
            (3, "a text of two ids it is"), (None, "a text of two ids it is"), (3, "the third text is of three"), (1, "the third text is of three")]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(docs)], "doc_id long, text string, root long")
    left = simhash.one_per_class(df)
    assert left.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(None, "no id at all here"), (None, "nor has this other text an id"), (None, ""), (2, "a b c d e"),
         (2, "quite another text stands here"), (3, "a text of two ids it is"), (1, "the third text is of three")], key=str)
    alone = simhash.one_per_class(df.where("doc_id IS NULL AND text = ''"))
    assert [(r.doc_id, r.text) for r in alone.collect()] == [(None, "")]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert simhash.one_per_class(spark.createDataFrame([], "doc_id long, text string")).where(F.lit(True)).count() == 0
