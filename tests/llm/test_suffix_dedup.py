import random

from terrane.llm.suffix_dedup import repeated_passages


def brute(docs, m):
    """Per document the maximal unions of m-word windows that occur twice, by looking at every window."""
    words = [(t or "").encode().split() for _, t in docs]
    seen = {}
    for d, w in enumerate(words):
        for s in range(len(w) - m + 1):
            seen.setdefault(tuple(w[s:s + m]), []).append((d, s))
    out = set()
    for d, w in enumerate(words):
        hit = [s for s in range(len(w) - m + 1) if len(seen[tuple(w[s:s + m])]) > 1]
        spans = []
        for s in hit:
            if spans and s <= spans[-1][1]:
                spans[-1][1] = s + m
            else:
                spans.append([s, s + m])
        out |= {(docs[d][0], a, b - a) for a, b in spans}
    return out


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(40)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passages = [text(n) for n in (9, 10, 11, 14, 30, 60)]
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            a = rnd.randrange(3)
            parts += text(rnd.randrange(12)) + p[a:len(p) - rnd.randrange(3)]
        docs.append(parts + text(rnd.randrange(15)))
    docs += [docs[3]] * 20 + [["und"] * 200, ["und"] * 35, ["a", "b"] * 60, docs[5] + docs[5], []]
    near = list(passages[5])
    near[30] = "changed"
    docs += [near, passages[5][:29]]
    sep = [" ", "\n", "\t ", "\r\n"]
    return [(i, "".join(w + rnd.choice(sep) for w in d)) for i, d in enumerate(docs)]


def check(spark, docs, m, seed):
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, key int")
    rows = repeated_passages(df, m, seed).collect()
    got = {(r.doc_id, r.start_word, r.n_words) for r in rows}
    assert len(got) == len(rows)
    assert got == brute(docs, m)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append((t or "").split())
    grams = {i: [tuple(w[s:s + m]) for w in ws for s in range(len(w) - m + 1)] for i, ws in texts.items()}
    for r in rows:
        own = {g for w in texts[r.doc_id] for s in range(len(w) - m + 1) for g in [tuple(w[s:s + m])]
               if r.start_word <= s <= r.start_word + r.n_words - m}
        if r.other_doc_id is not None and r.other_doc_id != r.doc_id:
            assert own & set(grams[r.other_doc_id])


def test_against_every_window(spark):
    for seed in (1, 2):
        check(spark, corpus(seed), 10, 4)


def test_hot_passage_over_many_tasks(spark):
    """A passage of a third of the rows, with few rows a task: no occurrence is lost at a task's edge."""
    rnd = random.Random(5)
    hot = [f"h{i}" for i in range(14)]
    docs = [(i, " ".join([f"a{rnd.random()}"] + (hot if i % 3 == 0 else [f"b{rnd.random()}" for _ in range(14)]) + [f"c{i}"])) for i in range(240)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, docs, 10, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_edge_rows(spark):
    long = " ".join(f"x{i}" for i in range(30000))
    docs = [(1, None), (2, ""), (3, "few words"), (4, long), (5, long + " tail"), (None, long), (6, "p " * 60), (6, "q " * 60), (7, "r " * 49)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.start_word, r.n_words) for r in repeated_passages(df).collect()}
    assert got == brute(docs, 50)
    assert repeated_passages(df.limit(0)).count() == 0


def test_repeated_rows_are_copies(spark):
    docs = [(1, " ".join(f"y{i}" for i in range(60)))] * 3 + [(2, "other words here")]
    rows = repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.start_word, r.n_words) for r in rows] == [(1, 0, 60)]
