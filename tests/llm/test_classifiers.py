import math
import random
import re
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from terrane.llm import quality, toxicity
from terrane.llm.queries import op4_quality, op7_toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [None, "", " \n\t", "one", "a b c", "a b c d", "x " * 30000, "é ü\nñ\né ü\n\n \n \né ü\n", "## a|b <c> $%&* ##", "r s t r s t r s t u"]


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1 if len(grams) < 3000 else True:
            hit.update(range(i, i + 3))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 1000 else None
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_base_counts_against_brute_force(spark):
    rnd = random.Random(2)
    docs = EDGE + [" ".join(rnd.choice("abcdef") for _ in range(n)) for n in (5, 40, 200)] + ["\n".join(rnd.choice(["p q", "", "r", " "]) for _ in range(60))]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, quality string")
    rows = quality.judge(quality.describe(df, quality.CONSTANT)).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)


def test_many_words_fall_back_to_three_keys():
    ids = np.array([5, 1 << 22, 7, 5, 1 << 22, 7, 9])
    assert quality.repeat_words(ids) == 6


def labelled(spark, tmp_path, bad_words, column, n_bad=3):
    """600 documents, half labelled; those with a bad word have the label."""
    rnd = random.Random(4)
    plain = ["w%s" % "".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    docs, labels = [], []
    for i in range(600):
        sentences = [[rnd.choice(plain) for _ in range(10)] for _ in range(8)]
        bad = rnd.random() < 0.3
        if bad:
            for _ in range(n_bad):
                sentences[rnd.randrange(8)][rnd.randrange(10)] = rnd.choice(bad_words) + rnd.choice(["", "ab", "ef"])
        docs.append((i, ". ".join(" ".join(s).capitalize() for s in sentences) + "."))
        labels.append((i, int(bad)))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    table = [(i, 1 - b if column == "quality" else 1, b if column == "toxic" else 0) for i, b in labels if i % 2]
    spark.createDataFrame(table, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return docs, dict(labels)


def test_toxicity_held_out_accuracy_and_offending_sentences(spark, tmp_path):
    docs, truth = labelled(spark, tmp_path, ["grubbel", "zorkan"], "toxic")
    rows = op7_toxicity(spark, str(tmp_path)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    unseen = [r for r in rows if r.held_out or r.doc_id % 2 == 0]
    assert np.mean([r.predicted == truth[r.doc_id] for r in unseen]) > 0.97
    text = dict(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.read.parquet(str(tmp_path / "labels.parquet"))
    found = toxicity.score(df, toxicity.train(df, labels)).collect()
    spans = [text[r.doc_id][s.start:s.start + s.length] for r in found for s in r.sentences]
    assert spans and np.mean([bool(re.search("grubbel|zorkan", s.lower())) for s in spans]) > 0.95


def test_held_out_labels_are_not_learnt_from(spark, tmp_path):
    labelled(spark, tmp_path, ["grubbel"], "toxic")
    df, labels = (spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("documents", "labels"))
    out = toxicity.held_out(F.col("doc_id"))
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(df, x, only=~out) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_quality_held_out_accuracy(spark, tmp_path):
    docs, truth = labelled(spark, tmp_path, ["$$grubbel!!", "ZORK"], "quality", 15)
    rows = [r for r in op4_quality(spark, str(tmp_path)).collect() if r.doc_id % 2 == 0]
    assert np.mean([r.kept == (not truth[r.doc_id]) for r in rows]) > 0.95
    good = np.mean([r.quality for r in rows if not truth[r.doc_id]])
    assert good > 0.85 and np.mean([r.quality for r in rows if truth[r.doc_id]]) < 0.3


def test_no_labels_and_edge_texts(spark):
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(EDGE)] + [(None, "x. y", 2.0), (1, "", 3.0)],
                               "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, none)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(EDGE) + 2 and all(r.score < 1e-6 for r in rows)
    assert toxicity.drop_toxic(df, model).columns == df.columns and toxicity.drop_toxic(df, model).count() == len(rows)
    assert quality.train(df, none) is quality.CONSTANT
    nulls = spark.createDataFrame([(None, None, None), (0, None, 1), (0, 1, None), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.score(df, toxicity.train(df, nulls)).count() == len(rows)
    assert quality.describe(df, quality.train(df, nulls)).count() == len(rows)
    assert toxicity.score(df.limit(0), model).count() == 0 and quality.describe(df.limit(0), quality.CONSTANT).count() == 0


def test_noisy_or_loss_and_gradient_against_plain_loops():
    rnd = random.Random(6)
    docs = []
    for _ in range(12):
        sizes = [rnd.randrange(0, 4) for _ in range(rnd.randrange(1, 5))]
        docs.append((rnd.randrange(2), rnd.choice([1.0, 2.5]), np.array(sizes, np.int32), np.array([rnd.randrange(6) * 1000 for _ in range(sum(sizes))], np.int32)))
    docs[0], docs[1] = (0, *docs[0][1:]), (1, *docs[1][1:])
    bags = toxicity.Bags(docs, 1)
    x = np.array([rnd.uniform(-1, 1) for _ in range(len(bags.buckets) + 1)])
    weight = dict(zip(bags.buckets.tolist(), x))

    def loss(weight, bias):
        total = 0.0
        for y, w, sizes, features in docs:
            keep, at = 1.0, 0
            for n in sizes:
                z = bias + toxicity.BIAS + sum(weight[f] for f in features[at:at + n].tolist())
                keep *= 1 - 1 / (1 + math.exp(-z))
                at += n
            total -= w * math.log(1 - keep if y else keep)
        return total / sum(d[1] for d in docs)

    got = bags.gradient(x)
    for i, f in enumerate([*bags.buckets.tolist(), None]):
        lo, hi = ({**weight, f: weight.get(f, 0) + d} if f is not None else weight for d in (-1e-5, 1e-5))
        by = (loss(hi, x[-1] + (1e-5 if f is None else 0)) - loss(lo, x[-1] - (1e-5 if f is None else 0))) / 2e-5
        assert abs(by - got[i]) < 1e-6


def test_toxicity_scores_against_plain_loops(spark):
    rnd = np.random.default_rng(1)
    model = toxicity.Model(rnd.normal(0, 1, toxicity.BUCKETS), -2.0)
    texts = [None, "", "One two. Three!", "a b c d e f g h. i j", "wort " * 100, "x. y. z. " * 30]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        keep = 1.0
        for _, _, words in toxicity.instances(text):
            keep *= 1 - 1 / (1 + math.exp(-(model.bias + sum(model.weights[f] for w in words for f in toxicity.word_features(w)))))
        assert abs(got[i].score - (1 - keep)) < 1e-9


def test_long_documents_send_a_bounded_number_of_features():
    bags = [[i, i + 1, i + 2] for i in range(1000)]
    some = toxicity.bounded(bags, 100)
    assert len(some) == 33 and all(b in bags for b in some) and toxicity.bounded(bags, 100) == some and toxicity.bounded(bags) == bags


def test_quality_probability_and_verdict_against_plain_loops(spark):
    rnd = np.random.default_rng(2)
    model = quality.Model(rnd.normal(0, 3, 2 * quality.BUCKETS), 0.2, 1.5, -0.1)
    texts = [None, "", "ab", "one two three " * 30, " ".join(f"w{i}" for i in range(80)), "é ü " * 60]
    rows = quality.judge(quality.describe(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)).collect()
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        words, three = raw.split(), quality.trigrams(raw)
        w = sum(model.weights[xxhash.xxh32_intdigest(x) % quality.BUCKETS] for x in words) / len(words) if words else 0.0
        t = sum(model.weights[x] for x in three) / len(three) if len(three) else 0.0
        p = 1 / (1 + math.exp(-(1.5 * (w + t + 0.2) - 0.1)))
        assert abs(r.quality - p) < 1e-9
        failed = len(words) < 50 or 100 * r.n_repeat_words > 50 * len(words)
        assert r.base_failed == failed and r.kept == (not failed and p >= quality.THRESHOLD)


def test_a_few_labelled_rows_are_fitted(spark):
    good, bad = "fine words all along " * 20, "zork ## zork " * 20
    df = spark.createDataFrame([(i, good if i % 2 else bad) for i in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    got = {r.doc_id: r.quality for r in quality.describe(df, quality.train(df, labels)).collect()}
    assert min(got[i] for i in (1, 3, 5, 7)) > max(got[i] for i in (0, 2, 4, 6))
