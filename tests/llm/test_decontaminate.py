import hashlib
import re

import pytest

from terrane.llm.decontaminate import contamination, remove_contaminated
from terrane.llm.queries import op1_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"
DOCS = [
    (1, f"before {PASSAGE} after"), (2, PASSAGE.lower().replace(" ", "-\n")), (3, "clean text here"), (4, None), (5, ""),
    (6, "...!"), (7, PASSAGE[:40]), (8, "état süß 42 état"), (1, f"before {PASSAGE} after"), (None, PASSAGE),
    (9, "x " * 30000 + PASSAGE + " alpha beta gamma delta epsilon zeta eta theta iota kappa"),
]
ITEMS = [(10, PASSAGE), (2, "again " + PASSAGE), (3, "ÉTAT süß"), (4, None), (5, " ,"), (6, "42"), (10, PASSAGE), (None, "clean text")]


def fold(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, ids = fold(text), set(), set()
        for item_id, item in items:
            v = fold(item)
            size = min(window, len(v))
            for p in range(len(v) - size + 1) if v else ():
                for q in range(len(w) - size + 1):
                    if w[q:q + size] == v[p:p + size]:
                        hit.update(range(q, q + size))
                        ids.add(item_id)
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def tables(spark, tmp_path):
    def write(docs, items):
        spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id long, text string, items string").write.parquet(
            str(tmp_path / "documents.parquet"))
        spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)
    return write


def test_against_brute_force(spark, tables):
    got = op1_decontamination(spark, tables(DOCS, ITEMS)).drop("longest_match").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(DOCS, ITEMS)


def test_empty_tables(spark, tables, tmp_path):
    assert op1_decontamination(spark, tables([], [])).count() == 0


def test_longest_match_and_location(spark):
    docs = spark.createDataFrame(DOCS[:1] + DOCS[6:7], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    rows = {r.doc_id: r for r in contamination(docs, items, shard_words=2, block_bytes=40).collect()}
    assert sorted(tuple(m) for m in rows[1].matches) == [(2, 1, 1, 12), (10, 0, 1, 12)]
    assert [tuple(s) for s in rows[1].spans] == [(1, 12)]
    assert rows[7].n_hit == 0


def test_affected_documents_are_removed_with_all_columns(spark):
    docs = spark.createDataFrame([(i, t, "keep") for i, t in DOCS], "doc_id long, text string, n_hit string")
    left = remove_contaminated(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert left.columns == docs.columns
    want = sorted(str(i) for (i, t) in DOCS if not brute([(i, t)], ITEMS)[0][5])
    assert sorted(str(r.doc_id) for r in left.collect()) == want
