import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from terrane.llm import decontaminate, pii, simhash, toxicity
from terrane.llm.common import stored

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], DATA), f"test-{name}"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_stage_return_the_columns_of_documents(stages):
    assert [s.columns for s in stages[1:-1]] == [stages[0].columns] * 4
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]


def test_each_stage_decides_on_its_own_input(spark, stages):
    start, clean, single, unleaked, private, packed = (rows(s) if i < 5 else s.collect() for i, s in enumerate(stages))
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    model = toxicity.train(stages[0], labels, only=~toxicity.held_out(F.col("doc_id")))
    assert set(clean) == {i for i, r in start.items() if toxicity.noisy_or(model.sentences(r.text)[1]) < toxicity.THRESHOLD}

    ids = sorted(clean)
    prints = simhash.fingerprints([clean[i].text.encode() if clean[i].text else None for i in ids])
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    left, kept = list(range(len(ids))), set()
    while left:
        group, front = {left[0]}, [left[0]]
        while front:
            new = set(np.flatnonzero(near[front.pop()]).tolist()) - group
            group |= new
            front += new
        kept.add(min(ids[i] for i in group))
        left = [i for i in left if i not in group]
    assert set(single) == kept

    items = [decontaminate.words(r.text.encode()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() if r.text]
    grams = {tuple(w[p:p + min(10, len(w))]) for w in items if w for p in range(len(w) - min(10, len(w)) + 1)}

    def leaks(text):
        w = decontaminate.words(text.encode())
        return any(tuple(w[p:p + n]) in grams for n in {len(g) for g in grams} for p in range(len(w) - n + 1))
    assert set(unleaked) == {i for i, r in single.items() if not leaks(r.text or "")}

    want = {r.doc_id: r.text for r in pii.pseudonyms(stages[3], "terrane test key").collect()}
    assert {i: r.text for i, r in private.items()} == want
    assert all(private[i].source == unleaked[i].source and private[i].lang == unleaked[i].lang for i in unleaked)

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    length, fill = defaultdict(int), defaultdict(int)
    for p in packed:
        ids = (tok.encode(private[p.doc_id].text or "", add_special_tokens=False).ids + [0])[p.start:p.start + p.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == p.ids_crc32
        length[p.doc_id] += p.length
        fill[p.sequence_id] += p.length
    assert set(length) == set(private) and max(fill.values()) <= 2048
    assert len(fill) <= 1.1 * sum(fill.values()) / 2048 + 1


def test_empty_documents_and_extra_columns(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, sequence_id string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_null_texts_ids_and_repeated_rows(spark, tmp_path):
    docs = [(1, None, "en", "s", 0, "x"), (None, "a b c d e f", "en", None, None, None), (2, "mail me at bob@x.org please or not", None, "s", 1, "y"),
            (2, "mail me at bob@x.org please or not", None, "s", 1, "y"), (3, "", "en", "s", 0, "z"), (4, "word " * 40000, "en", "s", 5, "w")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, component_id string").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(2, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == {1, 2, 4, None}
    assert sum(r.length for r in out if r.doc_id == 4) == 40001 and len([r for r in out if r.doc_id == 2]) == 1
