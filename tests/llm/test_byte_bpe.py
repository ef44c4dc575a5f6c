import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from terrane.llm import byte_bpe
from terrane.llm.queries import op12_byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return byte_bpe.Codec(byte_bpe.parse_ranks(f.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n=3000):
    rnd = random.Random(3)
    alphabets = ["abcdefgh ", "eaitnsr'", " \t\n\r\x0b", "0123456789.,-", "äöüßéèçñ ", "ключ слово", "漢字かな交じり文、。", "😀👩‍👧 é",
                 "abAB12 .!?\n", "\x00\x01\x7f ~"]
    out = ["", " ", "a" * 5000, "ab" * 3000, " " * 4000, "\n" * 300 + "x", "don't I'll we've", "<|endoftext|>", "1" * 999,
           "漢" * 700, "\U00032431\U0003e827 a\U00016ff5 1\U00012586x"]
    for _ in range(n):
        k = rnd.randrange(1, 40)
        if rnd.random() < 0.3:
            out.append("".join(chr(c) for c in (rnd.randrange(1, 0x110000) for _ in range(k)) if not 0xD800 <= c < 0xE000))
        else:
            letters = "".join(rnd.sample(alphabets, 2))
            out.append("".join(rnd.choice(letters) for _ in range(k)))
    return out


def test_same_ids_as_the_library_and_back(codec, library):
    for t in texts():
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t), t
        # Back: what the pattern leaves out is nothing, so the text comes back whole.
        assert codec.decode(ids) == t.encode()


def test_unreachable_tokens_and_any_order_of_ranks():
    # Ranks in random order: some tokens can't be reached by merges, others only from some contexts.
    rnd = random.Random(5)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        tokens |= {bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(2, 6))) for _ in range(25)}
        order = sorted(tokens, key=len)[:256] + rnd.sample(sorted(t for t in tokens if len(t) > 1), len(tokens) - 256)
        ranks = {t: i for i, t in enumerate(order)}
        own = byte_bpe.Codec(ranks, r"[\s\S]+", "")
        theirs = tiktoken.Encoding("x", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        for _ in range(60):
            t = "".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 30)))
            assert np.frombuffer(own.encode(t), "<u4").tolist() == theirs.encode_ordinary(t)


def test_work_is_linear(codec):
    calls = []
    plain = codec.compatible
    codec.compatible = lambda a, b: calls.append(1) or plain(a, b)
    try:
        counts = []
        for n in (10_000, 20_000, 40_000):
            calls.clear()
            codec.encode_match(b"aababcab" * (n // 8))
            counts.append(len(calls))
    finally:
        codec.compatible = plain
    assert counts[2] <= 4.2 * counts[0] and counts[2] <= 40_000 * 4


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="every byte"):
        byte_bpe.Codec({b"a": 0}, "a", "")


def test_query_on_nulls_repeats_long_texts_and_clashing_columns(spark, tmp_path, library):
    rows = [(1, None), (2, ""), (3, "The cat's 12 hats"), (3, "The cat's 12 hats"), (None, "x"), (4, "word " * 400_000), (5, "q" * 50_000)]
    spark.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, ids int, n_tokens string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = op12_byte_bpe(spark, str(tmp_path)).collect()
    want = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert op12_byte_bpe(spark, str(tmp_path)).collect() == []
