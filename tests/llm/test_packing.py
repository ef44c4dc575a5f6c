import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from terrane.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéüñß") for _ in range(rnd.randrange(1, 12))) for _ in range(3000)]
    docs = [" ".join(rnd.choice(words) for _ in range(int(rnd.paretovariate(0.8) * 30) % 4000)) for _ in range(150)]
    return docs + [None, "", " \n\t ", "It's <|endoftext|> I'll  don't\x0bÉCOLE x y １２ é", "dup dup", "dup dup", "x " * 50000]


def test_pieces_match_whole_text_encoding(spark):
    docs = texts()
    tok = Tokenizer.from_file(PATH)
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(docs)], "doc_id long, text string, piece int")
    rows = sorted(packing.pieces(df, PATH).collect())
    want = []
    for i, t in enumerate(docs):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a:a + 2048]
            want.append((i, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert [tuple(r) for r in rows] == want


def assert_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_documents_are_packed_gapless_and_tight(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    rows = packing.pack_documents(df, PATH).collect()
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)
    n = assert_packed(rows, 2048)
    assert n <= 1.05 * sum(r.length for r in rows) / 2048 + 1


def test_tree_of_many_groups(spark):
    rnd = random.Random(1)
    lengths = [rnd.randrange(1, 101) for _ in range(4000)]
    items = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long")
    rows = packing.pack(items, capacity=100, group_items=400, nearly_full=99, fan=3, receivers=8).collect()
    assert sorted((r.id, r.length) for r in rows) == list(enumerate(lengths))
    assert assert_packed(rows, 100) <= 1.06 * sum(lengths) / 100
    alone = packing.pack(items, capacity=100, group_items=400, nearly_full=0, fan=3, receivers=0)
    assert assert_packed(rows, 100) <= assert_packed(alone.collect(), 100)


def test_best_fit_against_a_plain_search():
    rnd = random.Random(3)
    lengths = np.array([rnd.randrange(1, 51) for _ in range(300)])
    bins, offsets, fills = packing.best_fit(lengths, 50)
    rooms = []
    for n in sorted(lengths.tolist(), reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(50 - n)
    assert sorted(50 - np.array(rooms)) == sorted(fills)
    assert all(np.bincount(bins, weights=lengths) == fills)


def test_only_large_items_and_empty_table(spark):
    items = spark.createDataFrame([(i, 70) for i in range(500)] + [(500, 30), (501, 100)], "id long, length long")
    rows = packing.pack(items, capacity=100, group_items=50, nearly_full=99, fan=2, receivers=4).collect()
    assert len(rows) == 502 and assert_packed(rows, 100) == 501
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_repeated_rows_and_clashing_names_spread_over_groups(spark):
    items = spark.createDataFrame([(7, "same", 60, "g", 1, 2, True)] * 3000, "doc_id long, bin string, length long, group string, fill int, number int, go boolean")
    rows = packing.pack(items, capacity=100, group_items=300).collect()
    assert len(rows) == 3000 and rows[0].__fields__ == [*items.columns, "sequence_id", "offset"]
    assert assert_packed(rows, 100) == 3000
    assert len({r.sequence_id >> 32 for r in rows}) == 10  # no group holds all copies


def test_a_vocabulary_that_the_shortcuts_do_not_fit_is_refused():
    import pytest
    with pytest.raises(ValueError, match="shortcuts"):
        packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
