import random

import numpy as np

from terrane.llm import automata


def strings(seed, n=400):
    rnd = random.Random(seed)
    words = {bytes(rnd.choice(b"abc\xc3\xa9 z") for _ in range(rnd.randrange(1, 9))) for _ in range(n)}
    words |= {b"stem" + e for e in (b"", b"s", b"ed", b"ing")} | {b"long" * 300, b"long" * 300 + b"er"}
    return sorted(words)


def looked_up(block, key, words):
    data = np.frombuffer(b"\n".join(words) + b"\n", np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - np.array([len(w) for w in words])
    found = {}
    for automaton, index, state, total in block.accepted(key, data, start, end):
        place = total if len(automaton.out) else automaton.accept[state]
        found.update(zip(index.tolist(), (automaton.offset + place).tolist()))
    return [found.get(i, -1) for i in range(len(words))]


def shard(key, offset, words, build):
    made = build(words)
    return (key, offset, words[0][:8] if words else b"", *(made[a] for a in automata.ARRAYS))


def test_ordinals_of_both_automata_in_one_and_many_shards():
    for seed in range(3):
        words = strings(seed)
        others = sorted({w + b"x" for w in words} | {w[:-1] for w in words if len(w) > 1} | {b"\xff"})
        place = {w: i for i, w in enumerate(words)}
        asked = words + others
        for build in (automata.trie, automata.transducer):
            for size in (len(words), 37, 1):
                block = automata.Block([shard("k", at, words[at:at + size], build) for at in range(0, len(words), size)])
                assert looked_up(block, "k", asked) == [place.get(w, -1) for w in asked]
                assert looked_up(block, "other", asked[:3]) == [-1] * 3


def test_transducer_is_minimal():
    def residuals(words):  # the states of the minimal automaton are the different sets of ways to go on
        return len({frozenset(w[i:] for w in words if w.startswith(p)) for w0 in words for i in [0] for p in
                    (w0[:j] for j in range(len(w0) + 1)) for i in [len(p)]})
    for seed in (1, 2):
        words = [w for w in strings(seed, 120) if len(w) < 40]
        made = automata.transducer(words)
        assert len(made["base"]) // 4 == residuals(words)
        assert len(made["base"]) < len(automata.trie(words)["base"])


def test_no_two_transitions_share_a_slot():
    made = automata.trie(strings(4, 2000))
    owner, base = np.frombuffer(made["owner"], np.int32), np.frombuffer(made["base"], np.int32)
    assert (owner >= 0).sum() == len(base) - 1  # one transition into every state but the root


def test_empty_automata():
    for build in (automata.trie, automata.transducer):
        assert looked_up(automata.Block([shard("k", 0, [], build)]), "k", [b"a"]) == [-1]


def test_numbering_in_spark(spark):
    words = [w.decode("latin-1") for w in strings(5, 300)]
    rows = [("en", w) for w in words] + [("de", w) for w in words[:50]] + [("", "x")]
    random.Random(1).shuffle(rows)
    got = automata.numbered(spark.createDataFrame(rows, "lang string, term string"), "lang", "term", 400)
    by = {(r.lang, r.term): r.ordinal for r in got.collect()}
    for lang in ("en", "de", ""):
        own = sorted((w for x, w in rows if x == lang), key=lambda w: w.encode())
        assert [by[lang, w] for w in own] == list(range(len(own)))
    shards = automata.automata(got, "lang", "term", automata.transducer)
    assert shards.where("bytes > 0").count() > 10
    lists = list(automata.blocks(shards, "lang", 30_000))
    assert len(lists) > 2 and sum(map(len, lists)) == shards.count()
    assert all(len(b) == 1 or sum(len(x) for s in b for x in s[3:]) <= 30_000 for b in lists)
