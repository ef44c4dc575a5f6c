"""Phrase collocation mining: level-wise candidates counted by broadcast double-array tries.

Texts become lower-cased *pieces* of words (no phrase crosses a piece), written once.  Then,
a level at a time:

1. Words are counted in each task and summed; those in at least ``least`` places are kept.
2. For k = 1 to ``longest``: the candidates of k words are range-sorted, cut into bounded
   shards and built into double-array tries (``automata``), which are broadcast in blocks of
   bounded bytes.  All word positions of a slice of text advance through a trie at once, a
   byte a step.  The accepting states they end in are counted by ``bincount``, and the
   shards' counts are summed.
3. In the same pass, two neighbouring positions that both hold a k-word candidate give a
   sequence of k + 1 words.  A phrase can only be frequent if both its k-word parts are, so
   no other sequence can (Apriori); what all tasks together saw less than ``least`` times is
   no candidate either.  The rest are the candidates of the next level.

If the tries of a level need several blocks, each but the last adds what it found to a
written table of the positions, so every position is known when neighbours meet.  That table
goes when the next one is written: there are two of them at most, however many blocks.

Every candidate is then cut after each of its words and scored by
floor(SCALE * a / (l + r)), the lowest cut counting; phrases that mostly occur inside a longer
candidate go.  That is native DataFrame code; all numbers are exact integers.

Defined results: a NULL lang is 'und'; NULL, empty and wordless texts have no words; long
texts are read whole (a slice of text holds at least one document); every repeated row
counts; ties go by count and then by the phrase's bytes; an empty table, or one without
frequent phrases, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import remove_scratch
from . import automata
from .common import stored, written

LEAST = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
COVERED = 80  # percent of a phrase's places inside one longer candidate that drop it
_FLUSH = 1 << 19  # counts that a task holds before it hands them on
_SLICE = 2 << 20  # bytes of text whose positions advance together
# Lower-cased letters; every piece border a line feed, every word border a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
_RUNS = re.compile(rb" *\n[ \n]*|  +")


def _tidy(text: bytes) -> bytes:
    """Words with one space between them and one line feed between pieces."""
    return _RUNS.sub(lambda m: b"\n" if b"\n" in m.group() else b" ", text.translate(_FOLD)).strip(b" \n")


def pieces(documents: DataFrame) -> DataFrame:
    """(lang, text) of the tidied text of every document with a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _slices(batch):
                tidy = [_tidy(t) for t in texts]
                keep = [i for i, t in enumerate(tidy) if t]
                yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(keep, pa.int64())),
                                                  pa.array([tidy[i] for i in keep], pa.binary())], ["lang", "text"])

    rows = documents.select(F.coalesce(F.col("`lang`").cast("string"), F.lit("und")).alias("lang"), F.col("`text`").cast("string").alias("text"))
    return stored(rows.where("text IS NOT NULL").mapInArrow(run, "lang string, text binary"), "pieces", "zstd")


def _slices(batch: pa.RecordBatch, limit: int = _SLICE) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    texts = batch.column("text").cast(pa.binary())
    size = np.concatenate([[0], np.cumsum([len(t.as_buffer()) for t in texts])])
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(size, size[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start), texts.slice(start, stop - start).to_pylist()
        start = stop


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n); the row of a NULL word holds the number of all words of the language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def flushed():
            for lang, found in held.items():
                words = [None, *(w.decode("utf-8", "replace") for w in found)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()),
                                                  pa.array([sum(found.values()), *found.values()], pa.int64())], ["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for part, own in _slices(batch):
                for lang, text in zip(part.column("lang").to_pylist(), own):
                    held[lang].update(text.replace(b"\n", b" ").split(b" "))
                if sum(map(len, held.values())) > _FLUSH:
                    yield from flushed()
        yield from flushed()

    return texts.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Words:
    """Word borders of a slice of texts of one language, as places in its bytes."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.end = np.flatnonzero((self.data == 32) | (self.data == 10))
        self.start = np.concatenate([[0], self.end[:-1] + 1])
        # Of each word, the number of words from it to the end of its piece.
        last = np.flatnonzero(self.data[self.end] == 10)
        self.left = last[np.searchsorted(last, np.arange(len(self.end)))] - np.arange(len(self.end)) + 1

    def phrases(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, start, end) of every sequence of ``k`` words inside a piece."""
        at = np.flatnonzero(self.left >= k)
        return at, self.start[at], self.end[at + k - 1]


@lru_cache(maxsize=1)
def _block(shared) -> automata.Block:
    return automata.Block(shared.value)


def _look_up(lang: str, words: Words, k: int, block: automata.Block, seen: np.ndarray, counts: list) -> None:
    """Put the ordinal of every ``k``-word candidate of the block into ``seen``, and count its accepting states."""
    at, start, end = words.phrases(k)
    for automaton, index, state, _ in block.accepted(lang, words.data, start, end):
        place = automaton.accept[state]
        seen[at[index]] = automaton.offset + place
        n = np.bincount(state, minlength=len(automaton.accept))
        hit = np.flatnonzero(n)
        ordinals = automaton.offset + automaton.accept[hit].astype(np.int64)
        counts.append((ordinals, np.full(len(hit), -1, np.int64), n[hit]))


def _merged(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of (a, b, n) triples by (a, b)."""
    a, b, n = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    return a[first], b[first], np.add.reduceat(n, first) if len(first) else n


def _pass(texts: DataFrame, k: int, block: list[tuple], joined: bool, last: bool) -> DataFrame:
    """One pass of a block of k-word tries.

    ``texts`` has a column ``seen`` (ordinals by word, as bytes) if other blocks came before.  The
    last block's pass gives (a, b, n): candidate a's places with b NULL, and the places of a followed a word
    later by b; ordinals run across the languages.  Another gives the texts with what was seen, and its
    counts as rows without text.
    """
    shared = texts.sparkSession.sparkContext.broadcast(block)
    schema = "a long, b long, n long" if last else "lang string, text binary, seen binary, a long, b long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = _block(shared)
        held: list[tuple] = []
        size = 0

        def flushed():
            if held:
                a, b, n = _merged(held)
                rows = {"lang": pa.nulls(len(a), pa.string()), "text": pa.nulls(len(a), pa.binary()),
                        "seen": pa.nulls(len(a), pa.binary()), "a": pa.array(a), "b": pa.array(b, mask=b < 0), "n": pa.array(n)}
                names = ["a", "b", "n"] if last else list(rows)
                yield pa.RecordBatch.from_arrays([rows[x] for x in names], names)
            held.clear()

        for batch in batches:
            for part, own in _slices(batch):
                langs = part.column("lang").to_pylist()
                before = part.column("seen").to_pylist() if joined else None
                for lang in set(langs):
                    rows = [i for i, x in enumerate(langs) if x == lang]
                    words = Words([own[i] for i in rows])
                    seen = (np.concatenate([np.frombuffer(before[i], np.int64) for i in rows]) if joined
                            else np.full(len(words.end), -1, np.int64)).copy()
                    _look_up(lang, words, k, tries, seen, held)
                    if last:
                        at = np.flatnonzero((seen[:-1] >= 0) & (seen[1:] >= 0) & (words.left[:-1] > 1))
                        held.append(_merged([(seen[at], seen[at + 1], np.ones(len(at), np.int64))]))
                        size += len(held[-1][0])
                    else:
                        docs = np.flatnonzero(np.isin(words.end, np.cumsum([len(own[i]) + 1 for i in rows]) - 1)) + 1
                        kept = [x.tobytes() for x in np.split(seen, docs[:-1])]
                        none = pa.nulls(len(rows), pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(rows), pa.string()), pa.array([own[i] for i in rows], pa.binary()),
                             pa.array(kept, pa.binary()), none, none, none], ["lang", "text", "seen", "a", "b", "n"])
                if size > _FLUSH:
                    yield from flushed()
                    size = 0
        yield from flushed()

    return texts.select("lang", "text", *(["seen"] if joined else [])).mapInArrow(run, schema)


def _summed(found: DataFrame) -> DataFrame:
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _level(texts: DataFrame, candidates: DataFrame, k: int, least: int, shard_bytes: int, block_bytes: int):
    """(lang, phrase, ordinal, n) of the candidates of k words, and (lang, phrase) of those of k + 1."""
    listed = automata.numbered(candidates, "lang", "phrase", shard_bytes, across=True)
    shards = automata.automata(listed, "lang", "phrase", automata.trie)
    rest, counted, before, blocks = texts, [], None, automata.blocks(shards, "lang", block_bytes)
    block = next(blocks, None)
    if block is None:
        return None
    while block is not None:
        following = next(blocks, None)
        found = _pass(rest, k, block, before is not None, following is None)
        if following is not None:
            seen, path = written(found, f"seen-{k}", "zstd")
            if before:
                remove_scratch(before)
            rest, before = seen.where("text IS NOT NULL").select("lang", "text", "seen"), path
            found = stored(_summed(seen.where("text IS NULL")), f"found-{k}")
        counted.append(found.select("a", "b", "n"))
        block = following
    rows = counted[0]
    for more in counted[1:]:
        rows = rows.unionByName(more)
    total = stored(_summed(rows).where(F.col("n") >= least), f"counts-{k}")
    if before:
        remove_scratch(before)
    # Only what is frequent meets the list again, through plain equi-joins.
    name = listed.select("lang", F.col("ordinal").alias("a"), "phrase")
    frequent = total.where("b IS NULL").drop("b").join(name, "a").select("lang", "phrase", F.col("n").alias("f"))
    second = listed.select(F.col("ordinal").alias("b"), F.substring_index("phrase", " ", -1).alias("word"))
    longer = total.where("b IS NOT NULL").join(name, "a").join(second, "b").select(
        "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"))
    return stored(frequent, f"frequent-{k}"), stored(longer, f"candidates-{k + 1}")


def _words(phrase, start, count):
    return F.array_join(F.slice(F.split(phrase, " ", -1), start, count), " ")


def mine(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
         shard_bytes: int = automata.SHARD_BYTES, block_bytes: int = automata.BLOCK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score; see the module."""
    spark = documents.sparkSession
    texts = pieces(documents)
    words = stored(word_counts(texts).where((F.col("n") >= least) | F.col("word").isNull()), "words")
    totals = words.where("word IS NULL").select("lang", "n")
    candidates = words.where("word IS NOT NULL").select("lang", F.col("word").alias("phrase"))
    frequent = spark.createDataFrame([], "lang string, phrase string, f long, k int")
    for k in range(1, longest + 1):
        found = _level(texts, candidates, k, least, shard_bytes, block_bytes)
        if found is None:
            break
        frequent = frequent.unionByName(found[0].withColumn("k", F.lit(k)))
        candidates = found[1]

    phrases = frequent.where("k > 1")
    part = frequent.select("lang", "phrase", "f")
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "cut", _words("phrase", F.lit(1), F.col("cut")).alias("first"),
                       _words("phrase", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(
        part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * F.col("a").cast("decimal(19,0)"),
                            F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)")).cast("long")
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r", "a")).alias("x"))

    # The parts of two or more words of every longer candidate, with its count.
    inner = phrases.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inside = inner.groupBy("lang", _words("phrase", F.col("at"), F.col("size")).alias("phrase")).agg(F.max("f").alias("most"))
    left = lowest.select("lang", "phrase", "x.*").join(inside, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * COVERED))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(F.broadcast(totals), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
