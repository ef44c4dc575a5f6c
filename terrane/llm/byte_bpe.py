"""Byte-level BPE encoding and decoding in time linear in the text.

A text is cut by the tokenizer's pattern; every match is encoded on its own.  A match
that is a token is that token.  Any other match is encoded without replaying merges:

- its bytes, read as Latin-1, are looked up in one pyahocorasick trie of all tokens, which
  gives the longest token that begins at a byte; it is asked only where a token may begin;
- from the left the longest token is taken that is *compatible* with the token before
  it; where none is, a shorter one is tried, and then the token before it is given up.
  A place given up once is never entered again, so the work is linear;
- two adjacent tokens are compatible if the merges turn their joined bytes into just
  these two.  That is decided once a pair, by the merges themselves, and remembered.

If no merge crosses any border between neighbours, none crosses one in the whole
match, and every token forms within its own bytes.  So the sequence found is the one
that the merges give, whatever the vocabulary's order.

Ids are stored as little-endian unsigned 32-bit integers.  Nothing is shuffled; the
vocabulary (its size is checked) is broadcast; memos are bounded.

Defined results: NULL and empty texts give no ids, and NULL or empty ids decode to
nothing; bytes of a text that are no UTF-8 count as U+FFFD; texts of any length are
encoded whole; repeated rows get equal results; an empty table gives no rows; other
columns are ignored.  Ids outside the vocabulary make decoding fail.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from .common import id_text, rows_of

MAX_VOCABULARY = 64 << 20  # bytes of a vocabulary file that may be broadcast
_WORDS = 1 << 18  # matches whose ids are remembered
_PAIRS = 1 << 19
_WORD_CHARS = 64
_LONG = 1 << 20


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The vocabulary file (a base64 token and its rank a line), read once on the driver; its size is checked."""
    with open(path, "rb") as f:
        content = f.read(MAX_VOCABULARY + 1)
    if len(content) > MAX_VOCABULARY:
        raise ValueError(f"vocabulary {path} has more than {MAX_VOCABULARY} bytes")
    return content


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line.strip())}


def newer_characters() -> str:
    """As a regex set, the characters that ``regex`` takes for letters or numbers and the tokenizer library does not know yet."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    one_byte = {bytes([b]): b for b in range(256)}
    known = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=one_byte, special_tokens={})
    mine = np.array([ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every)])
    theirs = np.array([ord(c) for c in bytes(known.encode_ordinary(every)).decode("utf-8")])
    rest = np.setdiff1d(mine, theirs)
    cuts = np.flatnonzero(np.diff(rest) > 1) + 1
    return "".join(f"\\U{part[0]:08X}-\\U{part[-1]:08X}" for part in np.split(rest, cuts) if len(part))


class Splitter:
    """The matches of the tokenizer's pattern, with letters and numbers as the tokenizer library knows them."""

    def __init__(self, pattern: str, newer: str):
        self.plain = regex.compile(pattern)
        self.newer = regex.compile(f"[{newer}]") if newer else None
        # A newer character is neither letter nor number: outside these classes, inside their negation.
        careful = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\s\p{L}\p{N}||NEWER]").replace(r"\p{L}+", r"[\p{L}--[NEWER]]+").replace(
            r"\p{N}+", r"[\p{N}--[NEWER]]+").replace(r"[^\s\p{L}\p{N}||NEWER]", r"(?:[^\s\p{L}\p{N}]|[NEWER])")
        self.careful = regex.compile(careful.replace("NEWER", newer), regex.V1) if newer else self.plain

    def _may_hold_newer(self, text: str) -> bool:
        if self.newer is None or text.isascii():
            return False
        try:
            text.encode("latin-1")  # no character of Latin-1 is newer
            return False
        except UnicodeEncodeError:
            return self.newer.search(text) is not None

    def __call__(self, text: str) -> Iterator[str]:
        pattern = self.careful if self._may_hold_newer(text) else self.plain
        if len(text) <= _LONG:
            return pattern.findall(text)
        return (m.group() for m in pattern.finditer(text))  # never all matches of a long text at once


class Codec:
    """Encoder and decoder of one vocabulary; see the module."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, newer: str | None = None):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.sizes = {i: len(t) for t, i in ranks.items()}
        self.most = max(map(len, ranks))
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary must hold every byte")
        self.split = Splitter(pattern, newer_characters() if newer is None else newer)
        self.shorter: dict[int, int] = {}
        self.fits: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}

    @cached_property
    def trie(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for t in self.ranks:
            found.add_word(t.decode("latin-1"))
        return found

    def merged(self, data: bytes) -> list[int]:
        """Ids by the merges: the adjacent pair of the least rank first, the leftmost of equals."""
        ranks, none = self.ranks, 1 << 62
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [ranks.get(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        return [ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens as they are side by side (``left`` -1: the token alone)."""
        pair = (left << 32) + right
        known = self.fits.get(pair)
        if known is None:
            if len(self.fits) >= _PAIRS:
                self.fits.clear()
            first = self.token[left] if left >= 0 else b""
            known = self.merged(first + self.token[right]) == ([left, right] if left >= 0 else [right])
            self.fits[pair] = known
        return known

    def next_shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        found = self.shorter.get(token)
        if found is None:
            t = self.token[token]
            found = next((self.ranks[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ranks), -1)
            self.shorter[token] = found
        return found

    def longest(self, text: str, data: bytes, at: int) -> int:
        """The longest token that begins at a byte."""
        size, ranks = self.trie.longest_prefix(text[at:at + self.most]), self.ranks
        while (token := ranks.get(data[at:at + size])) is None:  # the trie also holds the tokens' prefixes
            size -= 1
        return token

    def encode_match(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        text, n, sizes, fits = data.decode("latin-1"), len(data), self.sizes, self.fits
        out, given_up = [], bytearray(n + 1)
        at, last, token = 0, -1, self.longest(text, data, 0)
        while True:
            while token >= 0:
                end = at + sizes[token]
                if not given_up[end]:
                    ok = fits.get((last << 32) + token)
                    if self.compatible(last, token) if ok is None else ok:
                        break
                token = self.next_shorter(token)
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, last = end, token
                token = self.longest(text, data, at)
            else:
                given_up[at] = 1
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1
                token = self.next_shorter(token)

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        out, words = bytearray(), self.words
        for match in self.split(text):
            ids = words.get(match)
            if ids is None:
                found = self.encode_match(match.encode("utf-8"))
                ids = struct.pack(f"<{len(found)}I", *found)
                if len(match) <= _WORD_CHARS:
                    if len(words) >= _WORDS:
                        words.clear()
                    words[match] = ids
            out += ids
        return bytes(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(content: bytes, pattern: str, newer: str) -> Codec:
    """One codec a Python worker."""
    return Codec(parse_ranks(content), pattern, newer)


def _shared(spark: SparkSession, path: str, pattern: str):
    return spark.sparkContext.broadcast((read_ranks(spark, path), pattern, newer_characters()))


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every document row."""
    shared = _shared(documents.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value)
        for doc_ids, texts in rows_of(batches):
            ids = [codec.encode(t.decode("utf-8", "replace")) if t else b"" for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])

    return id_text(documents).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` (doc_id, n_tokens, ids) with the decoded bytes added."""
    shared = _shared(tokens.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                decoded = [codec.decode(x) if x else b"" for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], [*part.schema.names, "decoded"])

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")
