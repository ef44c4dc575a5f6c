"""Hierarchical best-fit packing of tokenised documents.

Documents are tokenised in Arrow batches and cut only where they are longer than
a sequence.  Pieces are numbered as they are written and dealt by a hash of that number
into groups of a bounded number of pieces, repeated rows as any others; each group
is packed best-fit in order of falling length.  Nearly full bins are emitted.
Underfull bins become items of the next round: groups merge in a tree of
``FAN`` children, and the bins that still may join others are packed best-fit
again until one group is left.  Two bins over half full never fit together and
best-fit leaves at most one bin of a group half full or less, so a group passes
on that bin and the ``RECEIVERS`` emptiest of the others; the rest are emitted as
they are.  The rows of a later round are therefore bounded by the groups of the
round before, not by the input.

A whole sequence of one document is its own bin at once.  Bins are joined by
adding offsets, so only the few merged bins' (bin, sequence, offset) rows meet
the pieces again in a join on the bin.

Defined results: NULL and empty texts are one closing id; repeated rows are packed
as different documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import id_text, rows_of, stored

CAPACITY = 2048
END = 0
GROUP_ITEMS = 1 << 16
NEARLY_FULL = 2040
FAN = 8
RECEIVERS = 256
_CACHE = 1 << 20

# Latin letters that keep their form under NFC and are one pre-token together, then any run of ASCII punctuation
# (without the apostrophe, which may begin a pre-token of its own): the chunks that need no full pre-tokenisation.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer drops white space before it splits, so a text's ids are the
    concatenation of its chunks' ids, and a chunk is encoded once while it is kept.
    ASCII letters are lower-cased beforehand, as the tokenizer does, unless the text may
    hold a special token.  A plain word and its tail of punctuation are two pre-tokens; the
    tokenizer's model encodes them directly, after the tokenizer's byte mapping.  Every
    other chunk goes through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        letters = [chr(c) for c in range(0xC0, 0x100) if _PLAIN.fullmatch(chr(c))]
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.mapped = str.maketrans({c: split(c)[0][0] for c in letters})
        # The shortcuts below hold for vocabularies that fold case, map bytes to one character and drop white space.
        for probe in ("Ab\u00c9c,", "a  b\n\tc", "X.y!?", "stra\u00dfe"):
            whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
            if list(struct.unpack(f"<{len(whole)}I", self.text(probe.encode()))) != whole:
                raise ValueError(f"{path} isn't a vocabulary that this operator's shortcuts fit")

    def _ids(self, chunk: bytes) -> bytes:
        ids = self.known.get(chunk)
        if ids is None:
            if chunk[-1] in b".," and chunk[:-1].isalpha():
                ids = self._ids(chunk[:-1]) + self._ids(chunk[-1:])
            else:
                ids = self._encoded(chunk.decode())
            self.known[chunk] = ids
        return ids

    def _encoded(self, s: str) -> bytes:
        tokenize = self.model.tokenize
        if s.isalpha() and s.isascii():
            found = [t.id for t in tokenize(s.lower())]
        elif plain := _PLAIN.fullmatch(s):
            word, tail = plain.groups()
            found = [t.id for t in tokenize(word.lower().translate(self.mapped))] + ([t.id for t in tokenize(tail)] if tail else [])
        else:
            found = self.tokenizer.encode(s, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def text(self, t: bytes) -> bytes:
        chunks = (t if b"<|" in t else t.lower()).split()
        out = list(map(self.known.get, chunks))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = self._ids(chunks[i])
        return b"".join(out)

    def batch(self, texts: list[bytes | None]) -> list[bytes]:
        if len(self.known) > _CACHE:  # bounded memory; chunks are encoded again when needed
            self.known = {}
        return [self.text(t) if t else b"" for t in texts]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every document row."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for ids, texts in rows_of(batches):
            out = []
            for doc_id, coded in zip(ids, encoder.batch(texts)):
                coded += tail
                for k, at in enumerate(range(0, len(coded), 4 * capacity)):
                    part = coded[at:at + 4 * capacity]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_text(documents).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit in order of falling length: bin and offset of each item, and the fill of each bin.

    Open bins are kept by their room, and a bit set of the rooms in use finds the
    tightest one that holds the item.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fills = 0, []
    order = np.argsort(-lengths, kind="stable").tolist()
    for i, n in zip(order, lengths[order].tolist()):
        fitting = rooms >> n
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + n
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fills), capacity
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if room > n:
            by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, np.array(fills, np.int64)


def _passed_on(fills: np.ndarray, capacity: int, nearly_full: int, receivers: int) -> np.ndarray:
    """Which bins go on to the next round: all half full or less, and the emptiest of the other underfull ones."""
    go = fills * 2 <= capacity
    rest = np.flatnonzero(~go & (fills < nearly_full))
    go[rest[np.argsort(fills[rest], kind="stable")[:receivers]]] = True
    return go


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, nearly_full: int = NEARLY_FULL,
         fan: int = FAN, receivers: int = RECEIVERS) -> DataFrame:
    """``items`` (with a column length of 1 to ``capacity``, and none called sequence_id or offset) with these two added."""
    # An item travels as one struct, so its columns may have any names.  Its number is written with it: a hash of the number
    # deals even equal rows to different groups, and deals them alike when a task is run again.
    items = stored(items.select(F.struct(*[F.col(f"`{c}`") for c in items.columns]).alias("item"), F.col("length").cast("long").alias("length"),
                                F.monotonically_increasing_id().alias("number")), "packing-items")
    whole = items.where(F.col("length") == capacity)
    part = items.where(F.col("length") < capacity)
    n = part.count()
    groups = max(1, -(-n // group_items))

    def local(key, table):
        bins, offsets, fills = best_fit(table.column("length").to_numpy(), capacity)
        go = _passed_on(fills, capacity, nearly_full, receivers)
        out = table.select(["item"])
        for name, values in (("bin", bins + (key[0].as_py() << 32)), ("offset", offsets), ("fill", fills[bins])):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out.append_column("go", pa.array(go[bins]))

    schema = StructType([items.schema["item"], *(StructField(c, LongType()) for c in ("bin", "offset", "fill")), StructField("go", BooleanType())])
    spread = F.pmod(F.xxhash64("number"), F.lit(groups)).alias("group")
    packed = part.select("item", "length", spread).repartition(F.col("group")).groupBy("group").applyInArrow(local, schema)
    packed = stored(packed, "packing-local")

    # Later rounds: bins as items, a bounded number from each group.
    level = packed.where("go").select(F.col("bin").alias("root"), "fill").distinct().withColumn(
        "group", F.shiftright("root", 32))
    moves = None
    while groups > 1:
        groups = -(-groups // fan)

        def merge(key, table):
            bins, offsets, fills = best_fit(table.column("fill").to_numpy(), capacity)
            roots = table.column("root").to_numpy()
            # A merged bin is named after its first item.
            name = np.zeros(len(fills), np.int64)
            name[bins[offsets == 0]] = roots[offsets == 0]
            go = _passed_on(fills, capacity, nearly_full, receivers)
            return pa.table({"bin": roots, "root": name[bins], "shift": offsets, "fill": fills[bins], "go": go[bins],
                             "group": np.full(len(roots), key[0].as_py())})

        merged = level.withColumn("group", F.floor(F.col("group") / fan).cast("long")).groupBy("group").applyInArrow(
            merge, "bin long, root long, shift long, fill long, go boolean, group long")
        merged = stored(merged, "packing-merge")
        step = merged.where("bin != root").select("bin", "root", "shift")
        if moves is None:
            moves = step
        else:  # bins that sit in a bin that has moved now move with it
            then = step.select(F.col("bin").alias("mid"), F.col("root").alias("last"), F.col("shift").alias("more"))
            moves = moves.join(then, F.col("root") == F.col("mid"), "left").select(
                "bin", F.coalesce("last", "root").alias("root"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
            moves = stored(moves.unionByName(step), "packing-moves")
        level = merged.where("go AND bin = root").select("root", "fill", "group")
    if moves is not None:
        moved = moves.select(F.col("bin").alias("_bin"), F.col("root").alias("_root"), F.col("shift").alias("_shift"))
        packed = packed.join(moved, F.col("bin") == F.col("_bin"), "left").select(
            "item", F.coalesce("_root", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("_shift", F.lit(0))).alias("offset"))
    else:
        packed = packed.select("item", F.col("bin").alias("sequence_id"), "offset")
    # Whole sequences take negative numbers.
    alone = whole.select("item", (-F.col("number") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone).select("item.*", "sequence_id", "offset")


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(documents, tokenizer_path, capacity), capacity, **options)
