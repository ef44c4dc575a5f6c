"""Automata over sorted strings as double arrays, built in bounded shards and walked by numpy.

A shard holds a run of the sorted strings of one key (a language).  Its automaton is
stored as rows of numbers: ``base`` per state, and per slot the ``owner`` (the state
whose transition lies there) and ``target``.  The transition of a state by a byte lies in
slot ``base[state] + byte``; rows are displaced so that no two share a slot.

- ``transducer``: the minimal acyclic automaton, built from the sorted strings.  ``out``
  per slot holds the number of strings that sort before those through this transition, so
  the sum along a string is its place in the shard's order.
- ``trie``: a state per prefix; ``accept`` holds a string's place in the order at its state.

Shards are numbered along the order, so a string's ordinal is its shard's offset plus
its place.  All strings of a byte array are looked up at once, a byte a step.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARD_BYTES = 1 << 20  # of strings in a shard
BLOCK_BYTES = 64 << 20  # of automata that are broadcast at once
_FIRST = 256  # slots begin here, so no base is negative
_TRIES = 64
ARRAYS = ("base", "owner", "target", "out", "accept")


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 16:  # halve: most neighbours differ early, long ones late
        mid = (low + n) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            n = mid
    while low < n and a[low] == b[low]:
        low += 1
    return low


def _placed(n_states: int, src: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(base per state, slot per transition) of transitions sorted by (src, sym)."""
    first = np.searchsorted(src, np.arange(n_states + 1))
    degree = np.diff(first)
    base = np.full(n_states, _FIRST, np.int64)
    used = bytearray(_FIRST) + bytearray(2 * len(src) + 512)
    used[:_FIRST] = b"\1" * _FIRST
    cursor = _FIRST
    branching = np.flatnonzero(degree > 1)
    symbols = sym.tolist()
    for s in branching[np.argsort(-degree[branching], kind="stable")].tolist():
        row = symbols[first[s]:first[s + 1]]
        lead, tried = row[0], 0
        at = used.find(0, cursor)
        while True:
            b = at - lead
            if b >= 0 and not any(used[b + x] for x in row):
                break
            tried += 1
            at = used.find(0, at + 1)
            if at < 0 or at + 256 >= len(used):
                used += bytearray(len(used))
                at = used.find(0, max(cursor, at))
        base[s] = b
        for x in row:
            used[b + x] = 1
        if tried > _TRIES:
            cursor = at
    single = np.flatnonzero(degree == 1)
    free = np.flatnonzero(np.frombuffer(bytes(used), np.uint8) == 0)
    if len(free) < len(single):
        free = np.concatenate([free, np.arange(len(used), len(used) + len(single))])
    base[single] = free[:len(single)] - sym[first[single]]
    return base, base[src] + sym


def _arrays(n_states: int, src, sym, dst, out, accept) -> dict[str, bytes]:
    src, sym, dst = (np.asarray(x, np.int64) for x in (src, sym, dst))
    base, slot = _placed(n_states, src, sym)
    slots = int(max(slot.max(initial=0), base.max(initial=0))) + 257
    owner, target = np.full(slots, -1, np.int32), np.zeros(slots, np.int32)
    owner[slot], target[slot] = src, dst
    made = {"base": base.astype(np.int32), "owner": owner, "target": target, "accept": np.asarray(accept, np.int32)}
    if out is not None:
        made["out"] = np.zeros(slots, np.int32)
        made["out"][slot] = out
    return {k: made[k].tobytes() if k in made else b"" for k in ARRAYS}


def trie(strings: Iterable[bytes]) -> dict[str, bytes]:
    """Double array of a trie; ``accept`` is the place of the string that ends in a state, or -1.  State 0 is the root."""
    src, sym, accept, path, before = [], [], [-1], [0], b""
    for place, s in enumerate(strings):
        same = _common(before, s)
        del path[same + 1:]
        for byte in s[same:]:
            src.append(path[-1])
            sym.append(byte)
            path.append(len(accept))
            accept.append(-1)
        accept[path[-1]] = place
        before = s
    src, sym = np.array(src, np.int64), np.array(sym, np.int64)
    order = np.lexsort((sym, src))
    return _arrays(len(accept), src[order], sym[order], order + 1, None, accept)


def transducer(strings: Iterable[bytes]) -> dict[str, bytes]:
    """Double array of the minimal acyclic transducer from sorted strings to their places.  State 0 is the root.

    States of the string read last are open.  When the next string leaves them they close, from
    the end: one that has the same finality and transitions as a closed state is that state.
    """
    known: dict[tuple, int] = {}
    rows: list[tuple] = []  # of closed states: (final, ((byte, state), ...))
    below: list[int] = []  # strings from a closed state
    open_: list[list] = [[False, []]]
    before = b""

    def close(state: list) -> int:
        key = (state[0], tuple(state[1]))
        found = known.get(key)
        if found is None:
            found = known[key] = len(rows)
            rows.append(key)
            below.append(state[0] + sum(below[t] for _, t in state[1]))
        return found

    def shut(depth: int) -> None:
        while len(open_) > depth + 1:
            state = close(open_.pop())
            open_[-1][1].append((before[len(open_) - 1], state))

    for s in strings:
        shut(_common(before, s))
        open_.extend([False, []] for _ in range(len(s) + 1 - len(open_)))
        open_[-1][0] = True
        before = s
    shut(0)
    root = close(open_[0])
    n = len(rows)
    src, sym, dst, out = [], [], [], []
    for state in range(n - 1, -1, -1):  # the root was closed last: it becomes state 0
        final, row = rows[state]
        passed = int(final)
        for byte, t in row:
            src.append(root - state)
            sym.append(byte)
            dst.append(root - t)
            out.append(passed)
            passed += below[t]
    accept = [0 if rows[root - s][0] else -1 for s in range(n)]
    return _arrays(n, src, sym, dst, np.array(out, np.int64), accept)


def numbered(strings: DataFrame, key: str, value: str, shard_bytes: int = SHARD_BYTES, across: bool = False) -> DataFrame:
    """(key, value, part, seq, place, ordinal) of distinct (key, value) rows, ordinals from 0 along each key's order.

    ``across`` numbers on from key to key.  The rows are range-sorted; each sorted part is cut into shards
    (part, seq) of one key and a bounded number of bytes.  Only the shards' sizes are summed up.  NULLs don't occur.
    """
    total = strings.agg(F.sum(F.octet_length(value) + 32)).first()[0] or 0
    parts = max(1, -(-total // (4 * shard_bytes)))
    ordered = strings.select(key, value).repartitionByRange(int(parts), key, value).sortWithinPartitions(key, value)
    schema = f"{key} string, {value} string, part int, seq int, place int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, place, size, last = TaskContext.get().partitionId(), -1, 0, 0, None
        for batch in batches:
            keys, values = batch.column(key).to_pylist(), batch.column(value)
            lengths = values.cast(pa.binary()).to_pylist()
            seqs, places = [], []
            for k, v in zip(keys, lengths):
                if k != last or size >= shard_bytes:
                    seq, place, size, last = seq + 1, 0, 0, k
                seqs.append(seq)
                places.append(place)
                place += 1
                size += len(v) + 32
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), values, pa.array([part] * len(seqs), pa.int32()), pa.array(seqs, pa.int32()),
                 pa.array(places, pa.int32())], [key, value, "part", "seq", "place"])

    rows = stored(ordered.mapInArrow(cut, schema), "numbered")
    sizes = rows.groupBy(key, "part", "seq").agg(F.count("*").alias("n"))
    along = (Window.partitionBy() if across else Window.partitionBy(key)).orderBy("part", "seq")  # one row a shard
    offsets = sizes.select("part", "seq", (F.sum("n").over(along) - F.col("n")).alias("offset"))
    return stored(rows.join(offsets, ["part", "seq"]).select(
        key, value, "part", "seq", "place", (F.col("offset") + F.col("place")).alias("ordinal")), "ordinals")


def automata(strings: DataFrame, key: str, value: str, build) -> DataFrame:
    """An automaton a shard of ``numbered`` rows: key, part, seq, offset, low (the first string), the arrays and their bytes."""
    def make(group, table):
        order = np.argsort(table.column("place").to_numpy())
        values = table.column(value).cast(pa.binary()).take(pa.array(order)).to_pylist()
        made = build(values)
        return pa.table({key: [group[0].as_py()], "part": pa.array([group[1].as_py()], pa.int32()),
                         "seq": pa.array([group[2].as_py()], pa.int32()),
                         "offset": pa.array([table.column("ordinal")[int(order[0])].as_py()], pa.int64()),
                         "low": pa.array([values[0][:8]], pa.binary()), **{a: pa.array([made[a]], pa.binary()) for a in ARRAYS},
                         "bytes": pa.array([sum(map(len, made.values()))], pa.int64())})

    fields = ", ".join(f"{a} binary" for a in ARRAYS)
    return stored(strings.groupBy(key, "part", "seq").applyInArrow(
        make, f"{key} string, part int, seq int, offset long, low binary, {fields}, bytes long"), "automata")


def blocks(shards: DataFrame, key: str, limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The shards along the order, in lists of at most ``limit`` bytes (or one shard); only one list is on the driver at a time."""
    sizes = [tuple(r) for r in shards.select("part", "seq", "bytes").orderBy("part", "seq").collect()]
    start = 0
    while start < len(sizes):
        stop, total = start, 0
        while stop < len(sizes) and (stop == start or total + sizes[stop][2] <= limit):
            total += sizes[stop][2]
            stop += 1
        place = F.struct("part", "seq")
        low, high = (F.struct(F.lit(x).alias("part"), F.lit(y).alias("seq")) for x, y, _ in (sizes[start], sizes[stop - 1]))
        rows = shards.where(place.between(low, high)).orderBy("part", "seq").select(key, "offset", "low", *ARRAYS).toArrow()
        yield [(r[key], r["offset"], r["low"], *(r[a] for a in ARRAYS)) for r in rows.to_pylist()]
        start = stop


class Automaton:
    def __init__(self, offset: int, arrays: tuple):
        self.offset = offset
        self.base, self.owner, self.target, self.out, self.accept = (np.frombuffer(a, np.int32) for a in arrays)

    def accepted(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, state, sum of outputs) of the strings ``data[start:end]`` that end in an accepting state.

        All strings advance at once, a byte a step; those off every path leave.
        """
        index = np.arange(len(start))
        at, state, total = start, np.zeros(len(start), np.int32), np.zeros(len(start), np.int64)
        found = [(index[:0], state[:0], total[:0])]
        while len(index):
            slot = self.base[state] + data[at]
            on = np.flatnonzero(self.owner[slot] == state)
            slot, index, at = slot[on], index[on], at[on] + 1
            state = self.target[slot]
            if len(self.out):
                total = total[on] + self.out[slot]
            else:
                total = total[on]
            over = at == end[index]
            if over.any():
                hit = np.flatnonzero(over & (self.accept[state] >= 0))
                found.append((index[hit], state[hit], total[hit]))
                go = np.flatnonzero(~over)
                index, at, state, total = index[go], at[go], state[go], total[go]
        return tuple(np.concatenate(x) for x in zip(*found))


class Block:
    """The automata of one broadcast list, by key."""

    def __init__(self, shards: list[tuple]):
        self.keys: dict[str, tuple[np.ndarray, list[Automaton]]] = {}
        for key in {s[0] for s in shards}:
            own = [s for s in shards if s[0] == key]
            self.keys[key] = (np.array([int.from_bytes(s[2].ljust(8, b"\0"), "big") for s in own], np.uint64),
                              [Automaton(s[1], s[3:]) for s in own])

    def routed(self, key: str, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[Automaton, np.ndarray]]:
        """Each automaton of ``key`` with the indexes of the strings that may lie in it.

        A shard begins at a known string, so a string's first eight bytes choose its shard, or the few
        shards that begin alike.
        """
        lows, own = self.keys.get(key, (None, []))
        if len(own) < 2:
            yield from ((a, np.arange(len(start))) for a in own)
            return
        number, final = np.zeros(len(start), np.uint64), len(data) - 1
        for j in range(8):
            byte = np.where(start + j < end, data[np.minimum(start + j, final)], 0)
            number = (number << np.uint64(8)) | byte.astype(np.uint64)
        first = np.maximum(np.searchsorted(lows, number, "left").astype(np.int64) - 1, 0)
        many = np.maximum(np.searchsorted(lows, number, "right").astype(np.int64) - first, 0)
        which = np.repeat(np.arange(len(start)), many)
        shard = np.repeat(first, many) + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(len(own) + 1))
        for i, automaton in enumerate(own):
            if cuts[i] < cuts[i + 1]:
                yield automaton, which[order[cuts[i]:cuts[i + 1]]]

    def accepted(self, key: str, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(automaton, index, state, sum of outputs) a shard; see ``Automaton.accepted``."""
        for automaton, index in self.routed(key, data, start, end):
            hit, state, total = automaton.accepted(data, start[index], end[index])
            yield automaton, index[hit], state, total
