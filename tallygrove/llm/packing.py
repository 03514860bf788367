"""Operator 2: best-fit packing by linear grouping.

Documents become pieces of at most ``CAPACITY`` tokens: a longer one is cut so that
all its pieces but the first are full. How many pieces of each length there are is
all the planner needs, at most 1024 counts whatever the corpus holds:

1. full pieces are sequences of their own, with negative numbers, and are not moved;
2. large pieces are put, in order of length, into ``GROUPS`` groups of equal number,
   and each is rounded up to the longest of its group;
3. for those few sizes, configurations (which sizes share a sequence) are generated
   by pricing and their numbers optimised as a linear programme, rounded down;
4. actual pieces take the places of the rounded ones, the last place of a sequence
   the longest piece that still fits; what is left over is room for small pieces;
5. pieces that remain, longest first, go where they fit best, else into new
   sequences.

The plan is a list of runs: ranks a..b of length l go to sequences s.. at offset o.
The pieces get ranks within their length by a salted count and look their run up.

Defined cases: a null or empty text is the one token that ends a document; documents
with the same or a null doc_id are packed like others; pieces are whole
always; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrove.llm.common import read, staged

CAPACITY = 1024
END_ID = 2
GROUPS = 64
SMALL = CAPACITY // 8
#: Ranks are counted within this many hash buckets for each length.
SALTS = 256
#: What the vocabulary's own pattern says, without steps back.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
SPECIAL = "<|endoftext|>"

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


_loaded: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a worker process, loaded once, from a file of ranks."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _loaded[path] = tiktoken.Encoding(
            "bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
        )
    return _loaded[path]


def token_ids(text: str | None, path: str) -> bytes:
    """The ids of a whole text as little-endian 32-bit numbers."""
    ids = tokenizer(path).encode_to_numpy(text or "", allowed_special="all")
    return ids.astype("<u4", copy=False).tobytes()


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    end = struct.pack("<I", END_ID)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_ids(text.as_py(), path) + end
                total = len(ids) // 4
                stop = (total - 1) % capacity + 1
                start = piece = 0
                while start < total:
                    out[0].append(doc_id)
                    out[1].append(piece)
                    out[2].append(start)
                    out[3].append(stop - start)
                    out[4].append(zlib.crc32(ids[4 * start : 4 * stop]))
                    start, stop, piece = stop, stop + capacity, piece + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _PIECES)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations over few sizes and how often to use each, by column generation.

    Revised simplex on the covering programme: the price of a size is its dual, the
    best new configuration a knapsack over ``capacity``. Returns (numbers, use).
    """
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(40 * k):
        use = np.linalg.solve(basis, demand)
        price = np.linalg.solve(basis.T, np.ones(k))
        new = _knapsack(sizes, price, capacity)
        if price @ new <= 1 + 1e-7:
            break
        way = np.linalg.solve(basis, new.astype(float))
        ratio = np.where(way > 1e-9, use / np.where(way > 1e-9, way, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = new
    return basis.T.round().astype(int), np.maximum(np.linalg.solve(basis, demand), 0)


def _knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size make the dearest filling of ``capacity``."""
    value = np.zeros(capacity + 1)
    for n, p in zip(sizes.tolist(), price.tolist(), strict=True):
        if p > 1e-12:
            for _ in range(capacity // n):
                np.maximum(value[n:], value[:-n] + p, out=value[n:])
    chosen = np.zeros(len(sizes), int)
    room = capacity
    while value[room] > 1e-12:
        back = room - sizes
        fits = back >= 0
        gap = np.where(fits, value[np.maximum(back, 0)] + price - value[room], -np.inf)
        best = int(np.argmax(gap))
        if gap[best] < -1e-9:
            room -= 1
            continue
        chosen[best] += 1
        room -= int(sizes[best])
    return chosen


class Plan:
    """Runs of places for the pieces of each length."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.sequences = 0
        self.taken: dict[int, int] = {}
        self.runs: list[tuple[int, int, int, int]] = []  # length, first rank, sequence, offset
        self.room: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, number)

    def place(self, length: int, sequence: int, number: int, offset: int) -> None:
        rank = self.taken.get(length, 0)
        self.runs.append((length, rank, sequence, offset))
        self.taken[length] = rank + number

    def leave(self, sequence: int, number: int, filled: int) -> None:
        if number and filled < self.capacity:
            self.room.setdefault(self.capacity - filled, []).append((sequence, number))

    def best_fit(self, length: int, number: int) -> None:
        """``number`` pieces into the fullest sequences that hold them, else new ones."""
        while number:
            fitting = [r for r, runs in self.room.items() if r >= length and runs]
            if not fitting:
                each = self.capacity // length
                full, more = divmod(number, each)
                for count, copies in ((each, full), (more, 1 if more else 0)):
                    if copies:
                        for j in range(count):
                            self.place(length, self.sequences, copies, j * length)
                        self.leave(self.sequences, copies, count * length)
                        self.sequences += copies
                return
            room = min(fitting)
            sequence, there = self.room[room].pop()
            used = min(there, number)
            self.place(length, sequence, used, self.capacity - room)
            self.leave(sequence, used, self.capacity - room + length)
            if there > used:
                self.room[room].append((sequence + used, there - used))
            number -= used


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> Plan:
    """Places for ``counts[length]`` pieces of each length."""
    out = Plan(capacity)
    left = {n: c for n, c in counts.items() if c}
    if full := left.pop(capacity, 0):
        out.place(capacity, 0, full, 0)
        out.sequences = full
    sizes, demand, lowest = _rounded({n: c for n, c in left.items() if n > small}, groups)
    if len(sizes):
        there = np.zeros(capacity + 1, np.int64)
        there[list(left)] = list(left.values())
        numbers, use = configurations(sizes, demand, capacity)
        longest = [int(sizes[np.flatnonzero(c)].max()) for c in numbers]
        for at in sorted(range(len(numbers)), key=lambda j: -longest[j]):
            slots = [(int(sizes[g]), int(lowest[g])) for g in np.flatnonzero(numbers[at]) for _ in range(numbers[at][g])]
            _substitute(out, slots, int(use[at] + 1e-9), there)
        left = {int(n): int(there[n]) for n in np.flatnonzero(there)}
    for n in sorted(left, reverse=True):
        out.best_fit(n, left[n])
    return out


def _rounded(large: dict[int, int], groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of about equal number: their longest length, number, shortest length.

    A length is never divided, so a frequent one is a group that rounds nothing.
    """
    share = sum(large.values()) / max(groups, 1)
    found: list[list[int]] = []
    for n in sorted(large, reverse=True):
        if not found or found[-1][1] + large[n] > share:
            found.append([n, 0, n])
        found[-1][1] += large[n]
        found[-1][2] = n
    top, number, low = np.array(found, np.int64).reshape(-1, 3).T
    return top, number.astype(float), low


def _longest(there: np.ndarray, most: int, least: int, drawn: list[int]) -> int:
    """The longest length in ``least``..``most`` of which a piece is left, or 0."""
    for n in range(most, least - 1, -1):
        if there[n] > drawn.count(n):
            return n
    return 0


def _substitute(out: Plan, slots: list[tuple[int, int]], times: int, there: np.ndarray) -> None:
    """``times`` copies of a configuration with actual pieces in its places.

    A place takes the longest piece left of its group. The last takes the longest
    that fits, so that what the others are shorter than rounded is not lost.
    """
    slots = sorted(slots, reverse=True)
    while times:
        room, drawn = out.capacity, []
        for top, low in slots[:-1]:
            if n := _longest(there, min(top, room), low, drawn):
                drawn.append(n)
                room -= n
        if n := _longest(there, room, 1, drawn):
            drawn.append(n)
            room -= n
        if len(drawn) < len(slots):
            return  # too few are left; best fit has them
        copies = min(times, *(int(there[n]) // drawn.count(n) for n in drawn))
        offset = 0
        for n in drawn:
            out.place(n, out.sequences, copies, offset)
            there[n] -= copies
            offset += n
        out.leave(out.sequences, copies, offset)
        out.sequences += copies
        times -= copies


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (doc_id, piece, length and more) with sequence_id and offset.

    ``items`` is read twice: stage it first. Ranks are unique whatever repeats.
    """
    alone = items.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    salted = items.where(F.col("length") < capacity).withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS))
    )
    by_salt = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    # At most SALTS rows for each length.
    before = by_salt.select(
        "length",
        "_salt",
        "n",
        F.sum("n").over(Window.partitionBy("length").orderBy("_salt")).alias("upto"),
    ).toPandas()
    counts = before.groupby("length")["n"].sum()
    made = plan({int(k): int(v) for k, v in counts.items()}, capacity)
    runs = np.array(made.runs, np.int64).reshape(-1, 4)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    spark = items.sparkSession
    shared = spark.sparkContext.broadcast(runs)
    first = np.zeros((capacity + 1, SALTS), np.int64)
    first[before["length"], before["_salt"]] = before["upto"] - before["n"]
    offsets = spark.sparkContext.broadcast(first)
    ranked = salted.withColumn(
        "_rank",
        F.row_number().over(
            Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", F.monotonically_increasing_id())
        ),
    )
    schema = ranked.select(*items.columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    names = items.columns

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, start = shared.value, offsets.value
        keys = table[:, 0] << 40 | table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            salt = batch.column("_salt").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False) - 1 + start[length, salt]
            at = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            run = table[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(run[:, 2] + rank - run[:, 1]), pa.array(run[:, 3])],
                [*names, "sequence_id", "offset"],
            )

    return alone.union(ranked.mapInArrow(look_up, schema))


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """All documents cut and packed; see the module's text for the columns."""
    return pack(staged(pieces(docs, vocabulary, capacity), "pieces"), capacity)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of all pieces."""
    return pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
