"""Operator 11: the prefix trie of conversations, from double-array tries of shards.

A conversation is the sequence of its turns; turns of the same role and text are one
symbol. ``rebuilt`` conversations begin like another one. Each distinct prefix is a
node, the empty one the root.

* A prefix has a key of two 61-bit sums, over its turns, of hashes of a turn's digest
  and place. Sums need no walk along a conversation, so places and keys are counted in
  parts and put together, however long a conversation is.
* Conversations are cut into segments of ``SEGMENT`` turns. Equal segments behind equal
  prefixes are one row with a count and the smallest member.
* Shards are ranges of segments in the order of their prefix and turns, so that a hot
  prefix fills several. In a shard, turns get dense ids, and the segments are packed
  into BASE and CHECK arrays (child of state s by turn t: BASE[s] + t, if CHECK there is
  s); a node with one child takes any free place. A traversal then adds up members, the
  smallest one and the last turn's length at every node. Nodes that shards share are
  merged by their key.
* Each node belongs to its smallest member; so a conversation owns the end of its path,
  from where it leaves all smaller ones. Sums over subtrees are running sums along these
  ends, plus the whole of every end that hangs below: these go to all nodes above it, in
  one aggregation, without a round per level.
* Ids of conversations that end at a node are joined in sorted chunks by range, then
  hashed as a stream of chunks.

Defined cases: rows with a null conv_id are left out; null role or text is empty; turns
of one number are ordered by their digest (MD5 of the role's length, a colon, role and
text), null turns first; repeated rows are turns each; a conversation without turns after
rebuilding ends at the root; an empty table has no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrove.llm.common import mix, read, staged
from tallygrove.llm.embedding_dedup import dense_number

SEGMENT = 64
#: Segments whose sums are run through one window.
SPAN = 1024
#: Turns packed into one pair of arrays.
PACKED = 200_000
#: Ids joined into one chunk before they are hashed.
CHUNK = 1024
#: A conversation begins like the one whose id has its last digits cut, for so many turns.
GROUP, SHARED = 100, 6

MASK = np.uint64((1 << 61) - 1)
MODULUS = "2305843009213693952"  # 2 to the 61


def turns(conversations: DataFrame) -> DataFrame:
    """conv, turn, digest, length (code points of the text) of every row with an id."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("long").alias("length"),
    )


def _dealt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in order, with part and at; (conv, part, first, n, before).

    A row's place in its conversation is ``at - first + before``. The order is cut into
    ranges wherever it may be, so a long conversation is numbered by many tasks.
    """
    order = ("conv", "turn", "digest")
    ordered = rows.repartitionByRange(dense_number(rows), *order).sortWithinPartitions(*order)
    ordered = staged(
        ordered.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "ordered"
    )
    parts = ordered.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ordered, parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def shared_turns(conv: str = "conv") -> Column:
    """How many turns a conversation begins with that are its group's first ones."""
    return F.crc32(F.col(conv).cast("string").cast("binary")) % SHARED


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, place, digest, length), and every conv, of the rebuilt conversations.

    The first ``shared_turns`` of conversation conv - conv % GROUP come first, then the
    own turns without as many.
    """
    ordered, parts = _dealt(rows)
    parts = staged(parts, "parts")
    sizes = parts.groupBy("conv").agg(F.sum("n").alias("n"))
    base = (F.col("conv") - F.col("conv") % GROUP).alias("base")
    convs = sizes.select("conv", base, shared_turns().alias("skipped"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("there")), "base", "left")
    convs = staged(
        convs.select("conv", "base", "skipped", F.least("skipped", F.coalesce("there", F.lit(0))).alias("taken")), "convs"
    )
    placed = ordered.join(parts.join(convs, "conv"), ["conv", "part"]).select(
        "conv", "digest", "length", "skipped", "taken", (F.col("at") - F.col("first") + F.col("before")).alias("place")
    )
    own = placed.where("place >= skipped").select(
        "conv", (F.col("place") - F.col("skipped") + F.col("taken")).alias("place"), "digest", "length"
    )
    heads = placed.where((F.col("conv") % GROUP == 0) & (F.col("place") < SHARED)).select(
        F.col("conv").alias("base"), "place", "digest", "length"
    )
    # A base has the conversations of its group only: less than 2 * GROUP.
    begun = convs.join(heads, "base").where("place < taken").select("conv", "place", "digest", "length")
    return own.union(begun), convs.select("conv")


def terms(digests: np.ndarray, places: np.ndarray) -> np.ndarray:
    """What each turn adds to its prefix's two sums; ``digests``: n x 2 of 64 bits."""
    at = places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one = mix(digests[:, 0] ^ mix(digests[:, 1] + at))
    two = mix(digests[:, 1] ^ mix(digests[:, 0] + at + np.uint64(0xD1B54A32D192ED03)))
    return np.column_stack([one, two]) & MASK


def _digests(values: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), np.uint64).reshape(-1, 2)


def segments(rows: DataFrame, size: int = SEGMENT, span: int = SPAN) -> DataFrame:
    """conv, first, begin1, begin2, end1, end2, digests, lengths of every segment.

    ``first`` is the place of its first turn; ``digests`` is one binary of 16 bytes a turn; begin and end are the keys of the
    prefixes before and with the segment.
    """
    cut = (
        rows.groupBy("conv", (F.floor(F.col("place") / size) * size).alias("first"))
        # As many as a segment has turns.
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "length"))).alias("turns"))
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column(2).value_lengths().to_numpy()
            flat = batch.column(2).flatten()
            digests = _digests(flat.field("digest"))
            added = terms(digests, flat.field("place").to_numpy())
            start = np.append(0, np.cumsum(sizes))
            sums = np.add.reduceat(added, start[:-1], axis=0) & MASK
            raw, lengths = digests.tobytes(), flat.field("length").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sums[:, 0].astype(np.int64)),
                    pa.array(sums[:, 1].astype(np.int64)),
                    pa.array([raw[16 * a : 16 * b] for a, b in zip(start[:-1], start[1:], strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(lengths)),
                ],
                ["conv", "first", "s1", "s2", "digests", "lengths"],
            )

    found = staged(
        cut.mapInArrow(fold, "conv long, first long, s1 long, s2 long, digests binary, lengths array<long>"), "segments"
    )
    # Sums before a segment: within its span, and of the spans before.
    number = F.floor(F.col("first") / (size * span))
    sums = found.select("conv", "first", number.alias("span"), "s1", "s2")
    near = Window.partitionBy("conv", "span").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(F.col(name).cast("decimal(38,0)")).over(window), F.lit(0).cast("decimal(38,0)"))

    spans = sums.groupBy("conv", "span").agg(*(F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in ("s1", "s2")))
    spans = spans.select("conv", "span", before("s1", far).alias("f1"), before("s2", far).alias("f2"))
    within = sums.select("conv", "first", "span", before("s1", near).alias("n1"), before("s2", near).alias("n2"))

    def key(*parts: str) -> Column:
        return F.expr(f"cast(pmod({' + '.join(parts)}, cast({MODULUS} as decimal(38,0))) as bigint)")

    begins = within.join(spans, ["conv", "span"]).select(
        "conv", "first", key("n1", "f1").alias("begin1"), key("n2", "f2").alias("begin2")
    )
    return staged(
        found.join(begins, ["conv", "first"]).select(
            "conv", "first", "begin1", "begin2",
            F.expr(f"pmod(begin1 + s1, {MODULUS})").alias("end1"), F.expr(f"pmod(begin2 + s2, {MODULUS})").alias("end2"),
            "digests", "lengths",
        ),
        "segments",
    )


class DoubleArray:
    """BASE and CHECK of a trie over sequences of dense symbols.

    ``symbols`` holds all sequences one behind the other, ``sizes`` their lengths. State
    0 is the root. The child of state s by symbol t is BASE[s] + t if CHECK there is s.
    """

    WINDOW = 4096

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray):
        self.start = np.append(0, np.cumsum(sizes))[:-1]
        self.symbols, self.sizes = symbols, sizes
        self.span = int(symbols.max(initial=0)) + 1
        room = len(symbols) + self.span + self.WINDOW
        self.base, self.check = np.zeros(room, np.int64), np.full(room, -1, np.int64)
        self.check[0] = 0
        self.low, self.end = 1, 1  # no place below low is free, none from end on is taken
        state = np.zeros(len(sizes), np.int64)
        for level in range(int(sizes.max(initial=0))):
            alive = np.flatnonzero(sizes > level)
            symbol = symbols[self.start[alive] + level]
            pairs = np.unique(np.column_stack([state[alive], symbol]), axis=0)
            self._place(pairs)
            state[alive] = self.step(state[alive], symbol)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The children of states by symbols that they have."""
        child = self.base[state] + symbol
        assert (self.check[child] == state).all()
        return child

    def _place(self, pairs: np.ndarray) -> None:
        """Put the children (parent, symbol), in order, in free places."""
        first = np.flatnonzero(np.append(True, pairs[1:, 0] != pairs[:-1, 0]))
        count = np.diff(np.append(first, len(pairs)))
        for f, n in zip(first[count > 1], count[count > 1], strict=True):
            codes = pairs[f : f + n, 1]
            at = self._fit(codes - codes[0]) - codes[0]
            self.base[pairs[f, 0]] = at
            self.check[at + codes] = pairs[f, 0]
            self.end = max(self.end, int(at + codes[-1]) + 1)
        single = first[count == 1]
        if len(single):  # any place does, as BASE may be negative
            self._room(self.end + len(single))
            free = self.low + np.flatnonzero(self.check[self.low :] < 0)[: len(single)]
            parent, code = pairs[single, 0], pairs[single, 1]
            self.base[parent] = free - code
            self.check[free] = parent
            self.end = max(self.end, int(free[-1]) + 1)
        full = np.flatnonzero(self.check[self.low :] < 0)
        self.low += int(full[0]) if len(full) else 0

    def _fit(self, offsets: np.ndarray) -> int:
        """The first place from which all places at the ``offsets`` are free."""
        at = self.low
        while True:
            self._room(at + self.WINDOW)
            place = at + np.flatnonzero(self.check[at : at + self.WINDOW] < 0)
            for offset in offsets[1:]:
                if not len(place):
                    break
                place = place[self.check[place + offset] < 0]
            if len(place):
                return int(place[0])
            at += self.WINDOW

    def _room(self, upto: int) -> None:
        """Room for places below ``upto`` and a whole row of symbols behind them."""
        more = upto + self.span + 1 - len(self.check)
        if more > 0:
            more = max(more, len(self.check) // 4)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))


def _packed(rows: pa.Table) -> pa.RecordBatch:
    """The nodes of one shard's segments: key, parent's key, depth, n, conv, length."""
    sizes = rows.column("lengths").combine_chunks().value_lengths().to_numpy().astype(np.int64)
    lengths = rows.column("lengths").combine_chunks().flatten().to_numpy()
    digests = _digests(rows.column("digests"))
    begin = np.column_stack([rows.column(c).to_numpy() for c in ("first", "begin1", "begin2")])
    n, conv = rows.column("n").to_numpy(), rows.column("conv").to_numpy()
    # Dense ids: turns first, then the prefixes that segments begin behind.
    known, turn = np.unique(digests, axis=0, return_inverse=True)
    prefixes, prefix = np.unique(begin, axis=0, return_inverse=True)
    start = np.append(0, np.cumsum(sizes))[:-1]
    symbols = np.insert(turn.ravel(), start, len(known) + prefix.ravel())
    trie = DoubleArray(symbols, sizes + 1)

    place = np.arange(len(digests)) - np.repeat(start, sizes) + np.repeat(begin[:, 0], sizes)
    key = terms(digests, place)
    before = begin[:, 1:].astype(np.uint64)
    found: dict[str, list[np.ndarray]] = {c: [] for c in ("state", "k1", "k2", "p1", "p2", "depth", "length", "n", "conv")}
    state = trie.step(np.zeros(len(sizes), np.int64), symbols[trie.start])
    for level in range(int(sizes.max(initial=0))):
        alive = np.flatnonzero(sizes > level)
        at = start[alive] + level
        state[alive] = trie.step(state[alive], symbols[trie.start[alive] + level + 1])
        here = (before[alive] + key[at]) & MASK
        node, first, index = np.unique(state[alive], return_index=True, return_inverse=True)
        members, least = np.zeros(len(node), np.int64), np.full(len(node), np.iinfo(np.int64).max)
        np.add.at(members, index, n[alive])
        np.minimum.at(least, index, conv[alive])
        for name, value in (
            ("state", node), ("k1", here[first, 0]), ("k2", here[first, 1]),
            ("p1", before[alive][first, 0]), ("p2", before[alive][first, 1]),
            ("depth", place[at][first] + 1), ("length", lengths[at][first]), ("n", members), ("conv", least),
        ):
            found[name].append(value.astype(np.int64))
        before[alive] = here
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(found[c])) for c in NODE], list(NODE)
    )


NODE = ("k1", "k2", "p1", "p2", "depth", "length", "n", "conv")


def shard_nodes(cut: DataFrame, packed: int = PACKED) -> DataFrame:
    """``NODE`` of each shard's nodes, from ``segments`` of every conversation."""
    same = cut.groupBy("first", "end1", "end2").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"))
    distinct = cut.join(same.select("first", "conv", "n"), ["first", "conv"]).select(
        "first", "begin1", "begin2", "digests", "lengths", "n", "conv"
    )
    order = ("first", "begin1", "begin2", "digests")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lengths = batch.column(4).value_lengths().to_numpy().cumsum()
            at = 0
            while at < batch.num_rows:  # as many rows as fill one pair of arrays
                done = lengths[at - 1] if at else 0
                stop = max(int(np.searchsorted(lengths, done + packed - size, "right")), at + 1)
                held.append(batch.slice(at, stop - at))
                size += int(lengths[min(stop, batch.num_rows) - 1] - done)
                at = stop
                if size >= packed or at < batch.num_rows:
                    yield _packed(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield _packed(pa.Table.from_batches(held))

    return (
        distinct.repartitionByRange(dense_number(cut), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(pack, ", ".join(f"{c} long" for c in NODE))
    )


def _nodes(cut: DataFrame, convs: DataFrame, packed: int) -> DataFrame:
    """``NODE`` and children of every node, the root with key (0, 0) among them."""
    same = [F.min(c).alias(c) for c in ("p1", "p2", "depth", "length")]
    nodes = shard_nodes(cut, packed).groupBy("k1", "k2").agg(*same, F.sum("n").alias("n"), F.min("conv").alias("conv"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).where("n > 0")
    root = root.select(
        zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), zero.alias("depth"), zero.alias("length"), "n", "conv"
    )
    nodes = staged(nodes.select(*NODE).union(root.select(*NODE)), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("children")
    )
    return staged(
        nodes.join(children, ["k1", "k2"], "left").withColumn("children", F.coalesce("children", F.lit(0))), "nodes"
    )


def _below(nodes: DataFrame, cut: DataFrame, size: int) -> DataFrame:
    """k1, k2, leaves, saved: the sums over every node's subtree."""
    worth = nodes.select(
        "k1", "k2", "conv", "depth", F.floor(F.col("depth") / size).alias("segment"),
        (F.col("children") == 0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("length")).alias("saved"),
    )
    # Along a conversation's own nodes: from a node to its segment's end, and what follows.
    part = worth.groupBy("conv", "segment").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"), F.min("depth").alias("top"))
    after = Window.partitionBy("conv").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("conv", "segment").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    later = part.select(
        "conv", "segment", F.coalesce(F.sum("l").over(after), zero).alias("l"), F.coalesce(F.sum("s").over(after), zero).alias("s")
    )
    own = worth.select(
        "k1", "k2", "conv", "segment", F.sum("leaves").over(here).alias("leaves"), F.sum("saved").over(here).alias("saved")
    ).join(later, ["conv", "segment"])
    own = own.select("k1", "k2", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"))
    # All of a conversation's own nodes lie below every node of its path above them.
    ends = part.groupBy("conv").agg(F.sum("l").alias("leaves"), F.sum("s").alias("saved"), F.min("top").alias("top"))
    hung = cut.join(ends.where("top > 0"), "conv").where("first < top").select(
        "first", "begin1", "begin2", "digests", "top", "leaves", "saved"
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places, top = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            digests = _digests(batch.column(3))
            sizes = np.array([len(x.as_py()) // 16 for x in batch.column(3)])
            start = np.append(0, np.cumsum(sizes))[:-1]
            place = np.arange(len(digests)) - np.repeat(start, sizes) + np.repeat(places, sizes)
            sums = np.cumsum(terms(digests, place), axis=0)
            sums -= np.repeat(np.vstack([np.zeros((1, 2), np.uint64), sums])[start], sizes, axis=0)
            begin = np.column_stack([batch.column(i).to_numpy() for i in (1, 2)]).astype(np.uint64)
            key = (sums + np.repeat(begin, sizes, axis=0)) & MASK
            row = np.repeat(np.arange(len(sizes)), sizes)
            above = place + 1 < top[row]
            first = np.flatnonzero(places == 0)  # they hang below the root as well
            key = np.vstack([key[above], np.zeros((len(first), 2), np.uint64)])
            row = np.append(row[above], first)
            node, index = np.unique(key, axis=0, return_inverse=True)
            sums_of = np.zeros((2, len(node)), np.int64)
            for i in (0, 1):
                np.add.at(sums_of[i], index.ravel(), batch.column(5 + i).to_numpy()[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in (node[:, 0], node[:, 1], *sums_of)], ["k1", "k2", "leaves", "saved"]
            )

    above = hung.mapInArrow(spread, "k1 long, k2 long, leaves long, saved long")
    return own.union(above).groupBy("k1", "k2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _end_hashes(cut: DataFrame, convs: DataFrame, size: int) -> DataFrame:
    """k1, k2, ends: the hash of the sorted ids of the conversations that end there."""
    last = cut.groupBy("conv").agg(F.max(F.struct("first", "end1", "end2")).alias("e"))
    zero = F.lit(0).cast("long")
    ends = convs.join(last, "conv", "left").select(
        F.coalesce("e.end1", zero).alias("k1"), F.coalesce("e.end2", zero).alias("k2"), "conv"
    )

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, tuple[int, int]]]:
        k = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for p, q in zip(cuts[:-1], cuts[1:], strict=True):
            if p < q:
                yield p, q, (int(k[0, p]), int(k[1, p]))

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            ids = batch.column(2).to_numpy()
            for p, q, key in runs(batch):
                for lo in range(p, q, size):
                    for column, value in zip(out, (*key, int(ids[lo]), ",".join(map(str, ids[lo : min(lo + size, q)]))), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["k1", "k2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            for p, q, key in runs(batch):
                if key != at:
                    if at:
                        for column, value in zip(out, (*at, sha.hexdigest()), strict=True):
                            column.append(value)
                    at, sha = key, hashlib.sha256()
                    start = p
                else:
                    start = -1
                for i in range(p, q):
                    sha.update(("" if i == start else ",").encode() + batch.column(3)[i].as_py().encode())
            yield _ends(out)
        if at:
            yield _ends(([at[0]], [at[1]], [sha.hexdigest()]))

    n, order = dense_number(cut), ("k1", "k2", "conv")
    chunks = ends.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        chunk, "k1 long, k2 long, first long, ids string"
    )
    return chunks.repartition(n, "k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(
        digest, "k1 long, k2 long, ends string"
    )


def _ends(out: tuple[list, ...]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["k1", "k2", "ends"])


def trie(
    conversations: DataFrame, *, segment: int = SEGMENT, span: int = SPAN, packed: int = PACKED, chunk: int = CHUNK
) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations."""
    rows, convs = rebuilt(turns(conversations))
    cut = segments(rows, segment, span)
    nodes = _nodes(cut, convs, packed)
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    nothing = F.lit(hashlib.sha256().hexdigest())
    return (
        nodes.join(_below(nodes, cut, segment), ["k1", "k2"])
        .join(_end_hashes(cut, convs, chunk), ["k1", "k2"], "left")
        .join(parents, ["p1", "p2"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", nothing).alias("ends_sha256"),
        )
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of ``conversations``."""
    return trie(read(spark, sf_dir, "conversations"))


OP11_SQL = """
WITH RECURSIVE shifts AS (
  SELECT i, i AS v, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM shifts WHERE k < 8),
crc AS (
  SELECT conv_id, conv_id::VARCHAR AS name, 1 AS pos, 4294967295::BIGINT AS v
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT c.conv_id, c.name, c.pos + 1, xor(c.v >> 8, s.v)
  FROM crc c JOIN shifts s ON s.k = 8 AND s.i = xor(c.v & 255, ascii(substr(c.name, c.pos, 1))::BIGINT)
  WHERE c.pos <= length(c.name)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(v, 4294967295) % 6 AS h FROM crc WHERE pos = length(name) + 1),
bare AS (
  SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
         length(coalesce(text, '')) AS len
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS pos FROM bare),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, t.pos, t.d, t.len FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.d, t.len
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h LEFT JOIN sizes b ON b.conv_id = c.base),
path AS (
  SELECT conv_id, pos + 1 AS depth, len, string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY pos) AS key FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
  SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n, any_value(len) AS len,
         CASE WHEN key <> '' THEN left(key, length(key) - 32) END AS parent
  FROM path GROUP BY key),
children AS (SELECT parent AS key, count(*) AS c FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
worth AS (
  SELECT n.*, coalesce(c.c, 0) AS c, (c.c IS NULL)::INT AS leaf, (n.n - 1) * n.len AS saved
  FROM nodes n LEFT JOIN children c USING (key)),
below AS (
  SELECT p.key, sum(w.leaf)::BIGINT AS leaves, sum(w.saved)::BIGINT AS saved
  FROM worth w JOIN path p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY p.key),
last AS (SELECT conv_id, max(depth) AS depth FROM path GROUP BY conv_id),
ends AS (
  SELECT p.key, sha256(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id)) AS sha
  FROM path p JOIN last l ON l.conv_id = p.conv_id AND l.depth = p.depth GROUP BY p.key)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n::BIGINT AS n_convs, w.c::BIGINT AS n_children,
       b.leaves AS n_leaves, b.saved AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM worth w JOIN below b USING (key) LEFT JOIN ends e USING (key) LEFT JOIN nodes p ON p.key = w.parent
"""
