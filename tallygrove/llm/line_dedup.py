"""Operator 7: near-equal lines by a segment-partition edit join.

A line is normalised (lower case, runs of white space are one blank, none at the
ends). Equal lines, however short but not empty, are one line from the start. Two
different lines of at least ``min_chars`` characters (any two shorter ones could be
within few edits of each other) are linked if their edit distance is at most ``TAU``:

* each line is cut into TAU + 1 segments of almost equal length. If another, equally
  long or longer by at most TAU, is within TAU edits, it holds one of the segments
  unchanged, and at one of few places, which the lengths determine. Keys of a line's
  own segments and of the places where it would hold a shorter line's segments meet
  in the shuffle;
* small groups of lines that share a key are compared where they meet. Lines of
  larger groups are dealt out again, in blocks, and compared block against block
  within a task. Of its links only their number and the earliest linked line leave it,
  for each line, so a group of lines that are all linked stays as small as it is;
* a pair counts if a banded bit-parallel computation finds at most TAU edits after
  what they share at both ends is taken off, and counts once: at the least of the keys
  that they share.

A line is removed if an equal line or a linked line comes earlier, by doc_id and then
by place in the text; so the earliest of a group always stays. Empty lines stay.

Defined cases: a null text has no lines and stays null; an empty one stays empty; a
document left without any line by removals is empty, and ``lines_left`` says 0; rows
with the same doc_id share places; rows with a null doc_id are left as they are and
remove nothing; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrove.functions import named
from tallygrove.llm.common import read, salted_join, sieved, staged

TAU = 2
MIN_CHARS = 20
#: Larger groups are compared in blocks of ``BLOCK`` lines.
GROUP, BLOCK = 24, 1024
#: Heavy keys are looked for in one of so many texts, and have so many rows there.
SAMPLED, HEAVY = 32, 128
#: Texts that are rebuilt at a time.
REBUILT = 500
#: Width of the word of the banded computation.
WORD = 64


def normal(line: str) -> str:
    """Lower case, no white space at the ends, blanks and tabs within run together."""
    line = line.lower().strip()
    if "  " in line or "\t" in line or "\r" in line:
        line = " ".join(line.split())
    return line


def cuts(length: int, tau: int = TAU) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line; the last ones are the longer."""
    base, longer = divmod(length, tau + 1)
    out, start = [], 0
    for i in range(tau + 1):
        n = base + (i > tau - longer)
        out.append((start, n))
        start += n
    return out


def probes(length: int, tau: int = TAU) -> list[tuple[int, int, int, int]]:
    """Where a line may hold a segment of a line shorter by 0..tau.

    (that line's length, segment number, place in this line, segment's length).
    By the segments before it at most i, by those behind it at most tau - i edits
    can have moved segment i, or an earlier or later one is unchanged as well.
    """
    out = []
    for shorter in range(max(length - tau, tau + 1), length + 1):
        moved = length - shorter
        for i, (start, n) in enumerate(cuts(shorter, tau)):
            first = max(0, start - i, start + moved - (tau - i))
            last = min(length - n, start + i, start + moved + (tau - i))
            out += [(shorter, i, p, n) for p in range(first, last + 1)]
    return out


def within(a: str, b: str, tau: int = TAU) -> bool:
    """Whether the edit distance of two strings is at most ``tau``."""
    if abs(len(a) - len(b)) > tau:
        return False
    if a == b:
        return True
    a, b = _trimmed(a, b)
    if min(len(a), len(b)) == 0:
        return max(len(a), len(b)) <= tau
    if len(a) > len(b):
        a, b = b, a
    return _banded(a, b, tau) <= tau


def _same_start(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _trimmed(a: str, b: str) -> tuple[str, str]:
    k = _same_start(a, b)
    a, b = a[k:], b[k:]
    k = _same_start(a[::-1], b[::-1])
    return (a[: len(a) - k], b[: len(b) - k]) if k else (a, b)


def _banded(a: str, b: str, tau: int) -> int:
    """Edit distance of ``a`` and the not shorter ``b``, or any number above ``tau``.

    A word holds the vertical differences of one column for the rows around the
    diagonal and moves one row down with each character of ``b``. The distance is
    followed along the word's last row until that is the last of all.
    """
    a, b = "\0" * tau + a, "\0" * tau + b  # so that the last row comes after row tau
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << WORD) - 1
    plus, minus = full << (WORD - tau - 1) & full, 0
    distance, last, bottom = tau, 1 << (WORD - 1), 1 << (WORD - 2)
    hopeless = 2 * tau + len(b) - len(a)
    down = len(a) - tau
    for column, c in enumerate(b):
        above = column + tau + 1 - WORD
        match = places.get(c, 0)
        match = (match >> above if above >= 0 else match << -above) & full
        equal = ((((match & plus) + plus) ^ plus) | match | minus) & full
        right_plus = (minus | ~(equal | plus)) & full
        right_minus = equal & plus
        if column < down:
            distance += not equal & last
            if distance > hopeless:
                return tau + 1
        else:
            distance += bool(right_plus & bottom) - bool(right_minus & bottom)
            bottom >>= 1
        equal >>= 1
        plus = (right_minus | ~(equal | right_plus)) & full
        minus = equal & right_plus
    return distance


def identity(line: str) -> int:
    """A 64-bit even number for a normalised line."""
    return (xxhash.xxh3_64_intdigest(line) & ~1) - (1 << 63)


def _lines(text: str | None, min_chars: int = 1) -> Iterator[tuple[int, str]]:
    """(place, normalised line) of the lines that take part."""
    for i, line in enumerate((text or "").split("\n")):
        line = normal(line)
        if len(line) >= min_chars:
            yield i, line


def occurrences(docs: DataFrame) -> DataFrame:
    """lid, lid2 (a line's digest), doc_id, line (its place) of all lines that are not empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for i, line in _lines(text.as_py()):
                    out[0].append(identity(line))
                    out[1].append(xxhash.xxh64_intdigest(line) - (1 << 63))
                    out[2].append(doc_id)
                    out[3].append(i)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["lid", "lid2", "doc_id", "line"])

    return docs.select("doc_id", "text").mapInArrow(scan, "lid long, lid2 long, doc_id long, line long")


@lru_cache(maxsize=4096)
def _key_places(length: int, tau: int) -> list[tuple[int, int, int, int]]:
    """(place, end, seed, 1 if it is a segment of the line itself)."""
    own = {(i, p) for i, (p, _) in enumerate(cuts(length, tau))}
    return [
        (p, p + n, shorter * (tau + 1) + i, int(shorter == length and (i, p) in own))
        for shorter, i, p, n in probes(length, tau)
    ]


def keys(docs: DataFrame, min_chars: int, tau: int) -> DataFrame:
    """key, lid of every segment; lid is odd for a line's own segments."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        hashed = xxhash.xxh64_intdigest
        for batch in batches:
            found, ids = [], []
            for text in batch.column(0):
                for _, line in _lines(text.as_py(), min_chars):
                    lid = identity(line)
                    if lid in seen:
                        continue
                    if len(seen) >= 500_000:
                        seen.clear()
                    seen.add(lid)
                    places = _key_places(len(line), tau)
                    found += [hashed(line[p:q], seed) for p, q, seed, _ in places]
                    ids += [lid | own for _, _, _, own in places]
                if len(ids) > 200_000:
                    yield _key_batch(found, ids)
                    found, ids = [], []
            yield _key_batch(found, ids)

    return docs.select("text").mapInArrow(scan, "key long, lid long")


def common_keys(a: str, b: str, tau: int = TAU) -> set[int]:
    """The keys at which two lines meet: own segments of one at places of the other."""
    found = []
    for line in (a, b):
        own, all_ = set(), set()
        for p, q, seed, is_own in _key_places(len(line), tau):
            key = xxhash.xxh64_intdigest(line[p:q], seed)
            all_.add(key)
            if is_own:
                own.add(key)
        found.append((own, all_))
    return (found[0][0] & found[1][1]) | (found[0][1] & found[1][0])


def counting_key(a: str, b: str, tau: int = TAU) -> int:
    """The key at which a pair counts, as it stands in a column."""
    return int(np.uint64(min(common_keys(a, b, tau))).view(np.int64))


def _key_batch(found: list[int], ids: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(found, np.uint64).view(np.int64)), pa.array(np.array(ids, np.int64))], ["key", "lid"]
    )


def heavy_keys(docs: DataFrame, min_chars: int, tau: int) -> list[int]:
    """Keys that may hold more than a task's even share, as many as tasks at most.

    They are estimated from a part of the texts and steer only how rows are dealt.
    """
    part = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counts = keys(part, min_chars, tau).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") >= HEAVY).orderBy(F.desc("n"), "key").limit(partitions(docs))
    return [r["key"] for r in top.collect()]


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def meetings(keyed: DataFrame, heavy: list[int]) -> DataFrame:
    """What meets at a key: pairs (key, a, b) of small groups, members (key, a) of others.

    Rows are dealt by key, those of ``heavy`` keys by key and lid, so that these fill
    many tasks; no task sees all of such a key, so its rows become members. Any other
    key is in one task, which hands it on in parts if it is long. A key without any
    own segment links nothing.
    """
    apart = np.array(heavy, np.int64)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_keys, kept_ids, edges = np.empty(0, np.int64), np.empty(0, np.int64), apart
        for batch in batches:
            k = np.concatenate([kept_keys, batch.column(0).to_numpy()])
            v = np.concatenate([kept_ids, batch.column(1).to_numpy()])
            if not len(k):
                continue
            end = int(np.searchsorted(k, k[-1]))  # the last key may go on
            if len(k) - end > 100_000:  # it is large: no need to hold it
                edges = np.append(edges, k[-1])
                end = len(k)
            yield from _met(k[:end], v[:end], edges)
            if len(edges) > len(apart):  # of the long keys only the last may go on
                edges = np.append(apart, edges[-1])
            kept_keys, kept_ids = k[end:], v[end:]
        yield from _met(kept_keys, kept_ids, edges)

    count = partitions(keyed)
    salt = F.lit(0).cast("long")
    if heavy:
        salt = F.when(F.col("key").isin(heavy), F.pmod(F.xxhash64("lid"), F.lit(count))).otherwise(salt)
    return (
        keyed.repartition(count, "key", salt)
        .sortWithinPartitions("key", "lid")
        .mapInArrow(group, "key long, a long, b long")
    )


def _met(k: np.ndarray, v: np.ndarray, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(k):
        return
    fresh = np.append(True, (k[1:] != k[:-1]) | (v[1:] != v[:-1]))
    k, v = k[fresh], v[fresh]
    start = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    size = np.diff(np.append(start, len(k)))
    edge = np.isin(k[start], edges)
    own = np.add.reduceat(v & 1, start)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    of_pairs: list[bool] = []
    large = (size > GROUP) & (own > 0) | edge
    for s, n in zip(start[large], size[large], strict=True):
        out.append((k[s : s + n], v[s : s + n], np.zeros(n, np.int64)))
        of_pairs.append(False)
    small = start[(size > 1) & (own > 0) & ~large]
    sizes = size[(size > 1) & (own > 0) & ~large]
    for n in np.unique(sizes):
        rows = small[sizes == n][:, None] + np.arange(n)
        i, j = np.triu_indices(int(n), 1)
        a, b, key = v[rows[:, i]].ravel(), v[rows[:, j]].ravel(), k[rows[:, i]].ravel()
        use = ((a | b) & 1 == 1) & (a >> 1 != b >> 1)
        a, b = a[use] & ~1, b[use] & ~1
        out.append((key[use], np.minimum(a, b), np.maximum(a, b)))
        of_pairs.append(True)
    if out:
        cols = [np.concatenate([o[i] for o in out]) for i in range(3)]
        is_pair = np.repeat(of_pairs, [len(o[0]) for o in out])
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2], mask=~is_pair)], ["key", "a", "b"]
        )


def _texts(docs: DataFrame, needed: DataFrame, min_chars: int) -> DataFrame:
    """lid, line (normalised) of the lines whose lid is in ``needed``.

    A bit map of fixed size keeps most other lines out of the shuffle; the join
    behind it decides.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, seen = [], [], set()
            for text in batch.column(0):
                for _, line in _lines(text.as_py(), min_chars):
                    lid = identity(line)
                    if lid not in seen:
                        seen.add(lid)
                        ids.append(lid)
                        texts.append(line)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["lid", "text"])

    lines = docs.select("text").mapInArrow(scan, "lid long, text string")
    # An inner join, as ``needed`` has each lid once: a semi-join would be pushed below
    # the map, and all lines shuffled.
    return sieved(lines, "lid", needed).join(needed, "lid").select("lid", "text").dropDuplicates(["lid", "text"])


LINKED = "lid long, near_doc long, near_line long, links long"


def _linked(found: dict[int, list], pairs: Iterator[tuple[tuple, tuple]]) -> None:
    """Note for both lines of each pair of (lid, doc, line) where the other first stands."""
    for x, y in pairs:
        for own, other in ((x, y), (y, x)):
            mine = found.setdefault(own[0], [other[1:], 0])
            mine[0] = min(mine[0], other[1:])
            mine[1] += 1


def _linked_rows(found: dict[int, list]) -> pa.RecordBatch:
    cols = ([], [], [], [])
    for lid, ((doc, line), links) in found.items():
        for column, value in zip(cols, (lid, doc, line, links), strict=True):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["lid", "near_doc", "near_line", "links"])


def _verified(pairs: DataFrame, texts: DataFrame, tau: int) -> DataFrame:
    """``LINKED`` of the pairs (a, b, keys: where they met) of small groups."""

    def side(name: str) -> DataFrame:
        line = F.struct("lid", "doc_id", "line", "text").alias(f"of_{name}")
        return texts.select(F.col("lid").alias(name), line)

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("keys", "of_a", "of_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, list] = {}
            for keys, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if within(x["text"], y["text"], tau) and counting_key(x["text"], y["text"], tau) in keys:
                    _linked(found, [tuple((z["lid"], z["doc_id"], z["line"]) for z in (x, y))])
            yield _linked_rows(found)

    return both.mapInArrow(verify, LINKED)


def _in_blocks(members: DataFrame, texts: DataFrame, tau: int) -> DataFrame:
    """``LINKED`` within groups of any size: own segments' lines against all, by blocks."""
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = counts.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    known = texts.select((F.shiftright("lid", 1)).alias("half"), "doc_id", "line", "text")
    lines = salted_join(members, counts, "key", "a").withColumn("half", F.shiftright("a", 1)).join(known, "half")
    block = F.pmod(F.xxhash64("half", F.lit(7)), F.col("blocks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ("a", "doc_id", "line", "text")
    left = lines.where("a % 2 <> 0").select("key", block.alias("i"), each.alias("j"), F.lit(True).alias("own"), *columns)
    right = lines.select("key", each.alias("i"), block.alias("j"), F.lit(False).alias("own"), *columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, i, j) != at:
                    if rows:
                        yield _compared(at[0], rows, tau)
                    at, rows = (key, i, j), []
                rows.append(row)
        if rows:
            yield _compared(at[0], rows, tau)

    return (
        left.union(right)
        .repartition(partitions(members), "key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(compare, LINKED)
    )


def _compared(key: int, rows: list[list], tau: int) -> pa.RecordBatch:
    """Links of one block of a key's own lines with one of all its lines."""
    left = {a & ~1: (doc, line, t) for own, a, doc, line, t in rows if own}
    right = {a & ~1: (doc, line, t) for own, a, doc, line, t in rows if not own}
    owners = {a & ~1 for own, a, *_ in rows if not own and a & 1}
    found: dict[int, list] = {}
    if left and right:
        names = list(right)
        bags = np.array([_bag(right[y][2]) for y in names], np.int16)
        for x, (doc, line, t) in left.items():
            # An edit changes two counts of characters by one at most.
            for k in np.flatnonzero(np.abs(bags - _bag(t)).sum(axis=1) <= 2 * tau):
                y = names[k]
                # Of two owners one is on the left here, the other in another block.
                if y == x or y in owners and y < x:
                    continue
                if within(t, right[y][2], tau) and counting_key(t, right[y][2], tau) == key:
                    _linked(found, [((x, doc, line), (y, *right[y][:2]))])
    return _linked_rows(found)


def _bag(text: str) -> np.ndarray:
    return np.bincount(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32) % 32, minlength=32)


ADDED = "lines_left int, lines_removed int, near_removed int, n_links long, removed array<struct<line:long,first_doc_id:long,first_line:long>>"


def line_links(docs: DataFrame, firsts: DataFrame, *, tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """lid, near (doc_id, line) and n_links of every line with a link.

    ``near`` is where the earliest of the lines within ``tau`` edits first stands,
    ``n_links`` how many of these there are. ``firsts``: lid, first (doc_id, line).
    """
    met = staged(meetings(keys(docs, min_chars, tau), heavy_keys(docs, min_chars, tau)), "meetings")
    # A pair meets at as many keys as its lines have segments and places, at most.
    pairs = staged(met.where("b is not null").groupBy("a", "b").agg(F.collect_set("key").alias("keys")), "pairs")
    members = staged(met.where("b is null").select("key", "a").distinct(), "members")
    needed = (
        pairs.select(F.explode(F.array("a", "b")).alias("lid"))
        .union(members.select((F.shiftright("a", 1) * 2).alias("lid")))
        .distinct()
    )
    texts = _texts(docs, staged(needed, "needed"), min_chars)
    texts = staged(texts.join(firsts.select("lid", "first.doc_id", "first.line"), "lid"), "texts")
    found = _verified(pairs, texts, tau).union(_in_blocks(members, texts, tau))
    nearest = F.struct(F.col("near_doc").alias("doc_id"), F.col("near_line").alias("line"))
    return staged(found.groupBy("lid").agg(F.min(nearest).alias("near"), F.sum("links").alias("n_links")), "links")


def dedup_lines(docs: DataFrame, *, tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without lines that an equal or linked line precedes.

    Adds lines_left, lines_removed, near_removed, n_links and removed, a list of
    (line, first_doc_id, first_line): the place and where the line first stands. Other
    columns are kept, but for those of these five names.
    """
    docs = docs.drop(*(f.name for f in T._parse_datatype_string(ADDED).fields))
    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    seen = staged(occurrences(known), "lines")
    firsts = staged(
        seen.groupBy("lid", "lid2").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count(F.lit(1)).alias("n")),
        "firsts",
    )
    nearest = line_links(known, firsts, tau=tau, min_chars=min_chars)
    marked = (
        firsts.join(nearest, "lid", "left")
        .where("n > 1 or near is not null")
        .select("lid", "lid2", "first", F.when(F.col("near") < F.col("first"), F.col("near")).alias("near"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    hits = seen.join(marked, ["lid", "lid2"]).select(
        "doc_id",
        F.struct(
            "line",
            "lid",
            F.coalesce("near", "first").alias("to"),
            (F.col("near").isNotNull() | (F.col("first") != F.struct("doc_id", "line"))).alias("gone"),
            F.col("near").isNotNull().alias("is_near"),
            "n_links",
        ).alias("hit"),
    )
    # As many as a document has lines.
    per_doc = hits.groupBy("doc_id").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
    # Only a document's id, text and hits pass the join and Python; its other columns
    # are in one struct, so that none of their names can clash.
    names = docs.columns
    schema = docs.schema
    for field in T._parse_datatype_string(ADDED).fields:
        schema = schema.add(field)
    others = [n for n in names if n != "text"]
    whole = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*map(named, others)).alias("row"), "text")
    joined = whole.join(per_doc.select(F.col("doc_id").alias("id"), "hits"), "id", "left").select("row", "text", "hits")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        removed_type = pa.list_(pa.struct([("line", pa.int64()), ("first_doc_id", pa.int64()), ("first_line", pa.int64())]))
        types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), removed_type)
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, REBUILT):
                batch = whole_batch.slice(at, REBUILT)
                texts, out = [], ([], [], [], [], [])
                given = dict(zip(others, batch.column(0).flatten(), strict=True))
                for text, hits in zip(batch.column(1), batch.column(2), strict=True):
                    new, *counts = _without(text.as_py(), hits.as_py() or [])
                    texts.append(new)
                    for column, value in zip(out, counts, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()) if n == "text" else given[n] for n in names]
                    + [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                    [f.name for f in schema.fields],
                )

    return joined.mapInArrow(rebuild, schema)


def _without(text: str | None, hits: list[dict]) -> tuple:
    """A text less its removed lines, with the counts and places of these."""
    if text is None:
        return None, 0, 0, 0, 0, []
    lines = text.split("\n")
    gone, near, links = {}, 0, 0
    for hit in hits:
        i = hit["line"]
        if i >= len(lines) or i in gone or identity(normal(lines[i])) != hit["lid"]:
            continue
        links += hit["n_links"]
        if hit["gone"]:
            gone[i] = {"line": i, "first_doc_id": hit["to"]["doc_id"], "first_line": hit["to"]["line"]}
            near += hit["is_near"]
    left = [line for i, line in enumerate(lines) if i not in gone]
    return "\n".join(left), len(left), len(gone), near, links, list(gone.values())


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text without repeated lines, and what was removed, per document."""
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
