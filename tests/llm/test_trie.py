"""The prefix trie against a plain one, its SQL, and its arrays against a set of prefixes."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallygrove.llm.prefix_trie import OP11_SQL, DoubleArray, op11_prefix_trie, trie

SF = "/root/testdata/sf0.001"
MESSAGES = "conv_id long, turn long, role string, text string, n long, place string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _plain(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(found)] for c, found in own.items()}
    full = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + found[h:])
    members, ends = {}, {}
    for c, path in full.items():
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, found in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(found) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(children.get(node, [])), leaves[node],
            saved[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def _found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*COLUMNS).collect())


def _talks(seed, long=0):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(0, 130), 205, 207, -3, -250]:
        copy = rng.random() < 0.3
        for turn in range(rng.choice([0, 1, 2, 5, 9])):
            text = "hello ünï" if copy else rng.choice(["a", "bb", "c c c", "", None])
            rows.append((conv, None if rng.random() < 0.05 else turn, rng.choice(["u", "v", None]), text, 1, "x"))
    rows += [(500, t, "u", f"t{t % 7}", 1, "x") for t in range(long)]
    rows += [(600, t, "u", f"t{t % 7}", 1, "x") for t in range(long - 20)] + [(700, 1, "u", "same", 1, "x")] * 3
    return rows + [(None, 1, "u", "no conversation", 1, "x")]


def test_the_trie_equals_a_plain_one_on_odd_rows(spark):
    rows = _talks(1, 150)
    assert _found(trie(spark.createDataFrame(rows, MESSAGES))) == _plain(rows)
    # Segments, shards and chunks of any size give the same.
    small = trie(spark.createDataFrame(rows, MESSAGES), segment=3, span=2, packed=7, chunk=2)
    assert _found(small) == _plain(rows)


def test_the_trie_of_few_rows(spark):
    assert trie(spark.createDataFrame([], MESSAGES)).count() == 0
    # Its first turns are those of a conversation that is not there.
    conv = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6)
    turnless = [(conv, 1, "u", "x", 1, "x")]
    assert _found(trie(spark.createDataFrame(turnless, MESSAGES))) == _plain(turnless)
    text = "very long " * 50_000
    rows = [(c, t, "u", text if t else "first", 1, "x") for c in (0, 100, 200) for t in (0, 1)]
    assert _found(trie(spark.createDataFrame(rows, MESSAGES))) == _plain(rows)


def _sql(con):
    found = con.execute(OP11_SQL)
    names = [c[0] for c in found.description]
    return sorted(tuple(-1 if v is None else v for v in (r[names.index(c)] for c in COLUMNS)) for r in found.fetchall())


def test_the_trie_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert _found(op11_prefix_trie(spark, SF)) == _sql(con)
    rows = [r[:4] for r in _talks(2)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert _sql(con) == _plain(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=6), min_size=1, max_size=60), st.integers(1, 50))
def test_double_arrays_hold_each_prefix_once(sequences, window):
    DoubleArray.WINDOW = window
    try:
        found = DoubleArray(np.concatenate(sequences), np.array([len(s) for s in sequences]))
    finally:
        DoubleArray.WINDOW = 4096
    states = {}
    for s in sequences:
        state = np.zeros(1, np.int64)
        for d, symbol in enumerate(s):
            state = found.step(state, np.array([symbol]))
            assert states.setdefault(tuple(s[: d + 1]), int(state[0])) == state[0]
    assert len(set(states.values())) == len(states) and 0 not in states.values()


@pytest.mark.parametrize("children", [1, 300])
def test_double_arrays_stay_dense(children):
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 500, (4000, 8))
    symbols[:, 0] %= children
    found = DoubleArray(symbols.ravel(), np.full(4000, 8))
    used = int((found.check >= 0).sum())
    assert np.flatnonzero(found.check >= 0)[-1] < 1.5 * used + 1000
