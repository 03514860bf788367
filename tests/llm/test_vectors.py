"""Whitening, exact search and planned neighbour search against plain computations."""

import duckdb
import numpy as np
import pytest

from tallygrove.llm import exact_search, neighbours
from tallygrove.llm.exact_search import OP13_SQL, op13_exact_search, products, top_products
from tallygrove.llm.whitening import above, intervals, largest, op12_whitening, tridiagonal, whiten

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, ids string, ring int, raw double"
BAD = [
    (9000, None, "x", 1, None),
    (9001, [float("nan"), 1.0], "x", 1, 0.0),
    (9002, [float("inf"), 1.0], "x", 1, 0.0),
    (9003, [None, 1.0], "x", 1, 0.0),
    (9004, [], "x", 1, 0.0),
]


def _rows(x, first=0):
    return [(first + i, list(map(float, v)), "y", 0, 1.0) for i, v in enumerate(x)]


# -- exact search ------------------------------------------------------------------


def _brute(rows, asked, k, scale=256):
    good = {(i, tuple(int(np.floor(scale * c)) for c in v)) for i, v, *_ in rows
            if i is not None and v and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for q, a in good:
        if asked(q):
            near = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in good if i != q and len(a) == len(b)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


def _found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_search_equals_brute_force_on_odd_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 6)).round(1)
    x[40:75] = x[39]  # a hot vector, queries among its rows
    rows = _rows(x) + BAD + [(None, [1.0] * 6, "z", 1, 1.0), (7, list(map(float, x[7])), "z", 1, 1.0)]
    rows += [(500, [0.0] * 6, "", 0, 0.0), (510, [0.5, 0.25], "", 0, 0.0), (511, [1.0, 1.0], "", 0, 0.0)]
    vectors = spark.createDataFrame(rows, VECTORS)
    assert _found(top_products(vectors, "id % 10 = 0", ring_rows=16)) == _brute(rows, lambda i: i % 10 == 0, 5)
    few = top_products(spark.createDataFrame(rows[:3], VECTORS), "id >= 0", k=5)
    assert _found(few) == _brute(rows[:3], lambda i: True, 5) and few.count() == 6
    assert top_products(spark.createDataFrame([], VECTORS), "id = 0").count() == 0


def test_search_stops_by_its_bounds_and_stays_exact(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(8, 6)) * 4
    rows = _rows(centre[rng.integers(0, 8, 900)] + rng.normal(scale=0.05, size=(900, 6)))
    seen = []
    met = exact_search._met
    monkeypatch.setattr(exact_search, "_met", lambda i, v, b, *a: seen.append((v.count(), i.select("ring").distinct().count())) or met(i, v, b, *a))
    out = _found(top_products(spark.createDataFrame(rows, VECTORS), "id % 30 = 0", ring_rows=24))
    assert out == _brute(rows, lambda i: i % 30 == 0, 5)
    rings = seen[0][1]
    assert rings > 20 and sum(v for v, _ in seen) < 0.7 * 30 * rings


def test_search_equals_its_sql_on_the_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    found = con.execute(OP13_SQL)
    columns = [c[0] for c in found.description]
    out = op13_exact_search(spark, SF).select(*columns).collect()
    assert sorted(map(tuple, out)) == sorted(found.fetchall())


@pytest.mark.parametrize("most", [100, 1 << 28, 1 << 40])
def test_products_are_exact_at_any_size(most):
    rng = np.random.default_rng(most)
    a, b = rng.integers(-most, most, (4, 9)), rng.integers(-most, most, (5, 9))
    exact = np.clip(a.astype(object) @ b.astype(object).T, -(1 << 63), (1 << 63) - 1)
    assert (products(a, b) == exact.astype(np.int64)).all()


# -- whitening ---------------------------------------------------------------------


def _plain(x, wanted=16):
    """n, deviations, eigenvalues, components by a dense solver; x: all usable vectors."""
    whole = np.floor(64 * x).astype(np.int64) + 1_000_000
    fit = np.unique(whole, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = (n * fit - s) / n
    v = y.T @ y / n
    e, c = np.linalg.eigh(v)
    own = n * whole - s
    return n, (own * own).sum(axis=1), e[::-1][:wanted], c[:, ::-1][:, :wanted], own / n, np.trace(v)


def _agrees(out, ids, x, wanted=16):
    n, deviation, e, c, y, trace = _plain(x, wanted)
    e = e[e > 1e-10 * trace]
    assert len(out) == len(ids) * len(e)
    out = out.sort_values(["vec_id", "component"], kind="stable")
    assert set(out.n) == {n} and out.identity_error.nunique() == 1 and out.identity_error.iloc[0] <= 1e-4
    order = np.argsort(ids, kind="stable")
    assert (out[out.component == 1].deviation.to_numpy() == deviation[order]).all()
    for k in range(len(e)):
        mine = out[out.component == k + 1]
        assert abs(mine.explained.iloc[0] / (e[k] / trace) - 1) < 1e-9
        wanted_values = (y @ c[:, k] / np.sqrt(e[k]))[order]
        sign = np.sign(wanted_values @ mine.whitened.to_numpy())
        assert np.abs(mine.whitened.to_numpy() * sign - wanted_values).max() < 1e-7


def test_whitening_equals_a_dense_solver_on_the_table(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    _agrees(op12_whitening(spark, SF).toPandas(), given.vec_id.to_numpy(), np.array(given.embedding.tolist(), float))


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 5)) * [9, 3, 1, 0.5, 0]  # one constant dimension
    x[20:50] = x[19]
    out = whiten(spark.createDataFrame(_rows(x) + BAD[:3] + BAD[4:], VECTORS)).toPandas()
    _agrees(out, np.arange(60), x)
    two = _rows(x[:9]) + _rows(rng.normal(size=(9, 3)), 100)
    out = whiten(spark.createDataFrame(two, VECTORS)).toPandas()
    assert set(out[out.vec_id >= 100].component) == {1, 2, 3} and set(out.n) == {9}
    assert whiten(spark.createDataFrame(_rows(x[:1]) * 3, VECTORS)).count() == 0
    assert whiten(spark.createDataFrame([], VECTORS)).count() == 0
    with pytest.raises(Exception, match="too large"):
        whiten(spark.createDataFrame(_rows([[1e300, 1.0]]), VECTORS)).collect()


@pytest.mark.parametrize("e", [np.r_[np.ones(30) * 2, np.ones(10)], np.arange(40.0), np.r_[1e6, np.linspace(1, 1.01, 39)]])
def test_no_eigenvalue_is_missed(spark, e):
    q, _ = np.linalg.qr(np.random.default_rng(6).normal(size=(40, 40)))
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    t = tridiagonal(v)
    assert [above(s, *t) for s in (-0.5, 1.005, 1.5, 2.5)] == [int((e > s).sum()) for s in (-0.5, 1.005, 1.5, 2.5)]
    assert sum(n for _, _, n in intervals(v, 16)) >= 16
    found, c = largest(spark, v)
    assert np.allclose(found, np.sort(e)[::-1][:16], rtol=1e-12, atol=1e-12 * e.max())
    assert np.allclose(c.T @ c, np.eye(16), atol=1e-13) and np.abs(v @ c - c * found).max() < 1e-12 * e.max()


# -- neighbours ----------------------------------------------------------------------


def _clustered(n, clusters, scale, d=32):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(clusters, d))[rng.integers(0, clusters, n)] + rng.normal(scale=scale, size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _true(x, queries, k=5):
    s = x[queries] @ x.T
    s[np.arange(len(queries)), queries] = -2
    return np.argsort(-s, axis=1)[:, :k]


@pytest.mark.parametrize(("clusters", "scale", "most"), [(60, 0.2, 0.15), (60, 0.5, 0.3), (1, 9.0, 1.9)])
def test_plan_finds_neighbours_of_other_queries_by_few_visits(clusters, scale, most):
    x = _clustered(6000, clusters, scale)
    asked, others = np.arange(0, 2400, 50), np.arange(25, 5000, 50)
    plan, recall, share, count = neighbours.choose(x[asked], x[_true(x, asked)], x[::2], len(x))
    assert recall >= 0.96 and share <= most and count <= neighbours.PROBES * plan.tables
    at = np.min([neighbours._visited(x[others], x, t, plan)[0] for t in range(plan.tables)], axis=0)
    assert np.take_along_axis(at < plan.success, _true(x, others), 1).mean() >= 0.9


def test_probes_come_once_in_falling_order_and_hold_their_share():
    position = np.array([0.3, -1.8, 4.95])
    found = list(neighbours.probes(position, 0.7, 0.9))
    cells = [c for c, _ in found]
    chance = np.diff([p for _, p in found])
    assert len(set(cells)) == len(cells) and cells[0] == (0, -2, 4)
    assert (np.diff(chance) <= 1e-12).all() and found[-1][1] < 0.9
    near = np.floor(position + np.random.default_rng(3).normal(scale=0.7, size=(20_000, 3))).astype(int)
    assert abs(np.mean([tuple(c) in set(cells) for c in near.tolist()]) - 0.9) < 0.03


@pytest.mark.parametrize("block", [40, 2048])
def test_neighbours_of_clustered_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    x = _clustered(3000, 40, 0.2)
    vectors = spark.createDataFrame(_rows(x), VECTORS)
    good = neighbours.usable(vectors)
    choice = neighbours._plan(good, good.where("id % 50 = 0"), 3000, 32, 5)
    assert choice.share < 0.3 and choice.recall >= 0.96
    out = neighbours.nearest(vectors, "id % 50 = 0").toPandas()
    true = _true(x, np.arange(0, 3000, 50))
    got = {q: set(g.vec_id) for q, g in out.groupby("query_id")}
    assert sum(len(got[50 * i] & set(t)) for i, t in enumerate(true)) >= 0.9 * true.size
    assert np.allclose(out.score, (x[out.query_id] * x[out.vec_id]).sum(axis=1), atol=1e-14)
