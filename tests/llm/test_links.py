"""Line, span, near and embedding dedup, neighbours and quotes against brute force."""

import itertools
import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallygrove.llm import line_dedup, near_dedup, span_dedup
from tallygrove.llm.common import components, multiset_jaccard, shingles
from tallygrove.llm import embedding_dedup
from tallygrove.llm.embedding_dedup import near_vectors
from tallygrove.llm.line_dedup import BLOCK, cuts, dedup_lines, line_links, normal, probes, within
from tallygrove.llm.near_dedup import dart_signatures, marks, near_duplicates
from tallygrove.llm.neighbours import nearest
from tallygrove.llm.quotes import OP10_SQL, op10_quotes, reply_order
from tallygrove.llm.span_dedup import OP3_SQL, dedup_units, op3_span_dedup

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lines_left string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


short = st.text("ab", max_size=14)


@settings(max_examples=400, deadline=None)
@given(short, short, st.integers(1, 3))
def test_banded_distance_is_right(a, b, tau):
    assert within(a, b, tau) == (distance(a, b) <= tau)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=3, max_size=14), st.text("ab", min_size=3, max_size=14))
def test_close_lines_share_a_probed_segment(a, b):
    a, b = sorted((a, b), key=len)
    if distance(a, b) <= 2:
        own = {(i, a[p : p + n]) for i, (p, n) in enumerate(cuts(len(a)))}
        assert any(n == len(a) and (i, b[p : p + m]) in own for n, i, p, m in probes(len(b)))


def _lines(seed, n=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefg ") for _ in range(rng.randint(22, 40))).strip() for _ in range(12)]
    out = []
    for _ in range(n):
        line = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            i = rng.randrange(len(line))
            line[i : i + rng.choice([0, 1])] = rng.choice(["", "x", "yz"])
        out.append("".join(line))
    return out


def test_line_links_and_removals_equal_brute_force(spark):
    lines = _lines(5)
    rows = [(i, "\n".join(lines[3 * i : 3 * i + 3] + ["short"]), "z") for i in range(20)]
    out = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, DOCS).drop("lines_left")).collect()}
    first = {}
    for doc, text, _ in rows:
        for i, line in enumerate(text.split("\n")):
            first.setdefault(normal(line), (doc, i))
    long = [x for x in first if len(x) >= 20]
    linked = [(x, y) for x, y in itertools.combinations(long, 2) if distance(x, y) <= 2]
    assert linked
    earlier = {max(p, key=first.get) for p in linked}
    links = {x: sum(x in p for p in linked) for x in first}
    for doc, text, _ in rows:
        lines = list(enumerate(text.split("\n")))
        keep = [line for i, line in lines if first[normal(line)] == (doc, i) and normal(line) not in earlier]
        assert out[doc].text == "\n".join(keep)
        assert out[doc].n_links == sum(links[normal(line)] for _, line in lines)


def _line_links(spark, rows, **settings):
    docs = spark.createDataFrame(rows, DOCS).select("doc_id", "text")
    firsts = line_dedup.occurrences(docs).groupBy("lid").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    return {(r.lid, tuple(r.near), r.n_links) for r in line_links(docs, firsts, **settings).collect()}


def _linked_truth(rows):
    """As many links and the first linked place of every line, one line a row."""
    out, bare = set(), {}
    for i, line, _ in rows:
        bare.setdefault(normal(line), (i, 0))
    for x in bare:
        near = [bare[y] for y in bare if y != x and abs(len(x) - len(y)) <= 2 and within(x, y)]
        if near:
            out.add((line_dedup.identity(x), min(near), len(near)))
    return out


def test_heavy_keys_change_no_link(spark, monkeypatch):
    rows = [(i, line, None) for i, line in enumerate(_lines(9, 200))]
    docs = spark.createDataFrame(rows, DOCS)
    plain = _line_links(spark, rows)
    assert plain == _linked_truth(rows) and not line_dedup.heavy_keys(docs, 20, 2)
    monkeypatch.setattr(line_dedup, "SAMPLED", 1)
    monkeypatch.setattr(line_dedup, "HEAVY", 2)
    assert len(line_dedup.heavy_keys(docs, 20, 2)) > 1
    assert _line_links(spark, rows) == plain


def test_lines_of_a_large_group_are_compared_in_blocks(spark):
    stem = "the same long beginning of all these lines "
    words = sorted("".join(w) for w in itertools.product("abcde", repeat=4))[:300]
    rows = [(i, stem + w + " and the same end of them all", None) for i, w in enumerate(words)]
    assert _line_links(spark, rows) == _linked_truth(rows)
    many = [(i, f"{stem}{i:05d} and the same end of them all", None) for i in range(2500)]
    assert len(many) > 2 * BLOCK
    docs = spark.createDataFrame(many, DOCS).select("doc_id", "text")
    firsts = [i for i in range(2500) if all(within(many[i][1], many[j][1]) is False for j in range(i))]
    out = dedup_lines(docs).where("lines_left > 0").collect()
    assert sorted(r.doc_id for r in out) == firsts


def test_line_dedup_odd_rows(spark):
    line = "a line that is long enough to take part"
    rows = [(2, line, None), (1, line + "!", None), (1, line + "!", None), (3, None, None), (4, "", None), (None, line, None)]
    rows.append((5, "\n".join([line] * 3000), None))
    rows += [(6, "tiny!\nown", None), (7, "tiny!\n\n", None)]
    out = dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
    texts = sorted(((r.doc_id, r.text) for r in out), key=repr)
    assert texts == sorted([(1, line + "!"), (1, line + "!"), (2, ""), (3, None), (4, ""), (5, ""), (6, "tiny!\nown"), (7, "\n"), (None, line)], key=repr)
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("heavy", [1, 1000])
def test_span_dedup_equals_its_sql(spark, monkeypatch, heavy):
    monkeypatch.setattr(span_dedup, "HEAVY", heavy)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(OP3_SQL)
    columns = [c[0] for c in found.description]
    ours = [tuple(r) for r in op3_span_dedup(spark, SF).select(*columns).collect()]
    assert sorted(ours, key=repr) == sorted(found.fetchall(), key=repr)


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_spans_point_into_the_original(spark, unit):
    end = {"line": "\n", "paragraph": "\n\n"}[unit]
    copied = "Some words that come again"
    rows = [(1, end.join(["first of all these", copied, "x"]), None), (2, end.join([copied.upper() + " ", "own words of it here"]), None),
            (2, None, None), (3, "", None), (None, copied, None), (4, end.join([copied] * 400), None)]
    out = dedup_units(spark.createDataFrame(rows, DOCS), unit=unit).collect()
    by_id = {(r.doc_id, r.text is None): r for r in out}
    two = by_id[2, False]
    assert two.text == "own words of it here" and two.removed[0].first_doc_id == 1
    assert rows[1][1][two.removed[0].start : two.removed[0].stop] == copied.upper() + " "
    assert by_id[4, False].text == "" and by_id[4, False].n_removed == 400
    assert by_id[None, False].text == copied and by_id[3, False].text == "" and len(out) == len(rows)
    assert dedup_units(spark.createDataFrame([], DOCS)).count() == 0
    long = end.join(["again", "own 1", ""] + [f"unit {i % 15_000}" for i in range(30_000)])
    out = dedup_units(spark.createDataFrame([(1, "again", None), (2, long, None)], DOCS), unit=unit).collect()
    two = next(r for r in out if r.doc_id == 2)
    assert two.n_removed == 15_001 and two.text == end.join(["own 1", ""] + [f"unit {i}" for i in range(15_000)])
    assert all(long[r.start : r.stop] in ("again", f"unit {(i - 1) % 15_000}") for i, r in enumerate(two.removed))


def _talky(seed, n):
    """Documents whose lines share sentences, passages and odd bits."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 4)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(1, 14))) + rng.choice(".!?。")
    pool = [" ".join(sentence() for _ in range(rng.randint(1, 9))) for _ in range(12)]
    odd = ["", "  ", "...", "3.14 is a number of four", "\x01", "a\x01b c d e. f g\x0bh i j", ". . a b c d", "no stop at all here"]
    bit = lambda: rng.choice([sentence(), rng.choice(pool), rng.choice(pool).upper(), rng.choice(odd)])
    line = lambda: rng.choice(["", " ", "\t"]).join(bit() for _ in range(rng.randint(1, 5)))
    return [(i, "\n".join(line() for _ in range(rng.randint(1, 6)))) for i in range(n)] + [(n, None), (n + 1, "")]


def _plain_spans(rows, run_words=25):
    """What span dedup keeps, by a walk over all texts in order."""
    def flat(x):
        return re.sub(r"[ \t\r\n\x0b\f]+", " ", x).strip(" ").lower()

    def parts(line):
        line, out = line.replace("\x01", " "), []
        for sentence in re.findall(r"[^.!?。！？]*[.!?。！？]|[^.!?。！？]+$", line):
            # Marks of an end that follow one another at once belong together.
            if out and not (len(flat(sentence).split(" ")) >= 4 and re.search(r"[^.!?。！？]", sentence)):
                out[-1] += sentence
            else:
                out.append(sentence)
        return out

    seen, result = set(), {}
    for doc_id, text in sorted(rows):
        if text is None:
            result[doc_id] = None
            continue
        kept, here = [], set()
        for line in text.split("\n"):
            whole, bits = flat(line), parts(line)
            if whole and whole in seen:
                continue
            seen |= {whole}
            left, run = "", []
            at = 0
            fresh = []
            for bit in [*bits, None]:
                again = bit is not None and len(bits) > 1 and len(flat(bit).split(" ")) >= 4 and flat(bit) in seen
                if again:
                    run.append(bit)
                else:
                    if sum(len(flat(x).split(" ")) for x in run) < run_words:
                        left += line[at : at + sum(map(len, run))]
                    at += sum(map(len, run))
                    run = []
                    if bit is not None:
                        left += line[at : at + len(bit)]
                        at += len(bit)
                if bit is not None and len(bits) > 1 and len(flat(bit).split(" ")) >= 4:
                    seen.add(flat(bit))
            kept.append(left)
        result[doc_id] = "\n".join(kept)
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_span_dedup_within_lines_equals_its_sql_and_a_plain_walk(spark, tmp_path, seed):
    rows = _talky(seed, 150)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ours = {r.doc_id: r for r in op3_span_dedup(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, text, n_removed, spans FROM ({OP3_SQL})").fetchall()}
    assert {k: (r.text, r.n_removed, r.spans) for k, r in ours.items()} == found
    assert {k: r.text for k, r in ours.items()} == _plain_spans(rows)
    assert sum(r.n_removed for r in ours.values()) > 100


def test_a_passage_within_different_lines_goes_once(spark):
    rng = random.Random(5)
    words = lambda n: [("%06x" % rng.getrandbits(24)) for _ in range(n)]
    body = [" ".join(words(n)) + "." for n in (9, 3, 14, 12, 13)]
    passage = " ".join(body)
    rows = [(i, f"{' '.join(words(8))}. {passage} {' '.join(words(9))}.\n{' '.join(words(30))}.") for i in range(4)]
    # Cut through a sentence at both ends.
    rows.append((4, f"{' '.join(words(6))} {passage[20:-20]} {' '.join(words(6))}."))
    # One sentence alone is no passage.
    rows.append((5, f"{' '.join(words(6))}. {body[2]} {' '.join(words(6))}."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in dedup_units(docs).collect()}
    assert out[0].text == rows[0][1] and out[5].text == rows[5][1]
    for i in (1, 2, 3):
        assert out[i].text == rows[i][1].replace(" " + passage, "")
        assert "".join(rows[i][1][r.start : r.stop] for r in out[i].removed) == " " + passage
        assert {r.first_doc_id for r in out[i].removed} == {0}
    assert body[2] not in out[4].text and body[3] not in out[4].text
    lines = {r.doc_id: r.text for r in dedup_units(docs, run_words=None).collect()}
    assert lines == dict(rows)


def test_dart_signatures_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(0)
    common, hits, truth = rng.integers(0, 2**63, 300).astype(np.uint64), [], []
    weights = rng.integers(1, 9, 340).astype(float)
    for _ in range(30):
        sets = [np.concatenate([common, rng.integers(0, 2**63, 40).astype(np.uint64)]) for _ in range(2)]
        a, b = dart_signatures(np.concatenate(sets), np.tile(weights, 2), np.array([340, 340]), 128)
        hits.append((a == b).mean())
        truth.append(weights[:300].sum() / (weights[:300].sum() + 2 * weights[300:].sum()))
    assert abs(np.mean(hits) - np.mean(truth)) < 0.03


def _near_truth(rows):
    ids = sorted({r[0] for r in rows})
    root = {i: i for i in ids}
    sets = [(r[0], shingles(r[1])) for r in rows]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if len(a) and multiset_jaccard(a, b) >= 0.8:
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for group in range(12):
        words = [rng.choice(vocabulary) for _ in range(120)]
        for copy in range(rng.choice([1, 2, 6])):
            changed = list(words)
            for _ in range(copy):
                changed[rng.randrange(120)] = rng.choice(vocabulary)
            rows.append((100 * group + copy, " ".join(changed), None))
    rows += [(9001, None, None), (9002, "", None), (9003, "two words", None), (9004, "Two  words!", None), (9005, "word " * 20000, None)]
    rows.append(rows[0])
    out = near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    truth = _near_truth(rows)
    assert {r.doc_id: r.class_id for r in out} == truth
    assert all(r.kept == (r.doc_id == truth[r.doc_id]) for r in out)
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_marks_keep_the_similarity_of_multisets():
    a, b = "x y " * 30 + "q r s t u v w", "x y " * 20 + "q r s t u v z"
    shared = len(np.intersect1d(marks(a), marks(b)))
    assert shared / (len(marks(a)) + len(marks(b)) - shared) == multiset_jaccard(shingles(a), shingles(b)) > 0
    assert len(marks(None)) == len(marks("")) == 0 and len(marks("one")) == 1


def test_large_buckets_with_strangers_equal_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randrange(300)}" for _ in range(120)]
    rows = []
    for i in range(70):
        changed = list(base)
        for _ in range(i % 5):
            changed[rng.randrange(120)] = f"n{rng.randrange(300)}"
        rows.append((i, " ".join(changed), None))
    rows += [(3, None, None), (4, "other words under an id that comes twice", None), rows[5]]
    docs = spark.createDataFrame(rows, DOCS)
    calls = []
    blocks = near_dedup._in_blocks
    monkeypatch.setattr(near_dedup, "_in_blocks", lambda placed, *a: calls.append(placed.count()) or blocks(placed, *a))
    truth = _near_truth(rows)
    assert 5 < len(set(truth.values())) < 60
    for group, block in ((24, 256), (2, 3), (10**9, 1)):
        monkeypatch.setattr(near_dedup, "GROUP", group)
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        assert {r.doc_id: r.class_id for r in near_duplicates(docs).collect()} == truth
    assert calls[1] > 0 and calls[2] == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 30)] + [(5, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[1000 + i] == 1000 for i in range(30))


VECTORS = "vec_id long, embedding array<float>, label int"


def _vectors(n=400, d=16, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(0, n, 7):
        x[i] = x[i // 2] + rng.normal(scale=0.12, size=d)
    x[50:80] = x[49]
    return [(i, list(map(float, v.astype(np.float32))), 0) for i, v in enumerate(x)]


BAD = [
    (9000, None, 1),
    (9001, [0.0] * 16, 1),
    (9002, [float("nan")] + [1.0] * 15, 1),
    (9003, [float("inf")] + [1.0] * 15, 1),
    (9004, [None] + [1.0] * 15, 1),
    (9005, [], 1),
]


def test_embedding_links_equal_brute_force(spark):
    rows = _vectors()
    out = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows + BAD, VECTORS)).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    assert [out[i].n_links for i in range(len(rows))] == linked.sum(axis=1).tolist()
    reach = np.eye(len(rows), dtype=bool) | linked
    for _ in range(9):
        reach = reach @ reach
    assert [out[i].component_id for i in range(len(rows))] == reach.argmax(axis=1).tolist()
    assert all(out[r[0]].n_links == 0 and out[r[0]].kept for r in BAD)
    assert near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_embedding_links_across_many_cells_of_flat_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    x = np.zeros((480, 64))
    x[:, :3] = np.random.default_rng(5).normal(size=(480, 3))
    x /= np.linalg.norm(x, axis=1)[:, None]
    out = near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    wanted = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert [r.n_links for r in sorted(out, key=lambda r: r.vec_id)] == wanted.tolist(), (sum(r.n_links for r in out), wanted.sum())


def test_neighbours_are_found_and_ranked_exactly(spark):
    rows = _vectors()
    out = nearest(spark.createDataFrame(rows + BAD, VECTORS), "id % 10 = 0").toPandas()
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    found = wanted = 0
    for query, got in out.groupby("query_id"):
        scores = x @ x[query]
        scores[query] = -2
        got = got.sort_values("rank")
        assert list(got["rank"]) == list(range(1, 6))
        assert np.allclose(scores[got.vec_id], got.score)
        bar = np.sort(scores)[-5]
        found += (got.score >= bar - 1e-9).sum()
        wanted += 5
    assert out.query_id.nunique() == 40 and found / wanted >= 0.9
    # Of equal vectors the smallest ids, the query itself left out.
    assert out[out.query_id == 60].sort_values("rank").vec_id.tolist() == [49, 50, 51, 52, 53]
    few = nearest(spark.createDataFrame(rows[:3], VECTORS), "id = 0").collect()
    assert len(few) == 2
    assert nearest(spark.createDataFrame([], VECTORS), "id = 0").count() == 0


MESSAGES = "conv_id long, turn long, role string, text string"
TALK = [
    (1, 0, "user", "Hello there\nHow are you?"),
    (1, 1, "a", "> How are you?\nfine"),
    (1, 2, "user", "other topic"),
    (1, 3, "a", "> > how  ARE you?\n> fine\nglad"),
    (1, 4, "b", "> other topic\nok"),
    (1, 4, "b", "> other topic\nok"),
    (1, 3000, "b", "> Hello there"),
    (2, 0, "u", None),
    (2, None, "u", "x"),
    (None, 1, "u", "> x"),
    (2, 1, "u", "> nothing known"),
    (2, 2, "x", ""),
]


def _talk_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = con.execute(OP10_SQL)
    return [c[0] for c in found.description], found.fetchall()


def test_quotes_equal_their_sql_on_odd_rows(spark):
    columns, wanted = _talk_sql(TALK)
    out = reply_order(spark.createDataFrame(TALK, MESSAGES)).select(*columns).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(wanted, key=repr)
    one = {(r.conv_id, r.turn): r for r in out}
    assert one[1, 3].answers == 1 and one[1, 3].thread == 0 and one[1, 3].text == "glad"
    assert [r.turn for r in sorted(out, key=lambda r: r.position) if r.conv_id == 1] == [0, 1, 3, 3000, 2, 4, 4]
    assert reply_order(spark.createDataFrame([], MESSAGES)).count() == 0


def test_quotes_equal_their_sql_on_the_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    found = con.execute(OP10_SQL)
    columns = [c[0] for c in found.description]
    out = op10_quotes(spark, SF).select(*columns).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(found.fetchall(), key=repr)


def test_vectors_of_each_length_are_linked_and_searched(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=8 if i < 60 else 5).tolist(), 0) for i in range(90)]
    rows += [(100, [1.01 * x for x in rows[3][1]], 0), (101, [2 * x for x in rows[70][1]], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = {r.vec_id: r for r in near_vectors(vectors).collect()}
    assert out[100].component_id == 3 and out[101].component_id == 70
    x = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    for i, a in x.items():
        assert out[i].n_links == sum(j != i and len(a) == len(b) and a @ b >= 0.9 for j, b in x.items())
    found = nearest(vectors, "id in (100, 101)", k=2).collect()
    assert {(r.query_id, r.vec_id) for r in found if r["rank"] == 1} == {(100, 3), (101, 70)}
