"""Toxicity, mixing, packing and token counts: exactness and edge cases."""

import base64
import collections
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallygrove.llm.mixing import OP1_SQL, budgets, mix, op1_mixing, sized, targets
from tallygrove.llm.packing import configurations, op2_packing, pack_documents, plan
from tallygrove.llm.token_counts import Automaton, count_tokens
from tallygrove.llm.toxicity import DIMENSIONS, held_out, score, train

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, note string"
ODD = [
    (1, "one two  three four", "b", "x"),
    (1, "one two  three four", "b", "x"),
    (2, None, "b", None),
    (3, "", "a", None),
    (None, "a b c d", None, None),
    (4, "word " * 3000, "a", None),
    (5, " \t\n", None, None),
    (6, "end<|endoftext|>of it's   here\n\nnow", "c", None),
]


def _sql(spark, sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    found = con.execute(sql)
    return [c[0] for c in found.description], found.fetchall()


def _same(df, columns, wanted):
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert ours == sorted(wanted, key=repr)


def test_mixing_equals_its_sql_on_the_tables_and_on_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, wanted = _sql(spark, OP1_SQL, documents=docs)
    _same(op1_mixing(spark, SF), columns, wanted)


def test_mixing_odd_rows(spark):
    rows = sized(spark.createDataFrame(ODD, DOCS))
    out = mix(rows, budgets(rows)).collect()
    assert len(out) == len(ODD)
    assert {r["size"] for r in out if r.doc_id == 1} == {3}  # a no-break space separates no words
    assert all(0 <= r.copies <= 3 for r in out)
    empty = sized(spark.createDataFrame([], DOCS))
    assert mix(empty, budgets(empty)).count() == 0


def test_targets_share_what_capped_sources_leave():
    assert targets([100, 100, 100], [1, 2, 3], 300) == [50.0, 100.0, 150.0]
    found = targets([10, 1000], [5, 1], 1010)
    assert found == [30.0, 980.0]
    assert targets([0, 0], [1, 2], 0) == [0.0, 0.0]


def _check_plan(lengths, capacity):
    counts = collections.Counter(lengths)
    made = plan(dict(counts), capacity, groups=6, small=capacity // 8)
    assert made.taken == dict(counts)
    runs, content = sorted(made.runs), collections.defaultdict(list)
    for i, (n, rank, sequence, offset) in enumerate(runs):
        end = runs[i + 1][1] if i + 1 < len(runs) and runs[i + 1][0] == n else made.taken[n]
        for k in range(end - rank):
            content[sequence + k].append((offset, n))
    for pieces in content.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(content) == made.sequences
    return made.sequences


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_any_plan_places_every_piece_once_and_without_gaps(lengths):
    used = _check_plan(lengths, 64)
    assert used <= 2 * -(-sum(lengths) // 64) + 1


def test_a_plan_is_near_the_least_number_of_sequences():
    lengths = np.random.default_rng(1).integers(1, 1024, 20_000).tolist()
    assert _check_plan(lengths, 1024) <= 1.01 * sum(lengths) / 1024


def test_configurations_cover_the_demand():
    numbers, use = configurations(np.array([60, 40, 30]), np.array([10.0, 10.0, 20.0]), 100)
    assert (numbers @ np.array([60, 40, 30]) <= 100).all()
    assert np.allclose(use @ numbers, [10, 10, 20])


def _packed(frame, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = collections.Counter()
    for (_, _), rows in frame.sort_values(["piece"]).groupby(["doc_id", "copy"], dropna=False):
        assert list(rows.start) == list(np.cumsum([0, *rows.length])[:-1])
        whole[tuple(rows.ids_crc32)] += 1
    wanted = collections.Counter()
    for text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        wanted[tuple(zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True))] += 1
    return whole, wanted


def test_packing_is_gapless_and_has_the_tokenizers_ids(spark):
    odd = pack_documents(spark.createDataFrame(ODD, DOCS)).toPandas()
    odd["copy"] = odd.groupby(["doc_id", "piece"], dropna=False).cumcount()
    whole, wanted = _packed(odd, [r[1] for r in ODD])
    assert whole == wanted
    given = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    out = op2_packing(spark, SF).toPandas()
    whole, wanted = _packed(out.assign(copy=0), given.text)
    assert whole == wanted
    ordered = out.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    assert ordered.groupby("sequence_id").length.sum().max() <= 1024
    assert pack_documents(spark.createDataFrame([], DOCS)).count() == 0


PIECES = [bytes([b]) for b in range(256)] + [b"ab", b"abcd", b"bc", b"bcde", b" a", b"cda", b" abca"]


@settings(max_examples=300, deadline=None)
@given(st.text("abcde ", max_size=30))
def test_the_automaton_counts_as_greedy_matching(text):
    word, known, count = text.encode(), set(PIECES), 0
    while word:
        n = max(k for k in range(1, len(word) + 1) if word[:k] in known)
        word, count = word[n:], count + 1
    assert Automaton(PIECES).count(text.encode()) == count


def test_token_counts_of_odd_rows(spark):
    out = count_tokens(spark.createDataFrame(ODD, DOCS).withColumnRenamed("note", "n_words")).collect()
    by_text = {r.text: r for r in out}
    assert len(out) == len(ODD) and by_text[None].n_tokens == 0 == by_text[" \t\n"].n_words
    assert by_text["word " * 3000].n_tokens == 3000
    with pytest.raises(ValueError, match="single byte"):
        Automaton([b"a"])


def test_vocabulary_file_has_every_byte():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        assert {bytes([b]) for b in range(256)} <= {base64.b64decode(x.split()[0]) for x in lines}


def test_toxicity_learns_words_and_leaves_clean_texts_alone(spark):
    rng = np.random.default_rng(3)
    clean = [f"w{i}" for i in range(80)]
    rows, labels = [], []
    for i in range(600):
        text = rng.choice(clean, 40).tolist()
        if i % 5 == 0:
            text[7] = ["nasty", "vile"][i % 2]
        rows.append((i, " ".join(text), "s", None))
        labels.append((i, int(i % 5 == 0), 1))
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels, "doc_id long, toxic int, quality int").where(~held_out())
    weights = train(docs, known)
    assert 0 < np.count_nonzero(weights) < DIMENSIONS // 100
    out = score(docs, weights).where(held_out()).collect()
    right = [(r.score >= 0.3) == (r.doc_id % 5 == 0) for r in out]
    assert len(right) > 100 and sum(right) / len(right) > 0.97
    odd = score(spark.createDataFrame(ODD, DOCS), weights).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert {r.score < 0.01 for r in score(docs, train(docs, none)).collect()} == {True}
