"""Whole queries and the whole pipeline against plain versions, on the smallest tables."""

import base64
import collections
import hashlib
import itertools
import math
import random
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest

from tallygrove.llm.common import multiset_jaccard, shingles
from tallygrove.llm.line_dedup import MIN_CHARS, TAU, normal, within
from tallygrove.llm.mixing import OP1_SQL
from tallygrove.llm.quotes import OP10_SQL, reply_order
from tallygrove.llm.token_counts import op5_token_counts
from tallygrove.llm.toxicity import L1, L2, PASSES, RATE, RATE_BASE, THRESHOLD, features, op8_toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").toPandas()


# -- token counts --------------------------------------------------------------------


def test_token_counts_equal_greedy_matching(spark, documents):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        known = {base64.b64decode(line.split()[0]) for line in lines if line.strip()}
    longest = max(map(len, known))

    def greedy(word):
        count = 0
        while word:
            n = next(n for n in range(min(longest, len(word)), 0, -1) if word[:n] in known)
            word, count = word[n:], count + 1
        return count

    wanted = {}
    for doc_id, text in zip(documents.doc_id, documents.text, strict=True):
        words = (text or "").encode().split()
        wanted[doc_id] = len(words), sum(greedy(b" " + w) for w in words)
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in op5_token_counts(spark, SF).collect()} == wanted


# -- toxicity ------------------------------------------------------------------------


def _held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def _plain_scores(spark, documents):
    """doc_id to score, by a loop over one coordinate after the other."""
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = {i: features(t).tolist() for i, t in zip(documents.doc_id, documents.text, strict=True)}
    learned = [i for i in rows if labels.get(i) is not None and not _held_out(i)]
    learned.sort(key=lambda i: int(hashlib.md5(f"toxicity{i}".encode()).hexdigest()[:8], 16))
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(c):
        shrink = 0.0 if c == "bias" else L1
        if abs(z[c]) <= shrink:
            return 0.0
        return -(z[c] - math.copysign(shrink, z[c])) / ((RATE_BASE + math.sqrt(n[c])) / RATE + L2)

    for _ in range(PASSES):
        for i in learned:
            w = {c: weight(c) for c in [*rows[i], "bias"]}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - labels[i]
            for c, now in w.items():
                step = (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / RATE
                z[c] += g - step * now
                n[c] += g * g
    final = {c: weight(c) for c in z}
    return {i: 1 / (1 + math.exp(-sum(final.get(c, 0.0) for c in [*row, "bias"]))) for i, row in rows.items()}


def test_toxicity_equals_a_plain_learner(spark, documents):
    wanted = _plain_scores(spark, documents)
    out = op8_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(wanted)
    assert len({round(s, 3) for s in wanted.values()}) > 10
    for r in out:
        assert abs(r.score - wanted[r.doc_id]) < 1e-5
        assert r.held_out == _held_out(r.doc_id) and r.predicted == int(r.score >= THRESHOLD)


# -- quotations ----------------------------------------------------------------------


def _talk(seed, conversations=12, hot=260):
    """Messages that quote parts of earlier ones, which quote others in turn."""
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        bodies = []
        for turn in range(hot if conv == 3 else rng.randint(1, 25)):
            lines = []
            # The hot conversation is mostly one long chain of answers.
            for source in [turn - 1 if conv == 3 and rng.random() < 0.9 else rng.randrange(turn)] if turn else []:
                if conv == 3 or rng.random() < 0.8:
                    quoted = bodies[source].split("\n")
                    # In the hot one always from the first line that is its own.
                    own = next((i for i, line in enumerate(quoted) if line and not line.lstrip().startswith(">")), 0)
                    first = own if conv == 3 else rng.randrange(len(quoted))
                    mark = rng.choice(["> ", ">", " > "])
                    part = quoted[first : first + rng.randint(1, 4)]
                    lines += [mark + (line.upper() if rng.random() < 0.2 else line) for line in part if line.count(">") < 3]
            lines += [f"{rng.choice(['yes', 'no', 'maybe'])} {rng.randrange(4 * turn + 4)}" for _ in range(rng.randint(conv == 3, 3))]
            lines += rng.choice([[], [""], ["> never said by anyone"], ["the same words in every message"]])
            bodies.append("\n".join(lines))
            rows.append((conv, turn, rng.choice(["user", "assistant"]), bodies[-1]))
    rng.shuffle(rows)
    return rows


def test_quotes_equal_their_sql_on_long_talks(spark):
    rows = _talk(7)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = con.execute(OP10_SQL)
    columns = [c[0] for c in found.description]
    wanted = found.fetchall()
    out = reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(map(tuple, out.select(*columns).collect()), key=repr) == sorted(wanted, key=repr)
    depth, linked = columns.index("depth"), columns.index("n_linked")
    assert max(r[depth] for r in wanted) > 30 and sum(r[linked] for r in wanted) > 300


# -- pipeline ------------------------------------------------------------------------


def _plain_line_dedup(docs):
    """doc_id to text, without lines that an equal or nearly equal one precedes."""
    first = {}
    for doc_id, text in sorted(docs.items()):
        for i, line in enumerate((text or "").split("\n")):
            if normal(line):
                first.setdefault(normal(line), (doc_id, i))
    by_length = collections.defaultdict(list)
    for line in first:
        if len(line) >= MIN_CHARS:
            by_length[len(line)].append(line)
    near = set()
    for n, lines in by_length.items():
        pairs = itertools.chain(itertools.combinations(lines, 2), *(itertools.product(lines, by_length.get(n + k, [])) for k in range(1, TAU + 1)))
        near.update(max(p, key=first.get) for p in pairs if within(*p))
    out = {}
    for doc_id, text in docs.items():
        lines = list(enumerate((text or "").split("\n")))
        kept = [x for i, x in lines if not normal(x) or (first[normal(x)] == (doc_id, i) and normal(x) not in near)]
        if len(kept) == len(lines) or kept:
            out[doc_id] = text if text is None else "\n".join(kept)
    return out


def _plain_near_dedup(docs):
    """doc_id to text, the smallest id of each group of near copies."""
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = sorted(((shingles(t), i) for i, t in docs.items()), key=lambda e: len(e[0]))
    for k, (a, i) in enumerate(sets):
        for b, j in sets[k + 1 :]:
            if len(a) < 0.8 * len(b):
                break
            if len(a) and multiset_jaccard(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: t for i, t in docs.items() if find(i) == i}


def _plain_mixing(docs):
    """(doc_id, size) to copies; of documents without words any number may be taken."""
    con = duckdb.connect()
    con.register("documents", docs)
    return {r[0]: r[1] // r[2] for r in con.execute(f"SELECT doc_id, taken, size FROM ({OP1_SQL}) WHERE size > 0").fetchall()}


def _plain_pieces(texts):
    """ids_crc32 of all pieces."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = collections.Counter()
    for text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        out.update(zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True))
    return out


def test_every_stage_equals_a_plain_version_on_its_own_input(spark, documents, tmp_path):
    assert documents.doc_id.is_unique
    before = documents
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, spark.createDataFrame(before), SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name)).toPandas()
        texts = dict(zip(before.doc_id, before.text, strict=True))
        got = dict(zip(after.doc_id, after.text, strict=True)) if "text" in after else None
        if name == "toxicity":
            scores = _plain_scores(spark, before)
            assert got == {i: t for i, t in texts.items() if scores[i] < THRESHOLD}
        elif name == "line_dedup":
            assert got == _plain_line_dedup(texts) != texts
            assert list(after.n_chars) == [len(t or "") for t in after.text]
        elif name == "near_dedup":
            assert got == _plain_near_dedup(texts)
        elif name == "mixing":
            copies = collections.Counter(after.doc_id)
            assert {i: n for i, n in _plain_mixing(before).items() if n} == {i: n for i, n in copies.items() if texts[i].split()}
            assert all(texts[i] == t for i, t in got.items())
        else:
            assert collections.Counter(after.ids_crc32) == _plain_pieces(before.text)
            ordered = after.sort_values(["sequence_id", "offset"])
            assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
        before = after
