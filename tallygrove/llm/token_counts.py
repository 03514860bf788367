"""Operator 5: greedy longest-match token counts by a linear automaton.

A word's pieces under greedy longest match are found in one pass over its bytes: the
vocabulary is a trie; a node that cannot go on with the next byte fails over to the
node of what remains once its longest pieces are taken off the front. How many
pieces that takes off is precomputed for each node, so counting needs no pieces.

Words are what white space (of bytes: blank, tab, line feed, vertical tab, form feed,
carriage return) separates; a word is matched with one blank in front, as the
vocabulary has its pieces for beginnings of words. All 256 single bytes are pieces,
so each word has a length. Counts of words are kept in a worker, up to a limit.

The vocabulary is a file of base64 pieces, a few ten thousand and not derived from the
corpus; its automaton is built once in each worker.

Defined cases: null and empty texts and texts of white space have 0 tokens and 0 words;
rows with the same or a null doc_id are counted one by one; an empty table gives an
empty result; other columns are kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm.common import read

#: Words whose counts a worker keeps before it starts afresh.
KEPT_WORDS = 1_000_000
ROOT = 0


class Automaton:
    """Trie, failure links and numbers of pieces popped on failing over."""

    def __init__(self, vocabulary: list[bytes]):
        self.go: dict[int, int] = {}
        is_piece = [False]
        parent = [(ROOT, 0)]
        for piece in vocabulary:
            node = ROOT
            for byte in piece:
                key = node << 8 | byte
                if key not in self.go:
                    self.go[key] = len(is_piece)
                    is_piece.append(False)
                    parent.append((node, byte))
                node = self.go[key]
            is_piece[node] = node != ROOT
        if any(byte not in self.go or not is_piece[self.go[byte]] for byte in range(256)):
            raise ValueError("the vocabulary must have every single byte")
        self.fail = [ROOT] * len(is_piece)
        self.popped = [0] * len(is_piece)
        depth = [0] * len(is_piece)
        for node in range(1, len(is_piece)):  # parents come before children
            depth[node] = depth[parent[node][0]] + 1
        for node in sorted(range(1, len(is_piece)), key=depth.__getitem__):
            if is_piece[node]:
                self.popped[node] = 1
                continue
            above, byte = parent[node]
            at, popped = self.fail[above], self.popped[above]
            while (at << 8 | byte) not in self.go:
                popped += self.popped[at]
                at = self.fail[at]
            self.fail[node] = self.go[at << 8 | byte]
            self.popped[node] = popped

    def count(self, word: bytes) -> int:
        """How many pieces greedy longest match cuts ``word`` into."""
        go, fail, popped = self.go, self.fail, self.popped
        node = count = 0
        for byte in word:
            key = node << 8 | byte
            while key not in go:
                count += popped[node]
                node = fail[node]
                key = node << 8 | byte
            node = go[key]
        while node:
            count += popped[node]
            node = fail[node]
        return count


class _Counts(dict):
    """Counts of words, found when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as lines:
            self.automaton = Automaton([base64.b64decode(line.split()[0]) for line in lines if line.strip()])

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self.automaton.count(b" " + word)
        return value


_loaded: dict[str, _Counts] = {}


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with n_words and n_tokens of its ``text``."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")

    @F.pandas_udf("n_words long, n_tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if path not in _loaded:
            _loaded[path] = _Counts(path)
        counts = _loaded[path]
        for texts in batches:
            n_words, n_tokens = [], []
            for text in texts:
                found = (text or "").encode("utf-8", "replace").split()
                n_words.append(len(found))
                n_tokens.append(sum(map(counts.__getitem__, found)))
                if len(counts) > KEPT_WORDS:
                    counts.clear()
            yield pd.DataFrame({"n_words": n_words, "n_tokens": n_tokens}, dtype="int64")

    return docs.withColumn("_counted", counted(F.col("text"))).select(
        *[docs[c] for c in docs.columns if c not in ("n_words", "n_tokens")],
        F.col("_counted.n_words").alias("n_words"),
        F.col("_counted.n_tokens").alias("n_tokens"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every document."""
    return count_tokens(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_tokens"
    )
