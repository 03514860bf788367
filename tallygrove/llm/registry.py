"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrove.llm.embedding_dedup import op6_embedding_dedup
from tallygrove.llm.exact_search import OP13_SQL, op13_exact_search
from tallygrove.llm.line_dedup import op7_line_dedup
from tallygrove.llm.mixing import OP1_SQL, op1_mixing
from tallygrove.llm.near_dedup import op9_near_dedup
from tallygrove.llm.neighbours import op4_neighbours
from tallygrove.llm.packing import op2_packing
from tallygrove.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from tallygrove.llm.quotes import OP10_SQL, op10_quotes
from tallygrove.llm.span_dedup import OP3_SQL, op3_span_dedup
from tallygrove.llm.token_counts import op5_token_counts
from tallygrove.llm.toxicity import op8_toxicity
from tallygrove.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_span_dedup": op3_span_dedup,
    "op4_neighbours": op4_neighbours,
    "op5_token_counts": op5_token_counts,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_near_dedup": op9_near_dedup,
    "op10_quotes": op10_quotes,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whitening": op12_whitening,
    "op13_exact_search": op13_exact_search,
}

#: A token automaton, learned scores, eigenvectors, edit distances and signatures have no SQL; tests
#: hold those queries against plain computations.
ORACLES: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op3_span_dedup": OP3_SQL,
    "op10_quotes": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_exact_search": OP13_SQL,
}
