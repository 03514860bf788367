"""From raw documents to packed training sequences.

toxicity -> line dedup -> MinHash near-dedup -> mixing -> packing

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns the columns of ``documents`` (the last one: packed pieces). ``run`` writes
every stage to the shared folder and reads it back, so a lost executor costs at most
one stage's work.

* toxicity: documents that the classifier rejects go. It learns from the labels of
  the rows not held out.
* line_dedup: lines that an equal or nearly equal line precedes go. A document that
  consisted of such lines alone goes as well; one that was empty before stays.
* near_dedup: one document of each group stays. Of rows equal in doc_id and text one
  stays; rows of one doc_id with different texts are one document, which stays or goes
  as a whole; rows with a null doc_id take no part and stay.
* mixing: a document is taken as often as its source's budget says: its row is
  repeated, or left out.
* packing: repeated rows are packed like any others.

Columns that a stage does not need go through it in one struct, so that whatever their
names are, they come out as they went in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions import named
from tallygrove.llm.common import read, staged
from tallygrove.llm.line_dedup import dedup_lines
from tallygrove.llm.mixing import budgets, mix, sized
from tallygrove.llm.near_dedup import near_duplicates
from tallygrove.llm.packing import pack_documents
from tallygrove.llm.toxicity import THRESHOLD, held_out, score, train


NEEDED = ("doc_id", "text", "source")


def _narrow(docs: DataFrame) -> DataFrame:
    """doc_id, text, source and row, which holds all other columns."""
    others = [named(c) for c in docs.columns if c not in NEEDED] or [F.lit(None).alias("none")]
    return docs.select(*NEEDED, F.struct(*others).alias("row"))


def _wide(rows: DataFrame, docs: DataFrame, **new: F.Column) -> DataFrame:
    """The columns of ``docs``, those in ``new`` replaced."""
    given = {c: F.col(c) if c in NEEDED else F.col("row")[c] for c in docs.columns} | new
    return rows.select(*(given[c].alias(c) for c in docs.columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where(~held_out())
    rows = _narrow(docs)
    return _wide(score(rows, train(rows, labels)).where(F.col("score") < THRESHOLD), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(_narrow(docs)).where("lines_removed = 0 or lines_left > 0")
    new = {}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return _wide(cleaned, docs, **new)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dropped = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti")
    # Ids that come more than once, if any: of their equal texts one stays.
    often = staged(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "often")
    if not often.isEmpty():
        several = _narrow(kept.join(often, "doc_id", "left_semi")).dropDuplicates(["doc_id", "text"])
        kept = kept.join(often, "doc_id", "left_anti").select(*map(named, docs.columns)).union(_wide(several, docs))
    return kept.select(*map(named, docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _narrow(docs)
    taken = mix(rows, budgets(sized(rows))).where("copies > 0")
    return _wide(taken.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: A learned score, edit distances and signatures have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
