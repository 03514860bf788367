"""Operator 10: quotation linking.

A message's lines that begin with '>' are quotes; the number of leading '>' (blanks
between them allowed) is a line's level. A run of consecutive lines of one level is a
passage. Passages are normalised (case, white space, quote marks) and hashed, line by
line, so that a message that quotes a part of another is linked as well. A line links
to the latest earlier message of the conversation that has it as its own text. A
message answers the one that most of its outermost linked quoted lines come from, the
latest of equals; links of deeper levels are counted. Following answers up leads to
the message that a thread began with.

The conversation's reply order puts threads in order of their first messages, and a
thread's messages in order of turns: each message comes after the one it answers.
``position`` numbers it from 0. The text returned has no quotes.

Only DataFrame functions are used. A conversation is not gathered: messages stay rows,
the latest earlier message is found by windows over blocks of ``TURNS`` turns and
their maxima, threads by pointer jumping, and positions from a range-partitioned sort.

Defined cases: a null text has no lines and stays null; a message of quotes alone
becomes empty; repeated rows of a (conv_id, turn) each keep their place, equal ones in
any order; null conv_id and turn sort first, are not linked and do not clash; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrove.llm.common import read, staged

TURNS = 1_024
MARKS = r"^\s*((?:>\s*)+)"


def _level(line: F.Column) -> F.Column:
    """How deep a line is quoted; 0: it is the message's own."""
    marks = F.regexp_extract(line, MARKS, 1)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">")))


def _hash(line: F.Column) -> F.Column:
    bare = F.regexp_replace(line, MARKS, "")
    return F.md5(F.lower(F.trim(F.regexp_replace(bare, r"\s+", " "))))


def _lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, hash of every line that says something."""
    return (
        messages.where("conv_id is not null and turn is not null")
        .select("conv_id", "turn", F.explode(F.split("text", "\n", -1)).alias("line"))
        .select("conv_id", "turn", _level(F.col("line")).alias("level"), F.regexp_replace("line", MARKS, "").alias("bare"))
        .where(F.trim(F.regexp_replace("bare", r"\s+", " ")) != "")
        .select("conv_id", "turn", "level", _hash(F.col("bare")).alias("hash"))
    )


def _linked(lines: DataFrame) -> DataFrame:
    """conv_id, turn, level, source: quoted lines and the message each comes from."""
    quoted = lines.where("level > 0").withColumn("own", F.lit(None).cast("long"))
    asked = quoted.select("conv_id", "hash").distinct()
    own = lines.where("level = 0").join(asked, ["conv_id", "hash"], "left_semi")
    own = own.select("conv_id", "turn", "level", "hash").distinct().withColumn("own", F.col("turn").cast("long"))
    rows = quoted.unionByName(own).withColumn("block", F.floor(F.col("turn") / TURNS))
    # The latest own turn within a block before this one, else of an earlier block.
    within = Window.partitionBy("conv_id", "hash", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "hash", "block").agg(F.max("own").alias("last"))
    before = Window.partitionBy("conv_id", "hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "hash", "block", F.max("last").over(before).alias("earlier"))
    return (
        rows.withColumn("latest", F.max("own").over(within))
        .where("level > 0")
        .join(blocks, ["conv_id", "hash", "block"])
        .select("conv_id", "turn", "level", F.coalesce("latest", "earlier").alias("source"))
    )


def _threads(answers: DataFrame) -> DataFrame:
    """conv_id, turn, root, depth of messages that answer one, by pointer jumping."""
    now = staged(
        answers.select("conv_id", "turn", F.col("answers").alias("root"), F.lit(1).cast("long").alias("depth")), "threads"
    )
    while True:
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        next_ = staged(
            now.join(up, ["conv_id", "root"], "left").select(
                "conv_id",
                "turn",
                F.coalesce("above", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("above").isNotNull().alias("moved"),
            ),
            "threads",
        )
        moved = next_.where("moved").limit(1).count()
        now = next_.drop("moved")
        if not moved:
            return now


def reply_order(messages: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, text without quotes, and its place.

    answers (the turn it answers, null if none), thread (the turn its thread began
    with), depth (answers up to there), n_quoted and n_linked (lines), position.
    """
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    lines = _lines(rows)
    linked = staged(_linked(lines), "linked")
    counts = linked.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n_quoted"), F.count("source").alias("n_linked")
    )
    outermost = linked.where("source is not null").groupBy("conv_id", "turn", "level", "source").agg(F.count(F.lit(1)).alias("n"))
    answers = (
        outermost.groupBy("conv_id", "turn")
        .agg(F.min(F.struct(F.col("level"), -F.col("n"), -F.col("source"))).alias("best"))
        .select("conv_id", "turn", (-F.col("best.col3")).alias("answers"))
    )
    answers = staged(answers, "answers")
    threads = _threads(answers)
    own = F.filter(F.split("text", "\n", -1), lambda x: ~x.rlike(MARKS))
    placed = (
        rows.join(answers, ["conv_id", "turn"], "left")
        .join(threads, ["conv_id", "turn"], "left")
        .join(counts, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            F.when(F.col("text").isNull(), None).otherwise(F.trim(F.array_join(own, "\n"))).alias("text"),
            "answers",
            F.coalesce("root", "turn").alias("thread"),
            F.coalesce("depth", F.lit(0)).alias("depth"),
            F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        )
    )
    return _numbered(placed)


def _numbered(placed: DataFrame) -> DataFrame:
    """``position`` from a sort over all tasks: no conversation is in one task alone.

    A row's number in its sorted partition, plus the rows of the partitions before,
    less the number that its conversation starts with.
    """
    key = ["conv_id", "thread", "turn"]
    ordered = staged(
        placed.orderBy(*key, "role", "text").withColumn("_row", F.monotonically_increasing_id()), "ordered"
    )
    part = F.shiftright("_row", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition.
    starts = sizes.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start")
    )
    numbered = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(
        "_at", F.col("_start") + F.col("_row") - F.shiftleft("_part", 33)
    )
    first = numbered.groupBy("conv_id").agg(F.min("_at").alias("_first")).withColumnRenamed("conv_id", "_conv")
    return numbered.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        *[c for c in placed.columns], (F.col("_at") - F.col("_first")).alias("position")
    )


def op10_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of every conversation, in reply order, without quotes."""
    return reply_order(read(spark, sf_dir, "conversations"))


OP10_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM conversations),
lines AS (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line
  FROM rows WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
parsed AS (
  SELECT conv_id, turn,
         length(regexp_extract(line, '^\s*((?:>\s*)+)', 1))
           - length(replace(regexp_extract(line, '^\s*((?:>\s*)+)', 1), '>', '')) AS level,
         lower(trim(regexp_replace(regexp_replace(line, '^\s*((?:>\s*)+)', ''), '\s+', ' ', 'g'))) AS bare
  FROM lines),
quoted AS (SELECT * FROM parsed WHERE level > 0 AND bare <> ''),
linked AS (
  SELECT q.conv_id, q.turn, q.level, q.bare,
         (SELECT max(o.turn) FROM parsed o
          WHERE o.level = 0 AND o.conv_id = q.conv_id AND o.bare = q.bare AND o.turn < q.turn) AS source
  FROM quoted q),
votes AS (
  SELECT conv_id, turn, level, source, count(*) AS n FROM linked
  WHERE source IS NOT NULL GROUP BY ALL),
answers AS (
  SELECT conv_id, turn, source AS answers FROM votes
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, source DESC) = 1),
up AS (
  SELECT conv_id, turn, answers AS root, 1::BIGINT AS depth FROM answers
  UNION ALL
  SELECT u.conv_id, u.turn, a.answers, u.depth + 1 FROM up u
  JOIN answers a ON a.conv_id = u.conv_id AND a.turn = u.root),
threads AS (
  SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM up GROUP BY ALL),
counts AS (
  SELECT conv_id, turn, count(*) AS n_quoted, count(source) AS n_linked FROM linked GROUP BY ALL)
SELECT r.conv_id, r.turn, r.role,
       CASE WHEN r.text IS NULL THEN NULL ELSE trim(array_to_string(list_filter(
         string_split(r.text, chr(10)), lambda x: NOT regexp_matches(x, '^\s*((?:>\s*)+)')), chr(10)), ' ') END AS text,
       a.answers, coalesce(t.root, r.turn) AS thread, coalesce(t.depth, 0) AS depth,
       coalesce(c.n_quoted, 0) AS n_quoted, coalesce(c.n_linked, 0) AS n_linked,
       row_number() OVER (PARTITION BY r.conv_id
         ORDER BY coalesce(t.root, r.turn) NULLS FIRST, r.turn NULLS FIRST, r.role NULLS FIRST, r.text NULLS FIRST) - 1 AS position
FROM rows r
LEFT JOIN answers a ON a.conv_id = r.conv_id AND a.turn = r.turn
LEFT JOIN threads t ON t.conv_id = r.conv_id AND t.turn = r.turn
LEFT JOIN counts c ON c.conv_id = r.conv_id AND c.turn = r.turn
"""
