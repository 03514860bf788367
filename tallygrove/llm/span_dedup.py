"""Operator 3: substring dedup by hashing lines or paragraphs, and sentences within them.

A text is cut into units, lines by default, whose places in it (start, stop, in
characters) are kept. A unit is normalised (lower case, each run of white space one
blank, none at the ends) and hashed. Digests are grouped over all documents; the
occurrence that ranks first, by doc_id and then by place, stays, all others are
removed. Every unit that is not empty takes part; ``min_words`` leaves shorter ones alone.

A passage may repeat within lines that differ. So a line is cut again, before each
sentence of ``SENTENCE`` words or more (shorter ones go with the one before them), and
these parts are hashed and ranked along with the lines. Within a line that stays,
neighbouring parts that all stand somewhere before are removed if they have ``run_words``
words or more together; a lone short sentence stays. The cuts follow from the words
around them, so a passage is cut alike wherever it stands, but for the sentences that its
ends cut through: those stay. ``run_words=None`` leaves the insides of lines alone.
Whatever is removed, the first occurrence of it stays.

Digests that occur once are gone after the first
aggregation, whose minima are found before the shuffle, so a frequent line is one row
per task there; only the numbers of removed units meet the documents again, which are
rebuilt in one pass over their units.

Defined cases: a null text has no units and stays null; an empty text stays empty; of
equal units within a document the first stays; equal rows keep or lose the same
units; rows of one doc_id with different texts are told apart by their texts' hash;
rows with a null doc_id are left as they are and remove nothing; a line of which all
parts go stays as an empty line; an empty table gives an empty result; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.llm.common import read, staged

MIN_WORDS = 1
#: Words that neighbouring parts of a line need to be removed: what is left of a passage
#: of 50 words when the sentences at its ends are cut through.
RUN_WORDS = 25
#: Words of a sentence that begins a part.
SENTENCE = 4
#: A unit that stands in more than one of so many places is heavy: fewer than that many are.
HEAVY = 1_000
#: Texts that are rebuilt at a time.
REBUILT = 500
SPAN = ("start", "stop", "first_doc_id")
SPANS = pa.list_(pa.struct([(name, pa.int64()) for name in SPAN]))
#: What separates units.
ENDS = {"line": "\n", "paragraph": "\n\n"}
BLANK = r" \t\r\n\x0B\f"
STOP = ".!?。！？"
#: The end of a sentence, and the beginning of the next with SENTENCE words in it.
CUT = rf"([{STOP}])([{BLANK}]*(?:[^{STOP}{BLANK}]+[{BLANK}]+){{{SENTENCE - 1}}}[^{STOP}{BLANK}])"
#: The same in a normalised unit.
NORMAL_CUT = rf"([{STOP}]) ?((?:[^{STOP} ]+ ){{{SENTENCE - 1}}}[^{STOP} ])"
#: Marks a cut; in a text it counts as a blank when parts are cut.
MARK = "\x01"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("row_hash"))


def _normal(text: str | Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, f"[{BLANK}]+", " ")))


def _words(normal: str) -> Column:
    return F.length(normal) - F.length(F.replace(normal, F.lit(" "))) + 1


def units(
    docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, run_words: int | None = RUN_WORDS
) -> DataFrame:
    """doc_id, row_hash, n (a unit's number), m (its part's, from 1; 0 for the unit), digest."""
    lines = (
        _keyed(docs)
        .where("doc_id is not null and text is not null")
        .select("doc_id", "row_hash", F.posexplode(F.transform(F.split("text", ENDS[unit], -1), _normal)).alias("n", "whole"))
        .where("whole <> ''")
    )
    if run_words is None:
        found = lines.select("doc_id", "row_hash", "n", F.lit(0).alias("m"), F.col("whole").alias("normal"))
    else:
        blank = F.trim(F.regexp_replace(F.translate("whole", MARK, " "), " +", " "))
        marked = F.regexp_replace("bare", NORMAL_CUT, f"$1{MARK}$2")
        found = (
            lines.withColumn("bare", F.when(F.contains("whole", F.lit(MARK)), blank).otherwise(F.col("whole")))
            .withColumn("parts", F.concat(F.array("whole"), F.split(marked, MARK, -1)))
            .select("doc_id", "row_hash", "n", "bare", F.posexplode("parts").alias("m", "normal"))
            # A unit that is one part is only itself.
            .where("not (m = 1 and normal = bare)")
        )
    least = F.when(F.col("m") == 0, F.lit(min_words)).otherwise(F.lit(max(SENTENCE, min_words)))
    return (
        found.where("normal <> ''")
        .where(_words("normal") >= least)
        .select("doc_id", "row_hash", "n", "m", F.unhex(F.md5("normal")).alias("digest"))
    )


def dedup_units(
    docs: DataFrame, *, unit: str = "line", min_words: int = MIN_WORDS, run_words: int | None = RUN_WORDS
) -> DataFrame:
    """doc_id, text without repeated units, n_removed and removed, per document.

    ``removed`` lists (start, stop, first_doc_id) in the original text's characters;
    a removed unit takes the separator behind it along, or the one before it if it
    is the last; a removed part of a unit takes nothing along.
    """
    end = ENDS[unit]
    place = F.struct("doc_id", "n", "m", "row_hash")
    found = staged(units(docs, unit, min_words, run_words), "units")
    repeated = (
        found.groupBy("digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .select("digest", "first", (F.col("times") * HEAVY > found.count()).alias("heavy"))
    )
    repeated = staged(repeated, "repeated")
    # Places of a heavy unit stay where they are: its row comes to them.
    heavy = F.broadcast(repeated.where("heavy"))
    light = found.join(heavy, "digest", "left_anti").join(repeated.where("not heavy"), "digest")
    gone = (
        found.join(heavy, "digest")
        .unionByName(light)
        .where(place != F.col("first"))
        .select("doc_id", "row_hash", F.struct("n", "m", F.col("first.doc_id").alias("first_doc_id")).alias("hit"))
        .distinct()
        # As many as a document has units.
        .groupBy("doc_id", "row_hash")
        .agg(F.collect_list("hit").alias("hits"))
    )
    joined = _keyed(docs).join(gone, ["doc_id", "row_hash"], "left").select("doc_id", "text", "hits")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, REBUILT):
                batch = whole.slice(at, REBUILT)
                texts, spans = [], []
                for text, hits in zip(batch.column(1), batch.column(2), strict=True):
                    gone = {(h["n"], h["m"]): h["first_doc_id"] for h in hits.as_py() or ()}
                    kept, removed = without(text.as_py(), gone, end, run_words or 0)
                    texts.append(kept)
                    spans.append(removed)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(texts, pa.string()),
                        pa.array([len(r) for r in spans], pa.int32()),
                        pa.array([[dict(zip(SPAN, x, strict=True)) for x in r] for r in spans], SPANS),
                    ],
                    ["doc_id", "text", "n_removed", "removed"],
                )

    return joined.mapInArrow(
        rebuild, "doc_id long, text string, n_removed int, removed array<struct<start:long,stop:long,first_doc_id:long>>"
    )


_CUT = re.compile(CUT)
_BLANKS = re.compile(f"[{BLANK}]+")


def parts_of(unit: str) -> list[tuple[int, int]]:
    """Where the parts of a unit start and stop, as ``units`` cuts them."""
    at = [0, *(m.end(1) for m in _CUT.finditer(unit.replace(MARK, " "))), len(unit)]
    return list(zip(at, at[1:], strict=False))


def n_words(part: str) -> int:
    return len(_BLANKS.sub(" ", part.replace(MARK, " ")).strip(" ").split(" "))


def runs(unit: str, repeated: set[int], run_words: int) -> list[tuple[int, int, int]]:
    """Number, start and stop of the parts in runs of repeated ones that are long enough."""
    out, run, size = [], [], 0
    for m, (start, stop) in enumerate([*parts_of(unit), (0, 0)], 1):
        if m in repeated:
            run.append((m, start, stop))
            size += n_words(unit[start:stop])
        else:
            out += run if size >= run_words else []
            run, size = [], 0
    return out


def without(
    text: str | None, gone: dict[tuple[int, int], int], end: str, run_words: int = RUN_WORDS
) -> tuple[str | None, list[tuple[int, int, int]]]:
    """A text less what ``gone`` names (first_doc_id by unit and part), and its places."""
    if not gone:
        return text, []
    inner = defaultdict(set)
    for n, m in gone:
        if m:
            inner[n].add(m)
    kept, removed, start = [], [], 0
    for n, unit in enumerate(text.split(end)):
        if (n, 0) in gone:
            removed.append((start, start + len(unit), gone[n, 0]))
        else:
            left, at = "", 0
            for m, first, stop in runs(unit, inner[n], run_words) if n in inner else ():
                removed.append((start + first, start + stop, gone[n, m]))
                left, at = left + unit[at:first], stop
            kept.append(left + unit[at:])
        start += len(unit) + len(end)
    return end.join(kept), removed


def op3_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, n_removed, spans ("start-stop,...") of every document."""
    spans = F.transform("removed", lambda r: F.concat_ws("-", r["start"], r["stop"]))
    return dedup_units(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "text", "n_removed", F.array_join(spans, ",").alias("spans")
    )


OP3_SQL = rf"""
WITH cut AS (
  SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, unnest(p) AS unit, generate_subscripts(p, 1) AS n FROM cut),
placed AS (
  SELECT *, sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY n) - length(unit) - 1 AS start,
         string_split(regexp_replace(replace(unit, chr(1), ' '), '{CUT}', '\1' || chr(1) || '\2', 'g'), chr(1)) AS p
  FROM lines),
inside AS (
  SELECT doc_id, n, start, unit, unnest(p) AS part, generate_subscripts(p, 1) AS m FROM placed WHERE len(p) > 1),
units AS (
  SELECT doc_id, n, 0 AS m, start, unit FROM placed
  UNION ALL
  SELECT doc_id, n, m, start + before, substring(unit, before + 1, length(part)) FROM (
    SELECT *, (sum(length(part)) OVER (PARTITION BY doc_id, n ORDER BY m) - length(part))::BIGINT AS before
    FROM inside)),
normal AS (
  SELECT *, lower(trim(regexp_replace(CASE WHEN m > 0 THEN replace(unit, chr(1), ' ') ELSE unit END,
                                      '[{BLANK}]+', ' ', 'g'))) AS bare FROM units),
counted AS (
  SELECT *, len(string_split(bare, ' ')) AS words, bare <> '' AND (m = 0 OR words >= {SENTENCE}) AS part FROM normal),
ranked AS (
  SELECT *, part AND row_number() OVER (PARTITION BY bare, part ORDER BY doc_id, n, m) > 1 AS again FROM counted),
islands AS (
  SELECT *, m - row_number() OVER (PARTITION BY doc_id, n, m > 0, again ORDER BY m) AS island,
         bool_or(again AND m = 0) OVER (PARTITION BY doc_id, n) AS line_gone
  FROM ranked),
decided AS (
  SELECT *, CASE WHEN m = 0 THEN again
                 ELSE again AND NOT line_gone
                      AND sum(words) OVER (PARTITION BY doc_id, n, m > 0, again, island) >= {RUN_WORDS} END AS gone
  FROM islands),
remade AS (
  SELECT doc_id, n, any_value(line_gone) AS line_gone,
         CASE WHEN max(m) = 0 THEN any_value(unit)
              ELSE coalesce(string_agg(unit, '' ORDER BY m) FILTER (m > 0 AND NOT gone), '') END AS unit,
         count(*) FILTER (gone) AS n_removed,
         string_agg(start || '-' || (start + length(unit)), ',' ORDER BY m) FILTER (gone) AS spans
  FROM decided GROUP BY doc_id, n),
rebuilt AS (
  SELECT doc_id, coalesce(string_agg(unit, chr(10) ORDER BY n) FILTER (NOT line_gone), '') AS text,
         sum(n_removed)::INT AS n_removed, coalesce(string_agg(spans, ',' ORDER BY n), '') AS spans
  FROM remade GROUP BY doc_id)
SELECT d.doc_id, r.text, coalesce(r.n_removed, 0) AS n_removed, coalesce(r.spans, '') AS spans
FROM documents d LEFT JOIN rebuilt r ON d.doc_id = r.doc_id
"""
