"""The pipeline against its stages' contracts, stage by stage on its own input."""

import corpus_pipeline
import pytest

from __spark_entry__ import queries
from tallygrove.llm.near_dedup import near_duplicates
from tallygrove.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = found[name] = spark.read.parquet(str(folder / name))
    return found


def test_stages_return_the_columns_of_documents(stages):
    wanted = stages["documents"].dtypes
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].dtypes == wanted, name


def test_each_stage_keeps_rows_of_its_input_only(stages):
    names = ["documents", *(n for n, _ in corpus_pipeline.STAGES)]
    for before, after in zip(names[:-1], names[1:], strict=True):
        ids = {r.doc_id for r in stages[after].select("doc_id").collect()}
        assert ids <= {r.doc_id for r in stages[before].select("doc_id").collect()}
        assert ids


def test_near_dedup_leaves_one_of_each_group(stages):
    assert near_duplicates(stages["near_dedup"]).where("not kept").count() == 0


def test_run_packs_what_mixing_took(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == stages["packing"].count()
    assert out.agg({"length": "sum"}).first()[0] == stages["packing"].agg({"length": "sum"}).first()[0]


CLASHING = ("lines_left", "removed", "target", "copies", "threshold", "rounds", "source_size", "_toxic", "_copy", "_id",
            "_hits", "row", "score", "hits", "n_links", "copy", "id", "ring")


def test_stages_keep_columns_of_any_name_and_odd_rows(spark):
    line = "a line that is long enough to take part in the dedup of lines"
    texts = [(1, line + "\nown words of one"), (2, line + "\nown words of two"), (3, None), (4, ""), (None, "no id here"),
             (None, "no id here"), (5, "one row that comes twice"), (5, "one row that comes twice"), (6, "word " * 5000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    first = 10**9  # no label has such an id
    rows = [(i and first + i, t, "en", "s", len(t or ""), *(f"{c} {k}" for c in CLASHING)) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        found = [r.asDict() | {"doc_id": r.doc_id and r.doc_id - first} for r in out.collect()]
        values = {tuple(r[c] for c in CLASHING) for r in found}
        assert values <= {r[5:] for r in rows}, name
        assert {3, 4, None} <= {r["doc_id"] for r in found}, name
        if name == "near_dedup":
            assert sorted(r["doc_id"] or 0 for r in found) == [0, 0, 1, 3, 4, 5, 6]  # 2 is a near copy of 1
        if name == "line_dedup":
            assert {r["text"] for r in found if r["doc_id"] == 2} == {"own words of two"}
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert corpus_pipeline.packing(spark, docs, SF).where(f"doc_id = {first + 6}").agg({"length": "sum"}).first()[0] > 1000
    assert corpus_pipeline.packing(spark, docs.limit(0), SF).count() == 0


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert {"pipeline", *QUERIES} <= set(queries())
