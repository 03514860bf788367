"""S1, S2, S3, K1, K3, K4, C1."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallygrove.operators import prepare_table
from tallygrove.sources import (
    held,
    leaving_nothing,
    preview,
    read_table,
    report_lines,
    shared_dir,
    shared_path,
    stage,
    write_scored,
)


def _file(tmp_path, text):
    path = tmp_path / "table.csv"
    path.write_text(text)
    return str(path)


def test_s1_types_are_inferred(spark, tmp_path):
    df = read_table(spark, _file(tmp_path, "a b,c,d\n1,2.5,x\n3,4.0,y\n"))
    assert df.dtypes == [("a b", "int"), ("c", "double"), ("d", "string")]
    assert rows(df) == [(1, 2.5, "x"), (3, 4.0, "y")]


def test_s1_header_only_file_is_empty_and_textual(spark, tmp_path):
    df = read_table(spark, _file(tmp_path, "a,b\n"))
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.count() == 0


def test_s1_inference_short_rows_give_null_and_extra_fields_are_ignored(spark, tmp_path):
    df = read_table(spark, _file(tmp_path, "a,b\n1,2\n3\n4,5,6\n"))
    assert sorted(map(tuple, df.collect()), key=str) == [(1, 2), (3, None), (4, 5)]


def test_s1_declared_schema_is_checked_against_the_header(spark, tmp_path):
    path = _file(tmp_path, "a,b\n1,2\n")
    assert rows(read_table(spark, path, schema="a int, b double")) == [(1, 2.0)]
    with pytest.raises(Exception, match="header does not conform"):
        read_table(spark, path, schema="b int, a double").collect()


def test_s1_declared_schema_raises_on_text_that_does_not_parse(spark, tmp_path):
    path = _file(tmp_path, "a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_table(spark, path, schema="a int, b double").collect()
    lenient = read_table(spark, path, schema="a int, b double", mode="PERMISSIVE")
    assert rows(prepare_table(lenient, "a", ["b"])) == [(1, 2.0)]


def test_s1_scan_reads_only_the_columns_used(spark, tmp_path):
    path = _file(tmp_path, "a,b,c\n1,2,3\n")
    df = read_table(spark, path, schema="a int, b int, c int").select("b")
    assert "ReadSchema: struct<b:int>" in plan_of(df)


def test_s2_separator_and_quote(spark, tmp_path):
    text = '"a";"b"\n1;"x;y"\n2;z\n'
    assert rows(read_table(spark, _file(tmp_path, text), sep=";")) == [(1, "x;y"), (2, "z")]
    text = "'a';'b'\n1;'x;y'\n"
    assert rows(read_table(spark, _file(tmp_path, text), sep=";", quote="'")) == [(1, "x;y")]


def test_s2_wrong_separator_gives_a_clear_error(spark, tmp_path):
    df = read_table(spark, _file(tmp_path, "a;b\n1;2\n"))
    with pytest.raises(ValueError, match=r"missing columns .*separator"):
        prepare_table(df, "a", ["b"])


def test_s3_any_uri_scheme_of_the_session(spark, tmp_path):
    path = _file(tmp_path, "a,b\n1,2\n")
    assert rows(read_table(spark, f"file://{path}")) == [(1, 2)]
    with pytest.raises(Exception, match="nosuchscheme"):
        read_table(spark, "nosuchscheme://bucket/table.csv")


def test_s3_several_files_are_one_table(spark, tmp_path):
    for name in "pq":
        (tmp_path / f"{name}.csv").write_text("a,b\n1,2\n")
    paths = [str(tmp_path / "p.csv"), str(tmp_path / "q.csv")]
    assert rows(read_table(spark, paths)) == [(1, 2), (1, 2)]
    assert rows(read_table(spark, str(tmp_path))) == [(1, 2), (1, 2)]


def test_k1_write_replaces_earlier_rows_and_raises_on_failure(spark, tmp_path):
    path = str(tmp_path / "out")
    write_scored(spark.range(5), path)
    write_scored(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    bad = spark.range(3).select((F.lit(1) / F.col("id")).alias("x"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_scored(bad, path)


def test_k3_preview_is_top_n_without_a_full_sort(spark):
    df = spark.range(50).selectExpr("id AS features", "id AS label", "id AS prediction", "id AS x")
    assert preview(df).count() == 5 and preview(df).columns == ["features", "label", "prediction"]
    ordered = preview(df, 3, order_by=[F.desc("x")])
    assert [r.label for r in ordered.collect()] == [49, 48, 47]
    assert "TakeOrderedAndProject" in plan_of(ordered)


def test_k4_report_lines_follow_the_order_of_names(spark):
    found = [Row(metric="b", value=2.0), Row(metric="a", value=0.5)]
    assert list(report_lines(found, {"a": "Alpha", "b": "Beta"})) == ["Alpha: 0.5", "Beta: 2.0"]


def test_shared_folder_is_the_sessions(spark):
    session = _Session(spark_master="local[2]", spark_checkpoint_dir="file:///shared/dir/")
    assert shared_dir(session) == "file:///shared/dir"
    assert shared_path(session, "x").startswith("file:///shared/dir/x-")
    assert shared_path(session, "x") != shared_path(session, "x")
    assert shared_path(spark, "x").startswith(shared_dir(spark))


class _Session:
    """Stands in for a session whose settings a running one cannot change."""

    def __init__(self, **settings):
        self.conf = self
        self._settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self._settings.get(key, default)

    def set(self, key, value):
        self._settings[key] = value


def test_shared_folder_is_required_on_a_cluster_and_made_up_locally():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session(spark_master="spark://host:7077"))
    local = _Session(spark_master="local[2]")
    assert shared_dir(local) == shared_dir(local)
    assert shared_dir(_Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///c/")) == "hdfs:///c"


def test_stage_writes_below_the_shared_folder_and_cuts_the_plan(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    staged = stage(df, "t")
    assert rows(staged) == rows(df)
    plan = plan_of(staged)
    assert shared_dir(spark) in plan and "Range" not in plan


@pytest.mark.parametrize("reuse", ["rescan", "stage", "cache"])
def test_c1_every_way_of_reuse_gives_the_same_rows(spark, reuse):
    df = spark.range(10)
    with held(df, reuse) as kept:
        assert rows(kept) == rows(df)
        assert kept.storageLevel.useMemory == (reuse == "cache")
    assert not df.storageLevel.useMemory


def test_c1_the_staged_copy_is_deleted_even_after_a_failure(spark):
    with pytest.raises(RuntimeError), held(spark.range(10), "stage") as kept:
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(path).count() == 10
        raise RuntimeError
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_c1_a_scope_deletes_what_was_staged_within_it(spark):
    outside = stage(spark.range(3), "t")
    with pytest.raises(RuntimeError), leaving_nothing(spark):
        with leaving_nothing(spark):
            inner = stage(spark.range(4), "t").inputFiles()[0].rsplit("/", 1)[0]
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(inner)
        outer = stage(spark.range(5), "t").inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(outer).count() == 5
        raise RuntimeError
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(outer)
    assert outside.count() == 3


def test_c1_unknown_way_of_reuse(spark):
    with pytest.raises(ValueError), held(spark.range(1), "forever"):
        pass
