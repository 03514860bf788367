"""R1-R5, R7, M1."""

import math

import pytest
from conftest import plan_of, rows
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array

from tallygrove.operators import assemble, prepare_table


def test_r1_r2_label_first_then_features_in_the_given_order(spark):
    df = spark.createDataFrame([(1.0, 2, 3.0, "x")], "`a b` double, y int, c double, extra string")
    flat = prepare_table(df, "y", ["c", "a b"])
    assert flat.dtypes == [("label", "int"), ("c", "double"), ("a b", "double")]
    assert rows(flat) == [(2, 3.0, 1.0)]


def test_r1_names_resolve_without_regard_to_case(spark):
    df = spark.createDataFrame([(1, 2.0)], "Y int, PH double")
    assert prepare_table(df, "y", ["pH"]).columns == ["label", "pH"]


def test_r1_case_matters_when_the_session_says_so(spark):
    df = spark.createDataFrame([(1, 2.0)], "Y int, a double")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="missing"):
            prepare_table(df, "y", ["a"])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_r1_table_renamed_before_is_accepted(spark):
    df = spark.createDataFrame([(1, 2.0)], "label int, a double")
    assert rows(prepare_table(df, "y", ["a"])) == [(1, 2.0)]


def test_r1_target_wins_over_an_unrelated_label_column(spark):
    df = spark.createDataFrame([(1, 9, 2.0)], "y int, label int, a double")
    assert rows(prepare_table(df, "y", ["a"])) == [(1, 2.0)]


def test_r2_missing_columns_are_listed(spark):
    df = spark.createDataFrame([(1, 2.0)], "y int, a double")
    with pytest.raises(ValueError, match=r"\['b', 'c'\]"):
        prepare_table(df, "y", ["a", "b", "c"])


def test_r3_null_or_nan_in_any_selected_column_drops_the_row(spark):
    df = spark.createDataFrame(
        [
            (1, 1.0, 1, None),
            (None, 1.0, 1, "a"),
            (1, None, 1, "b"),
            (1, math.nan, 1, "c"),
            (1, 1.0, None, "d"),
            (2, math.inf, 2, "e"),
        ],
        "y int, a double, b int, unused string",
    )
    flat = prepare_table(df, "y", ["a", "b"])
    assert rows(flat) == [(1, 1.0, 1), (2, math.inf, 2)]
    assert rows(flat) == rows(
        df.withColumnRenamed("y", "label").select("label", "a", "b").na.drop()
    )


def test_r3_null_checks_reach_the_scan(lineitem):
    plan = plan_of(prepare_table(lineitem, "l_linenumber", ["l_quantity", "l_tax"]))
    assert "IsNotNull(l_linenumber), IsNotNull(l_quantity), IsNotNull(l_tax)" in plan
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double,l_tax:double>" in plan
    assert "Exchange" not in plan


def test_r5_flat_table_may_hold_text_which_only_the_vector_rejects(spark):
    df = spark.createDataFrame([(1, "u")], "y int, a string")
    flat = prepare_table(df, "y", ["a"])
    assert rows(flat) == [(1, "u")]
    with pytest.raises((PySparkException, ValueError)):
        assemble(flat, ["a"]).collect()


def test_keep_carries_keys_and_does_not_check_them(spark):
    df = spark.createDataFrame([(None, 1, 2.0)], "id long, y int, a double")
    flat = prepare_table(df, "y", ["a"], keep=["id"])
    assert flat.collect()[0].asDict() == {"label": 1, "a": 2.0, "id": None}
    assert assemble(flat, ["a"], keep=["id"]).columns == ["label", "features", "id"]


def test_m1_r4_r7_vector_slots_follow_order_and_widen(spark):
    df = spark.createDataFrame([(5, 1.5, 7, 9)], "label int, a double, b int, c long")
    out = assemble(df, ["c", "a", "b"])
    assert out.columns == ["label", "features"]
    assert out.schema["label"].dataType.simpleString() == "int"
    assert out.select(vector_to_array("features")).collect()[0][0] == [9.0, 1.5, 7.0]


@pytest.mark.parametrize("bad", [None, math.nan])
def test_m1_incomplete_features_raise(spark, bad):
    df = spark.createDataFrame([(1, bad)], "label int, a double")
    with pytest.raises(Exception, match="handleInvalid"):
        assemble(df, ["a"]).collect()
