"""The registered queries against their SQL, and the shape of their plans."""

import os
from pathlib import Path

import duckdb
import pytest
from conftest import SF, plan_of

from __spark_entry__ import entry, oracle_sql, queries
from tallygrove.plans import contract
from tallygrove.plans.oracles import ORACLES
from tallygrove.sources import leaving_nothing, shared_dir

SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql_unless_it_cannot():
    assert set(contract.QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_and_leaves_nothing(spark, database, name):
    os.makedirs(shared_dir(spark), exist_ok=True)
    before = set(os.listdir(shared_dir(spark)))
    wanted = database.execute(oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in wanted.description}
    order = [c[0] for c in wanted.description]
    with leaving_nothing(spark):
        got = queries()[name](spark, SF)
        assert {c: SQL_TYPES[t] for c, t in got.dtypes} == types
        ours = sorted((tuple(r) for r in got.select(*order).collect()), key=repr)
    assert set(os.listdir(shared_dir(spark))) <= before
    assert ours == sorted(wanted.fetchall(), key=repr)


def test_bands_have_metrics_that_can_tell_right_from_wrong(spark):
    found = {r.metric: r.value for r in queries()["fit_bands_summary"](spark, SF).collect()}
    assert all(0 < v < 1 for v in found.values())
    counts = queries()["fit_bands_confusion"](spark, SF).toPandas()
    assert counts["count"].sum() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_nonfinite_margins_reach_more_than_one_class(spark):
    counts = queries()["linear_nonfinite"](spark, SF).toPandas()
    assert counts["prediction"].nunique() > 2


def test_entry_reports_both_data_sets(spark):
    out = entry(spark)
    assert out.columns == ["dataset", "metric", "value"] and out.count() == 10


@pytest.mark.parametrize("name", ["linear_margins", "linear_softmax", "linear_argmax"])
def test_scorers_neither_shuffle_nor_leave_the_jvm(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert "Exchange" not in plan and "UDF" not in plan and "Python" not in plan
    assert "PushedFilters: [IsNotNull(l_linenumber)" in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_query_sorts_joins_or_runs_python(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    for node in ("Join", "CartesianProduct", "SortMerge", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan, node


def test_counts_are_summed_before_the_only_shuffle(spark):
    plan = plan_of(contract.confusion_counts(spark, SF))
    assert plan.count("hashpartitioning") == 1
    assert "partial_count" in plan
