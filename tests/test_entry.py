"""Every registered query against its SQL on the smallest tables."""

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from corpusloom.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
QUERIES, ORACLE = catalog.queries(), oracle.statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in catalog.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and not math.isnan(value) and value == int(value):
        return int(value)
    return value


def rows(table):
    names = sorted(table.column_names)
    columns = [[plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns), key=repr)


# Figures of trained cells, which SQL does not have; compared with brute force elsewhere.
FIGURES = {"certified_cells", "two_level_recall", "ivf_measured_recall"}


def test_all_queries_have_an_oracle():
    assert set(QUERIES) - FIGURES == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, duck, name):
    got = rows(QUERIES[name](spark, FOLDER).toArrow())
    want = rows(duck.sql(ORACLE[name]).to_arrow_table())
    assert got == want and got[1]


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:3] == ["query_id", "rank", "score"] and df.count() == 200


def test_figures_of_trained_cells(spark):
    cells = QUERIES["certified_cells"](spark, FOLDER).collect()
    assert len(cells) == 10 and all(0 < r.n_searched <= r.n_cells == 50 for r in cells)
    recall = QUERIES["two_level_recall"](spark, FOLDER).first()
    assert recall.n_true == 50 and recall.recall == recall.n_found / 50 > 0.5 and recall.n_cells > 60


LONG = {"three_run_scenario", "failed_run_scenario", "streamed_updates", "retrieve_indexed",
        "retrieval_eval_stored"}


def test_no_plan_has_a_cross_join(spark):
    for name in sorted(set(QUERIES) - LONG):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|NestedLoopJoin", plan), name
