import os

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.encoders import HashingEncoder
from corpusloom.operators import sampling
from corpusloom.plans import build as B
from corpusloom.sources import jsonl, scratch
from corpusloom.sources.warehouse import Warehouse

MODE = "spark.sql.autoBroadcastJoinThreshold"


def raw(spark, n, tasks=2, note=""):
    words = F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(f"-{k}")), 256) for k in range(60)])
    return spark.range(0, n, numPartitions=tasks).select(F.col("id").cast("string").alias("id")).select(
        "id", F.lit("u").alias("url"), F.lit("t").alias("title"), F.concat(words, F.lit(note)).alias("text"),
        F.struct(F.lit("f").alias("file"), F.lit(0).cast("bigint").alias("block"),
                 F.col("id").cast("bigint").alias("row")).alias("seq"))


def folders(spark, purpose):
    root = scratch.shared_root(spark).removeprefix("file:")
    return {name for name in os.listdir(root) if name.startswith(f"corpusloom-{purpose}-")}


@pytest.fixture
def sort_joins(spark):
    """Joins as they are on tables too large to be broadcast."""
    kept = spark.conf.get(MODE)
    spark.conf.set(MODE, "-1")
    yield
    spark.conf.set(MODE, kept)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_build_leaves_no_scratch_tables_of_texts_and_vectors(spark):
    before = {p: folders(spark, p) for p in ("staged", "active-vectors")}
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    B.Build(w, "full", "demo", "rows", encoder=HashingEncoder(8)).run(
        lambda run_id: jsonl.raw_rows(raw(spark, 300), run_id))
    assert {p: folders(spark, p) for p in before} == before
    for table in ("raw_documents", "clean_documents", "chunks"):
        assert all(".zstd." in f for f in w.read_run(table, 1).inputFiles()), table


def test_texts_move_only_where_some_rows_of_a_batch_are_new(spark, sort_joins, monkeypatch):
    plans, write = [], Warehouse.write_run

    def planned(self, table, df, run_id, metrics=None):
        if table == "clean_documents":
            plans.append(plan(df))
        return write(self, table, df, run_id, metrics)

    monkeypatch.setattr(Warehouse, "write_run", planned)
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    some = raw(spark, 300).unionByName(raw(spark, 3, note=" more").withColumn("seq", F.struct(
        F.lit("g").alias("file"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("row"))))
    seen = []
    for rows in (raw(spark, 300), raw(spark, 300), some):
        B.Build(w, "full", "demo", "rows", encoder=HashingEncoder(8)).run(
            lambda run_id, rows=rows: jsonl.raw_rows(rows, run_id))
        seen.append(w.read_run("clean_documents", len(seen) + 1).count())
    assert seen == [300, 0, 3]
    assert ["Exchange" in p and "cleaned_text" in p for p in plans] == [False, False, True]


def test_raw_rows_of_one_file_are_read_by_many_tasks_without_a_shuffle(spark, monkeypatch):
    plans, write = [], B.written

    def planned(df, purpose, *codec):
        if purpose == "staged":
            plans.append(plan(df))
        return write(df, purpose, *codec)

    monkeypatch.setattr(B, "written", planned)
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    B.Build(w, "full", "demo", "rows", encoder=HashingEncoder(8)).run(
        lambda run_id: jsonl.raw_rows(raw(spark, 12_000, tasks=1), run_id))
    assert len(w.read_run("raw_documents", 1).inputFiles()) == 1
    assert len(plans) == 1 and "Exchange" not in plans[0]
    parts = w.read_run("raw_documents", 1).groupBy(F.spark_partition_id()).count().collect()
    assert len([r for r in parts if r["count"]]) >= 4


def test_a_preview_moves_no_texts(spark, sort_joins):
    batch = raw(spark, 20).drop("seq")
    shown = sampling.batch_preview(batch, spark.range(5).select(F.col("id").cast("string").alias("id")))
    text = "SortMergeJoin"
    at = plan(shown)
    assert text in at and all("text#" not in line for line in at.splitlines() if "Exchange" in line or "Sort " in line)
    assert "text_len" in at.split("Exchange")[1]
    rows = {r.id: r for r in shown.collect()}
    assert len(rows) == 20 and sorted(k for k, r in rows.items() if not r.is_new) == list("01234")
    assert {(r.text_len, r.has_text) for r in rows.values()} == {(60 * 65 - 1, True)}


def test_compressed_lines_hold_few_rows_a_file(spark, monkeypatch):
    monkeypatch.setattr(jsonl, "FILE_ROWS", 100)
    path = scratch.held_folder(spark, "lines") + "/rows"
    jsonl.write_documents(raw(spark, 450, tasks=1), path, compressed=True)
    back = jsonl.accepted(jsonl.read_documents(spark, path, 1))
    assert len(spark.read.text(path).inputFiles()) == 5
    assert sorted(back.select("id", "text").collect()) == sorted(raw(spark, 450).select("id", "text").collect())
