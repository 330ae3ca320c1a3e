import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions.encoders import HashingEncoder
from corpusloom.operators import quality, search
from corpusloom.plans import build as B
from corpusloom.plans.retrieve import retrieve
from corpusloom.sources import jsonl, scratch
from corpusloom.sources.warehouse import Warehouse
from corpusloom.streaming.incremental import run_available

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def document(n, extra=""):
    words = " ".join(f"w{n}x{i}" for i in range(40 if n else 900))
    return {"id": f"d{n}", "url": f"u{n}", "title": f"Title {n}", "text": words + extra}


SENTENCE = " fresh news about lighthouses and harbours in winter"
BASE = [document(n) for n in range(40)]
DELTA = [document(99), document(0, SENTENCE), document(1),
         {"id": "corrupted_doc_001", "title": "c", "url": "", "text": ""}]


def write(path, docs):
    path.write_text("\n".join(json.dumps(d) for d in docs))
    return str(path)


def counts(w, run_id):
    return w.runs().filter(F.col("run_id") == run_id).first()


@pytest.fixture(scope="module")
def three_runs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    base, delta = write(folder / "base.jsonl", BASE), write(folder / "delta.jsonl", DELTA)
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    question = spark.createDataFrame([("q", "news about lighthouses and harbours in winter"), ("none", None)],
                                     "query_id string, query_text string")
    # Many slots, so that unrelated words hardly ever share one.
    encoder = HashingEncoder(2048)
    B.build(spark, w.root, "full", "demo", base, encoder=encoder)
    B.build(spark, w.root, "full", "demo", base, encoder=encoder)
    before = retrieve(w, question, 3, encoder=encoder).collect()
    B.build(spark, w.root, "augmented", "demo", delta, encoder=encoder)
    after = retrieve(w, question, 3, encoder=encoder).collect()
    return w, before, after


def test_counts(three_runs):
    w, _, _ = three_runs
    first, second, third = (counts(w, r) for r in (1, 2, 3))
    assert first.new_doc_count == first.active_doc_count == 40
    # 902 tokens (two from the title) give three windows.
    assert first.new_chunk_count == first.active_chunk_count == first.index_vector_count == 42
    assert (second.new_doc_count, second.unchanged_doc_count, second.new_chunk_count,
            second.new_embedding_count, second.active_chunk_count) == (0, 40, 0, 0, 42)
    assert (third.new_doc_count, third.updated_doc_count, third.unchanged_doc_count,
            third.rejected_doc_count, third.duplicate_doc_count) == (1, 1, 1, 1, 0)
    assert (third.raw_doc_count, third.stg_valid_count, third.active_doc_count) == (4, 3, 41)
    assert third.new_chunk_count == 4 and third.active_chunk_count == 43
    assert {r.status for r in (first, second, third)} == {"success"}
    assert first.notes is None and third.notes == B.AUGMENTED_NOTE


def test_audit_and_reconciliation(three_runs):
    w, _, _ = three_runs
    audits = w.read("audit_results").collect()
    assert len(audits) == 5 and {(a.run_id_a, a.run_id_b, a.result) for a in audits} == {(1, 2, "PASS")}
    status = [r.reconciliation_status for r in w.read("row_count_reconciliation").collect()]
    assert status == ["PASS"] * 3
    later = {r.audit_type: r.result for r in B.audit_runs(w, 2, 3).collect()}
    assert later["active_doc_count"] == later["chunk_hash_checksum"] == "FAIL"
    assert [r.audit_type for r in B.audit_runs(w, 2, 77).collect()] == ["run_existence"]


def test_latency_and_registry(three_runs):
    w, _, _ = three_runs
    log = w.read("latency_logs")
    assert json.loads(log.filter("run_id = 3 AND stage_name = 'index'").first().details) == {"nlist": 4}
    assert [r.stage_name for r in log.filter("run_id = 3").orderBy("start_time").collect()] == [
        "ingest", "clean", "curate", "chunk", "embed", "index"]
    assert quality.latest_run_latency(w.runs(), log).select("run_id").distinct().collect() == [(3,)]
    registry = quality.newest_index(w.read("index_registry")).filter("is_active").collect()
    assert [(r.run_id, r.num_vectors, r.nlist, r.nprobe, r.index_type, r.metric) for r in registry] == [
        (3, 43, 4, 10, "IVFFlat", "INNER_PRODUCT")]
    sums = [r.index_checksum for r in w.read("index_registry").orderBy("run_id").collect()]
    assert sums[0] == sums[1] != sums[2]


def test_revised_text_is_found_only_after_the_update(three_runs):
    _, before, after = three_runs
    assert before and not any("fresh news" in r.chunk_text for r in before)
    assert [(r.query_id, r.rank) for r in after] == sorted((r.query_id, r.rank) for r in after)
    assert {r.query_id for r in after} == {"none", "q"}
    best = min((r for r in after if r.query_id == "q"), key=lambda r: r.rank)
    assert best.doc_id == "d0" and "fresh news" in best.chunk_text and best.title == "Title 0"


def test_rejects_and_partitions(three_runs):
    w, _, _ = three_runs
    rows = w.read("rejected_documents").collect()
    assert [(r.run_id, r.doc_id, r.reason_code) for r in rows] == [(3, "corrupted_doc_001", "EMPTY_TEXT")]
    assert {r.run_id: r["count"] for r in w.read("raw_documents").groupBy("run_id").count().collect()} == {
        1: 40, 2: 40, 3: 4}
    assert all("run_id=3" in f for f in w.read_run("raw_documents", 3).inputFiles())


class Broken:
    """Fails as soon as a window is asked for."""
    def windows(self, text):
        raise RuntimeError("no tokenizer")


def test_failed_run_is_invisible_and_can_be_repeated(spark, tmp_path):
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    base, changed = write(tmp_path / "a.jsonl", BASE[:6]), write(
        tmp_path / "b.jsonl", [document(n, " changed") for n in range(6)])
    B.build(spark, w.root, "full", "demo", base)
    with pytest.raises(RuntimeError):
        B.build(spark, w.root, "augmented", "demo", changed, tokenizer=Broken())
    failed = counts(w, 2)
    assert failed.status == "failed" and "no tokenizer" in failed.notes
    assert failed.updated_doc_count == 6
    assert w.read("clean_documents").count() == 6 and w.read("closures").count() == 0
    B.build(spark, w.root, "augmented", "demo", changed)
    again = counts(w, 3)
    assert (again.updated_doc_count, again.new_chunk_count, again.active_doc_count) == (6, 8, 6)
    assert [r.run_id for r in w.run_history().collect()] == [1, 2, 3]
    assert {r.run_id for r in w.read("latency_logs").collect()} == {1, 3}
    assert {r.run_id for r in w.everything("latency_logs").collect()} == {1, 2, 3}


def test_contract_details(spark, tmp_path):
    """Title changes are no updates; empty text leaves the old version; absent ids stay."""
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    B.build(spark, w.root, "full", "demo", write(tmp_path / "a.jsonl", BASE[:5]))
    renamed = dict(document(1), title="Another title", url="elsewhere")
    emptied = dict(document(2), text=" ")
    twice = [document(3, " one"), document(3, " two"), document(77), document(77)]
    B.build(spark, w.root, "full", "demo", write(tmp_path / "b.jsonl", [renamed, emptied, *twice]))
    c = counts(w, 2)
    assert (c.new_doc_count, c.updated_doc_count, c.unchanged_doc_count, c.duplicate_doc_count,
            c.rejected_doc_count, c.active_doc_count) == (1, 1, 1, 2, 1, 6)
    versions = w.read("clean_documents").filter("doc_id = 'd3'").orderBy("source_run_id").collect()
    assert len(versions) == 2 and versions[1].cleaned_text.endswith(" two")
    assert w.read("clean_documents").filter("doc_id = 'd1'").first().title == "Title 1"


def test_nothing_to_index(spark, tmp_path):
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    with pytest.raises(ValueError, match="no active embeddings"):
        B.build(spark, w.root, "full", "demo", write(tmp_path / "a.jsonl", DELTA[3:]))
    assert counts(w, 1).status == "failed" and counts(w, 1).rejected_doc_count == 1
    with pytest.raises(ValueError, match="no index"):
        retrieve(w, spark.createDataFrame([(1, "x")], "query_id int, query_text string"))
    with pytest.raises(ValueError, match="mode"):
        B.build(spark, w.root, "partial", "demo", "nowhere")


def test_missing_input_fails_the_run(spark, tmp_path):
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        B.build(spark, w.root, "full", "demo", str(tmp_path / "nowhere"))
    assert counts(w, 1).status == "failed"


def test_files_arriving_one_after_the_other(spark, tmp_path):
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    checkpoint = scratch.new_folder(spark, "stream")
    write(inbox / "1.jsonl", BASE[:4])
    run_available(w, "demo", str(inbox), checkpoint)
    write(inbox / "2.jsonl", [document(0, SENTENCE), document(5)])
    run_available(w, "demo", str(inbox), checkpoint)
    run_available(w, "demo", str(inbox), checkpoint)
    rows = w.runs().orderBy("run_id").collect()
    assert [(r.raw_doc_count, r.new_doc_count, r.updated_doc_count, r.status) for r in rows] == [
        (4, 4, 0, "success"), (2, 1, 1, "success")]
    assert rows[1].active_doc_count == 5


def test_order_of_input_decides_across_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.jsonl", [document(1, " old")])
    write(folder / "b.jsonl", [document(1, " new")])
    raw = jsonl.read_documents(spark, str(folder), 1)
    assert raw.orderBy(F.desc("seq")).first().text.endswith(" new")


def test_no_text_is_shuffled_to_find_the_hits(three_runs):
    w, _, _ = three_runs
    question = w.spark.createDataFrame([("q", "lighthouses")], "query_id string, query_text string")
    kept = w.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    w.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = retrieve(w, question, 3, encoder=HashingEncoder(2048))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        w.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" not in plan and "chunk_text" in plan
    # The ranking of hits and the last sort are the only exchanges.
    assert plan.count("Exchange hashpartitioning(query_id") <= 4


def test_only_the_folders_of_hits_are_read(three_runs):
    w, _, _ = three_runs
    chunks = w.read("chunks")
    one = chunks.orderBy("chunk_id").first().chunk_id
    hits = w.spark.createDataFrame([("q", one, 0.5, 1)], "query_id string, id string, score double, rank int")
    found = search.hydrate(scratch.written(hits, "hits"), chunks, w.read("clean_documents"), w.read("closures"))
    plan = search.hydrate(scratch.written(hits, "hits"), chunks, w.read("clean_documents"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    assert [r.chunk_id for r in found.collect()] == [one]
    folders = {f.split("prefix=")[1][:2] for f in chunks.inputFiles()}
    assert len(folders) > 10 and all(r.chunk_id.startswith(r.prefix) for r in chunks.collect())


def test_cells_are_limited(spark, tmp_path):
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    base = write(tmp_path / "a.jsonl", BASE[:8])
    B.build(spark, w.root, "full", "demo", base, max_cells=2)
    assert w.read("index_registry").first().nlist == 2
    with pytest.raises(ValueError, match="max_cells"):
        B.build(spark, w.root, "full", "demo", base, max_cells=0)


def test_chunk_files_follow_the_folders_and_not_the_tasks(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    rows = spark.range(0, 600, numPartitions=6).select(
        F.sha2(F.col("id").cast("string"), 256).alias("chunk_id"), F.col("id").cast("string").alias("doc_id"),
        F.lit("h").alias("content_hash"), F.lit(0).alias("chunk_index"), F.lit(0).alias("start_tok"),
        F.lit(40).alias("end_tok"), F.lit("text").alias("chunk_text"), F.lit(40).alias("chunk_token_len"),
        F.lit("h").alias("chunk_hash"))
    seen = w.write_run("chunks", rows.withColumn("prefix", F.left("chunk_id", F.lit(2))), 1,
                       {"rows": F.count("*")})
    stored = w.read_run("chunks", 1)
    assert seen == {"rows": 600} and stored.count() == 600
    files = list(tmp_path.rglob("chunks/**/*.parquet"))
    assert len(files) == stored.select("prefix").distinct().count()
    assert sum(f.stat().st_size for f in files) < 100_000 * len(files)


def test_rows_of_one_task_are_staged_by_several(spark):
    letters = F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(f"-{n}")), 256) for n in range(60)])
    rows = spark.range(0, 2000, numPartitions=1).select(F.col("id").cast("string").alias("id")).select(
        "id", F.lit("u").alias("url"), F.lit("t").alias("title"), letters.alias("text"),
        F.struct(F.lit("f").alias("file"), F.lit(0).cast("bigint").alias("block"),
                 F.col("id").cast("bigint").alias("row")).alias("seq"))
    w = Warehouse(spark, scratch.new_folder(spark, "test"))
    run = B.Build(w, "full", "demo", "rows", encoder=HashingEncoder(8))
    run.run(lambda run_id: jsonl.raw_rows(rows, run_id))
    assert len(w.read_run("raw_documents", 1).inputFiles()) == 1
    assert len(run.staged.inputFiles()) > 1
    assert counts(w, 1).active_doc_count == 2000
