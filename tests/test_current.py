"""Key buckets and totals over random histories, against sequential bookkeeping."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import current
from corpusloom.plans import build as B
from corpusloom.plans.retrieve import retrieve
from corpusloom.functions.encoders import HashingEncoder
from corpusloom.sources import scratch
from corpusloom.sources.warehouse import Warehouse


def line(key, n_words):
    return json.dumps({"id": key, "url": "", "title": "t", "text": " ".join(f"{key}w{i}" for i in range(n_words))})


def batches(seed, runs):
    rng, known = random.Random(seed), []
    for n in range(runs):
        batch = {}
        for _ in range(rng.randint(7, 14) if n else 12):
            key = rng.choice(known) if known and rng.random() < 0.6 else f"d{len(known) + len(batch)}"
            batch[key] = rng.choice([0, 5, 40, 60, 400, 900])
        known += [k for k in batch if k not in known]
        yield batch


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("history")
    w = Warehouse(spark, scratch.new_folder(spark, "history"))
    now, states = {}, {}
    for n, batch in enumerate(batches(5, 3), 1):
        path = folder / f"{n}.jsonl"
        path.write_text("\n".join(line(k, size) for k, size in batch.items()))
        B.Build(w, "augmented", "demo", str(path), encoder=HashingEncoder(16), key_buckets=16).run()
        for key, size in batch.items():
            if size and now.get(key, (None,))[0] != size:
                now[key] = size, n
        states[n] = dict(now)
    return w, states


def test_snapshot_follows_the_history(history):
    w, states = history
    rows = w.current_keys().collect()
    assert {r.doc_id: r.source_run_id for r in rows} == {k: run for k, (_, run) in states[3].items()}
    assert len(rows) == len(states[3]) and len({r.bucket for r in rows}) > 4
    chunks = {r.doc_id: r["count"] for r in w.read("chunks").join(
        w.current_keys().select("doc_id", "source_run_id"), ["doc_id", "source_run_id"]).groupBy("doc_id").count().collect()}
    assert {r.doc_id: r.n_chunks for r in rows if r.n_chunks} == chunks
    assert all(r.n_embeddings == r.n_chunks for r in rows)


def test_totals_kept_equal_a_recount(history):
    w, states = history
    rows = B.states_and_recounts(w).orderBy("run_id").collect()
    assert [r.run_id for r in rows] == [1, 2, 3] and all(r.agrees for r in rows)
    assert [r.n_documents for r in rows] == [len(states[n]) for n in (1, 2, 3)]
    sums = {r.run_id: r.checksum for r in B.checksums(w, [1, 2, 3]).collect()}
    again = {r.run_id: r.checksum for r in B.chunk_checksums(
        w.read("chunks"), w.read("closures"), [1, 2, 3]).collect()}
    assert sums == again and len(set(sums.values())) > 1
    assert [r.active_doc_count for r in w.runs().orderBy("run_id").collect()] == [r.n_documents for r in rows]


def test_a_small_batch_reads_and_writes_its_buckets_only(history, tmp_path):
    w, _ = history
    spark = w.spark
    n_buckets, before = w.key_layout()
    key = "d0"
    touched = spark.createDataFrame([(key,)], "doc_id string").select(current.bucket_of(n_buckets)).first()[0]
    path = tmp_path / "one.jsonl"
    path.write_text(line(key, 77))
    run = B.Build(w, "augmented", "demo", str(path), encoder=HashingEncoder(16))
    run_id = run.run()
    read = {f.split("/current_keys/")[1].rsplit("/", 1)[0] for f in run.current.inputFiles()}
    assert read == {f"run_id={before[touched]}/bucket={touched}"}
    _, after = w.key_layout()
    assert after == before | {touched: run_id}
    written = w.everything("key_buckets").filter(F.col("run_id") == run_id).collect()
    assert [r.bucket for r in written] == [touched]
    assert B.states_and_recounts(w).filter("NOT agrees").isEmpty()


def test_small_updates_add_parts_that_answer_like_a_rebuild(spark, tmp_path):
    w = Warehouse(spark, scratch.new_folder(spark, "parts"))
    encoder, path = HashingEncoder(64), tmp_path / "a.jsonl"

    def run(docs):
        path.write_text("\n".join(line(k, size) for k, size in docs))
        return B.Build(w, "augmented", "demo", str(path), encoder=encoder).run()

    run([(f"d{i}", 50 + i) for i in range(120)])
    # A revision, a new document; then the first text again, whose chunk ids were closed.
    runs = [run([("d3", 300), ("e1", 90)]), run([("d3", 53), ("d4", 200)]), run([("d4", 54)])]
    registry = {r.run_id: r for r in w.read("index_registry").collect()}
    assert [len(w.index_parts(n)) for n in (1, *runs)] == [1, 2, 3, 4]
    assert {registry[n].centroids_path for n in runs} == {registry[1].centroids_path}
    assert [registry[n].num_vectors for n in runs] == [121, 121, 121]
    row = w.runs().filter(F.col("run_id") == runs[-1]).first()
    assert row.index_vector_count == row.active_embedding_count == row.active_chunk_count == 121
    questions = spark.createDataFrame([(n, f"d{n}w1 d{n}w7 d3w60 e1w5") for n in range(8)],
                                      "query_id int, query_text string")
    shown = ["query_id", "rank", "score", "chunk_id"]
    added = retrieve(w, questions, 6, nprobe=100, encoder=encoder).select(shown).collect()
    other = Warehouse(spark, scratch.new_folder(spark, "parts"))
    path.write_text("\n".join(line(k, s) for k, s in [*((f"d{i}", 50 + i) for i in range(120)), ("e1", 90)]))
    B.Build(other, "full", "demo", str(path), encoder=encoder).run()
    assert retrieve(other, questions, 6, nprobe=100, encoder=encoder).select(shown).collect() == added
    # Nothing new keeps the index and its curve; much at once builds anew.
    same = run([("d4", 54)])
    rows = {r.run_id: r for r in w.read("index_registry").collect()}
    assert rows[same].index_checksum == rows[runs[-1]].index_checksum and len(w.index_parts(same)) == 4
    assert w.read("index_recall").filter(F.col("run_id") == same).isEmpty()
    curve = B.stored_curve(w, rows[same].index_checksum)
    assert len(curve) == rows[same].nlist and curve[-1][0] == curve[-1][1] > 0
    assert len(w.index_parts(run([(f"d{i}", 400) for i in range(20)]))) == 1


def test_a_corpus_without_snapshot_gets_one_from_its_history(spark, tmp_path):
    w = Warehouse(spark, scratch.new_folder(spark, "old"))
    path = tmp_path / "a.jsonl"
    path.write_text("\n".join(line(f"d{i}", 50 + i) for i in range(6)))
    B.Build(w, "full", "demo", str(path), encoder=HashingEncoder(16)).run()
    old = Warehouse(spark, scratch.new_folder(spark, "old"))
    for name in ("runs", "clean_documents", "chunks", "embeddings", "index_registry"):
        rows = w.everything(name)
        split = [c for c in ("source_run_id", "prefix") if c in rows.columns]
        rows.write.partitionBy(*split).parquet(old.path(name))
    path.write_text(line("d0", 99) + "\n" + line("d9", 60))
    run_id = B.Build(old, "augmented", "demo", str(path), encoder=HashingEncoder(16)).run()
    row = old.runs().filter(F.col("run_id") == run_id).first()
    assert (row.new_doc_count, row.updated_doc_count, row.active_doc_count) == (1, 1, 7)
    assert B.states_and_recounts(old).first().agrees
    assert old.current_keys().count() == 7


def test_buckets_grow_with_the_corpus():
    assert current.bucket_count(0) == current.bucket_count(100_000) == 8
    sizes = [current.bucket_count(n) for n in (10 ** 6, 10 ** 7, 10 ** 9, 10 ** 13)]
    assert sizes == sorted(sizes) and all(n & (n - 1) == 0 for n in sizes) and sizes[-1] == 1 << 16
