import hashlib
from collections import Counter, defaultdict
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import quality, sampling


def hashes(spark, n):
    return spark.range(n).select(F.sha2((F.col("id") % 700).cast("string"), 256).alias("h"))


def test_digest_is_about_the_multiset_only(spark):
    df = hashes(spark, 1000)
    value = quality.multiset_digest(df, "h").first()
    for other in (df.repartition(1), df.repartition(13), df.orderBy(F.desc("h"))):
        assert quality.multiset_digest(other, "h").first() == value
    assert quality.multiset_digest(df.limit(999), "h").first().digest != value.digest
    assert quality.multiset_digest(df.distinct(), "h").first().digest != value.digest
    assert quality.multiset_digest(df.filter("false"), "h").first().n_rows == 0


def test_ordered_checksum(spark):
    df = hashes(spark, 50).repartition(4)
    found = quality.ordered_checksum(df.unionByName(df.limit(7)), "h").first()
    level = [(h, f"{h}:{n}") for h, n in Counter(
        [r.h for r in df.collect()] + [r.h for r in df.limit(7).collect()]).items()]
    for digits in (6, 3, 0):
        groups = defaultdict(list)
        for at, value in sorted(level):
            groups[at[:digits]].append(value)
        level = [(k, hashlib.sha256("".join(v).encode()).hexdigest()) for k, v in groups.items()]
    assert found == (57, level[0][1])
    empty = quality.ordered_checksum(df.filter("false"), "h").first()
    assert empty == (0, hashlib.sha256(b"").hexdigest())


def test_digest_sees_every_digit(spark):
    def digest(*values):
        rows = spark.createDataFrame([(v,) for v in values], "h string")
        return quality.multiset_digest(rows, "h").first().digest
    one = "0" * 64
    for at in range(0, 64, 7):
        assert digest(one) != digest(one[:at] + "1" + one[at + 1:])
    assert digest("5" * 64, "5" * 64) != digest("5" * 64)


def runs(spark, rows):
    return spark.createDataFrame(rows, "run_id int, active_doc_count long, active_chunk_count long, "
                                       "active_embedding_count long, index_vector_count long")


def test_audit(spark):
    table = runs(spark, [(1, 5, 9, 9, 9), (2, 5, 9, 9, 9), (3, 6, 10, 10, 9)])
    sums = spark.createDataFrame([(1, "a" * 20), (2, "a" * 20), (3, "b" * 20)],
                                 "run_id int, checksum string")
    rows = quality.audit(table, sums, [(1, 2), (2, 3), (3, 9), (8, 9)])
    got = {}
    for r in rows.collect():
        got.setdefault((r.run_id_a, r.run_id_b), {})[r.audit_type] = (r.result, json.loads(r.details))
    assert {k: v[0] for k, v in got[1, 2].items()} == dict.fromkeys(
        [*quality.AUDITED_COUNTS, "chunk_hash_checksum"], "PASS")
    assert got[2, 3]["active_doc_count"] == ("FAIL", {"run_a": 5, "run_b": 6})
    assert got[2, 3]["index_vector_count"][0] == "PASS"
    assert got[2, 3]["chunk_hash_checksum"] == (
        "FAIL", {"checksum_a": "a" * 16 + "...", "checksum_b": "b" * 16 + "..."})
    assert got[3, 9] == {"run_existence": ("FAIL", {"error": "run_a=ok, run_b=missing"})}
    assert got[8, 9] == {"run_existence": ("FAIL", {"error": "run_a=missing, run_b=missing"})}
    assert quality.audit_tally(rows).first() == (6, 6)


@pytest.mark.parametrize("indexed,status", [(4, "PASS"), (3, "FAIL"), (None, "FAIL")])
def test_reconciliation(spark, indexed, status):
    rows = [] if indexed is None else [(9, 1), (indexed, 2)]
    registry = spark.createDataFrame(rows, "num_vectors long, created_at int")
    r = quality.reconcile(spark.range(7), spark.range(3), spark.range(2), spark.range(4),
                          spark.range(4), registry, 5).first()
    assert (r.run_id, r.reconciliation_status) == (5, status)
    assert json.loads(r.details) == {"raw": 7, "clean_active": 3, "rejected": 2, "chunks": 4,
                                     "embeddings": 4, "index_vectors": indexed or 0}


def test_registry_and_previous_run(spark):
    registry = spark.createDataFrame(
        [("i1", 1, "x", 4, 10), ("i2", 2, "x", 6, 20), ("i3", 3, "y", 8, 15)],
        "index_id string, run_id int, dataset_name string, num_vectors long, created_at int")
    active = quality.newest_index(registry).filter("is_active")
    assert sorted(r.index_id for r in active.collect()) == ["i2", "i3"]
    assert quality.active_index_size(registry).first()[0] == 6
    assert quality.active_index_size(registry.filter("false")).first()[0] == 0
    log = spark.createDataFrame(
        [(1, "full", "x", "p", "success"), (2, "full", "x", "p", "failed"),
         (3, "augmented", "x", "p", "success"), (4, "full", "y", "p", "success"),
         (5, "full", "x", "p", "success")],
        "run_id int, mode string, dataset_name string, input_path string, status string")
    here = {"dataset_name": "x", "input_path": "p", "run_id": 5}
    assert quality.previous_full_run(log, here).first().run_id == 1


def test_sampling(spark):
    raw = spark.range(100).select(
        F.col("id").cast("string").alias("id"), F.lit("u").alias("url"), F.lit("t").alias("title"),
        F.when(F.col("id") % 10 == 3, " ").otherwise("x").alias("text"), F.col("id").alias("seq"))
    usable = sampling.usable(raw)
    assert usable.count() == 90
    one = sampling.seeded_sample(usable.repartition(1), 40).collect()
    two = sampling.seeded_sample(usable.repartition(9), 40).collect()
    assert sorted(one) == sorted(two) and len({r.id for r in one}) == 40
    assert [sampling.sample_size(n) for n in (45, 44, 8, 3)] == [40, 39, 3, 2]
    assert [r.id for r in sampling.first_rows(raw, 3).orderBy("seq").collect()] == ["0", "1", "2"]
    sample = spark.createDataFrame(one, usable.schema)
    batch = {r.case: r for r in sampling.update_batch(usable, sample).collect()}
    first, second = sorted(one, key=lambda r: r.seq)[:2]
    rest = min(int(r.id) for r in usable.collect() if r.id not in {s.id for s in one})
    assert batch["new"].id == str(rest)
    assert batch["revised"].id == first.id and batch["revised"].text == "x" + sampling.REVISION
    assert batch["duplicate"].id == second.id and batch["duplicate"].text == "x"
    assert batch["corrupted"].text == "" and len(batch) == 4
    lonely = {r.case: r for r in sampling.update_batch(sample, sample).collect()}
    assert lonely["new"].id == sampling.SYNTHETIC_ID
    rows = raw.limit(3).unionByName(raw.limit(1).withColumn("id", F.lit("zz")))
    seen = sampling.batch_preview(rows, raw).collect()
    assert sorted((r.id, r.is_new) for r in seen) == [("0", False), ("1", False), ("2", False), ("zz", True)]
