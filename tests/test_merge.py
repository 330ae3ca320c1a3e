import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import merge

VALID = ("doc_id string, url string, title string, cleaned_text string, content_hash string, "
         "text_len int, seq int")


def batch(spark, rows):
    """rows of (doc_id, content) in input order."""
    return spark.createDataFrame(
        [(d, "", "", c, f"h{c}", len(c), n) for n, (d, c) in enumerate(rows)], VALID)


def empty(spark):
    versions = spark.createDataFrame([], VALID.replace("seq int", "source_run_id int"))
    return versions, spark.createDataFrame(
        [], "doc_id string, valid_from_run_id int, valid_to_run_id int")


def play(spark, batches):
    versions, closures = empty(spark)
    statuses = []
    for run_id, rows in enumerate(batches, start=1):
        valid = batch(spark, rows)
        keys = merge.batch_keys(valid)
        s = merge.classify(keys, merge.current_keys(versions, closures, keys))
        statuses.append({r.doc_id: r.status for r in s.collect()})
        versions = versions.unionByName(merge.new_versions(valid, s, run_id))
        closures = closures.unionByName(merge.new_closures(s, run_id))
        # Cut the growing plan.
        versions = spark.createDataFrame(versions.collect(), versions.schema)
        closures = spark.createDataFrame(closures.collect(), closures.schema)
    return versions, closures, statuses


def model(batches):
    """Sequential bookkeeping: the last row of an id in a batch counts."""
    log, current, statuses = [], {}, []
    for run_id, rows in enumerate(batches, start=1):
        status = {}
        for doc, content in dict(rows).items():
            row = current.get(doc)
            if row is None:
                status[doc] = "NEW"
            elif row[1] == content:
                status[doc] = "UNCHANGED"
                continue
            else:
                status[doc] = "UPDATED"
                row[3] = run_id
            current[doc] = [doc, content, run_id, None]
            log.append(current[doc])
        statuses.append(status)
    return log, statuses


def histories(spark, batches):
    versions, closures, statuses = play(spark, batches)
    rows = merge.with_validity(versions, closures).collect()
    got = sorted((r.doc_id, r.cleaned_text, r.source_run_id, r.valid_to_run_id or 0) for r in rows)
    log, want_statuses = model(batches)
    assert got == sorted((d, c, f, t or 0) for d, c, f, t in log)
    assert statuses == want_statuses
    assert all(r.is_active == (r.valid_to_run_id is None) for r in rows)
    active = [r.doc_id for r in merge.active(versions, closures).collect()]
    assert len(active) == len(set(active)) == len({d for d, *_ in log})
    return versions, closures


def test_there_and_back_again(spark):
    versions, closures = histories(spark, [[("d", "A")], [("d", "B")], [("d", "A")], [("d", "A")]])
    assert versions.count() == 3 and closures.count() == 2


def test_random_histories(spark):
    draw = random.Random(7)
    for _ in range(3):
        batches = [[(draw.choice("abcdef"), draw.choice("XYZ")) for _ in range(draw.randint(0, 8))]
                   for _ in range(4)]
        versions, closures = histories(spark, batches)
        derived = merge.closures_from_history(versions)
        assert sorted(derived.collect()) == sorted(closures.collect())
        rows = merge.with_validity(versions, closures)
        both = merge.as_of_runs(rows, [1, 2, 3, 4]).select("run_id", "doc_id", "source_run_id")
        each = [merge.as_of(rows, r).select(F.lit(r).alias("run_id"), "doc_id", "source_run_id")
                for r in (1, 2, 3, 4)]
        assert sorted(both.collect()) == sorted(x for e in each for x in e.collect())


def test_last_row_of_a_hot_id_wins(spark):
    n = 3000
    rows = [("hot" if i % 3 == 0 else f"d{i}", f"t{i}") for i in range(n)]
    keys = merge.batch_keys(batch(spark, rows).repartition(7))
    hot = keys.filter("doc_id = 'hot'").first()
    assert (hot.seq, hot.content_hash, hot.copies) == (2997, "ht2997", 1000)
    s = merge.classify(keys, merge.current_keys(*empty(spark)))
    counts = merge.status_counts(s).first().asDict()
    assert counts == {"new_doc_count": 2001, "updated_doc_count": 0, "unchanged_doc_count": 0,
                      "duplicate_doc_count": 999}


@pytest.mark.parametrize("second, want", [
    ([("a", "1"), ("b", "2"), ("c", "9")], ["c"]),              # mostly unchanged
    ([("a", "1"), ("x", "2"), ("y", "3")], ["x", "y"]),         # mostly new
    ([("x", "2"), ("y", "3")], ["x", "y"]),                     # nothing unchanged
    ([("a", "1"), ("x", "2"), ("x", "3")], ["x"]),              # duplicates
    ([("a", "1")], []),                                         # nothing new
])
def test_only_winners_that_changed_are_appended(spark, second, want):
    versions, closures, _ = play(spark, [[("a", "1"), ("b", "2"), ("c", "3")]])
    valid = batch(spark, second)
    keys = merge.batch_keys(valid)
    s = merge.classify(keys, merge.current_keys(versions, closures, keys))
    assert sorted(r.doc_id for r in merge.new_versions(valid, s, 2).collect()) == want


def test_history_joins_on_the_whole_version(spark):
    documents = spark.createDataFrame(
        [("d", "h1", 1), ("d", "h2", 2), ("e", "h3", 1)],
        "doc_id string, content_hash string, source_run_id int")
    chunks = spark.createDataFrame(
        [("c1", "d", "h1", 1, 0), ("c2", "d", "h2", 2, 0), ("c3", "d", "h2", 2, 1)],
        "chunk_id string, doc_id string, content_hash string, source_run_id int, chunk_index int")
    rows = merge.version_history(documents, chunks).collect()
    assert sorted((r.doc_id, r.source_run_id, r.chunk_id or "") for r in rows) == [
        ("d", 1, "c1"), ("d", 2, "c2"), ("d", 2, "c3"), ("e", 1, "")]
