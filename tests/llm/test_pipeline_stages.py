"""Every stage of the pipeline over awkward tables; each has to leave columns and values as they are."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import re

import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, empty, table

import corpus_pipeline

KEEPING = corpus_pipeline.STAGES[:3]


def documents(spark, rows=AWKWARD):
    df = table(spark, rows).withColumn("lang", F.when(F.col("doc_id").isNotNull(), "en"))
    return df.withColumn("score", F.lit(7.5)).withColumn("lang_pred", F.lit("own"))


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def words(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), normal(text)).strip(" ")


@pytest.mark.parametrize("name, stage", KEEPING)
def test_columns_and_values_stay(spark, name, stage):
    docs = documents(spark)
    kept = stage(spark, docs, "")
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = kept.collect()
    assert rows and {(r.score, r.lang_pred, r.judged, r.found) for r in rows} == {(7.5, "own", "x", "x")}
    before = [(r.doc_id, r.text) for r in docs.collect()]
    assert all((r.doc_id, r.text) in before for r in rows)


def test_what_each_stage_keeps(spark):
    language, exact, near = ([(r.doc_id, r.text) for r in stage(spark, documents(spark), "").collect()]
                             for _, stage in KEEPING)
    lettered = [(k, t) for k, t in AWKWARD if t and re.search(r"[^\W\d_]", t)]
    assert sorted(language, key=repr) == sorted(lettered, key=repr)
    # Of rows equal in key and text one stays; of equal texts the smallest key, null last.
    assert len(exact) == len({normal(t) for _, t in AWKWARD}) == len({normal(t) for _, t in exact})
    for key, text in exact:
        same = [k for k, t in AWKWARD if normal(t) == normal(text) and k is not None]
        assert key == (min(same) if same else None)
    greeting = words(AWKWARD[0][1])
    assert {k for k, t in near if words(t) == greeting} == {1}
    assert sum(not words(t) for _, t in near) == sum(not words(t) for _, t in AWKWARD)


def test_packing_takes_every_row(spark):
    rows = corpus_pipeline.packed(spark, documents(spark), "").collect()
    ends = [r for r in rows if r.start + r.length == r.doc_tokens]
    assert len(ends) == len(AWKWARD)
    assert sorted((r.doc_id for r in ends), key=repr) == sorted((k for k, _ in AWKWARD), key=repr)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_tables(spark, name, stage):
    docs = empty(spark).withColumn("lang", F.lit("en"))
    assert stage(spark, docs, "").count() == 0


def test_a_language_left_out_of_learning(spark):
    """What the first stage does not claim to reject: another language in the same letters."""
    rows = [(i, "der Hund und die Katze laufen durch den Garten", "de") for i in range(30)]
    rows += [(100, "Зимой холодно и темно", None), (101, "un gato corre por el jardin", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs, "").collect()}
    assert 100 not in kept and kept >= set(range(30))
