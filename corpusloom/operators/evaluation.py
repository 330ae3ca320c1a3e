"""Retrieval evaluation against expected documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X


def evaluate(hits: DataFrame, expected: DataFrame, k: int, run_id: int) -> DataFrame:
    """One row per expected query and retrieved row.

    hits: (query_id, retrieved_doc_id, rank); expected: (query_id, query_text,
    expected_doc_id). A query without hits keeps one row with a null rank. A row is a hit
    when it holds the expected document within the first k ranks; the reciprocal rank is
    that of the row, 0 when it is not the expected document.
    """
    match = F.col("retrieved_doc_id") == F.col("expected_doc_id")
    return expected.join(hits, "query_id", "left").select(
        X.key_hash(F.lit(run_id), "query_id", "rank").alias("eval_id"),
        F.lit(run_id).cast("int").alias("run_id"),
        "query_id", "query_text", "expected_doc_id", "retrieved_doc_id", "rank",
        F.coalesce(match & (F.col("rank") <= k), F.lit(False)).alias("hit_at_k"),
        F.when(match, 1.0 / F.col("rank")).otherwise(0.0).alias("reciprocal_rank"),
    )


def metrics(evaluated: DataFrame) -> DataFrame:
    """One row: queries, hit rate at k, mean reciprocal rank."""
    per_query = evaluated.groupBy("query_id").agg(
        F.max(F.col("hit_at_k").cast("int")).alias("hit"),
        F.max("reciprocal_rank").alias("rr"))
    return per_query.agg(
        F.count("*").alias("n_queries"), F.avg("hit").alias("hit_rate"), F.avg("rr").alias("mrr"))


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: share of the true (query_id, id) pairs that were found."""
    hit = found.select("query_id", "id", F.lit(1).alias("hit"))
    return truth.select("query_id", "id").join(hit, ["query_id", "id"], "left").agg(
        F.count("*").alias("n_true"), F.count("hit").alias("n_found"),
        (F.count("hit") / F.count("*")).alias("recall"))
