"""Batch retrieval from a warehouse."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions.encoders import Encoder, HashingEncoder, encode_column
from corpusloom.operators import evaluation, index_store, quality, search
from corpusloom.plans.build import stored_curve, whole_index
from corpusloom.sources.scratch import written
from corpusloom.sources.warehouse import Warehouse


def encode_queries(queries: DataFrame, encoder: Encoder) -> DataFrame:
    """(query_id, query_text) to (query_id, embedding)."""
    coded = encode_column(queries.select("query_id", "query_text"), "query_text", encoder,
                          S.QUERY_PREFIX)
    return coded.select("query_id", "embedding")


def retrieve(w: Warehouse, queries: DataFrame, top_k: int = 5, nprobe: int | None = None,
             dataset_name: str | None = None, encoder: Encoder | None = None,
             least_recall: float = S.AIMED_RECALL) -> DataFrame:
    """The best chunks for each (query_id, query_text), with their texts, by query and rank.

    Uses the newest index of a successful run. A null text is asked like an empty one. Without
    ``nprobe`` so many cells are probed, the index's own number at least, that ``least_recall`` of
    the true neighbours of stored vectors were found when the index was built. Questions may fare
    better or worse than stored vectors.
    """
    spark = w.spark
    registry = w.read("index_registry")
    if dataset_name is not None:
        registry = registry.filter(F.col("dataset_name") == dataset_name)
    newest = quality.newest_index(registry).filter("is_active").orderBy(
        F.desc("created_at")).first()
    if newest is None:
        raise ValueError("no index has been built")
    centroids = index_store.read_centroids(spark, newest.centroids_path)
    parts = [tuple(r)[:3] for r in w.index_parts(newest.run_id)]
    index = whole_index(w, parts) if parts else index_store.read_index(spark, newest.index_path)
    index = index.withColumnRenamed("chunk_id", "id")
    asked = written(encode_queries(queries, encoder or HashingEncoder()), "questions")
    if nprobe is None:
        curve = stored_curve(w, newest.index_checksum) or search.measured_curve(index, centroids)
        nprobe = max(newest.nprobe, search.probes_for(curve, least_recall))
    blocks = search.ivf_blocks(asked, index, centroids, top_k, nprobe)
    closures, chunks = w.read("closures"), w.read("chunks")
    documents = w.read("clean_documents")
    found = (search.hydrate(hits, chunks, documents, closures) for hits in blocks)
    return search.in_one(found, "retrieved").orderBy("query_id", "rank")


def evaluate_retrieval(w: Warehouse, expected: DataFrame, top_k: int = 5, **options) -> DataFrame:
    """Ask each (query_id, query_text, expected_doc_id), keep how the hits fared and return it.

    The rows are appended to ``retrieval_eval`` under the run whose index answered.
    """
    asked = written(expected.select("query_id", "query_text", "expected_doc_id"), "expected")
    hits = retrieve(w, asked, top_k, **options)
    run_id = quality.newest_index(w.read("index_registry")).filter("is_active").agg(
        F.max("run_id")).first()[0]
    rows = evaluation.evaluate(
        hits.select("query_id", F.col("doc_id").alias("retrieved_doc_id"), "rank"), asked, top_k, run_id)
    rows = written(rows.withColumn("query_id", F.col("query_id").cast("string")).withColumn(
        "created_at", F.current_timestamp()), "evaluated")
    w.append("retrieval_eval", rows)
    return rows
