"""The index as files: vectors partitioned by cell, centroids beside them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom import settings as S
from corpusloom.functions import text as X
from corpusloom.operators import ivf, quality, search
from corpusloom.sources import scratch


def write_index(assigned: DataFrame, centroids: ivf.Centroids, index_path: str,
                centroids_path: str) -> None:
    """Write vectors by cell.

    Rebalancing brings a cell into few files, merges small cells into one task and splits a
    cell that is too large for one.
    """
    (assigned.select(*schemas.TABLES["index_vectors"].names)
     .hint("rebalance", "cell")
     .write.mode("overwrite").partitionBy("cell").parquet(index_path, compression=scratch.TEXT_CODEC))
    centroids.to_df(assigned.sparkSession).coalesce(1).write.mode("overwrite").parquet(
        centroids_path)


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    return spark.read.schema(schemas.TABLES["index_vectors"]).parquet(index_path)


def read_centroids(spark: SparkSession, centroids_path: str) -> ivf.Centroids:
    stored = spark.read.schema(schemas.TABLES["index_centroids"]).parquet(centroids_path)
    return ivf.Centroids.from_df(stored)


def index_checksum(index: DataFrame) -> DataFrame:
    """One row: n_rows and digest over (chunk_id, cell, embedding_hash) of every row."""
    rows = index.select(X.key_hash("chunk_id", "cell", "embedding_hash").alias("h"))
    return quality.multiset_digest(rows, "h")


def build_index(active_embeddings: DataFrame, index_path: str, centroids_path: str,
                max_cells: int = S.MAX_CELLS) -> dict:
    """Train, assign and store an index over all active vectors; returns its facts.

    The active vectors are found once and written; training, assignment and the count read them, then
    they are removed.
    ``curve`` is the recall of the index by number of probes, measured once it is stored.
    """
    if not 1 <= max_cells <= ivf.CELL_LIMIT:
        raise ValueError(f"max_cells must be 1 to {ivf.CELL_LIMIT}")
    spark = active_embeddings.sparkSession
    vectors = scratch.written(
        active_embeddings.select("chunk_id", "embedding_hash", "embedding"), "active-vectors",
        scratch.TEXT_CODEC)
    rows = vectors.count()
    if not rows:
        raise ValueError("no active embeddings: an index cannot be built")
    centroids = ivf.train(vectors, ivf.cell_count(rows, max_cells))
    write_index(ivf.assign(vectors, centroids), centroids, index_path, centroids_path)
    scratch.remove(vectors)
    index = read_index(spark, index_path)
    stored = index_checksum(index).first()
    curve = search.measured_curve(index.withColumnRenamed("chunk_id", "id"), centroids)
    return {"num_vectors": stored.n_rows, "nlist": centroids.nlist, "checksum": stored.digest,
            "curve": curve}


def read_parts(spark: SparkSession, parts: list[tuple[int, str]], closed: DataFrame) -> DataFrame:
    """The vectors of an index of several parts (run, path), a bounded number of them.

    A vector counts unless a later run than that of its part closed its chunk (closed: chunk_id,
    run_id). A text that comes back has its old chunk ids again, in a later part.
    """
    index = quality.union_all([read_index(spark, path).withColumn("part_run", F.lit(run))
                               for run, path in parts])
    if len(parts) > 1:
        since = closed.filter(F.col("run_id") > parts[0][0]).select(
            F.col("chunk_id").alias("closed_id"), F.col("run_id").alias("closed_run"))
        index = index.join(since, (F.col("chunk_id") == F.col("closed_id"))
                           & (F.col("closed_run") > F.col("part_run")), "left_anti")
    return index.drop("part_run")


def add_part(fresh: DataFrame, centroids: ivf.Centroids, index_path: str) -> None:
    """Write new vectors (chunk_id, embedding_hash, embedding) by the cells of a built index."""
    assigned = ivf.assign(fresh.select("chunk_id", "embedding_hash", "embedding"), centroids)
    (assigned.select(*schemas.TABLES["index_vectors"].names).hint("rebalance", "cell")
     .write.mode("overwrite").partitionBy("cell").parquet(index_path, compression=scratch.TEXT_CODEC))
