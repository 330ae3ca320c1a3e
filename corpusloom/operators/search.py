"""Top-k search by inner product, exact or over the probed cells of an index.

Queries are written once in blocks of bounded size, those that probe the same cells together.
Blocks are taken one after the other: a block passes through the driver into a broadcast for the
tasks that scan the cells it probes, its ranked hits are written, and the broadcast is destroyed
before the next block is read. The driver holds the block numbers and one block. The corpus is not
shuffled, and each task keeps k hits per query. More queries mean more passes, never another way
of searching, and no row is dropped before it was scored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import settings as S
from corpusloom.functions import vectors as V
from corpusloom.operators import chunking, ivf
from corpusloom.sources import scratch
from corpusloom.sources.scratch import in_one


# Hits that a task keeps at least before it drops those beyond the best of each query.
FOLD_HITS = 1 << 16


def rank_hits(hits: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score) to the best k per query, with rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _hit_schema(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", corpus.schema["id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _scan_with_queries(queries: pa.Table, corpus: DataFrame, k: int,
                       schema: T.StructType) -> tuple[DataFrame, Broadcast]:
    """Score a bounded query table (query_id, embedding, cells) inside the corpus scan.

    Without cells every query meets every row. The broadcast holds the queries; it may be
    destroyed when the hits have been written.
    """
    if "cells" not in queries.column_names:
        everywhere = pa.array([[0]] * queries.num_rows, pa.list_(pa.int32()))
        queries = queries.append_column("cells", everywhere)
        corpus = corpus.withColumn("cell", F.lit(0))
    query_ids = queries.column("query_id").combine_chunks()
    wanted = V.matrix(queries.column("embedding"))
    cells = queries.column("cells").combine_chunks()
    counts = cells.value_lengths().to_numpy()
    pairs = np.repeat(np.arange(len(counts)), counts), np.asarray(cells.flatten())
    by_cell = {int(c): pairs[0][pairs[1] == c] for c in np.unique(pairs[1])}
    corpus = corpus.filter(F.col("cell").isin(list(by_cell)))
    shared = corpus.sparkSession.sparkContext.broadcast((query_ids, wanted, by_cell))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, wanted, by_cell = shared.value
        kept, pending = [], 0

        def fold():
            return [V.trim_hits(pa.concat_tables(kept), k)]

        for batch in batches:
            ids, cell = batch.column(0), np.asarray(batch.column(2))
            vectors = V.matrix(batch.column(1))
            for c in np.unique(cell):
                members = np.flatnonzero(cell == c)
                asked = by_cell[int(c)]
                part = ids.take(pa.array(members))
                q, r, s = V.block_topk(wanted[asked], vectors[members], part, k)
                kept.append(pa.table({"q": asked[q], "id": part.take(pa.array(r)), "score": s}))
                pending += len(q)
            # Hits wait in numbers that follow the queries, not the rows of the task.
            if pending > max(FOLD_HITS, k * len(wanted)):
                kept, pending = fold(), 0
        if kept:
            best = fold()[0].combine_chunks()
            yield from pa.table({
                "query_id": query_ids.take(best.column("q").combine_chunks()),
                "id": best.column("id"), "score": best.column("score"),
            }).to_batches()

    return corpus.select("id", "embedding", "cell").mapInArrow(run, schema), shared


def query_blocks(queries: DataFrame, k: int) -> tuple[DataFrame, list[int]]:
    """The queries (query_id, embedding, and cells if any) as a table written by ``block``, of
    bounded size each, and the numbers of the blocks."""
    path = scratch.new_folder(queries.sparkSession, "queries")
    first = F.col("cells")[0] if "cells" in queries.columns else F.lit(0)
    queries.withColumn("first", first).write.parquet(path)
    scratch.release_at_end(queries.sparkSession, path)
    stored = queries.sparkSession.read.parquet(path)
    width = F.size("embedding") * 8 + 100 * k
    total = stored.agg(F.sum(width)).first()[0]
    if total is None:
        return queries.withColumn("block", F.lit(0)), []
    wanted = 1 + total // S.QUERY_BLOCK_BYTES
    if wanted == 1:
        return stored.drop("first").withColumn("block", F.lit(0)), [0]
    # Hashed within ranges of the first cell, so that blocks stay bounded whatever the cells.
    dealt = stored.repartitionByRange(wanted, "first", F.xxhash64("query_id"), "query_id")
    dealt = dealt.withColumn("block", F.spark_partition_id())
    dealt.write.partitionBy("block").parquet(f"{path}-blocks")
    scratch.release_at_end(queries.sparkSession, f"{path}-blocks")
    blocks = queries.sparkSession.read.parquet(f"{path}-blocks")
    numbers = sorted(r.block for r in blocks.select("block").distinct().collect())
    return blocks.select(*queries.columns, "block"), numbers


def block_hits(queries: DataFrame, corpus: DataFrame, k: int) -> Iterator[DataFrame]:
    """Ranked hits of queries (query_id, embedding[, cells]) on corpus (id, embedding[, cell]),
    in written tables of at most k rows for each query of a bounded block.

    A block is searched when its table is asked for; nothing of it is left in the driver after.
    """
    schema = _hit_schema(queries, corpus)
    blocks, numbers = query_blocks(queries, k)
    for n in numbers:
        block = blocks.filter(F.col("block") == n).drop("block").toArrow()
        hits, shared = _scan_with_queries(block, corpus, k, schema)
        del block
        found = scratch.written(rank_hits(hits, k), "hits")
        shared.destroy()
        yield found
    if not numbers:
        yield rank_hits(queries.sparkSession.createDataFrame([], schema), k)


def exact_topk(queries: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Best k of corpus (id, embedding) for each of queries (query_id, embedding)."""
    return in_one(block_hits(
        queries.select("query_id", "embedding"), corpus.select("id", "embedding"), k), "found")


def ivf_blocks(queries: DataFrame, index: DataFrame, centroids: ivf.Centroids, k: int,
               nprobe: int = S.NPROBE) -> Iterator[DataFrame]:
    """Best k of index (id, embedding, cell) within the nprobe nearest cells of each query."""
    probed = ivf.probe(queries.select("query_id", "embedding"), centroids, nprobe)
    return block_hits(probed, index.select("id", "embedding", "cell"), k)


def ivf_topk(*args, **options) -> DataFrame:
    return in_one(ivf_blocks(*args, **options), "found")


@dataclass(frozen=True)
class Certified:
    """Exact hits, and per query how many cells there are and how many were searched for them."""

    hits: DataFrame
    cells: DataFrame


def certified_topk(queries: DataFrame, index: DataFrame, centroids: ivf.Centroids, k: int,
                   nprobe: int = S.NPROBE) -> Certified:
    """Best k of index (id, embedding, cell) for each query, exactly, without reading all cells.

    The nearest cells give a k-th score. No vector of a cell scores higher than the centroid does
    plus the length of the query times the radius of the cell, so cells whose bound lies below the
    k-th score are left out and all others are searched. Where nothing can be left out every cell
    is searched. ``index`` is read three times and should be a stored table.
    """
    radius = ivf.radii(index, centroids)
    centres, margin = centroids.matrix, 10.0 ** (2 - S.SCORE_DECIMALS)
    probed = ivf.probe(queries.select("query_id", "embedding"), centroids, nprobe)
    probed = scratch.written(probed, "probed")
    first = in_one(block_hits(probed, index.select("id", "embedding", "cell"), k), "near")
    lowest = first.groupBy("query_id").agg(
        F.min(F.when(F.col("rank") == k, F.col("score"))).alias("score"))
    asked = probed.join(lowest, "query_id", "left").select("query_id", "embedding", "cells", "score")

    def beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            wanted = V.matrix(batch.column(1))
            bound = wanted @ centres.T + np.linalg.norm(wanted, axis=1)[:, None] * radius[None, :]
            score = batch.column(3).to_numpy(zero_copy_only=False)
            open_ = (np.isnan(score)[:, None] | (bound >= score[:, None] - margin)) & (radius >= 0)
            left = []
            for row, near in zip(open_, batch.column(2).to_pylist()):
                row[near] = False
                left.append(np.flatnonzero(row).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(left, pa.list_(pa.int32())),
                 pa.array([len(c) for c in batch.column(2).to_pylist()], pa.int32())],
                names=["query_id", "embedding", "cells", "n_near"])

    schema = T.StructType([probed.schema["query_id"], probed.schema["embedding"],
                           probed.schema["cells"], T.StructField("n_near", T.IntegerType())])
    rest = scratch.written(asked.mapInArrow(beyond, schema), "open-cells")
    more = in_one(block_hits(rest.filter(F.size("cells") > 0).select(*probed.columns),
                             index.select("id", "embedding", "cell"), k), "far")
    hits = rank_hits(first.drop("rank").unionByName(more.drop("rank")), k)
    cells = rest.select("query_id", F.lit(centroids.nlist).alias("n_cells"),
                        (F.col("n_near") + F.size("cells")).alias("n_searched"))
    return Certified(hits, cells)


def recall_curve(queries: DataFrame, truth: DataFrame, index: DataFrame,
                 centroids: ivf.Centroids) -> list[tuple[int, int]]:
    """(true, found) pairs by number of probes, from one probe to all cells.

    A true neighbour (query_id, id) is found exactly when its cell is probed, so the place of that
    cell among the cells of its query tells the probes it takes.
    """
    ordered = ivf.probe(queries.select("query_id", "embedding"), centroids, centroids.nlist)
    places = truth.select("query_id", "id").join(index.select("id", "cell"), "id").join(
        ordered.select("query_id", "cells"), "query_id").groupBy(
            F.array_position("cells", F.col("cell")).alias("place")).count()
    counts = np.zeros(centroids.nlist + 1, np.int64)
    for r in places.collect():
        counts[r.place] = r["count"]
    found = counts.cumsum()[1:].tolist()
    return [(found[-1], n) for n in found]


def probes_for(curve: list[tuple[int, int]], least: float) -> int:
    """The fewest probes that find at least this share; one if there is nothing to find."""
    return next(n for n, (true, found) in enumerate(curve, 1) if found >= least * true)


def probes_for_recall(queries: DataFrame, truth: DataFrame, index: DataFrame,
                      centroids: ivf.Centroids, least: float = S.LEAST_RECALL) -> int:
    """The fewest probes that find at least this share of the true (query_id, id) pairs."""
    return probes_for(recall_curve(queries, truth, index, centroids), least)


def measured_curve(index: DataFrame, centroids: ivf.Centroids,
                   chosen: DataFrame | None = None, n: int = S.RECALL_VECTORS,
                   k: int = S.RECALL_NEIGHBOURS) -> list[tuple[int, int]]:
    """The recall curve of an index (id, embedding, cell) on the other neighbours of vectors of its
    own: of ``chosen`` (id, embedding), or all, the n with the smallest hashes of their ids."""
    pool = (index if chosen is None else chosen).select("id", "embedding")
    sample = scratch.written(
        pool.orderBy(F.xxhash64("id"), "id").limit(n).withColumnRenamed("id", "query_id"), "sample")
    truth = without_self(exact_topk(sample, index, k + 1), k)
    return recall_curve(sample, scratch.written(truth, "truth"), index, centroids)


def without_self(hits: DataFrame, k: int) -> DataFrame:
    """Leave-one-out form of hits that were asked for with k + 1."""
    others = hits.filter(F.col("query_id") != F.col("id")).drop("rank")
    return rank_hits(others, k)


RESULT_COLUMNS = ["query_id", "rank", "score", "chunk_id", "doc_id", "chunk_text", "chunk_index",
                  "start_tok", "end_tok", "title", "url"]


def hydrate(hits: DataFrame, chunks: DataFrame, documents: DataFrame,
            closures: DataFrame | None = None) -> DataFrame:
    """Hits (id = chunk_id) of one block beside the text of their active chunks and documents.

    A block has a bounded number of hits, so the hits travel and no text is shuffled. Where chunks
    lie in folders by ``prefix``, only the folders of the hits are read. What ``closures`` ended is
    left out; ranks were given before, so it leaves a gap.
    """
    asked = hits.filter("rank >= 1").select("query_id", "rank", "score", F.col("id").alias("chunk_id"))
    keys = ["chunk_id"]
    if "prefix" in chunks.columns:
        asked, keys = asked.withColumn("prefix", chunking.prefix("chunk_id")), ["prefix", "chunk_id"]
    found = chunks.select(
        *keys, "doc_id", "source_run_id", "chunk_text", "chunk_index", "start_tok",
        "end_tok").join(F.broadcast(asked), keys)
    if closures is not None:
        found = scratch.written(found, "hit-chunks")
        keys = ["doc_id", "source_run_id"]
        ended = closures.select("doc_id", F.col("valid_from_run_id").alias("source_run_id")).join(
            F.broadcast(found.select(*keys)), keys, "left_semi")
        found = found.join(F.broadcast(ended), keys, "left_anti")
    return documents.select("doc_id", "source_run_id", "title", "url").join(
        F.broadcast(found), ["doc_id", "source_run_id"]).select(RESULT_COLUMNS)
