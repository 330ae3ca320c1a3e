"""Cells in two levels, for more cells than a driver should hold.

A coarse quantiser, a bounded matrix, deals vectors into groups; every group has fine cells of its
own, whose centroids are a table and never all in one place. Fine cells are trained on a bounded
number of a group's vectors, those with the smallest hashes of their ids; every vector is assigned.
A cell is numbered coarse * n_fine + fine.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import settings as S
from corpusloom.functions import vectors as V
from corpusloom.functions.encoders import float_lists
from corpusloom.operators import ivf, search
from corpusloom.sources.scratch import written

# Vectors that train each fine cell of a group, at most.
TRAINED_PER_CELL = 64
STEPS = 8
# A group is dealt over so many tasks when its vectors are assigned or its queries ranked.
SALTS = 16


@dataclass(frozen=True)
class TwoLevel:
    """``fine`` has (coarse, fine, centroid), stored; a group without vectors has no row."""

    coarse: ivf.Centroids
    fine: DataFrame
    n_fine: int


def _fine_centroids(vectors: np.ndarray, n: int) -> np.ndarray:
    """k-means from vectors spread over the group by farthest-first choice; cells that lose all
    their vectors keep their place."""
    chosen = [0]
    nearest = ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(vectors)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
    centres = vectors[chosen].copy()
    for _ in range(STEPS):
        cell = V.nearest_cells(vectors, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, vectors)
        held = np.bincount(cell, minlength=len(centres))
        centres[held > 0] = sums[held > 0] / held[held > 0, None]
    return centres


def train(vectors: DataFrame, n_coarse: int, n_fine: int, seed: int = S.SEED) -> TwoLevel:
    """Quantisers for vectors (id, embedding), a stored table."""
    coarse = ivf.train(vectors, n_coarse, seed)
    grouped = ivf.assign(vectors.select("id", "embedding"), coarse)
    order = Window.partitionBy("cell").orderBy(F.xxhash64("id"), "id")
    sample = grouped.withColumn("n", F.row_number().over(order)).filter(
        F.col("n") <= n_fine * TRAINED_PER_CELL)

    def fit(table: pa.Table) -> pa.Table:
        ids = table.column("id")
        rows = table.take(pc.sort_indices(ids))
        centres = _fine_centroids(V.matrix(rows.column("embedding")), n_fine).astype(np.float32)
        return pa.table({
            "coarse": pa.array([table.column("cell")[0].as_py()] * len(centres), pa.int32()),
            "fine": pa.array(range(len(centres)), pa.int32()), "centroid": float_lists(centres)})

    fine = sample.select("id", "embedding", "cell").groupBy("cell").applyInArrow(
        fit, "coarse int, fine int, centroid array<float>")
    return TwoLevel(coarse, written(fine, "fine-cells"), n_fine)


def _beside_fine(rows: DataFrame, cells: TwoLevel, body, result: T.StructType) -> DataFrame:
    """body(rows as a batch, coarse, fine centroids) over rows with ``coarse``, group by group.

    Rows are dealt by group and salt and read in order, after the group's centroids; centroids are
    repeated once per salt, rows move once, and a hot group is many tasks.
    """
    names = rows.columns
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    heads = cells.fine.select("coarse", salts.alias("salt"), "fine", "centroid")
    for f in rows.schema.fields:
        if f.name != "coarse":
            heads = heads.withColumn(f.name, F.lit(None).cast(f.dataType))
    tails = rows.withColumn("salt", F.pmod(F.xxhash64(names[0]), F.lit(SALTS)).cast("int")).withColumns({
        "fine": F.lit(None).cast("int"), "centroid": F.lit(None).cast("array<float>")})
    order = ["coarse", "salt", "fine", "centroid"]
    rest = [n for n in names if n != "coarse"]
    met = heads.select(*order, *rest).unionByName(tails.select(*order, *rest))
    met = met.repartition("coarse", "salt").sortWithinPartitions(
        "coarse", "salt", F.col("fine").asc_nulls_last())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centres = None, []
        for batch in batches:
            coarse, salt = (np.asarray(batch.column(i)) for i in (0, 1))
            is_head = np.asarray(batch.column(2).is_valid())
            steps = np.flatnonzero(np.diff(coarse) | np.diff(salt) | np.diff(is_head.astype(np.int8))) + 1
            for start, end in zip([0, *steps], [*steps, batch.num_rows]):
                if start == end:
                    continue
                part, key = batch.slice(start, end - start), (coarse[start], salt[start])
                if key != at:
                    at, centres = key, []
                if is_head[start]:
                    centres.append(V.matrix(part.column(3)))
                    continue
                if not centres:  # a group without vectors
                    continue
                centres = [np.concatenate(centres)]
                own = pa.RecordBatch.from_arrays(part.columns[4:], names=rest)
                yield body(own, int(coarse[start]), centres[0])

    return met.mapInArrow(walk, result)


def assign(vectors: DataFrame, cells: TwoLevel) -> DataFrame:
    """(id, embedding, cell): the nearest fine cell of the nearest coarse one, for every vector."""
    rows = ivf.assign(vectors.select("id", "embedding"), cells.coarse).withColumnRenamed("cell", "coarse")
    result = T.StructType([rows.schema["id"], rows.schema["embedding"],
                           T.StructField("cell", T.IntegerType())])

    n_fine = cells.n_fine

    def near(batch: pa.RecordBatch, coarse: int, centres: np.ndarray) -> pa.RecordBatch:
        fine = V.nearest_cells(V.matrix(batch.column(1)), centres, 1)[:, 0]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array((coarse * n_fine + fine).astype(np.int32))],
            names=result.names)

    return _beside_fine(rows, cells, near, result)


def probe(queries: DataFrame, cells: TwoLevel, n_coarse: int, n_probe: int) -> DataFrame:
    """Add ``cells``: of the fine cells of the n_coarse nearest groups the n_probe nearest ones."""
    asked = ivf.probe(queries.select("query_id", "embedding"), cells.coarse, n_coarse)
    rows = asked.select("query_id", "embedding", F.explode("cells").alias("coarse"))
    place = T.StructType().add("distance", T.DoubleType()).add("cell", T.IntegerType())
    result = T.StructType([rows.schema["query_id"], T.StructField("near", T.ArrayType(place))])

    n_fine = cells.n_fine

    def rank(batch: pa.RecordBatch, coarse: int, centres: np.ndarray) -> pa.RecordBatch:
        wanted = V.matrix(batch.column(1))
        away = np.round((centres * centres).sum(axis=1) - 2.0 * (wanted @ centres.T), S.SCORE_DECIMALS)
        best = np.argsort(away, axis=1, kind="stable")[:, :n_probe]
        near = [[{"distance": float(row[c]), "cell": coarse * n_fine + int(c)} for c in own]
                for row, own in zip(away, best)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(near, pa.list_(pa.struct(
                [("distance", pa.float64()), ("cell", pa.int32())])))], names=result.names)

    # At most n_coarse * n_probe numbers per query.
    ranked = _beside_fine(rows, cells, rank, result).groupBy("query_id").agg(F.slice(
        F.array_sort(F.flatten(F.collect_list("near"))), 1, n_probe).alias("near"))
    return queries.select("query_id", "embedding").join(ranked, "query_id").select(
        "query_id", "embedding", F.col("near.cell").alias("cells"))


def topk(queries: DataFrame, index: DataFrame, cells: TwoLevel, k: int, n_coarse: int,
         n_probe: int) -> DataFrame:
    """Best k of index (id, embedding, cell) within the fine cells probed for each query."""
    probed = written(probe(queries, cells, n_coarse, n_probe), "probed")
    return search.in_one(search.block_hits(probed, index.select("id", "embedding", "cell"), k), "found")
