"""Cell-partitioned (inverted file) vector index: training and assignment."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import settings as S
from corpusloom.functions import vectors as V
from corpusloom.functions.encoders import float_lists


CELL_LIMIT = 1 << 16


@dataclass(frozen=True)
class Centroids:
    """The coarse quantiser: one row per cell. Its size is bounded by the cell limit."""

    matrix: np.ndarray

    @property
    def nlist(self) -> int:
        return len(self.matrix)

    @staticmethod
    def from_df(df: DataFrame, limit: int = CELL_LIMIT) -> "Centroids":
        """Read (cell, centroid); cells must be 0..n-1 and at most ``limit``."""
        rows = df.select("cell", "centroid").orderBy("cell").limit(limit + 1).toArrow()
        if rows.num_rows > limit:
            raise ValueError(f"more than {limit} cells")
        if rows.column("cell").to_pylist() != list(range(rows.num_rows)):
            raise ValueError("cells must be numbered from 0 without gaps")
        return Centroids(V.matrix(rows.column("centroid")))

    def to_df(self, spark: SparkSession) -> DataFrame:
        table = pa.table({
            "cell": pa.array(range(self.nlist), pa.int32()),
            "centroid": float_lists(self.matrix.astype(np.float32)),
        })
        return spark.createDataFrame(table)


def cell_count(n: int, limit: int = S.MAX_CELLS) -> int:
    """Adaptive number of cells, never more than there are vectors."""
    return max(1, min(n, limit, max(S.MIN_CELLS, n // S.VECTORS_PER_CELL)))


def train(vectors: DataFrame, nlist: int, seed: int = S.SEED, max_iter: int = 10) -> Centroids:
    """Spherical k-means over the embeddings of all rows, combined in the tasks that read them.

    Zero vectors have no direction and do not train. ``vectors`` is read once per step, so it
    should be a stored table.
    """
    chosen = vectors.select("embedding").filter(F.exists("embedding", lambda x: x != 0))
    if chosen.isEmpty():
        dim = len(vectors.select("embedding").first()[0])
        return Centroids(np.zeros((1, dim)))
    if nlist == 1:
        return Centroids.from_df(mean_centroids(chosen.withColumn("cell", F.lit(0)), "cell"))
    points = chosen.select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter, distanceMeasure="cosine").fit(points)
    centres = np.array(model.clusterCenters())
    return Centroids(centres)


def mean_centroids(vectors: DataFrame, cell_column: str) -> DataFrame:
    """(cell, centroid): the mean vector of each cell, combined before the shuffle.

    With a first guess of the cells as input this is the update step of k-means.
    """
    mean = Summarizer.mean(array_to_vector("embedding"))
    return vectors.groupBy(F.col(cell_column).cast("int").alias("cell")).agg(
        vector_to_array(mean).alias("centroid"))


def _with_cells(df: DataFrame, centroids: Centroids, n: int, one: bool) -> DataFrame:
    at = df.columns.index("embedding")
    kind = T.IntegerType() if one else T.ArrayType(T.IntegerType())
    name = "cell" if one else "cells"
    schema = T.StructType(df.schema.fields + [T.StructField(name, kind)])
    names, centres = schema.names, centroids.matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = V.nearest_cells(V.matrix(batch.column(at)), centres, n).astype(np.int32)
                cells = pa.array(near[:, 0]) if one else pa.array(list(near), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(batch.columns + [cells], names=names)

    return df.mapInArrow(run, schema)


def assign(vectors: DataFrame, centroids: Centroids) -> DataFrame:
    """Add ``cell``, the nearest centroid, to every row; a map without a shuffle."""
    return _with_cells(vectors, centroids, 1, True)


def probe(queries: DataFrame, centroids: Centroids, nprobe: int = S.NPROBE) -> DataFrame:
    """Add ``cells``, the nprobe nearest cells, to every query."""
    return _with_cells(queries, centroids, min(nprobe, centroids.nlist), False)


def is_nearest(index: DataFrame, centroids: Centroids, margin: float = 1e-6) -> DataFrame:
    """Add ``is_nearest``: whether no centroid is nearer than that of the row's cell.

    Distances are taken from differences, apart from the formula that assigns cells.
    """
    at, cell = index.columns.index("embedding"), index.columns.index("cell")
    centres, names = centroids.matrix, [*index.columns, "is_nearest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, nearest = V.matrix(batch.column(at)), np.full(batch.num_rows, np.inf)
                for c in centres:
                    np.minimum(nearest, ((rows - c) ** 2).sum(axis=1), out=nearest)
                own = ((rows - centres[np.asarray(batch.column(cell))]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(own <= nearest + margin)], names=names)

    return index.mapInArrow(run, T.StructType(
        index.schema.fields + [T.StructField("is_nearest", T.BooleanType())]))


def cell_sizes(index: DataFrame) -> DataFrame:
    return index.groupBy("cell").agg(F.count("*").alias("n_vectors"))


def radii(index: DataFrame, centroids: Centroids) -> np.ndarray:
    """Per cell the distance of its farthest vector from the centroid; -1 for an empty cell.

    ``index`` has (embedding, cell). A task sends one number per cell, a bounded number of them.
    """
    centres = centroids.matrix

    def farthest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.full(len(centres), -1.0)
        for batch in batches:
            if batch.num_rows:
                cells = np.asarray(batch.column(1))
                away = np.linalg.norm(V.matrix(batch.column(0)) - centres[cells], axis=1)
                np.maximum.at(own, cells, away)
        held = np.flatnonzero(own >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(own[held])],
                                         names=["cell", "radius"])

    rows = index.select("embedding", "cell").mapInArrow(farthest, "cell int, radius double")
    found = np.full(len(centres), -1.0)
    for r in rows.groupBy("cell").agg(F.max("radius").alias("radius")).collect():
        found[r.cell] = r.radius
    return found
