"""Vector column expressions, and the scoring helpers tasks use on Arrow batches."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions.text import col, let


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product, accumulated in double."""
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def difference(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(col(a), col(b), lambda x, y: x.cast("double") - y.cast("double"))


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalise(v: Column | str) -> Column:
    """The vector scaled to length one; a zero vector stays zero."""
    safe = F.when(l2_norm(v) == 0, F.lit(1.0)).otherwise(l2_norm(v))
    return let(safe, lambda n: F.transform(col(v), lambda x: (x / n).cast("float")))


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow list column as a double matrix; all rows must have one length."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    n = len(lists)
    flat = np.asarray(lists.flatten(), dtype=np.float64)
    if n and (len(flat) % n or lists.null_count):
        raise ValueError("vectors of one column must have equal length and no nulls")
    return flat.reshape(n, len(flat) // n if n else 0)


def block_topk(queries: np.ndarray, corpus: np.ndarray, ids: pa.Array, k: int):
    """Top-k corpus rows for each query row, as (query row, corpus row, score) arrays.

    Order is score descending, then id ascending, with scores rounded first; ties at the
    k-th place are settled by id as well. Queries go through in slices so that the score
    matrix stays small whatever the number of queries.
    """
    m = len(corpus)
    place = np.empty(m, dtype=np.int64)
    place[pc.sort_indices(ids).to_numpy()] = np.arange(m)
    step = max(1, 4_000_000 // max(m, 1))
    found = []
    for at in range(0, len(queries), step):
        scores = queries[at:at + step] @ corpus.T
        if m > k:
            # Keep what may still tie with the k-th score after rounding.
            floor = np.partition(scores, m - k, axis=1)[:, m - k] - 10.0 ** (1 - S.SCORE_DECIMALS)
            q, c = np.nonzero(scores >= floor[:, None])
        else:
            q, c = (a.ravel() for a in np.indices(scores.shape))
        s = np.round(scores[q, c], S.SCORE_DECIMALS)
        order = np.lexsort((place[c], -s, q))
        q, c, s = q[order], c[order], s[order]
        first = np.searchsorted(q, q, side="left")
        top = np.arange(len(q)) - first < k
        found.append((q[top] + at, c[top], s[top]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(parts) for parts in zip(*found))


def trim_hits(hits: pa.Table, k: int) -> pa.Table:
    """Best k rows per query of a (q, id, score) table."""
    order = pc.sort_indices(
        hits, sort_keys=[("q", "ascending"), ("score", "descending"), ("id", "ascending")])
    hits = hits.take(order)
    q = hits.column("q").to_numpy()
    return hits.filter(pa.array(np.arange(len(q)) - np.searchsorted(q, q, side="left") < k))


def nearest_cells(vectors: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centroids of each row by Euclidean distance; ties go to the lower number."""
    distance = (centroids * centroids).sum(axis=1) - 2.0 * (vectors @ centroids.T)
    return np.argsort(np.round(distance, S.SCORE_DECIMALS), axis=1, kind="stable")[:, :n]
