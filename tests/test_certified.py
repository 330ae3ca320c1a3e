import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import numpy as np
from tests_frames import clustered, frame

from corpusloom.operators import ivf, search
from corpusloom.sources.scratch import written


def both(spark, points, ids, nlist, k, nprobe):
    df = written(frame(spark, "id", ids, points), "corpus")
    centroids = ivf.train(df, nlist)
    index = written(ivf.assign(df, centroids), "index")
    asked = frame(spark, "query_id", ids[::60], points[::60])
    found = search.certified_topk(asked, index, centroids, k, nprobe)
    return (sorted(found.hits.collect()), sorted(search.exact_topk(asked, df, k).collect()),
            found.cells.collect())


def test_clusters_let_most_cells_be_left_out(spark):
    points, ids = clustered(1, 30, 40)
    hits, exact, cells = both(spark, points, ids, 30, 6, 2)
    assert hits == exact and len(cells) == 20
    assert all(r.n_cells == 30 and r.n_searched >= 2 for r in cells)
    assert np.mean([r.n_searched for r in cells]) < 12


def test_without_clusters_every_cell_is_searched(spark):
    draw = np.random.default_rng(2)
    points = draw.normal(size=(600, 16)).astype(np.float32).astype(np.float64)
    hits, exact, cells = both(spark, points, [f"v{i:05d}" for i in range(600)], 20, 6, 2)
    assert hits == exact and max(r.n_searched for r in cells) == 20


def test_fewer_vectors_near_than_asked_for(spark):
    points, ids = clustered(3, 12, 3)
    hits, exact, _ = both(spark, points, ids, 12, 9, 1)
    assert hits == exact


def test_radii(spark):
    points, ids = clustered(4, 8, 10)
    df = written(frame(spark, "id", ids, points), "corpus")
    centroids = ivf.Centroids(np.vstack([ivf.train(df, 8).matrix, [[9.0] * 16]]))
    index = ivf.assign(df, centroids)
    found = ivf.radii(index, centroids)
    want = {}
    for r in index.collect():
        away = float(np.linalg.norm(np.array(r.embedding) - centroids.matrix[r.cell]))
        want[r.cell] = max(want.get(r.cell, 0), away)
    assert found[8] == -1 and {c: found[c] for c in want} == {c: want[c] for c in want}
