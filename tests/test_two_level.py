import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import numpy as np
import pytest

from corpusloom.operators import evaluation, ivf, search, two_level
from corpusloom.functions import vectors as V
from corpusloom.sources.scratch import written
from tests_frames import clustered, frame


@pytest.fixture(scope="module")
def corpus(spark):
    points, ids = clustered(3, 40, 30)
    df = written(frame(spark, "id", ids, points), "corpus")
    return df, points, ids, two_level.train(df, 6, 8)


def fine_of(cells):
    found = {}
    for r in cells.fine.orderBy("coarse", "fine").collect():
        found.setdefault(r.coarse, []).append(r.centroid)
    return {c: np.array(m, np.float64) for c, m in found.items()}


def test_every_vector_is_in_the_nearest_fine_cell_of_its_group(spark, corpus):
    df, points, ids, cells = corpus
    fine = fine_of(cells)
    assert sum(map(len, fine.values())) > 40
    rows = {r.id: r.cell for r in two_level.assign(df, cells).collect()}
    assert rows.keys() == set(ids)
    stored = {r.id: np.array(r.embedding) for r in df.collect()}
    for key, cell in rows.items():
        coarse = int(V.nearest_cells(stored[key][None], cells.coarse.matrix, 1)[0, 0])
        assert cell // cells.n_fine == coarse
        away = ((fine[coarse] - stored[key]) ** 2).sum(axis=1)
        assert away[cell % cells.n_fine] <= away.min() + 1e-6


def test_search_is_exhaustive_over_the_cells_probed(spark, corpus):
    df, points, ids, cells = corpus
    index = written(two_level.assign(df, cells), "index")
    asked = frame(spark, "query_id", ids[::50], points[::50])
    whole = two_level.topk(asked, index, cells, 5, 6, 48)
    exact = search.exact_topk(asked, df, 5)
    assert sorted(whole.collect()) == sorted(exact.collect())
    probed = {r.query_id: r.cells for r in two_level.probe(asked, cells, 3, 6).collect()}
    cell = {r.id: r.cell for r in index.collect()}
    found = two_level.topk(asked, index, cells, 5, 3, 6).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, set()).add(r.id)
    at = {k: p for k, p in zip(ids, points)}
    for key, near in probed.items():
        assert len(near) == 6
        inside = [i for i in ids if cell[i] in near]
        best = sorted(inside, key=lambda i: (-round(float(at[i] @ at[key]), 9), i))[:5]
        assert len(set(best) & by_query[key]) >= 4  # stored vectors are single precision
    recall = evaluation.recall(two_level.topk(asked, index, cells, 5, 3, 6), exact).first().recall
    assert recall > 0.7


def test_groups_without_vectors_are_passed_by(spark, corpus):
    df, points, ids, cells = corpus
    far = two_level.TwoLevel(ivf.Centroids(np.vstack([cells.coarse.matrix, -points[:1]])), cells.fine, 8)
    asked = frame(spark, "query_id", ["q"], -points[:1])
    near = two_level.probe(asked, far, 2, 5).first().cells
    assert near and all(c // 8 < 6 for c in near)
