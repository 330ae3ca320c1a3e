"""Vectors for tests."""

import numpy as np


def frame(spark, name, ids, matrix):
    rows = [(i, v.tolist()) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, f"{name} string, embedding array<float>")


def clustered(seed, clusters, members, dim=16, spread=0.12):
    """Unit vectors in clusters, and their ids."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(clusters, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    points = np.repeat(centres, members, axis=0) + spread * draw.normal(size=(clusters * members, dim)) / dim ** 0.5
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    return points.astype(np.float32).astype(np.float64), [f"v{i:05d}" for i in range(len(points))]
