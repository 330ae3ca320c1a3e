"""Encoders: texts to unit vectors, batch by batch inside the tasks."""

import hashlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import settings as S


# Rows that are encoded at a time, whatever the batches between Spark and Python hold.
SLICE_ROWS = 2500


class Encoder(Protocol):
    name: str
    dim: int

    def encode(self, texts: pa.Array) -> np.ndarray:
        """One row of ``dim`` float32 values of unit length per text."""


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row stays zero."""
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return (matrix / np.where(norms == 0, 1.0, norms)).astype(np.float32)


class HashingEncoder:
    """Signed feature hashing of space-separated tokens.

    The first eight hex digits of a token's MD5 choose the slot, the ninth the sign. It
    needs no model and is reproducible in SQL. It compares words, not meaning.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim
        self.name = f"hashing-md5-{dim}"

    def encode(self, texts: pa.Array) -> np.ndarray:
        tokens = pc.split_pattern(texts, " ")
        lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        words = tokens.flatten().dictionary_encode()
        digests = [hashlib.md5(w.encode()).hexdigest() for w in words.dictionary.to_pylist()]
        slots = np.array([int(d[:8], 16) % self.dim for d in digests], dtype=np.int64)
        signs = np.array([1.0 - 2.0 * (int(d[8], 16) % 2) for d in digests])
        codes = words.indices.to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(texts)), lengths)
        sums = np.bincount(rows * self.dim + slots[codes], weights=signs[codes],
                           minlength=len(texts) * self.dim)
        return unit_rows(sums.reshape(len(texts), self.dim))


def float_lists(matrix: np.ndarray) -> pa.Array:
    """A float32 matrix as an Arrow list column."""
    n, dim = matrix.shape
    offsets = np.arange(0, n * dim + 1, dim, dtype=np.int32) if dim else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1), pa.float32()))


def vector_hash(matrix: np.ndarray) -> list[str]:
    """SHA-256 over the little-endian float32 bytes of each row."""
    data = np.ascontiguousarray(matrix, dtype="<f4")
    return [hashlib.sha256(row.tobytes()).hexdigest() for row in data]


def encode_column(df: DataFrame, text_column: str, encoder: Encoder, prefix: str) -> DataFrame:
    """Replace ``text_column`` by ``embedding`` and ``embedding_hash`` of the prefixed text; null is empty."""
    keep = [c for c in df.columns if c != text_column]
    source = df.select(*keep, F.concat(F.lit(prefix), F.coalesce(text_column, F.lit(""))).alias("__text"))
    schema = T.StructType(
        [f for f in source.schema.fields if f.name != "__text"]
        + [T.StructField("embedding", T.ArrayType(T.FloatType())),
           T.StructField("embedding_hash", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                vectors = encoder.encode(part.column(len(keep)))
                yield pa.RecordBatch.from_arrays(
                    part.columns[:-1] + [float_lists(vectors), pa.array(vector_hash(vectors))],
                    names=keep + ["embedding", "embedding_hash"])

    return source.mapInArrow(run, schema)


@F.arrow_udf(T.StringType())
def embedding_hash(vectors: pa.Array) -> pa.Array:
    """SHA-256 of a stored vector's float32 bytes."""
    n = len(vectors)
    matrix = np.asarray(vectors.flatten(), dtype=np.float32).reshape(n, -1) if n else np.empty((0, 0))
    return pa.array(vector_hash(matrix), pa.string())


def embed_chunks(chunks: DataFrame, encoder: Encoder) -> DataFrame:
    """Vectors of the given chunks, with the keys that carry their validity."""
    keys = chunks.select("chunk_id", "doc_id", "source_run_id", "chunk_text")
    coded = encode_column(keys, "chunk_text", encoder, S.PASSAGE_PREFIX)
    return coded.select(
        "chunk_id", "doc_id",
        F.lit(encoder.name).alias("embedding_model"),
        F.lit(encoder.dim).alias("embedding_dim"),
        "embedding_hash", "embedding", "source_run_id",
    )
