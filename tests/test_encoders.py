import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions import encoders as E

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_hashing():
    encoder = E.HashingEncoder(16)
    texts = ["a b a", "", "c", "word " * 500]
    got = encoder.encode(pa.array(texts))
    assert got.dtype == np.float32 and got.shape == (4, 16)
    for text, row in zip(texts, got):
        want = np.zeros(16)
        for token in text.split(" "):
            digest = hashlib.md5(token.encode()).hexdigest()
            want[int(digest[:8], 16) % 16] += -1 if int(digest[8], 16) % 2 else 1
        norm = np.linalg.norm(want) or 1.0
        assert np.allclose(row, want / norm, atol=1e-6)
    assert encoder.encode(pa.array([], pa.string())).shape == (0, 16)


def test_zero_row_stays_zero():
    assert E.unit_rows(np.array([[0.0, 0.0], [3.0, 4.0]])).tolist() == [
        [0.0, 0.0], [np.float32(0.6), np.float32(0.8)]]


class Lengths:
    """An encoder of the user's own."""
    name, dim = "lengths", 2

    def encode(self, texts):
        return E.unit_rows(np.array([[len(t), 1.0] for t in texts.to_pylist()]))


def test_chunks_are_encoded_with_prefix_and_hash(spark):
    chunks = spark.createDataFrame([("c1", "d", 1, "xx"), ("c2", "d", 1, "")],
                                   "chunk_id string, doc_id string, source_run_id int, chunk_text string")
    rows = {r.chunk_id: r for r in E.embed_chunks(chunks, Lengths()).collect()}
    for key, text in (("c1", "xx"), ("c2", "")):
        want = Lengths().encode(pa.array(["passage: " + text]))
        assert rows[key].embedding == want[0].tolist()
        assert rows[key].embedding_hash == hashlib.sha256(want[0].tobytes()).hexdigest()
        assert (rows[key].embedding_model, rows[key].embedding_dim) == ("lengths", 2)


def test_hash_of_stored_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -2.0]), (2, [0.0, 1e-3])], "id int, v array<float>")
    for r in df.select("v", E.embedding_hash("v").alias("h")).collect():
        assert r.h == hashlib.sha256(np.array(r.v, "<f4").tobytes()).hexdigest()


def test_null_text_is_encoded_like_an_empty_one(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "id int, text string")
    rows = {r.id: r.embedding for r in E.encode_column(df, "text", E.HashingEncoder(8), "query: ").collect()}
    assert rows[1] == rows[2] != rows[3]


class Longest:
    """Tells how many texts it was given at a time."""
    name, dim = "longest", 1

    def encode(self, texts):
        return np.full((len(texts), 1), len(texts), np.float32)


def test_few_rows_are_encoded_at_a_time(spark):
    df = spark.range(0, 6000, numPartitions=1).select("id", F.lit("a b").alias("text"))
    rows = E.encode_column(df, "text", Longest(), "query: ").collect()
    assert sorted(r.id for r in rows) == list(range(6000))
    assert max(r.embedding[0] for r in rows) == E.SLICE_ROWS < 6000
