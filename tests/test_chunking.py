import hashlib
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import window_count
from corpusloom.operators import chunking

# Workers cannot import a test module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def loop(n):
    """Windows by walking through the tokens."""
    out, start = [], 0
    while start < n and min(start + 384, n) - start >= 32:
        out.append((start, min(start + 384, n)))
        if start + 384 >= n:
            break
        start += 320
    return out


def documents(spark, sizes):
    df = spark.createDataFrame([(n,) for n in sizes], "n int")
    words = F.array_join(F.transform(F.sequence(F.lit(2), F.greatest(F.col("n"), F.lit(2))),
                                     lambda i: F.concat(F.lit("w"), i)), " ")
    return df.select(F.concat(F.lit("d"), "n").alias("doc_id"), F.lit("h").alias("content_hash"),
                     F.lit("t").alias("title"), words.alias("cleaned_text"),
                     F.lit(1).alias("source_run_id"))


def test_closed_form(spark):
    rows = spark.range(3000).select("id", window_count(F.col("id")).alias("k")).collect()
    assert all(r.k == len(loop(r.id)) for r in rows)


def test_windows(spark):
    sizes = [2, 31, 32, 383, 384, 385, 704, 705, 1024, 1025, 5000]
    rows = chunking.chunk_documents(documents(spark, sizes)).collect()
    for n in sizes:
        mine = sorted((r for r in rows if r.doc_id == f"d{n}"), key=lambda r: r.chunk_index)
        tokens = ["t:"] + [f"w{i}" for i in range(2, n + 1)]
        assert [(r.start_tok, r.end_tok) for r in mine] == loop(n)
        for i, r in enumerate(mine):
            text = " ".join(tokens[r.start_tok:r.end_tok])
            assert r.chunk_index == i and r.chunk_text == text
            assert r.chunk_token_len == r.end_tok - r.start_tok
            assert r.chunk_hash == hashlib.sha256(text.encode()).hexdigest()
            key = f"d{n}|h|{r.start_tok}|{r.end_tok}"
            assert r.chunk_id == hashlib.sha256(key.encode()).hexdigest()
    short = chunking.documents_without_chunks(documents(spark, sizes)).collect()
    assert sorted(r.doc_id for r in short) == ["d2", "d31"]


def test_unembedded(spark):
    chunks = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "chunk_id string, source_run_id int")
    done = spark.createDataFrame([("a", 1)], "chunk_id string, source_run_id int")
    assert sorted(tuple(r) for r in chunking.unembedded(chunks, done).collect()) == [("a", 2), ("b", 1)]
