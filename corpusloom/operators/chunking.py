"""Sliding token windows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions import text as X
from corpusloom.functions.tokenizers import Tokenizer, WordTokenizer, window_count


def chunk_documents(documents: DataFrame, tokenizer: Tokenizer | None = None) -> DataFrame:
    """Cut document versions into windows; a narrow map without a shuffle.

    The windows of a document are built as one array before they are exploded, so the
    token list of a long document is not copied once per window.
    """
    tokenizer = tokenizer or WordTokenizer()
    windows = tokenizer.windows(X.embedding_text("title", "cleaned_text"))
    return (
        documents.select("doc_id", "content_hash", "source_run_id",
                         F.inline(windows))
        .select(
            X.key_hash("doc_id", "content_hash", "start_tok", "end_tok").alias("chunk_id"),
            "doc_id", "content_hash", "chunk_index", "start_tok", "end_tok", "chunk_text",
            (F.col("end_tok") - F.col("start_tok")).alias("chunk_token_len"),
            X.sha256("chunk_text").alias("chunk_hash"),
            "source_run_id",
        )
    )


def prefix(chunk_id: str) -> Column:
    """The folder of a chunk."""
    return F.left(chunk_id, F.lit(S.PREFIX_DIGITS))


def _window_count() -> Column:
    tokens = F.size(F.split(X.embedding_text("title", "cleaned_text"), " "))
    return X.let(tokens, lambda n: F.struct(n.alias("n_tokens"), window_count(n).alias("n_chunks")))


def documents_without_chunks(documents: DataFrame) -> DataFrame:
    """Documents too short for a window; they are stored but cannot be retrieved.

    The test is part of the generator: as a filter the optimizer would push it below the
    projection and clean and split every text twice.
    """
    none = F.filter(F.array(_window_count()), lambda w: w["n_chunks"] == 0)
    return documents.select("doc_id", "source_run_id", F.inline(none)).drop("n_chunks")


def unembedded(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Chunks of a run that have no vector from that run yet."""
    return chunks.join(
        embeddings.select("chunk_id", "source_run_id"), ["chunk_id", "source_run_id"], "left_anti")
