"""Documents to packed training sequences, each stage written before the next reads it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import exact_dedup, language_id, ngram_jaccard, packing
from corpusloom.llm.queries import piece_encoder
from corpusloom.llm.shared import fresh, small_batches, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Share of trigrams in the language found, below which a text is in no language that is known.
LEAST_SHARE = 0.25
END_ID = 0
# Pieces of text that each worker remembers with their tokens; workers of a pipeline have held
# other things before.
HELD_PIECES = 80_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with few trigrams of any language of the table, go.

    That is text in other scripts and random letters; another language in the same alphabet
    mostly stays.
    The languages are learned from all documents with a language; if there is none, only
    documents without a letter go. Null and empty texts go; rows repeat or not, with null keys or
    not, as they came. All columns keep their names and values. An empty table stays empty.
    """
    small_batches(spark)
    model = language_id.fit(docs)
    found, = fresh(docs, "found")
    judged = docs.withColumn(found, language_id.prediction(docs, model, F.col("text")))
    speaks = (F.col(f"{found}.score") >= LEAST_SHARE) if model.languages else F.col("text").rlike(
        r"\p{L}")
    return judged.filter(speaks).drop(found)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts stays, that with the smallest doc_id.

    A null text equals the empty one; null keys come last; of rows equal in key and text one stays.
    All columns keep their names and values. An empty table stays empty.
    """
    return exact_dedup.without_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents stays, that with the smallest doc_id.

    Documents without words all stay. Null keys come last; rows equal in key and words stay
    together. All columns keep their names and values. An empty table stays empty.
    """
    small_batches(spark)
    return ngram_jaccard.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens, with their token ids.

    A null or empty text is its end id alone; repeated rows and rows with null keys are documents
    of their own. Of the documents' columns only doc_id is left. An empty table gives no rows.
    """
    small_batches(spark)
    encode = piece_encoder(spark, public_tokenizers.path("byte_bpe_50k.json"), held=HELD_PIECES)
    return packing.pack(docs, encode, end_id=END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("near_copies", near_copies),
    ("packing", packed),
]

# Languages and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
