"""Helpers of the training-data operators."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.scratch import in_one, written  # noqa: F401

# What counts as white space between words, space and U+0009 to U+000D. The
# pattern matches only runs that change when replaced by one space.
UNEVEN_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++"

# Rows are whole texts, so batches between Spark and Python hold few of them.
BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Keep batches small for the rest of the session; operators run when their rows are written."""
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def one_spaced(text: Column) -> Column:
    """Every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN_SPACE, " ")


def text_bytes(df: DataFrame, text: str) -> int:
    return df.select(F.sum(F.octet_length(text))).first()[0] or 0


def blocks_for(df: DataFrame, text: str, block_bytes: int) -> int:
    """How many blocks of about block_bytes the texts fill; one at least."""
    return 1 + text_bytes(df, text) // block_bytes


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the table has a column of that name."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        found.append(name)
    return found
