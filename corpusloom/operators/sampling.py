"""Seeded samples and update batches for trying a build out."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions import text as X

# Ids and titles of the made-up rows of an update batch.
CORRUPTED_ID = "corrupted_doc_001"
CORRUPTED_TITLE = "Corrupted Test Document"
SYNTHETIC_ID = "synthetic_new_doc_001"
SYNTHETIC_URL = "https://en.wikipedia.org/wiki/Vector_database"
SYNTHETIC_TITLE = "Vector Database"
# What is appended to the revised row, and the text of the new one where none is left over.
REVISION = "\n\nA later delivery of this document ends with one more sentence."
SYNTHETIC_TEXT = (
    "Nearest-neighbour search compares lists of numbers. A store built for it keeps such a list "
    "beside every row and answers which rows lie closest to a given one.")
SAMPLE_SIZE = 40
RESERVE = 5


def usable(raw: DataFrame) -> DataFrame:
    """Rows with an id and a text."""
    return raw.filter(~X.is_blank("id") & ~X.is_blank("text"))


def first_rows(raw: DataFrame, n: int | None = None) -> DataFrame:
    """The first n rows in input order (a top-n, not a full sort); all where n is None."""
    return raw if n is None else raw.orderBy("seq").limit(n)


def sample_size(available: int, wanted: int = SAMPLE_SIZE) -> int:
    """A smaller sample where too few rows would be left over for updates."""
    return wanted if available >= wanted + RESERVE else max(2, available - RESERVE)


def seeded_sample(raw: DataFrame, n: int, seed: int = S.SEED) -> DataFrame:
    """n rows without replacement, those with the smallest MD5 of seed and id.

    The draw is the same under any partitioning and costs a top-n.
    """
    return raw.orderBy(F.md5(F.concat_ws("|", F.lit(seed), "id")), "id").limit(n)


def complement(raw: DataFrame, sample: DataFrame) -> DataFrame:
    return raw.join(sample.select("id"), "id", "left_anti")


def update_batch(raw: DataFrame, sample: DataFrame) -> DataFrame:
    """Four rows that show every status: new, revised, duplicate and corrupted.

    The new row is the first one outside the sample, or a made-up one where there is none.
    """
    shape = ["id", "url", "title", "text", "case"]
    drawn = sample.orderBy("seq").limit(2)
    ranked = drawn.select(
        "id", "url", "title", "text", "seq",
        (F.col("seq") == F.lit(drawn.agg(F.min("seq")).scalar())).alias("first"))
    revised = ranked.filter("first").select(
        "id", "url", "title", F.concat("text", F.lit(REVISION)).alias("text"),
        F.lit("revised").alias("case"))
    duplicate = ranked.filter(~F.col("first")).withColumn("case", F.lit("duplicate"))
    spark = raw.sparkSession
    made_up = spark.createDataFrame(
        [(SYNTHETIC_ID, SYNTHETIC_URL, SYNTHETIC_TITLE, SYNTHETIC_TEXT, "new")], shape)
    fresh = (
        complement(raw, sample).orderBy("seq").limit(1)
        .withColumn("case", F.lit("new")).select(shape).withColumn("prefer", F.lit(0))
        .unionByName(made_up.withColumn("prefer", F.lit(1)))
        .orderBy("prefer").limit(1).drop("prefer")
    )
    corrupted = spark.createDataFrame([(CORRUPTED_ID, "", CORRUPTED_TITLE, "", "corrupted")], shape)
    return (fresh.unionByName(revised.select(shape)).unionByName(duplicate.select(shape))
            .unionByName(corrupted))


def batch_preview(batch: DataFrame, base: DataFrame) -> DataFrame:
    """How a coming batch looks: text length, whether it has text, whether the id is unseen.

    Blank ids are unseen whatever the base holds, and any share of a batch may have one, so they
    do not take part in the join.
    """
    known = base.select("id").distinct().withColumn("known", F.lit(True)).withColumnRenamed(
        "id", "known_id")
    named = F.when(~X.is_blank("id"), F.col("id"))
    # What is shown of the texts, so that these do not move.
    seen = batch.select("id", "title", F.length("text").alias("text_len"),
                        (~X.is_blank("text")).alias("has_text"), named.alias("named"))
    return seen.join(known, F.col("named") == F.col("known_id"), "left").select(
        "id", "title", "text_len", "has_text", F.col("known").isNull().alias("is_new"))
