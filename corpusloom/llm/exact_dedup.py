"""Exact duplicates, combined in three stages that all compare whole texts.

A task first combines equal texts among its own rows, then the rows of one (digest, salt) meet,
then the winners of all salts of a digest. A text that fills a third of the table is therefore
one row per task and salt after the first stage, and one row per salt after the second.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import fresh, one_spaced, written

SALTS = 16


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS,
                digest=sha256_digest) -> DataFrame:
    """One row per input row: key, keep_key, group_size, kept, normalised_sha256.

    Texts are equal when they are identical after every run of white space became one space; a
    null text equals the empty one. Of equal texts the row with the smallest key stays; null
    keys come last. Of rows that agree in key and text, one stays. An empty table gives no rows.
    Other columns are not looked at, whatever their names.

    ``digest`` only brings rows together. Texts that differ stay apart also where their digests
    agree: such digests are joined on the texts themselves.
    """
    rows = df.select(
        F.col(key).alias("key"), one_spaced(F.col(text)).alias("text"),
    ).withColumn("digest", digest(F.col("text")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "text").agg(
        F.min("key").alias("keep_key"), F.count("*").alias("n"))
    groups = winners.groupBy("digest", "text").agg(
        F.min("keep_key").alias("keep_key"), F.sum("n").alias("group_size"))
    classes = written(
        groups.select("digest", "keep_key", "group_size",
                      F.sha2("text", 256).alias("normalised_sha256")), "exact-classes")

    shared = classes.groupBy("digest").count().filter("count > 1").select("digest")
    decided = rows.select("digest", "key").join(classes, "digest")
    if not shared.isEmpty():
        unlike = (rows.join(shared, "digest", "left_semi")
                  .withColumn("normalised_sha256", F.sha2("text", 256)))
        decided = decided.join(shared, "digest", "left_anti").unionByName(
            unlike.join(classes, ["digest", "normalised_sha256"])
            .select("digest", "key", "keep_key", "group_size", "normalised_sha256"))
    decided = written(decided.withColumn("row", F.monotonically_increasing_id()), "exact-rows")
    stays = (decided.filter(F.col("key").eqNullSafe(F.col("keep_key")))
             .groupBy("normalised_sha256").agg(F.min("row").alias("row"))
             .select("row", F.lit(True).alias("stays")))
    return decided.join(stays, "row", "left").select(
        F.col("key").alias(key), "keep_key", "group_size",
        F.coalesce("stays", F.lit(False)).alias("kept"), "normalised_sha256")


def without_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; of rows equal in key and text one, any, stays."""
    own, kept_key, kept_sha = fresh(df, "own_sha", "kept_key", "kept_sha")
    result = written(exact_dedup(df, key, text).select(
        F.col(key).alias(kept_key), F.col("normalised_sha256").alias(kept_sha), "kept"), "exact-kept")
    kept = result.filter("kept").select(kept_key, kept_sha)
    repeated = (result.groupBy(kept_key, kept_sha)
                .agg(F.count("*").alias("n"), F.max("kept").alias("k"))
                .filter("n > 1 AND k").select(kept_key, kept_sha))
    marked = df.withColumn(own, F.sha2(one_spaced(F.col(f"`{text}`")), 256))
    same = F.col(f"`{key}`").eqNullSafe(F.col(kept_key)) & (F.col(own) == F.col(kept_sha))
    found = marked.join(kept, same, "left_semi")
    if not repeated.isEmpty():
        again = found.join(repeated, same, "left_semi")
        found = found.join(repeated, same, "left_anti").unionByName(again.dropDuplicates([key, own]))
    return found.drop(own)
