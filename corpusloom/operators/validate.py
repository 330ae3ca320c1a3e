"""Row validation, cleaning and quarantine."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions import text as X


def reject_detail() -> Column:
    """The first reason why a raw row (id, text) is refused, or null."""
    return (
        F.when(X.is_blank("id"), S.DETAIL_MISSING_ID)
        .when(X.is_blank("text"), S.DETAIL_EMPTY_TEXT)
        .when(X.is_blank(X.without_nul("text")), S.DETAIL_EMPTY_CLEANED)
    )


def reason_code() -> Column:
    return F.when(F.col("reason_detail") == S.DETAIL_MISSING_ID, S.MISSING_ID).otherwise(
        S.EMPTY_TEXT).alias("reason_code")


def valid_documents(raw: DataFrame) -> DataFrame:
    """Accepted rows, cleaned. ``seq`` (any orderable type) is the input order."""
    kept = raw.filter(reject_detail().isNull()).select(
        F.col("id").alias("doc_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("title", F.lit("")).alias("title"),
        X.clean_text("text").alias("cleaned_text"),
        "seq",
    )
    return kept.select(
        "doc_id", "url", "title", "cleaned_text",
        X.sha256("cleaned_text").alias("content_hash"),
        F.length("cleaned_text").alias("text_len"),
        "seq",
    )


def rejected_documents(raw: DataFrame, run_id: int) -> DataFrame:
    """Refused rows with reason and snapshot."""
    detail = F.col("reason_detail")
    return (
        raw.withColumn("reason_detail", reject_detail())
        .filter(detail.isNotNull())
        .select(
            F.coalesce("id", F.lit("")).alias("doc_id"),
            F.coalesce("title", F.lit("")).alias("title"),
            reason_code(),
            detail,
            X.raw_snapshot().alias("raw_snapshot"),
            F.lit(run_id).cast("int").alias("run_id"),
        )
    )


def staged_documents(raw: DataFrame) -> DataFrame:
    """Every row judged and cleaned once: accepted ones as ``valid_documents`` gives them, refused
    ones with ``reason_detail`` and their snapshot instead of a text."""
    judged = raw.withColumn("reason_detail", reject_detail())
    good = F.col("reason_detail").isNull()
    cleaned = judged.select(
        F.coalesce("id", F.lit("")).alias("doc_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.when(good, X.clean_text("text")).alias("cleaned_text"), "seq", "reason_detail",
        F.when(~good, X.raw_snapshot()).alias("raw_snapshot"))
    return cleaned.select(
        "doc_id", "url", "title", "cleaned_text", X.sha256("cleaned_text").alias("content_hash"),
        F.length("cleaned_text").alias("text_len"), "seq", "reason_detail", "raw_snapshot")


def accepted_of(staged: DataFrame) -> DataFrame:
    return staged.filter("reason_detail IS NULL").drop("reason_detail", "raw_snapshot")


def refused_of(staged: DataFrame, run_id: int) -> DataFrame:
    return staged.filter("reason_detail IS NOT NULL").select(
        "doc_id", "title", reason_code(), "reason_detail", "raw_snapshot",
        F.lit(run_id).cast("int").alias("run_id"))
