"""Versioned merge on append-only tables.

A document version is one row of ``clean_documents`` and is never rewritten. When a later
run replaces it, that run appends one row to ``closures`` naming the version and the run
that closed it. Validity is the left join of the two, on narrow keys; chunks and
embeddings carry ``doc_id`` and ``source_run_id`` and inherit it through the same join.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import settings as S


def batch_keys(valid: DataFrame) -> DataFrame:
    """One narrow row per doc_id of a batch: its last occurrence, and how many there were.

    The maximum is combined before the shuffle, so an id that fills a third of the batch
    reaches its reducer as one row per map task. Texts are not shuffled here.
    """
    return (
        valid.groupBy("doc_id")
        .agg(F.max(F.struct("seq", "content_hash")).alias("last"), F.count("*").alias("copies"))
        .select("doc_id", "last.seq", "last.content_hash", "copies")
    )


def current_keys(versions: DataFrame, closures: DataFrame,
                 keys: DataFrame | None = None) -> DataFrame:
    """(doc_id, content_hash, source_run_id) of the versions no run has closed.

    With ``keys``, only for the documents of a batch: a small batch is then broadcast and
    the history is scanned on three narrow columns without being shuffled.
    """
    log = versions.select("doc_id", "content_hash", "source_run_id")
    if keys is not None:
        log = log.join(keys.select("doc_id"), "doc_id", "left_semi")
    return active(log, closures)


def classify(keys: DataFrame, current: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """NEW, UPDATED or UNCHANGED for each key of a batch; for UPDATED also the version closed.

    Columns of the current version named in ``carry`` come along as ``old_...``.
    """
    old = current.select(
        "doc_id",
        F.col("content_hash").alias("old_hash"),
        F.col("source_run_id").alias("old_run"),
        *[F.col(c).alias(f"old_{c}") for c in carry],
    )
    status = (
        F.when(F.col("old_hash").isNull(), S.NEW)
        .when(F.col("old_hash") == F.col("content_hash"), S.UNCHANGED)
        .otherwise(S.UPDATED)
    )
    return keys.join(old, "doc_id", "left").select(
        *keys.columns,
        status.alias("status"),
        F.when(status == S.UPDATED, F.col("old_run")).alias("closed_valid_from"),
        *[f"old_{c}" for c in carry],
    )


def changed(statuses: DataFrame) -> DataFrame:
    return statuses.filter(F.col("status").isin(S.NEW, S.UPDATED))


def new_versions(valid: DataFrame, statuses: DataFrame, run_id: int) -> DataFrame:
    """The rows to append: the winning occurrence of every NEW or UPDATED document."""
    return version_rows(valid.join(
        changed(statuses).select("doc_id", "seq"), ["doc_id", "seq"], "left_semi"), run_id)


def version_rows(valid: DataFrame, run_id: int) -> DataFrame:
    """Accepted rows in the shape of the version log."""
    return valid.select(
        "doc_id", "url", "title", "cleaned_text", "content_hash", "text_len",
        F.lit(run_id).cast("int").alias("source_run_id"),
    )


def new_closures(statuses: DataFrame, run_id: int) -> DataFrame:
    return statuses.filter(F.col("status") == S.UPDATED).select(
        "doc_id",
        F.col("closed_valid_from").alias("valid_from_run_id"),
        F.lit(run_id).cast("int").alias("valid_to_run_id"),
    )


def status_metrics() -> dict[str, Column]:
    """Counts over statuses: new, updated, unchanged, and in-batch duplicates that lost."""
    def n(name: str) -> Column:
        return F.count_if(F.col("status") == name)
    return {
        "new_doc_count": n(S.NEW),
        "updated_doc_count": n(S.UPDATED),
        "unchanged_doc_count": n(S.UNCHANGED),
        "duplicate_doc_count": F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)),
    }


def status_counts(statuses: DataFrame) -> DataFrame:
    """The same as one row."""
    return statuses.agg(*[c.alias(name) for name, c in status_metrics().items()])


def with_validity(rows: DataFrame, closures: DataFrame) -> DataFrame:
    """Add is_active, valid_from_run_id and valid_to_run_id to versions, chunks or embeddings."""
    closed = closures.select(
        "doc_id", F.col("valid_from_run_id").alias("source_run_id"), "valid_to_run_id")
    return rows.join(closed, ["doc_id", "source_run_id"], "left").select(
        *rows.columns,
        F.col("valid_to_run_id").isNull().alias("is_active"),
        F.col("source_run_id").alias("valid_from_run_id"),
        "valid_to_run_id",
    )


def active(rows: DataFrame, closures: DataFrame) -> DataFrame:
    """Rows of versions that are still current."""
    closed = closures.select("doc_id", F.col("valid_from_run_id").alias("source_run_id"))
    return rows.join(closed, ["doc_id", "source_run_id"], "left_anti")


def as_of(rows: DataFrame, run_id: int) -> DataFrame:
    """Rows (with validity) that were active at the end of a run."""
    valid_to = F.col("valid_to_run_id")
    return rows.filter(
        (F.col("source_run_id") <= run_id) & (valid_to.isNull() | (valid_to > run_id)))


def as_of_runs(rows: DataFrame, run_ids: list[int]) -> DataFrame:
    """The same for several runs in one pass: a row per run at whose end it was active."""
    valid_to = F.col("valid_to_run_id")
    runs = F.filter(F.array(*[F.lit(r) for r in run_ids]), lambda r: (
        F.col("source_run_id") <= r) & (valid_to.isNull() | (valid_to > r)))
    return rows.withColumn("run_id", F.explode(runs))


def closures_from_history(versions: DataFrame) -> DataFrame:
    """Recompute closures from the version log alone: each version ends where the next begins."""
    order = Window.partitionBy("doc_id").orderBy("source_run_id")
    return (
        versions.select("doc_id", F.col("source_run_id").alias("valid_from_run_id"),
                        F.lead("source_run_id").over(order).alias("valid_to_run_id"))
        .filter(F.col("valid_to_run_id").isNotNull())
    )


def version_history(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every version (with validity) beside its own chunks; versions without chunks stay."""
    parts = chunks.select("doc_id", "content_hash", "source_run_id", "chunk_id", "chunk_index")
    return documents.join(parts, ["doc_id", "content_hash", "source_run_id"], "left")
