"""Current keys in hash buckets, and totals kept up by difference.

A snapshot row says which version of a document is current and what it holds: its chunks, its
vectors, and the summed words of its chunk hashes. A run reads and writes only the buckets that
the ids of its batch fall into. Totals of the corpus are those of the run before, plus what the run
added, less what the versions held that it closed; all three are counted while rows are written.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions import text as X
from corpusloom.operators import merge, quality
from corpusloom.schemas import TABLES, WORDS

HELD = ("n_chunks", "n_embeddings", *WORDS)


def bucket_count(n_documents: int) -> int:
    """Buckets for a corpus of this size: a power of two, so that few sizes are ever used."""
    wanted = max(1, n_documents // S.KEYS_PER_BUCKET)
    return min(S.MAX_KEY_BUCKETS, max(S.MIN_KEY_BUCKETS, 1 << (wanted - 1).bit_length()))


def bucket_of(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(n_buckets)).cast("int").alias("bucket")


def held_by_document(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """(doc_id, source_run_id, counts and hash words) of the versions these rows belong to."""
    keys = ["doc_id", "source_run_id"]
    parts = chunks.select(*keys, F.lit(1).alias("c"), F.lit(0).alias("e"), "chunk_hash").unionByName(
        embeddings.select(*keys, F.lit(0).alias("c"), F.lit(1).alias("e"),
                          F.lit(None).cast("string").alias("chunk_hash")))
    return parts.groupBy(*keys).agg(
        F.sum("c").cast("long").alias("n_chunks"), F.sum("e").cast("long").alias("n_embeddings"),
        *[w.cast("long").alias(name) for w, name in zip(quality.digest_columns("chunk_hash"), WORDS)])


def snapshot_rows(keys: DataFrame, held: DataFrame) -> DataFrame:
    """Versions (doc_id, content_hash, source_run_id) with what they hold; nothing is zeros."""
    at = ["doc_id", "source_run_id"]
    return keys.select("doc_id", "content_hash", "source_run_id").join(held, at, "left").select(
        "doc_id", "content_hash", "source_run_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in HELD])


def from_history(versions: DataFrame, closures: DataFrame, chunks: DataFrame,
                 embeddings: DataFrame) -> DataFrame:
    """The snapshot of a corpus that has none yet, from all of its tables."""
    return snapshot_rows(merge.current_keys(versions, closures),
                         held_by_document(chunks, embeddings))


def updated_snapshot(current: DataFrame, statuses: DataFrame, held: DataFrame, run_id: int,
                     n_buckets: int) -> DataFrame:
    """The touched buckets after a run: what it did not change, and what it made current."""
    changed = merge.changed(statuses).select(
        "doc_id", "content_hash", F.lit(run_id).cast("int").alias("source_run_id"))
    kept = current.select(*TABLES["current_keys"].names[:-1]).join(
        changed.select("doc_id"), "doc_id", "left_anti")
    return kept.unionByName(snapshot_rows(changed, held)).withColumn("bucket", bucket_of(n_buckets))


def closed_metrics() -> dict[str, Column]:
    """What the versions held that a run closes, over its statuses beside the old snapshot row."""
    return {f"closed_{c}": F.coalesce(F.sum(F.when(
        F.col("status") == S.UPDATED, F.col(f"old_{c}"))).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
        for c in HELD}


def hash_metrics(column: str) -> dict[str, Column]:
    return dict(zip(WORDS, quality.digest_columns(column)))


def checksum(n: Column | str) -> Column:
    """The checksum of the chunks of a state, as a recount gives it."""
    return F.concat_ws(":", quality.digest_value(), X.col(n))


def recounted(versions: DataFrame, closures: DataFrame, chunks: DataFrame, embeddings: DataFrame,
              run_ids: list[int]) -> DataFrame:
    """(run_id, n_documents, n_chunks, n_embeddings, checksum) counted from the whole history."""
    def alive(rows: DataFrame, kind: str, hashed: Column) -> DataFrame:
        valid = merge.with_validity(rows.select("doc_id", "source_run_id", hashed.alias("h")), closures)
        return merge.as_of_runs(valid, run_ids).select("run_id", F.lit(kind).alias("kind"), "h")

    nothing = F.lit(None).cast("string")
    rows = quality.union_all([
        alive(versions, "n_documents", nothing), alive(chunks, "n_chunks", F.col("chunk_hash")),
        alive(embeddings, "n_embeddings", nothing),
        versions.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(r) for r in run_ids])).alias("run_id"),
            F.lit("none").alias("kind"), nothing.alias("h"))])
    counts = [F.count_if(F.col("kind") == n).alias(n)
              for n in ("n_documents", "n_chunks", "n_embeddings")]
    return rows.groupBy("run_id").agg(*counts, *quality.digest_columns("h")).select(
        "run_id", "n_documents", "n_chunks", "n_embeddings", checksum("n_chunks").alias("checksum"))
