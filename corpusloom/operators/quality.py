"""Counts, checksums, reconciliation, cross-run audit and reports."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions import text as X

# The audited counts, in order.
AUDITED_COUNTS = (
    "active_doc_count", "active_chunk_count", "active_embedding_count", "index_vector_count")
CHECKSUM_AUDIT = "chunk_hash_checksum"
EXISTENCE_AUDIT = "run_existence"


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_row(frames: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of each frame. Every count is combined before it is sent."""
    rows = union_all([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
                      for name, df in frames.items()])
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name)
                      for name in frames])


def table_overview(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([df.agg(F.count("*").alias("row_count"))
                      .select(F.lit(name).alias("table_name"), "row_count")
                      for name, df in tables.items()])


# Multiset digest: 32-bit words of a SHA-256 value, each summed over the rows.
_WORDS = 8
_WORD_DIGITS = 8


def digest_columns(hash_column: Column | str) -> list[Column]:
    """Partial sums of an order-independent checksum over SHA-256 hex values.

    Each value adds its words to eight running sums, so equal multisets of values, duplicates
    counted, give equal sums under any order and partitioning. Map tasks send one row each.
    """
    h = X.col(hash_column)
    return [
        F.coalesce(F.sum(F.conv(F.substring(h, 1 + i * _WORD_DIGITS, _WORD_DIGITS), 16, 10)
                         .cast("decimal(20,0)")).cast("decimal(38,0)"),
                   F.lit(0).cast("decimal(38,0)")).alias(f"w{i}")
        for i in range(_WORDS)
    ]


def digest_value() -> Column:
    """The checksum of summed words."""
    return F.sha2(F.concat_ws("|", *[F.col(f"w{i}").cast("string") for i in range(_WORDS)]), 256)


def multiset_digest(df: DataFrame, hash_column: str) -> DataFrame:
    """One row: n_rows and digest."""
    return df.agg(F.count("*").alias("n_rows"), *digest_columns(hash_column)).select(
        "n_rows", digest_value().alias("digest"))


def ordered_checksum(df: DataFrame, hash_column: str) -> DataFrame:
    """One row: n_rows, and a SHA-256 over all values in order.

    A tree keeps every group small: a value stands once with its count, values with the same
    first six digits are joined and hashed in order, these in turn by three digits, then all.
    """
    level = df.groupBy(F.col(hash_column).alias("h")).agg(F.count("*").alias("n")).select(
        F.col("h").alias("at"), F.concat_ws(":", "h", "n").alias("value"), "n")
    joined = F.sha2(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), ""), 256)
    for digits in (6, 3):
        level = level.groupBy(F.left("at", F.lit(digits)).alias("short")).agg(
            joined.alias("value"), F.sum("n").alias("n")).select(
            F.col("short").alias("at"), "value", "n")
    return level.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), joined.alias("checksum"))


def reconcile(raw: DataFrame, active_documents: DataFrame, rejected: DataFrame,
              active_chunks: DataFrame, active_embeddings: DataFrame,
              registry: DataFrame, run_id: int) -> DataFrame:
    """Six counts of a run; PASS when chunks, embeddings and the newest index agree."""
    counts = count_row({
        "raw_documents": raw, "clean_documents_active": active_documents,
        "rejected_documents": rejected, "active_chunks": active_chunks,
        "active_embeddings": active_embeddings,
    })
    size = active_index_size(registry).withColumnRenamed("num_vectors", "index_vectors")
    row = union_all([
        counts.withColumn("index_vectors", F.lit(None).cast("bigint")),
        size.select(*[F.lit(None).cast("bigint").alias(c) for c in counts.columns], "index_vectors"),
    ]).agg(*[F.max(c).alias(c) for c in [*counts.columns, "index_vectors"]])
    return reconciliation_status(row, run_id)


def reconciliation_status(row: DataFrame, run_id: int) -> DataFrame:
    agree = (F.col("active_chunks") == F.col("active_embeddings")) & (
        F.col("active_embeddings") == F.col("index_vectors"))
    details = F.to_json(F.struct(
        F.col("raw_documents").alias("raw"), F.col("clean_documents_active").alias("clean_active"),
        F.col("rejected_documents").alias("rejected"), F.col("active_chunks").alias("chunks"),
        F.col("active_embeddings").alias("embeddings"), "index_vectors"))
    return row.select(
        "*", F.when(agree, "PASS").otherwise("FAIL").alias("reconciliation_status"),
        details.alias("details"), F.lit(run_id).cast("int").alias("run_id"))


def newest_index(registry: DataFrame) -> DataFrame:
    """Registry with ``is_active``: the newest build of each dataset. It has a row per build."""
    newest = F.max(F.struct("created_at", "run_id", "index_id")).over(
        Window.partitionBy("dataset_name"))
    return registry.withColumn("is_active", newest["index_id"] == F.col("index_id"))


def active_index_size(registry: DataFrame) -> DataFrame:
    """One row: num_vectors of the newest build, 0 when there is none."""
    return registry.agg(
        F.coalesce(F.max_by("num_vectors", "created_at"), F.lit(0)).alias("num_vectors"))


def previous_full_run(runs: DataFrame, run: dict) -> DataFrame:
    """The newest earlier successful full run of the same dataset and input."""
    return (
        runs.filter((F.col("mode") == "full") & (F.col("status") == "success")
                    & (F.col("dataset_name") == run["dataset_name"])
                    & (F.col("input_path") == run["input_path"])
                    & (F.col("run_id") != run["run_id"]))
        .orderBy(F.desc("run_id")).limit(1)
    )


def audit(runs: DataFrame, checksums: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """Compare pairs of runs: (run_id_a, run_id_b, audit_type, result, details).

    ``checksums`` holds (run_id, checksum) of the chunks active at the end of each run. A
    missing run gives the single row ``run_existence`` FAIL. All pairs are served by one
    pass over the two inputs.
    """
    spark = runs.sparkSession
    sides = F.array(*[
        F.struct(F.lit(a).alias("run_id_a"), F.lit(b).alias("run_id_b"), F.lit(r).alias("run_id"),
                 F.lit(p).alias("side"))
        for a, b in pairs for r, p in ((a, "a_"), (b, "b_"))])

    def empty(*names: str) -> list[Column]:
        kinds = {"checksum": "string", "seen": "boolean"}
        return [F.lit(None).cast(kinds.get(n, "bigint")).alias(n) for n in names]

    facts = union_all([
        runs.select("run_id", *AUDITED_COUNTS, *empty("checksum"), F.lit(True).alias("seen")),
        checksums.select("run_id", *empty(*AUDITED_COUNTS), "checksum", *empty("seen")),
    ]).withColumn("s", F.explode(F.filter(sides, lambda x: x["run_id"] == F.col("run_id"))))
    values = [*AUDITED_COUNTS, "checksum", "seen"]
    # One row per side without values, so that a pair of missing runs is still reported.
    wanted = spark.range(1).select(F.explode(sides).alias("s"), *empty(*values))
    rows = facts.select("s", *values).unionByName(wanted)
    pair = rows.groupBy("s.run_id_a", "s.run_id_b").agg(*[
        F.max(F.when(F.col("s.side") == p, F.col(c))).alias(p + c)
        for p in ("a_", "b_") for c in values])

    def check(name: str, a: Column, b: Column, labels: tuple[str, str], equal: Column) -> Column:
        return F.struct(
            F.lit(name).alias("audit_type"),
            F.when(equal, "PASS").otherwise("FAIL").alias("result"),
            F.to_json(F.struct(a.alias(labels[0]), b.alias(labels[1])),
                      {"ignoreNullFields": "false"}).alias("details"))

    def both_sides(c: str) -> tuple[Column, Column]:
        return F.col("a_" + c), F.col("b_" + c)

    checks = [check(c, *both_sides(c), ("run_a", "run_b"), both_sides(c)[0].eqNullSafe(
        both_sides(c)[1])) for c in AUDITED_COUNTS]
    a, b = both_sides("checksum")
    short = [F.concat(F.left(c, F.lit(16)), F.lit("...")) for c in (a, b)]
    checks.append(check(CHECKSUM_AUDIT, *short, ("checksum_a", "checksum_b"), a.eqNullSafe(b)))

    def presence(p: str) -> Column:
        return F.when(F.col(p + "seen"), "ok").otherwise("missing")

    missing = F.array(F.struct(
        F.lit(EXISTENCE_AUDIT).alias("audit_type"), F.lit("FAIL").alias("result"),
        F.to_json(F.struct(F.concat(F.lit("run_a="), presence("a_"), F.lit(", run_b="),
                                    presence("b_")).alias("error"))).alias("details")))
    exist = F.coalesce(F.col("a_seen") & F.col("b_seen"), F.lit(False))
    return pair.select("run_id_a", "run_id_b",
                       F.inline(F.when(exist, F.array(*checks)).otherwise(missing)))


def audit_tally(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("result") == "PASS").alias("n_pass"),
        F.count_if(F.col("result") == "FAIL").alias("n_fail"))


def activity(rows: DataFrame, distinct: bool) -> DataFrame:
    """Rows by is_active, and how many ids they belong to."""
    extra = [F.countDistinct("doc_id").alias("n_ids")] if distinct else []
    return rows.groupBy("is_active").agg(F.count("*").alias("n_rows"), *extra)


def active_and_total(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count_if("is_active").alias("n_active"), F.count("*").alias("n_total"))
        .select(F.lit(name).alias("table_name"), "n_active", "n_total")
        for name, df in tables.items()])


def seconds_per_run(latency: DataFrame) -> DataFrame:
    return latency.groupBy("run_id").agg(
        F.sum("duration_seconds").alias("total_seconds"), F.count("*").alias("n_stages"))


def latest_run_latency(runs: DataFrame, latency: DataFrame) -> DataFrame:
    """Stage rows of the newest successful run."""
    newest = runs.filter(F.col("status") == "success").agg(F.max("run_id").alias("run_id"))
    return latency.join(F.broadcast(newest), "run_id")
