"""JSON lines in and out."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import settings as S
from corpusloom.functions import text as X

_RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "url", "title", "text")])


def _record(line: Column) -> Column:
    """The object a line holds, or null when it is anything else than exactly one object.

    The JSON parser stops after the first value, so the line is read as the first item of a
    list: whatever follows the object then breaks the list or changes its length.
    """
    items = F.from_json(F.concat(F.lit("["), line, F.lit(",null]")), T.ArrayType(_RECORD),
                        {"allowSingleQuotes": "false"})
    return X.let(items, lambda x: F.when(F.size(x) == 2, x[0]))


def located_lines(lines: DataFrame) -> DataFrame:
    """Text lines with the file block they come from; for batch and streaming reads."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"))


def parse_lines(lines: DataFrame, run_id: int) -> DataFrame:
    """Located lines to raw rows.

    ``seq`` (file, block, row in the task) is the input order: it is taken at the scan,
    before any shuffle, and compares as a struct. Blank lines are skipped. A line that is
    no JSON object is kept with its text in ``malformed_line``.
    """
    row = F.monotonically_increasing_id().alias("row")
    numbered = lines.select("value", F.struct("file", "block", row).alias("seq"))
    parsed = numbered.filter(~X.is_blank("value")).withColumn("doc", _record(F.col("value")))
    return raw_rows(parsed.select(
        "doc.id", "doc.url", "doc.title", "doc.text",
        F.when(F.col("doc").isNull(), F.col("value")).alias("malformed_line"), "seq"), run_id)


def read_documents(spark: SparkSession, path: str | list[str], run_id: int) -> DataFrame:
    """Raw rows of JSON lines files, in the shape of ``raw_documents``."""
    return parse_lines(located_lines(spark.read.text(path)), run_id)


def raw_rows(rows: DataFrame, run_id: int) -> DataFrame:
    """(id, url, title, text, seq[, malformed_line]) with defaults, batch id and run id."""
    if "malformed_line" not in rows.columns:
        rows = rows.withColumn("malformed_line", F.lit(None).cast("string"))
    good = F.col("malformed_line").isNull()

    def field(name: str) -> Column:
        return F.when(good, F.coalesce(F.col(name).cast("string"), F.lit(""))).otherwise("").alias(name)

    return rows.select(
        batch_id(run_id, F.col("seq")).alias("ingest_batch_id"),
        field("id"), field("url"), field("title"),
        F.when(good, F.col("text")).alias("text"),
        "malformed_line", "seq",
        F.current_timestamp().alias("ingested_at"),
        F.lit(run_id).cast("int").alias("run_id"))


def batch_id(run_id: int, seq: Column) -> Column:
    """A reproducible id shared by 500 consecutive rows of one file block."""
    in_task = seq["row"].bitwiseAND(F.lit((1 << 33) - 1))
    batch = F.floor(in_task / S.INGEST_BATCH_ROWS)
    return X.key_hash(F.lit(run_id), seq["file"], seq["block"], batch)


def accepted(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("malformed_line").isNull())


def malformed(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("malformed_line").isNotNull()).select("malformed_line", "seq", "run_id")


def numbered(raw: DataFrame) -> DataFrame:
    """The accepted rows of a stored raw table with ``number``, their place in input order from 0.

    Rows are not shuffled: a split of the table counts its rows of each file block, the counts are
    added up in input order, and a row's number is the sum before its split and block plus its
    place there. The sums are one row per split and block. ``raw`` is read twice and must be a
    table of files, so that both times its splits are the same.
    """
    rows = accepted(raw).withColumns({
        "split": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    at = ["seq.file", "seq.block", "split"]
    counts = rows.groupBy(*at).agg(F.count("*").alias("n"), F.min("seq.row").alias("first"),
                                   F.min("place").alias("begin"))
    before = Window.orderBy("file", "block", "first").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("file").alias("own_file"), F.col("block").alias("own_block"),
        F.col("split").alias("own_split"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("begin")).alias("base"))
    met = rows.join(bases, (F.col("seq.file") == F.col("own_file"))
                    & (F.col("seq.block") == F.col("own_block")) & (F.col("split") == F.col("own_split")))
    return met.select(*raw.columns, (F.col("base") + F.col("place")).alias("number"))


def numbered_batch(run_id: int, rows: int = S.INGEST_BATCH_ROWS) -> Column:
    """The id shared by so many consecutive accepted rows of a run, wherever they were read."""
    return X.key_hash(F.lit(run_id), F.floor(F.col("number") / rows))


# Rows of a compressed file, which one task reads.
FILE_ROWS = 20_000


def write_documents(df: DataFrame, path: str, compressed: bool = False) -> None:
    """One JSON object per line, nulls kept; compressed in files of a bounded number of lines."""
    writer = df.select("id", "url", "title", "text").write.option("ignoreNullFields", "false")
    if compressed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS)
    writer.json(path)


def normalise_corpus(df: DataFrame, id_column: str, url_column: str, title_column: str,
                     text_column: str, limit: int | None = None,
                     order: str | None = None) -> DataFrame:
    """Project any corpus onto (id, url, title, text), optionally its first rows by a column, the id
    where none is named."""
    if limit is not None:
        df = df.orderBy(order or id_column).limit(limit)
    return df.select(
        F.col(id_column).cast("string").alias("id"), F.col(url_column).alias("url"),
        F.col(title_column).alias("title"), F.col(text_column).alias("text"))
