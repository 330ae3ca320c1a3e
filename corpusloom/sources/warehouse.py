"""Parquet tables under one root folder; one root per dataset.

Facts are append-only. Each run owns one partition folder per table and overwrites only
that folder, so repeating an interrupted stage leaves no duplicate. A run counts once its
last ``runs`` row says success: readers see the rows of successful runs, plus those of the
run in progress. One driver writes at a time.
"""

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom import schemas
from corpusloom.sources import scratch

# Tables whose rows belong to the run that wrote them, and the column that says so.
RUN_COLUMN = {
    "raw_documents": "run_id", "rejected_documents": "run_id", "batch_keys": "run_id",
    "document_status": "run_id", "key_buckets": "run_id", "corpus_state": "run_id", "index_recall": "run_id",
    "index_parts": "run_id", "index_closed": "run_id", "known_ids": "run_id",
    "row_count_reconciliation": "run_id", "clean_documents": "source_run_id",
    "chunks": "source_run_id", "embeddings": "source_run_id", "closures": "valid_to_run_id",
}
# Tables of a row or a few per run, appended to, and the run that must not have failed.
CONTROL_COLUMN = {"index_registry": "run_id", "latency_logs": "run_id", "audit_results": "run_id_b",
                  "retrieval_eval": "run_id"}


# Row groups of raw rows: a task that reads them takes one or more.
RAW_GROUP_BYTES = 4 << 20


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a DataFrame, without starting a Python worker."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrays = [pa.array(list(values), kind.type)
              for values, kind in zip(columns, to_arrow_schema(schema))]
    table = pa.Table.from_arrays(arrays, names=schema.names)
    return spark.createDataFrame(table, schema)


def observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[Callable[[], dict], DataFrame]:
    """The rows with aggregates taken as they pass, and a call that gives these once they have.

    They have to pass in the last stage of a job, so that no retry counts them again.
    """
    if not metrics:
        return dict, df
    observation = Observation()
    marked = df.observe(observation, *[c.alias(name) for name, c in metrics.items()])
    return lambda: dict(observation.get), marked


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._held: dict[int, str] | None = None

    def path(self, table: str, run_id: int | None = None) -> str:
        base = f"{self.root}/{table}"
        return base if run_id is None else f"{base}/{RUN_COLUMN[table]}={run_id}"

    def _load(self, table: str) -> DataFrame:
        schema = schemas.TABLES[table]
        if not scratch.is_there(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def write_run(self, table: str, df: DataFrame, run_id: int,
                  metrics: dict[str, Column] | None = None) -> dict:
        """Write a run's partition, replacing an earlier attempt of the same run.

        ``metrics`` are aggregates over the rows, taken as they are written and returned by name;
        they may use columns that are not stored.
        """
        columns = [f.name for f in schemas.TABLES[table].fields if f.name != RUN_COLUMN[table]]
        if table == "chunks":
            # Brings a folder into few files, so that their number does not grow with the tasks.
            df = df.hint("rebalance", "prefix")
        seen, df = observed(df, metrics or {})
        writer = df.select(*columns).write.mode("overwrite").option("compression", scratch.TEXT_CODEC)
        if table == "raw_documents":
            # Lets as many tasks read a file as there are groups, whatever task wrote it.
            writer = writer.option("parquet.block.size", RAW_GROUP_BYTES)
        if table == "chunks":
            # Lets a look-up by id skip folders, and row groups; ids are hashes, so min/max cannot.
            # A filter is the smallest of a few sizes that holds its ids, not 1 MB whatever they are.
            writer = writer.partitionBy("prefix").option(
                "parquet.bloom.filter.enabled#chunk_id", "true").option(
                "parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(self.path(table, run_id))
        return seen()

    def append(self, table: str, df: DataFrame) -> None:
        """Append rows to a control table."""
        names = schemas.TABLES[table].names
        df.select(*names).write.mode("append").parquet(self.path(table))

    def append_rows(self, table: str, rows: list[tuple]) -> None:
        self.append(table, small_frame(self.spark, rows, schemas.TABLES[table]).coalesce(1))

    def statuses(self) -> dict[int, str]:
        """Run id to status, one entry per run."""
        if self._held is not None:
            return self._held
        return {r.run_id: r.status for r in self.runs().select("run_id", "status").collect()}

    @contextmanager
    def as_of_now(self) -> Iterator[None]:
        """Within, readers see the runs there are now, which are looked up once."""
        self._held = self.statuses()
        try:
            yield
        finally:
            self._held = None

    def read(self, table: str, also: int | None = None) -> DataFrame:
        """Rows of successful runs, and of one more run if it is given.

        What a failed or running run wrote to a control table is left out too. The run ids, one
        number per run, are a filter, so folders of other runs are not read.
        """
        df = self._load(table)
        if table in CONTROL_COLUMN:
            hidden = [n for n, status in self.statuses().items() if status != "success" and n != also]
            column = F.col(CONTROL_COLUMN[table])
            return df.filter(~column.isin(hidden) | column.isNull()) if hidden else df
        if table not in RUN_COLUMN:
            return df
        shown = {n for n, status in self.statuses().items() if status == "success"}
        return df.filter(F.col(RUN_COLUMN[table]).isin(sorted(shown | ({also} - {None}))))

    def everything(self, table: str) -> DataFrame:
        """All rows, also those of failed and running runs."""
        return self._load(table)

    def read_run(self, table: str, run_id: int) -> DataFrame:
        """The partition of one run, whatever became of that run; only its folder is listed."""
        reader = self.spark.read.schema(schemas.TABLES[table]).option("basePath", self.path(table))
        return reader.parquet(self.path(table, run_id))

    def runs(self) -> DataFrame:
        """One row per run: the last one written for it. There are as few as there were runs."""
        log = self._load("runs")
        order = Window.partitionBy("run_id").orderBy(F.col("end_time").desc_nulls_last())
        return log.withColumn("n", F.row_number().over(order)).filter("n = 1").drop("n")

    def run_history(self) -> DataFrame:
        """The runs in order."""
        return self.runs().orderBy("run_id")

    def next_run_id(self) -> int:
        return (self._load("runs").agg(F.max("run_id")).first()[0] or 0) + 1

    def last_state(self) -> dict | None:
        """What the newest successful run left, with its ``run_id``."""
        row = self.read("corpus_state").orderBy(F.desc("run_id")).first()
        return row and {n: v if n == "run_id" else int(v) for n, v in row.asDict().items()}

    def write_state(self, state: dict[str, int], run_id: int) -> None:
        fields = schemas.TABLES["corpus_state"].fields[:-1]
        values = tuple(Decimal(state[f.name]) if f.dataType == schemas.WIDE else state[f.name]
                       for f in fields)
        self.write_run("corpus_state", small_frame(self.spark, [values], T.StructType(fields)), run_id)

    # Current keys lie in folders by run and bucket; a run writes whole buckets.
    def key_layout(self) -> tuple[int | None, dict[int, int]]:
        """(number of buckets, bucket -> newest run that wrote it); None before the first run.

        The number only grows, with a run that writes all buckets; there are a bounded number.
        """
        newest = self.read("key_buckets").groupBy("n_buckets", "bucket").agg(
            F.max("run_id").alias("run_id")).collect()
        n_buckets = max((r.n_buckets for r in newest), default=None)
        return n_buckets, {r.bucket: r.run_id for r in newest if r.n_buckets == n_buckets}

    def read_keys(self, at: dict[int, int]) -> DataFrame:
        """The snapshot rows of buckets (bucket -> run); no other folder is listed or read."""
        schema = schemas.TABLES["current_keys"]
        if not at:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path("current_keys"))
        paths = [f"{self.path('current_keys')}/run_id={run}/bucket={b}" for b, run in sorted(at.items())]
        return reader.parquet(*paths).select(*schema.names)

    def current_keys(self) -> DataFrame:
        """The whole snapshot."""
        return self.read_keys(self.key_layout()[1])

    def sketch_words(self) -> int | None:
        """Words of the sketch of known ids; None before the first run."""
        return self.read("known_ids").agg(F.max("n_words")).first()[0]

    def write_keys(self, snapshot: DataFrame, n_buckets: int, run_id: int) -> None:
        """Write the buckets a run touched, and then which they were."""
        path = f"{self.path('current_keys')}/run_id={run_id}"
        snapshot.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        written = self.spark.read.schema(schemas.TABLES["current_keys"]).parquet(path)
        self.write_run("key_buckets", written.select("bucket").distinct().withColumn(
            "n_buckets", F.lit(n_buckets)), run_id)

    def index_parts(self, run_id: int) -> list:
        """The parts of the index that a run published, the oldest first; a bounded number."""
        rows = self.read("index_parts").filter(F.col("run_id") == run_id)
        return rows.orderBy("part_run_id").collect()

    def write_index_parts(self, parts: list[tuple[int, int, int]], run_id: int) -> None:
        fields = schemas.TABLES["index_parts"].fields[:-1]
        self.write_run("index_parts", small_frame(self.spark, parts, T.StructType(fields)), run_id)

    # Index folders carry the run in their path and are named by the registry.
    def index_path(self, run_id: int) -> str:
        return f"{self.path('index_vectors')}/run_id={run_id}"

    def centroids_path(self, run_id: int) -> str:
        return f"{self.path('index_centroids')}/run_id={run_id}"
