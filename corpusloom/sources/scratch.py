"""Where written intermediates go."""

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Of tables that hold whole texts.
TEXT_CODEC = "zstd"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only on a single machine without it."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    return tempfile.gettempdir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared root; nothing is created or removed."""
    return f"{shared_root(spark).rstrip('/')}/corpusloom-{purpose}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    """(file system, path) as the driver sees a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def is_there(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def release_at_end(spark: SparkSession, path: str) -> None:
    """Have a folder that is there removed when the driver ends; results may read it until then."""
    files, place = _place(spark, path)
    files.deleteOnExit(place)


def held_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder, there and empty, that is removed with all that it holds when the driver ends."""
    path = new_folder(spark, purpose)
    files, place = _place(spark, path)
    files.mkdirs(place)
    release_at_end(spark, path)
    return path


def written(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """The rows from a table in the shared folder: lineage ends here, nothing is computed twice.

    The table is removed when the driver ends, or by ``remove``.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path, compression=codec)
    release_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove(table: DataFrame) -> None:
    """Remove a written table that nothing reads any more."""
    for folder in {path.rsplit("/", 1)[0] for path in table.inputFiles()}:
        files, place = _place(table.sparkSession, folder)
        files.delete(place, True)


def in_one(parts: Iterator[DataFrame], purpose: str) -> DataFrame:
    """The rows of all parts as one table, each part written before the next is asked for."""
    path = None
    for part in parts:
        path = path or new_folder(part.sparkSession, purpose)
        part.write.mode("append").parquet(path)
        spark, schema = part.sparkSession, part.schema
    release_at_end(spark, path)
    return spark.read.schema(schema).parquet(path)
