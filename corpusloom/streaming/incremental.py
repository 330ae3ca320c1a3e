"""Augmented builds fed by a folder that keeps receiving JSON lines files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.build import Build
from corpusloom.sources import jsonl
from corpusloom.sources.warehouse import Warehouse


def run_available(w: Warehouse, dataset_name: str, folder: str, checkpoint: str,
                  max_files: int = 1000, **options) -> None:
    """Merge every file that arrived since the last call, one augmented run per micro-batch.

    The batch number is kept in the run's note. A batch that is handed over again after a
    failure is skipped when its run was published, so each file is merged once.
    """
    spark = w.spark

    def merge_batch(lines: DataFrame, batch: int) -> None:
        note = f"stream {checkpoint} batch {batch}"
        done = w.runs().filter((F.col("status") == "success") & (F.col("notes") == note))
        if not done.isEmpty():
            return
        Build(w, "augmented", dataset_name, folder, note=note, **options).run(
            lambda run_id: jsonl.parse_lines(lines, run_id))

    stream = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(folder)
    query = (
        jsonl.located_lines(stream).writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
