"""Token ids as flat binary files with 64-bit offsets, in key order.

Keys are dealt into ranges; a task sorts its range and writes one pair of files. ``part-N.bin``
holds unsigned integers of 16 bits if the vocabulary allows, else 32, and ``part-N.idx`` the
64-bit positions at which its documents begin and, last, end; ``part-N.key`` holds their keys as an
Arrow stream. ``parts.json`` names the parts in order with the ids before each, which are prefix
sums over one row per part.
"""

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.shared import blocks_for

RANGE_BYTES = 32 << 20
READ_ROWS = 1024
MANIFEST = "parts.json"


def _open(folder: str):
    """(file system, path) of a folder URI that every executor can reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


def _publish(files, path: str, chunks) -> None:
    """Write beside the place and move there, so that a lost or doubled task leaves whole files."""
    draft = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(draft) as out:
        for chunk in chunks:
            out.write(chunk)
    files.move(draft, path)


def _stream(keys) -> bytes:
    """A column as an Arrow stream of batches of bounded size."""
    import pyarrow as pa

    out = pa.BufferOutputStream()
    table = pa.table({"key": keys})
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table, max_chunksize=READ_ROWS)
    return out.getvalue().to_pybytes()


def write_token_files(df: DataFrame, folder: str, encode: Callable[[str | None], bytes],
                      key: str = "doc_id", text: str = "text", end_id: int = 2,
                      vocabulary: int = 1 << 32) -> DataFrame:
    """Encode, close each document by ``end_id`` and write; the rows of the key index come back.

    The index has part, row and key of every document; it is written beside the files as Parquet.
    Keys ascend over parts and rows, null keys first; rows with equal keys are ordered by a hash
    of their text, then the text, and all written. A null text is empty. An empty table gives no part.
    ``encode`` gives little-endian unsigned 32-bit ids, all below ``vocabulary``.
    """
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    width = np.dtype(kind).itemsize

    def write(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        files, path = _open(folder)
        end = end_id.to_bytes(4, "little")
        keys, sizes = [], []

        def chunks():
            for batch in batches:
                for k, t in zip(batch.column(0), batch.column(1)):
                    ids = np.frombuffer(encode(t.as_py()) + end, "<u4")
                    keys.append(k.as_py())
                    sizes.append(len(ids))
                    yield ids.astype(kind).tobytes()

        _publish(files, f"{path}/part-{part:06d}.bin", chunks())
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype="<i8")]).astype("<i8")
        _publish(files, f"{path}/part-{part:06d}.idx", [offsets.tobytes()])
        _publish(files, f"{path}/part-{part:06d}.key", [_stream(pa.array(keys, key_type))])
        for at in range(0, len(keys), 65536):
            rows = range(at, min(at + 65536, len(keys)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int64()), pa.array(rows, pa.int64()),
                 pa.array(keys[at:at + 65536], key_type),
                 pa.array([int(offsets[-1])] * len(rows), pa.int64())],
                ["part", "row", "key", "part_tokens"])

    from pyspark.sql.pandas.types import to_arrow_type

    spark = df.sparkSession
    source = df.select(df[f"`{key}`"].alias("key"), df[f"`{text}`"].alias("text"))
    key_type = to_arrow_type(source.schema["key"].dataType)
    files, path = _open(folder)
    files.create_dir(path, recursive=True)
    ranges = blocks_for(source, "text", RANGE_BYTES)
    # Samples of what ranges are made of go to the driver, so texts take part by a hash only.
    tied = source.withColumn("tie", F.xxhash64("text"))
    ordered = (tied.repartitionByRange(ranges, "key", "tie")
               .sortWithinPartitions("key", "tie", "text").drop("tie"))
    result = (T.StructType().add("part", T.LongType()).add("row", T.LongType())
              .add("key", source.schema["key"].dataType).add("part_tokens", T.LongType()))
    ordered.mapInArrow(write, result).write.parquet(f"{folder}/index")
    index = spark.read.schema(result).parquet(f"{folder}/index")
    tokens = index.groupBy("part").agg(F.max("part_tokens").alias("n")).orderBy("part").collect()
    base, parts = 0, []
    for row in tokens:
        parts.append({"part": row.part, "base": base})
        base += row.n
    _publish(files, f"{path}/{MANIFEST}", [json.dumps(
        {"type": kind, "width": width, "parts": parts, "tokens": base,
         "key": source.schema["key"].dataType.jsonValue()}).encode()])
    return index.select("part", "row", F.col("key").alias(key))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """part, row, key, start, n_tokens, ids (little-endian unsigned 32-bit) of every document.

    All of it comes from the files, so no row has to be looked up elsewhere. A task maps the files of its parts into memory, where the file system is local.
    """
    files, path = _open(folder)
    with files.open_input_file(f"{path}/{MANIFEST}") as file:
        manifest = json.loads(file.read())
    kind, width = manifest["type"], manifest["width"]

    def mapped(files, path):
        from pyarrow import fs

        if isinstance(files, fs.LocalFileSystem):
            return np.memmap(path, np.uint8, "r")
        with files.open_input_file(path) as file:
            return np.frombuffer(file.read(), np.uint8)

    def read(batches) -> Iterator:
        import pyarrow as pa

        files, path = _open(folder)
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = f"{path}/part-{part:06d}"
                offsets = mapped(files, f"{name}.idx").view("<i8")
                ids = mapped(files, f"{name}.bin").view(kind)
                keys = pa.ipc.open_stream(pa.py_buffer(mapped(files, f"{name}.key")))
                for at in range(0, len(offsets) - 1, READ_ROWS):
                    cuts = offsets[at:at + READ_ROWS + 1]
                    rows = len(cuts) - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * rows, pa.int64()), pa.array(range(at, at + rows), pa.int64()),
                         keys.read_next_batch().column(0), pa.array(cuts[:-1] + base), pa.array(np.diff(cuts)),
                         pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])],
                                  pa.binary())],
                        ["part", "row", "key", "start", "n_tokens", "ids"])

    parts = [(p["part"], p["base"], n) for n, p in enumerate(manifest["parts"])]
    listed = spark.createDataFrame(parts, "part long, base long, task int").repartitionById(
        max(1, len(parts)), "task")
    result = (T.StructType().add("part", T.LongType()).add("row", T.LongType())
              .add(T.StructField.fromJson({"name": "key", "type": manifest["key"], "nullable": True,
                                           "metadata": {}}))
              .add("start", T.LongType()).add("n_tokens", T.LongType()).add("ids", T.BinaryType()))
    return listed.mapInArrow(read, result)
