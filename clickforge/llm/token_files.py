"""Token-id output: shards of patched frame-of-reference blocks in document order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickforge.llm import pfor
from clickforge.llm.library_tokens import by_bytes, library_ids

#: Bytes of ids in a batch that the reader hands on, and bytes of text in a call of the encoder:
#: the more, the fewer words come back in another call.
READ_BYTES, CALL_BYTES = 8 << 20, 4 << 20


def _open_folder(folder: str):
    """File system and path of a folder that all executors share."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 1,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every row's text and write the ids in ascending order of ``id_col``, one shard a
    range of it; returns the manifest (``shard``, ``file``, ``n_docs``, ``n_tokens``,
    ``start``), which is also stored in the folder.

    ``end_id`` is appended to each document. Null ids come first; rows of one id are in the
    order of a hash of their texts, so that not even they must fit into one shard. A null
    text is encoded as an empty one. Other columns are
    ignored, and an empty table writes an empty manifest.

    ``folder`` must be shared by driver and executors. A task that is run again writes a new
    file, and the manifest, which is written once, names the file of the run that counted.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = library_ids(tokenizer_path), TaskContext.get()
        name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.pfor"
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        system, base = _open_folder(folder)
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        system.create_dir(base)
        with system.open_output_stream(f"{base}/{name}") as out:
            writer = pfor.Writer(out)
            for b in (x for group in ([first], batches) for x in group):
                ids, held, at = b.column(0).to_pylist(), [], 0
                for batch in by_bytes((t.as_py() or "" for t in b.column(1)), CALL_BYTES):
                    for (i, _), part in zip(batch, own.ids([t for _, t in batch])):
                        if i != at:
                            writer.add(ids[at], np.frombuffer(b"".join([*held, end]), "<u4"))
                            held, at = [], i
                        held.append(part)
                writer.add(ids[at], np.frombuffer(b"".join([*held, end]), "<u4"))
            writer.close()
        yield pa.RecordBatch.from_pylist([{"shard": task.partitionId(), "file": name, "n_docs":
                                           len(writer.ids), "n_tokens": writer.tokens}],
                                         pa.schema(fields))

    fields = [("shard", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()),
              ("n_tokens", pa.int64())]
    kept = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    kept = kept.withColumn("h", F.xxhash64("text"))
    shards = kept.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text") \
        .select("id", "text").mapInArrow(run, "shard long, file string, n_docs long, n_tokens long")
    shards.write.parquet(f"{folder.rstrip('/')}/shards")
    shards = spark.read.schema(shards.schema).parquet(f"{folder.rstrip('/')}/shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard
    manifest = shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    manifest.write.parquet(f"{folder.rstrip('/')}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("shard long, file string, n_docs long, n_tokens long, start long") \
        .parquet(f"{folder.rstrip('/')}/manifest")


def read_token_files(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Every document of a folder of token files: ``id_col``, ``start`` (number of ids before
    it in all files), ``n_tokens``, ``ids`` (binary, little-endian unsigned 32-bit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_folder(folder)
        for shard in (s for b in batches for s in b.to_pylist()):
            path, out, size = f"{base}/{shard['file']}", [], 0
            with system.open_input_file(path) as file:
                for doc_id, at, ids in pfor.Reader(file, file.size()):
                    out.append((doc_id, shard["start"] + at, len(ids), ids.tobytes()))
                    size += out[-1][2] * 4 + 24
                    if size >= READ_BYTES:
                        yield batch(out)
                        out, size = [], 0
            if out:
                yield batch(out)

    def batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          [id_col, "start", "n_tokens", "ids"])

    manifest = read_manifest(spark, folder)
    parts = max(1, min(manifest.count(), 100_000))  # a partition a shard, as far as sensible
    return manifest.repartitionByRange(parts, "shard").mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids binary")
