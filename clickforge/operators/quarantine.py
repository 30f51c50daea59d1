"""Quarantine of files that failed validation.

The reference copies every file with at least one error to ``quarantine/<key>`` (the
original stays in place) and writes ``quarantine/<key>.errors.json`` holding
``source_key, quarantined_at, error_count, errors[:100]``, each error being
``{record_index, user_id, session_id, reason}`` in record order, then check order.

Here the outputs are DataFrames over all files of a run at once:

* :func:`quarantine_metadata` - one row per flagged file. The first 100 errors of a file
  are chosen with ``row_number() <= 100`` over ``(file, record_index, position)``; Spark
  plans that as a partial ``WindowGroupLimit`` before the shuffle, so no task ever holds
  more than 100 errors of one file, however bad the file is.
* :func:`quarantine_copies` - the files' exact copies, with size and checksum.
* :func:`quarantine_lines` - every line of every flagged file with its order keys. The
  flagged-file table (one row per file) is joined to the lines; AQE broadcasts it when
  its measured size is small and keeps a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge.operators import validate as V
from clickforge.sources.raw import QUARANTINE_PREFIX, object_key

MAX_LISTED_ERRORS = 100


def ordered_errors(ann: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Errors of every record with their position inside the record (check order)."""
    idx = V.with_record_index(ann, records=records)
    return idx.select("file_path", "record_index",
                      F.col("err_user_id").alias("user_id"),
                      F.col("err_session_id").alias("session_id"),
                      F.posexplode("errors").alias("pos", "e")) \
              .select("file_path", "record_index", "pos", "user_id", "session_id",
                      F.col("e.reason").alias("reason"))


def quarantine_metadata(ann: DataFrame, quarantined_at: Column | None = None,
                        root: str | None = None,
                        max_listed: int = MAX_LISTED_ERRORS,
                        records: DataFrame | None = None) -> DataFrame:
    """One row per file with at least one error: ``file_path, source_key, quarantine_key,
    error_key, quarantined_at`` (ISO-8601 UTC text), ``error_count`` (all errors) and
    ``errors`` (a preview: the first ``max_listed`` as structs; the full table of errors is
    :func:`clickforge.operators.validate.validation_errors`)."""
    n_errors = F.when(F.col("is_record"), F.size("errors")).otherwise(0)
    counts = ann.groupBy("file_path").agg(F.sum(n_errors).alias("error_count")) \
                .filter("error_count > 0")
    errs = ordered_errors(ann, records)
    w = Window.partitionBy("file_path").orderBy("record_index", "pos")
    first = errs.withColumn("_rn", F.row_number().over(w)) \
                .filter(F.col("_rn") <= max_listed)
    listed = first.groupBy("file_path").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("_rn"), F.col("record_index"), F.col("user_id"), F.col("session_id"),
            F.col("reason")))).alias("_e"))
    at = quarantined_at if quarantined_at is not None else F.current_timestamp()
    key = object_key(F.col("file_path"), root)
    return counts.join(listed, "file_path").select(
        "file_path", key.alias("source_key"),
        F.concat(F.lit(QUARANTINE_PREFIX), key).alias("quarantine_key"),
        F.concat(F.lit(QUARANTINE_PREFIX), key, F.lit(".errors.json")).alias("error_key"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("quarantined_at"),
        F.col("error_count").cast("long").alias("error_count"),
        F.transform("_e", lambda s: s.dropFields("_rn")).alias("errors"))


def quarantine_lines(lines: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every line of the flagged files (blank and non-JSON lines included: the copy is of
    the whole file): ``file_path, source_key, quarantine_key, block_start, line_id,
    line``. Order inside a file is ``(block_start, line_id)``.

    The join is on ``(file_path, block_start)``, so that the lines of one big flagged file
    are spread over its splits."""
    flagged = metadata.select("file_path", "source_key", "quarantine_key")
    splits = lines.select("file_path", "block_start").distinct().join(flagged, "file_path")
    return lines.select("file_path", "block_start", "line_id", "line") \
                .join(splits, ["file_path", "block_start"])


def quarantine_copies(metadata: DataFrame, target: str) -> DataFrame:
    """The flagged files themselves, copied byte for byte to ``<target>/<quarantine_key>`` by
    tasks: ``source_key, quarantine_key, bytes, sha256``, one row a file (written by the caller,
    which makes the copies)."""
    from clickforge.sources.listing import copy_files
    files = metadata.select("file_path", F.col("quarantine_key").alias("key"))
    return copy_files(files, target).select(
        F.substring("key", len(QUARANTINE_PREFIX) + 1, 1 << 30).alias("source_key"),
        F.col("key").alias("quarantine_key"), "bytes", "sha256")
