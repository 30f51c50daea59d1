"""Ingest validation as a batch run or a file-arrival stream (V1-V13, S5, V11, ST1).

One function, :func:`ingest_lines`, validates the lines of a set of files and writes the
run's outputs; the batch entry point (:func:`ingest_files`) and every micro-batch of the
stream (:func:`start_ingest_stream`) call it, so both paths behave the same.

Outputs under ``out_root`` (all Parquet except the error documents):

* ``ingest_metrics/<run>/`` - per file counters (V9, V11)
* ``quarantine_errors/<run>/`` - JSON, one document per flagged file (S5)
* ``quarantine_lines/<run>/`` - the flagged files' lines with order keys (S5)
* ``quarantine_files/<run>/quarantine/<key>`` - the flagged files, byte for byte, and
  ``quarantine_copies/<run>/`` - their sizes and checksums (S5)
* ``arrivals/<run>/`` - the files that the run has taken note of (V9, ST1)
* ``validation_errors/<run>/`` - every error of the run (V8)
* ``valid_events/<run>/`` - the lines that passed, ready for the typed parse (V13)

``<run>`` is ``run_id=<id>`` for a batch and ``stream=<query id>/batch_id=<n>`` for a
micro-batch. Each run overwrites exactly its own folders, also with nothing, so a retried or
repeated run replaces all of its earlier output, and streams never meet each other's.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.operators import quarantine as Q
from clickforge.operators import validate as V
from clickforge.sources import raw as R
from clickforge.sources.listing import list_tree

ARRIVED = "file_path string, file_size long, broken boolean"


def _write_run(df: DataFrame, out_root: str, name: str, run: str, fmt: str = "parquet") -> str:
    path = os.path.join(out_root, name, run)
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def ingest_lines(lines: DataFrame, out_root: str, run: str, root: str | None = None,
                 quarantined_at: Column | None = None, profile: str = "ingest",
                 listing: DataFrame | None = None) -> dict:
    """Validate ``lines`` (``file_path, file_size, block_start, line_id, line``) and write the
    outputs of ``run``. Returns the run summary (V12) as a dict: one aggregated row, the
    only thing brought to the driver.

    Files under ``quarantine/`` of ``root`` are skipped (V10). The checked lines are written
    once, to ``checked_lines/<run>``; every output is derived from that table, so no check
    runs twice and a lost executor costs no recomputation. ``listing`` (``file_path, file_size,
    broken``, see :func:`clickforge.sources.listing.list_tree`) adds the files that have no line
    (V9); the lines of ``broken`` ones are left out, and such a file counts as a processing error.
    """
    spark = lines.sparkSession
    kept = lines.filter(~R.is_quarantined(F.col("file_path"), root))
    if listing is not None:
        listing = listing.filter(~R.is_quarantined(F.col("file_path"), root))
        kept = kept.join(listing.where("broken").select("file_path"), "file_path", "left_anti")
    checked = V.annotate(R.lines_to_records(kept), profile).drop("v")
    path = _write_run(checked, out_root, "checked_lines", run)
    ann = spark.read.schema(checked.schema).parquet(path)
    metrics = V.ingest_metrics(V.validation_summary(ann), None if listing is None else listing.drop("broken"))
    meta = Q.quarantine_metadata(ann, quarantined_at, root)
    _write_run(V.validation_errors(ann), out_root, "validation_errors", run)
    _write_run(V.valid_events(ann), out_root, "valid_events", run)
    _write_run(meta.drop("file_path"), out_root, "quarantine_errors", run, fmt="json")
    _write_run(Q.quarantine_lines(ann, meta), out_root, "quarantine_lines", run)
    copies = Q.quarantine_copies(meta, os.path.join(out_root, "quarantine_files", run))
    _write_run(copies, out_root, "quarantine_copies", run)
    path = _write_run(metrics, out_root, "ingest_metrics", run)
    row = V.run_summary(spark.read.schema(metrics.schema).parquet(path)).first()
    return {"processed_files": row["processed_files"], "total_errors": row["total_errors"]}


def ingest_files(spark: SparkSession, paths, out_root: str, run_id: str,
                 root: str | None = None, quarantined_at: Column | None = None,
                 skip_unreadable: bool = False) -> dict:
    """Batch run over some files or folders (``recursiveFileLookup`` so day folders are
    walked without turning them into partition columns). ``root`` defaults to ``paths`` when
    that is one folder.

    An unreadable file stops the run, unless ``skip_unreadable``: then a file that has bytes
    but gives no line counts as a processing error, and so does a gzip file that breaks off
    midway, of which nothing is taken.
    """
    if root is None and isinstance(paths, str):
        root = paths
    lines = R.read_lines(spark, paths, skip_unreadable)
    return ingest_lines(lines, out_root, f"run_id={run_id}", root, quarantined_at, listing=list_tree(spark, paths))


def start_ingest_stream(spark: SparkSession, raw_dir: str, out_root: str, checkpoint: str,
                        available_now: bool = True,
                        max_files_per_trigger: int | None = None,
                        processing_time: str | None = None,
                        quarantined_at: Column | None = None, skip_unreadable: bool = False):
    """ST1: validate every file that arrives under ``raw_dir``, exactly as the batch run
    does, one micro-batch at a time.

    The file source records processed files in ``checkpoint`` (a folder of this stream
    alone, shared by the cluster), so each file is validated once; a restarted query resumes
    where it stopped and a failed micro-batch is run again with the same ``batch_id``, whose
    outputs it replaces. Outputs are kept by the query id, which the checkpoint holds: another
    stream, or this one after its checkpoint was lost, writes beside them.

    A scan gives no line of a zero-byte file, and with ``skip_unreadable`` none or some of a broken
    one. So each micro-batch lists the folder and holds it against the stream's ``arrivals``:
    empty and broken files that no earlier batch noted are this batch's, and a broken file's
    lines are left out in whichever batch they come.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true") \
        .option("ignoreCorruptFiles", str(skip_unreadable).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = R.text_with_metadata(reader.load(raw_dir))

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        own = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        run = f"stream={own}/batch_id={batch_id}"
        lines = R.with_line_ids(batch)
        odd = list_tree(spark, raw_dir).where("broken or file_size = 0")
        arrivals = os.path.join(out_root, "arrivals", f"stream={own}")
        if batch_id:
            noted = spark.read.schema(f"{ARRIVED}, batch_id long").parquet(arrivals)
            noted = noted.where(F.col("batch_id") < batch_id)  # a batch that runs again notes its own once more
            odd = odd.join(noted.select("file_path"), "file_path", "left_anti")
            earlier = noted.where("broken").select(*odd.columns)
            lines = lines.join(earlier.select("file_path"), "file_path", "left_anti")
        own_files = _write_run(odd, out_root, "arrivals", run)
        odd = spark.read.schema(ARRIVED).parquet(own_files)
        read = lines.select("file_path", "file_size", F.lit(False).alias("broken")).distinct()
        listing = read.join(odd.select("file_path"), "file_path", "left_anti").unionByName(odd)
        ingest_lines(lines, out_root, run, raw_dir, quarantined_at, listing=listing)

    writer = stream.writeStream.foreachBatch(run_batch) \
        .option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
