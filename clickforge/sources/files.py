"""Day-partitioned Parquet tables and the mixed-feed split.

Layout: one table per dataset under a root, partitioned by ``event_date``
(``<root>/<name>/event_date=YYYY-MM-DD/part-*.parquet``). Every writer overwrites only
the days present in the frame it writes (dynamic partition overwrite) and those it is told
to replace, so re-running a day is idempotent and other days are untouched. Readers filter on ``event_date`` so the
scan lists and opens only the requested day directories (partition pruning).
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)


def read_days(spark: SparkSession, root: str, name: str,
              dates: str | Iterable[str] | None = None) -> DataFrame:
    """S3: scan ``<root>/<name>``, optionally restricted to some days.

    The restriction is a filter on the partition column, so only those directories are
    read (``PartitionFilters`` in the plan); ``None`` reads every day.
    """
    df = spark.read.parquet(table_path(root, name))
    if dates is None:
        return df
    days = [dates] if isinstance(dates, str) else list(dates)
    return df.filter(F.col("event_date").isin([F.lit(d).cast("date") for d in days]))


def write_days(df: DataFrame, root: str, name: str, partition_col: str = "event_date",
               fmt: str = "parquet", max_records_per_file: int = 5_000_000,
               days: Iterable | None = None, sort: Iterable[str] = ()) -> None:
    """Write ``df`` under ``<root>/<name>`` partitioned by day, replacing the days it
    contains, and of the ``days`` that the run stands for also those without rows: they are
    overwritten with nothing, so no stale day survives a re-run.

    No repartition by day: a hot day would land in one task. Each task sorts its own rows
    by the partition column and writes one file per day it holds; ``maxRecordsPerFile``
    bounds file size. The days written are observed in the same job. ``sort`` (columns) lays out
    each file, so that filters on the first of them skip row groups.
    """
    path, seen = table_path(root, name), Observation()
    df = df.sortWithinPartitions(partition_col, *sort) if sort else df
    (df.observe(seen, F.collect_set(partition_col).alias("days"))
       .write.mode("overwrite")
       .option("maxRecordsPerFile", max_records_per_file)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col)
       .format(fmt)
       .save(path))
    written = {str(d) for d in seen.get["days"]}
    for d in sorted({str(d) for d in days or ()} - written):
        df.limit(0).drop(partition_col).write.mode("overwrite").format(fmt) \
          .save(f"{path}/{partition_col}={d}")


def split_by_type(events: DataFrame, root: str, type_col: str = "event_type",
                  date_col: str = "event_date", fmt: str = "json") -> None:
    """Write a mixed feed as JSON lines, one directory per day and event type
    (``<root>/event_date=D/event_type=T/part-*.json``). ``fmt="text"`` takes a feed whose third
    column is the line itself.

    The event type is then recoverable from the path (see
    :func:`clickforge.sources.raw.event_type_from_path`), like the reference's
    ``<type>.jsonl`` file names. Only the given days are replaced. No shuffle: each task
    writes the (day, type) groups it holds.
    """
    (events.write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(date_col, type_col)
           .format(fmt).save(root))


def preview(df: DataFrame, n: int = 20) -> None:
    """Console preview of the first rows (``show`` fetches only ``n`` rows)."""
    df.show(n, truncate=False)
