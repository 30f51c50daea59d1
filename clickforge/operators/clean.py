"""Cleaning of raw events into typed, date-stamped clean tables.

Order matters and follows the published job: exact dedup on the declared columns, drop
null keys, impute, parse timestamps (unparseable -> dropped), drop future events,
normalise strings, add ``event_date``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.schemas import (IMPUTATION, KEY_COLUMNS, NORMALISED_COLUMNS,
                                RAW_SCHEMAS, RAW_TIMESTAMP_FORMAT)


def clean_events(raw: DataFrame, event_type: str, as_of: Column | None = None,
                 keep: tuple = ()) -> DataFrame:
    """C1-C8 for one event type. Columns in ``keep`` (a batch day) are carried along; records
    are the same only if they agree in them too.

    ``dropDuplicates()`` is an aggregate over all declared columns: Spark keeps one copy
    per map task before the shuffle, so a record repeated millions of times is reduced
    locally. ``try_to_timestamp`` returns null for bad input under ANSI mode (C4/C5).
    ``as_of`` defaults to ``current_timestamp()`` (C6).
    """
    cols = [f.name for f in RAW_SCHEMAS[event_type].fields]
    df = raw.select(*keep, *cols).dropDuplicates()                            # C1
    df = df.dropna(subset=list(KEY_COLUMNS))                                  # C2
    fills = {c: v for c, v in IMPUTATION.items() if c in cols}
    df = df.fillna(fills)                                                     # C3
    ts = F.try_to_timestamp(F.col("timestamp"), F.lit(RAW_TIMESTAMP_FORMAT))
    df = df.withColumn("event_timestamp", ts).drop("timestamp")               # C4
    limit = F.current_timestamp() if as_of is None else as_of
    df = df.filter(F.col("event_timestamp").isNotNull()                       # C5
                   & (F.col("event_timestamp") <= limit))                     # C6
    df = df.withColumns({c: F.lower(F.trim(F.col(c)))                         # C7
                         for c in NORMALISED_COLUMNS if c in cols})
    return df.withColumn("event_date", F.to_date("event_timestamp"))          # C8


def row_counts(raw_by_type: dict[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """C10 as one DataFrame: raw and clean row counts per type. Each type is parsed once: one
    group per distinct record counts the copies, and whether cleaning keeps the record is a
    flag of the group."""
    limit = F.current_timestamp() if as_of is None else as_of
    ts = F.try_to_timestamp(F.col("timestamp"), F.lit(RAW_TIMESTAMP_FORMAT))
    kept = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in KEY_COLUMNS]) \
        & F.coalesce(ts <= limit, F.lit(False))
    parts = []
    for et, raw in raw_by_type.items():
        cols = [f.name for f in RAW_SCHEMAS[et].fields]
        copies = raw.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(copies.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("raw_rows"),
                                F.count_if(kept).alias("clean_rows"))
                     .select(F.lit(et).alias("event_type"), "raw_rows", "clean_rows"))
    return reduce(DataFrame.unionByName, parts)
