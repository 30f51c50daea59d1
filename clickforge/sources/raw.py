"""Raw JSONL sources (S1, S2) and file-name event typing.

Raw day files live under ``raw/year=Y/month=MM/day=DD/<event_type>.jsonl``. Many days and
types are read in one scan; the file name carries the event type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.schemas import RAW_SCHEMAS

QUARANTINE_PREFIX = "quarantine/"


def decoded(path: Column) -> Column:
    """A scanned path with its ``%XX`` escapes resolved. Paths are URIs, not form data: a
    ``+`` stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def object_key(path: Column, root: str | None = None) -> Column:
    """The object key of a file: its path relative to ``root`` (the raw folder), or the decoded
    path itself when no root is given."""
    p = decoded(path)
    if root:
        # the scan reports URIs (``file:/...``, ``s3a://bucket/...``): cut after the root
        prefix = root.split("://")[-1].rstrip("/") + "/"
        pos = F.locate(prefix, p)
        p = F.when(pos > 0, p.substr(pos + len(prefix), F.lit(1 << 30))).otherwise(p)
    return p


def event_type_from_path(path: Column) -> Column:
    """V1: the last path segment without ``.jsonl`` (the record's own ``event_type`` is
    not used). The object key is URL-decoded first, as notifications deliver it.

    Files written by :func:`clickforge.sources.files.split_by_type` carry the type as an
    ``event_type=T`` directory instead (Spark names the part files); that wins when
    present."""
    key = decoded(path)
    name = F.regexp_replace(F.regexp_extract(key, r"([^/]*)$", 1), r"\.jsonl", "")
    part_dir = F.regexp_extract(key, r"/event_type=([^/]+)/[^/]*$", 1)
    return F.when(part_dir != "", part_dir).otherwise(name)


def read_raw_json(spark: SparkSession, paths, event_type: str) -> DataFrame:
    """JSONL scan with the declared schema of ``event_type`` (no inference pass).

    PERMISSIVE mode: undeclared fields are dropped, a wrong-typed field becomes null while
    the row's other fields survive.
    """
    return spark.read.schema(RAW_SCHEMAS[event_type]).option("mode", "PERMISSIVE").json(paths)


def parse_json_lines(lines: DataFrame, event_type: str, col: str = "line") -> DataFrame:
    """S1 on an in-memory column of JSON text (same declared schema and PERMISSIVE rules)."""
    schema = RAW_SCHEMAS[event_type]
    from clickforge.functions.columns import materialize
    parsed = F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"})
    return materialize(lines.select(F.col(col)), _r=parsed).select(
        *[F.col("_r")[f.name].alias(f.name) for f in schema.fields])


def read_lines(spark: SparkSession, paths, skip_unreadable: bool = False) -> DataFrame:
    """Every line of the given JSONL files with its file and its place: ``file_path, file_size,
    block_start, line_id, line``. Folders are walked without turning them into partition columns.

    ``line_id`` orders lines inside one split (a split is at most
    ``spark.sql.files.maxPartitionBytes``), which is what record positions are built from.
    :func:`lines_to_records` adds the lenient parse. An unreadable file stops the scan, unless
    ``skip_unreadable``.
    """
    text = spark.read.option("recursiveFileLookup", "true") \
        .option("ignoreCorruptFiles", str(skip_unreadable).lower()).text(paths)
    return with_line_ids(text_with_metadata(text))


def text_with_metadata(text: DataFrame) -> DataFrame:
    """``file_path, file_size, block_start, line`` of a text scan (batch or stream)."""
    return text.select(F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.file_size").alias("file_size"),
                       F.col("_metadata.file_block_start").alias("block_start"),
                       F.col("value").alias("line"))


def with_line_ids(df: DataFrame) -> DataFrame:
    """Add ``line_id``, increasing in scan order inside each split (not a shuffle: each
    task numbers its own rows)."""
    return df.withColumn("line_id", F.monotonically_increasing_id())


def is_quarantined(path: Column, root: str | None = None) -> Column:
    """An object key that starts with ``quarantine/`` (never validated again). Folders of
    that name above the root, or deeper inside it, do not count."""
    return object_key(path, root).startswith(QUARANTINE_PREFIX)


def lines_to_records(df: DataFrame) -> DataFrame:
    """Attach event type and the lenient parse: strip, skip blank, ``try_parse_json``."""
    from clickforge.functions.columns import materialize
    text = F.trim(F.col("line"))
    v = F.when(text != "", F.try_parse_json(text))
    return materialize(df.withColumn("event_type", event_type_from_path(F.col("file_path"))),
                       v=v)
