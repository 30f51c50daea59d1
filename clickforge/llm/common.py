"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but space, tab, LF, VT, FF and CR.
SEPARATORS = r"[\x20\x09-\x0D]+"

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables, below ``spark.checkpoint.dir``.

    That setting must name a folder that driver and executors share. Only a purely local
    session (tests) that leaves it unset gets a private temporary folder.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _LOCAL_FOLDERS.setdefault(app, tempfile.mkdtemp(prefix="clickforge-llm-"))
    return f"{base.rstrip('/')}/clickforge-{app}"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: later uses do not
    recompute it, and a lost executor costs nothing. The folder belongs to the application
    and is removed with the other files of ``spark.checkpoint.dir``."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words of a text in order; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda of the body uses it."""
    return F.transform(F.array(value), body)[0]


def materialise(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row: a generated column is not inlined into
    the expressions that use it, as a projected one would be."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def row_hash(df: DataFrame) -> Column:
    """One hash of all columns: equal rows get equal hashes. Map columns have no hash and
    are taken as JSON."""
    cols = [F.to_json(df[c]) if t.startswith("map") else df[c] for c, t in df.dtypes]
    return F.xxhash64(*cols)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem
