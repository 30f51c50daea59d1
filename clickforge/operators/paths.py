"""Navigation paths: ordered page-type sequences per session.

Only the first ``max_pages`` pages of a session and "has at least two pages" are ever
needed, so the per-session order is a ``row_number() <= max_pages`` window: Spark plans a
partial ``WindowGroupLimit`` before the exchange, so a bot session with millions of
views ships at most ``max_pages`` rows per map task and the collected array is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickforge.functions.columns import batch_keys
from clickforge.operators.metrics import top_k

ARROW = " -> "


def session_paths(pv: DataFrame, by="event_date", max_pages: int | None = 6,
                  order=("event_timestamp", "page_type")) -> DataFrame:
    """``(batch, session_id, path)`` with the first ``max_pages`` page types in
    time order. Ties on the timestamp are broken by ``page_type`` so the path is
    deterministic (tied rows with equal page type give the same path either way).
    ``max_pages=None`` keeps the full path, whose length is that of the session."""
    by = batch_keys(by)
    w = Window.partitionBy(*by, "session_id").orderBy(*order)
    first = pv.select(*by, "session_id", "page_type", F.row_number().over(w).alias("_pos"))
    if max_pages is not None:
        first = first.filter(F.col("_pos") <= max_pages)
    return first.groupBy(*by, "session_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "page_type"))),
                    lambda x: x["page_type"]).alias("path"))


def session_path_strings(pv: DataFrame, by="event_date", max_pages: int | None = 6,
                         min_pages: int = 2) -> DataFrame:
    """Sessions with at least ``min_pages`` pages; the first ``max_pages`` joined by
    ``" -> "``."""
    by = batch_keys(by)
    p = session_paths(pv, by, None if max_pages is None else max(max_pages, min_pages))
    path = F.col("path") if max_pages is None else F.slice("path", 1, max_pages)
    return (p.filter(F.size("path") >= min_pages)
             .select(*by, "session_id",
                     F.concat_ws(ARROW, path).alias("path_string")))


def navigation_paths(pv: DataFrame, by="event_date", top_n: int = 10,
                     max_pages: int | None = 6) -> DataFrame:
    """Most frequent path strings per batch (ties broken by the path text)."""
    by = batch_keys(by)
    counts = session_path_strings(pv, by, max_pages) \
        .groupBy(*by, F.col("path_string").alias("navigation_path")) \
        .agg(F.count(F.lit(1)).alias("session_count"))
    return top_k(counts, by, [F.desc("session_count"), F.asc("navigation_path")], top_n)
