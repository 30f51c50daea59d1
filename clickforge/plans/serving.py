"""Serving queries (Q1-Q9) over the result tables, as DataFrame functions.

Arguments are checked on the driver before any plan is built (Q9); the filters then
reach the table scans (partition pruning on ``event_date`` for partitioned tables).
Ordering ties are broken by the group key so every limit is deterministic, and
descending sorts put nulls first, as the published database does.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Accepted arguments.
METRICS = ("bounce_rate", "time_on_page")
DEVICES = ("mobile", "desktop", "tablet", "unknown")
DEFAULT_LIMIT = 20
# Page sizes of the published listings. Listings take them as an explicit
# ``limit``; totals and roll-ups read every row.
SESSION_ROWS, ANOMALY_ROWS, DATE_ROWS = 100, 500, 30


class BadRequest(ValueError):
    """An argument the serving layer rejects (HTTP 400 in the original API)."""


def check_date(date: str | None) -> str | None:
    if not date:
        return None
    try:
        _dt.date.fromisoformat(date)
    except (TypeError, ValueError):
        raise BadRequest("date must be YYYY-MM-DD") from None
    return date


def check_limit(limit) -> int | None:
    """A page size of at least 1, honoured as given; ``None`` means every row."""
    if limit is None:
        return None
    try:
        n = int(limit)
    except (TypeError, ValueError):
        raise BadRequest("limit must be an integer of at least 1") from None
    if n < 1:
        raise BadRequest("limit must be an integer of at least 1")
    return n


def _page(df: DataFrame, n: int | None) -> DataFrame:
    return df if n is None else df.limit(n)


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise BadRequest("metric must be 'bounce_rate' or 'time_on_page'")
    return metric


def check_device(device: str | None) -> str | None:
    device = (device or "").lower() or None
    if device and device not in DEVICES:
        raise BadRequest(f"device must be one of: {sorted(DEVICES)}")
    return device


def check_zscore(z) -> float:
    try:
        return float(z)
    except (TypeError, ValueError):
        raise BadRequest("min_zscore must be a number") from None


def _on_date(df: DataFrame, date: str | None) -> DataFrame:
    return df.filter(F.col("event_date") == F.lit(date).cast("date")) if date else df


def top_pages(top_pages_t: DataFrame, date: str | None = None, limit=DEFAULT_LIMIT,
              metric: str = "time_on_page", bounce_t: DataFrame | None = None) -> DataFrame:
    """Q1 (``metric='time_on_page'``) / Q2 (``'bounce_rate'``): across dates, the
    unweighted mean of daily values and summed counts, highest first."""
    metric, date, n = check_metric(metric), check_date(date), check_limit(limit)
    if metric == "bounce_rate":
        return bounce_summary(bounce_t, date, n)
    g = _on_date(top_pages_t, date).groupBy("page_url", "page_type").agg(
        F.round(F.avg("avg_time_seconds"), 2).cast("decimal(12,2)").alias("avg_time_seconds"),
        F.sum("total_visits").cast("long").alias("total_visits"))
    return _page(g.orderBy(F.desc_nulls_first("avg_time_seconds"), "page_url", "page_type"), n)


def bounce_summary(bounce_t: DataFrame, date: str | None = None, limit=DEFAULT_LIMIT
                   ) -> DataFrame:
    """Q2: bounce sums and unweighted mean percentage per page type."""
    date, n = check_date(date), check_limit(limit)
    g = _on_date(bounce_t, date).groupBy("page_type").agg(
        F.sum("total_sessions").cast("long").alias("total_sessions"),
        F.sum("bounce_sessions").cast("long").alias("bounce_sessions"),
        F.round(F.avg("bounce_rate_pct"), 2).cast("decimal(7,2)").alias("bounce_rate_pct"))
    return _page(g.orderBy(F.desc_nulls_first("bounce_rate_pct"), "page_type"), n)


def available_dates(bounce_t: DataFrame, limit=None) -> DataFrame:
    """Q3: the dates with data, newest first, as ISO text (the published listing shows the
    newest ``DATE_ROWS``)."""
    d = bounce_t.select("event_date").distinct().orderBy(F.desc("event_date"))
    return _page(d, check_limit(limit)).select(F.col("event_date").cast("string").alias("date"))


def session_summary(tdc_t: DataFrame, date: str | None = None, country: str | None = None,
                    device: str | None = None, limit=None) -> DataFrame:
    """Q4: device/country rows, most page views first; every row unless a page size is
    given. The country filter is case-insensitive on both sides (the clean job lower-cases,
    the API upper-cases)."""
    date, device, n = check_date(date), check_device(device), check_limit(limit)
    preds = []
    if date:
        preds.append(F.col("event_date") == F.lit(date).cast("date"))
    if country:
        preds.append(F.upper("country") == country.upper())
    if device:
        preds.append(F.col("device_type") == device)
    df = tdc_t.filter(reduce(lambda a, b: a & b, preds)) if preds else tdc_t
    df = df.orderBy(F.desc_nulls_first("total_sessions"), "event_date", "device_type",
                    "country")
    return _page(df, n).select("device_type", "country",
                               F.col("event_date").cast("string").alias("event_date"),
                               "avg_time_seconds", "total_sessions", "unique_users")


def session_totals(summary: DataFrame) -> DataFrame:
    """Q5: totals over all Q4 rows, nulls as 0."""
    return summary.agg(
        F.coalesce(F.sum(F.coalesce("total_sessions", F.lit(0))), F.lit(0)).cast("long")
         .alias("total_sessions"),
        F.coalesce(F.sum(F.coalesce("unique_users", F.lit(0))), F.lit(0)).cast("long")
         .alias("total_users"),
        F.count(F.lit(1)).alias("count"))


def available_filters(tdc_t: DataFrame) -> DataFrame:
    """Q6: distinct countries and devices as ``(filter, value)`` rows, sorted."""
    c = tdc_t.select(F.lit("country").alias("filter"), F.col("country").alias("value"))
    d = tdc_t.select(F.lit("device").alias("filter"), F.col("device_type").alias("value"))
    return c.unionByName(d).distinct().orderBy("filter", "value")


def anomaly_search(anom_t: DataFrame, date: str | None = None, anomaly_type: str | None = None,
                   min_zscore=0, limit=None) -> DataFrame:
    """Q7: anomalies with ``z_score >= min_zscore``, optional date and exact type, z
    rounded to 4 and value to 2 places, highest first; every row unless a page size is
    given."""
    date, z, n = check_date(date), check_zscore(min_zscore), check_limit(limit)
    if math.isfinite(z) and dict(anom_t.dtypes)["z_score"].startswith("decimal"):
        z = decimal.Decimal(repr(z))  # of the column's kind, so that the filter reaches the scan
    df = anom_t.filter(F.col("z_score") >= F.lit(z))
    df = _on_date(df, date)
    if anomaly_type:
        df = df.filter(F.col("anomaly_type") == anomaly_type)
    cols = ["session_id", "user_id", "page_url", "page_type",
            F.round("z_score", 4).alias("z_score"), "anomaly_type", "anomaly_field",
            F.round("anomaly_value", 2).alias("anomaly_value"),
            F.col("event_date").cast("string").alias("event_date")]
    if "detected_at" in anom_t.columns:
        cols.append("detected_at")
    df = df.orderBy(F.desc_nulls_first("z_score"), "event_date", "session_id", "anomaly_type")
    return _page(df, n).select(*cols)


def anomaly_counts(search: DataFrame) -> DataFrame:
    """Q8: per-type counts over all Q7 rows."""
    return search.groupBy(F.coalesce("anomaly_type", F.lit("unknown")).alias("anomaly_type")) \
                 .agg(F.count(F.lit(1)).alias("anomalies"))
