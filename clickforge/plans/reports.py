"""Dashboard roll-ups (D1-D7) as DataFrames: what the dashboard computes in the browser
from API rows, expressed as part of the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickforge.functions.columns import (ANOMALY_LABEL_REWRITES, PAGE_LABEL_REWRITES,
                                          severity, shorten_label)
from clickforge.plans import serving as S

TOP_ROWS = 8


def timeline(tdc_t: DataFrame, anom_t: DataFrame, bounce_t: DataFrame) -> DataFrame:
    """Per date with data (Q3), the sessions total and the number of anomalies of that
    date, oldest first: all dates, all rows, one aggregate per table."""
    s = tdc_t.groupBy("event_date").agg(
        F.sum(F.coalesce("total_sessions", F.lit(0))).cast("long").alias("sessions"))
    a = anom_t.filter(F.col("z_score") >= 0).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("anomalies"))
    dates = S.available_dates(bounce_t).select(F.col("date").cast("date").alias("event_date"))
    return (dates.join(s, "event_date", "left").join(a, "event_date", "left")
                 .select(F.col("event_date").cast("string").alias("date"),
                         F.coalesce("sessions", F.lit(0)).cast("long").alias("sessions"),
                         F.coalesce("anomalies", F.lit(0)).cast("long").alias("anomalies"))
                 .orderBy("date"))


def sessions_by_device(summary: DataFrame) -> DataFrame:
    """Page-view totals per device over all Q4 rows."""
    return summary.groupBy("device_type").agg(
        F.sum("total_sessions").cast("long").alias("total_sessions"))


def anomaly_severity(search: DataFrame) -> DataFrame:
    """D3: Q7 rows labelled high (z > 10), med (z > 5) or low."""
    return search.withColumn("severity", severity("z_score"))


def bounce_bands(bounce: DataFrame) -> DataFrame:
    """Q2 rows with a colour band (> 80 red, > 60 amber, else green) and a bar width
    relative to the largest rate (one decimal). Q2 has one row per page type and a page
    size, so the global ``max`` window is tiny."""
    pct = F.col("bounce_rate_pct").cast("double")
    mx = F.max(pct).over(Window.partitionBy())
    return bounce.select("*",
                         F.when(pct > 80, "red").when(pct > 60, "amber").otherwise("green")
                          .alias("band"),
                         F.round(pct / mx * 100, 1).alias("width_pct"))


def kpis(totals: DataFrame, counts: DataFrame, pages: DataFrame, dates: DataFrame
         ) -> DataFrame:
    """The KPI strip as ``(kpi, value)`` rows: sessions and users (Q5), anomalies
    and anomaly types (Q8), pages returned (Q1) and available dates (Q3). Each source is
    aggregated once; the rows of one source come from one ``stack``."""
    found = counts.agg(F.coalesce(F.sum("anomalies"), F.lit(0)).cast("long").alias("n"),
                       F.count(F.lit(1)).alias("types"))
    parts = [
        totals.selectExpr("stack(2, 'sessions', total_sessions, 'users', total_users) "
                          "as (kpi, value)"),
        found.selectExpr("stack(2, 'anomalies', n, 'anomaly_types', types) as (kpi, value)"),
        pages.agg(F.lit("pages").alias("kpi"), F.count(F.lit(1)).alias("value")),
        dates.agg(F.lit("dates").alias("kpi"), F.count(F.lit(1)).alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("kpi", F.col("value").cast("long").alias("value"))


def page_labels(pages: DataFrame) -> DataFrame:
    """D6 (pages): chart label of each Q1 page url."""
    return pages.select("page_url",
                        shorten_label("page_url", PAGE_LABEL_REWRITES).alias("label"))


def anomaly_labels(search: DataFrame) -> DataFrame:
    """D6 (anomalies): short type label and the session-id excerpt (characters 6-19,
    1-based) shown in the anomaly table."""
    return search.select("session_id", "anomaly_type",
                         shorten_label("anomaly_type", ANOMALY_LABEL_REWRITES)
                          .alias("type_label"),
                         F.substring(F.coalesce("session_id", F.lit("")), 6, 14)
                          .alias("session_label"))


def top8_remainder(search: DataFrame) -> DataFrame:
    """The first 8 Q7 rows (z desc) with the count of all rows not shown: a top-k and a
    global count, joined on a constant (8 rows and 1 row)."""
    top = search.orderBy(F.desc_nulls_first("z_score"), "event_date", "session_id",
                         "anomaly_type").limit(TOP_ROWS)
    rest = search.agg(F.greatest(F.count(F.lit(1)) - TOP_ROWS, F.lit(0)).alias("more"))
    return top.withColumn("_k", F.lit(0)).join(
        F.broadcast(rest.withColumn("_k", F.lit(0))), "_k").drop("_k")
