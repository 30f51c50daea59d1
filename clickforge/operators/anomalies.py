"""Statistical anomaly detectors (z-score, IQR) and the unified anomaly table.

Statistics are computed per batch with one aggregate (partial on the map side) and joined
back to the rows; the statistics table has one row per batch key value (calendar days), and
AQE broadcasts it when its measured size allows. Nothing is collected to the driver, so many
days run in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.functions.columns import batch_keys

MIN_ROWS = 10
RESULT_COLUMNS = ["z_score", "anomaly_type", "anomaly_field", "anomaly_value"]


def _attach(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    if by:
        return df.join(stats, by)
    # Whole input as one batch: a global aggregate is exactly one row; it is joined on a
    # constant key, always broadcast (never a shuffle of all rows onto that key).
    return df.withColumn("_batch", F.lit(0)).join(
        F.broadcast(stats.withColumn("_batch", F.lit(0))), "_batch").drop("_batch")


def _tag(df: DataFrame, col: str, prefix: str, z: Column) -> DataFrame:
    return (df.withColumn("z_score", z.cast("double"))
              .withColumn("anomaly_type", F.lit(f"{prefix}_{col}"))
              .withColumn("anomaly_field", F.lit(col))
              .withColumn("anomaly_value", F.col(col).cast("double")))


def zscore_anomalies(df: DataFrame, col: str, threshold: float = 3.0,
                     by="event_date", min_rows: int = MIN_ROWS) -> DataFrame:
    """A1: rows whose ``|x - mean| / stddev_samp`` is strictly above ``threshold``.

    A batch yields nothing when its standard deviation is null or 0 or it has fewer
    than ``min_rows`` non-null values (A7: an empty result keeps the full schema).
    """
    by = batch_keys(by)
    stats = df.groupBy(*by).agg(F.avg(col).alias("_mean"),
                                F.stddev_samp(col).alias("_std"),
                                F.count(col).alias("_cnt"))
    ok = F.col("_std").isNotNull() & (F.col("_std") != 0) & (F.col("_cnt") >= min_rows)
    z = F.when(ok, F.abs((F.col(col) - F.col("_mean")) / F.col("_std")))
    out = _tag(_attach(df, stats, by), col, "zscore", z)
    return out.filter(F.col("z_score") > threshold).drop("_mean", "_std", "_cnt")


def iqr_anomalies(df: DataFrame, col: str, factor: float = 3.0, by="event_date",
                  exact: bool = False, accuracy: int = 10000,
                  min_rows: int = MIN_ROWS) -> DataFrame:
    """A2: rows outside ``[q1 - factor*iqr, q3 + factor*iqr]`` (strict), scored
    ``|x - (q1+q3)/2| / (iqr/2)``. Batches with fewer than ``min_rows`` rows or IQR 0 yield
    nothing.

    ``exact=False`` (default) uses the bounded ``percentile_approx`` sketch (relative rank
    error 1/``accuracy``), which merges map-side and never holds a batch's values.
    ``exact=True`` uses ``percentile_disc``, whose buffer grows with the number of
    *distinct* values per batch: meant for integer counts and verification.
    """
    by = batch_keys(by)
    if exact:
        q1 = F.expr(f"percentile_disc(0.25) WITHIN GROUP (ORDER BY `{col}`)")
        q3 = F.expr(f"percentile_disc(0.75) WITHIN GROUP (ORDER BY `{col}`)")
        stats = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_cnt"),
                                    q1.cast("double").alias("_q1"),
                                    q3.cast("double").alias("_q3"))
    else:
        q = F.percentile_approx(F.col(col).cast("double"), [0.25, 0.75], accuracy)
        stats = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_cnt"), q.alias("_q")) \
                  .select(*by, "_cnt", F.col("_q")[0].alias("_q1"), F.col("_q")[1].alias("_q3"))
    return iqr_from_quartiles(df, col, stats, by, factor, min_rows)


def iqr_from_quartiles(df: DataFrame, col: str, stats: DataFrame, by: list[str], factor: float = 3.0,
                       min_rows: int = MIN_ROWS) -> DataFrame:
    """A2 with given quartiles: ``stats`` has a row a batch with ``_cnt``, ``_q1`` and ``_q3``."""
    iqr = F.col("_q3") - F.col("_q1")
    ok = (F.col("_cnt") >= min_rows) & (iqr != 0)
    x = F.col(col)
    outside = (x < F.col("_q1") - factor * iqr) | (x > F.col("_q3") + factor * iqr)
    z = F.when(ok, F.abs((x - (F.col("_q1") + F.col("_q3")) / 2) / (iqr / 2)))
    out = _attach(df, stats, by).filter(ok & outside)
    return _tag(out, col, "iqr", z).drop("_cnt", "_q1", "_q3")


def clicks_per_session(clk: DataFrame, by="event_date") -> DataFrame:
    """A3 input: clicks per ``(session_id, user_id)``."""
    by = batch_keys(by)
    return clk.groupBy(*by, "session_id", "user_id").agg(
        F.count(F.lit(1)).alias("click_count"))


def click_count_anomalies(clk: DataFrame, factor: float = 3.0, by="event_date",
                          exact: bool = False) -> DataFrame:
    """A3: sessions with an outlying number of clicks (IQR detector)."""
    by = batch_keys(by)
    return iqr_anomalies(clicks_per_session(clk, by), "click_count", factor, by, exact)


def dwell_time_anomalies(pv: DataFrame, threshold: float = 3.0,
                         by="event_date") -> DataFrame:
    """A4: z-score anomalies on ``time_on_page_seconds`` with the 8-column projection."""
    by = batch_keys(by)
    return zscore_anomalies(pv, "time_on_page_seconds", threshold, by).select(
        *by, "session_id", "user_id", "page_url", "page_type", *RESULT_COLUMNS)


def anomalies(pv: DataFrame, clk: DataFrame, by="event_date", z_threshold: float = 3.0,
              iqr_factor: float = 3.0, exact: bool = False,
              detected_at: Column | None = None, with_detected_at: bool = True) -> DataFrame:
    """A5: dwell and click anomalies in one table, one row per
    ``(batch, session_id, anomaly_type)``.

    The survivor of duplicates is the highest ``z_score`` (then ``page_url``,
    ``page_type``), chosen by a ``min_by`` aggregate: partial on the map side, so a
    session with millions of anomalous rows is reduced before the shuffle.
    ``detected_at`` defaults to ``current_timestamp()``; ``with_detected_at=False`` omits
    the column (deterministic output for comparisons).
    """
    by = batch_keys(by)
    dwell = dwell_time_anomalies(pv, z_threshold, by)
    click = click_count_anomalies(clk, iqr_factor, by, exact).select(
        *by, "session_id", "user_id", F.lit(None).cast("string").alias("page_url"),
        F.lit(None).cast("string").alias("page_type"), *RESULT_COLUMNS)
    u = dwell.unionByName(click).filter(F.col("anomaly_type") != "")
    keep = F.struct("user_id", "page_url", "page_type", "z_score", "anomaly_field",
                    "anomaly_value")
    rank = F.struct((-F.col("z_score")).alias("nz"), "page_url", "page_type", "user_id")
    best = u.groupBy(*by, "session_id", "anomaly_type").agg(F.min_by(keep, rank).alias("r"))
    out = best.select(*by, "session_id", "r.user_id", "r.page_url", "r.page_type",
                      "r.z_score", "anomaly_type", "r.anomaly_field", "r.anomaly_value")
    if not with_detected_at:
        return out
    return out.withColumn("detected_at",
                          F.current_timestamp() if detected_at is None else detected_at)


def anomaly_type_counts(anoms: DataFrame, by="event_date") -> DataFrame:
    """Number of anomalies per type (per batch)."""
    by = batch_keys(by)
    return anoms.groupBy(*by, "anomaly_type").agg(F.count(F.lit(1)).alias("anomaly_count"))
