"""Stored daily sketches: what can't be added up across days, kept mergeable.

Distinct users of two days are not the sum of the days' users, and a quartile over a week is not
a mean of the days' quartiles. So each day stores a sketch beside its exact figures: a theta
sketch of its users and a KLL sketch of its values. Sketches are a few rows a day, bounded in
size whatever the day's traffic, built map-side, and merged for any range of days without
reading the events again.

Errors: a theta sketch is exact up to ``2 ** LG_USERS`` distinct users of a merged group and has a
relative standard error of ``2 ** (-LG_USERS / 2)`` (0.8 %) beyond. A KLL sketch is exact while the
merged days hold up to ``KLL_K`` values; beyond, ranks are off by a small share of the rows (well below
0.1 %), which shrinks with a larger ``KLL_K``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.operators.anomalies import MIN_ROWS, iqr_from_quartiles
from clickforge.sources import files as FS

LG_USERS, KLL_K = 14, 8_192


def user_sketches(pv: DataFrame, by: str = "event_date", lg: int = LG_USERS) -> DataFrame:
    """M3's daily users as sketches: ``by, device_type, country, users`` (binary). Null users do not
    count."""
    return pv.groupBy(by, "device_type", "country").agg(F.theta_sketch_agg("user_id", lg).alias("users"))


def unique_users(sketches: DataFrame, *keys: str, lg: int = LG_USERS) -> DataFrame:
    """Q5's users without counting one twice: ``keys, unique_users`` over all rows of
    ``sketches`` (filter the days before)."""
    return sketches.groupBy(*keys).agg(
        F.theta_sketch_estimate(F.theta_union_agg("users", lg)).alias("unique_users"))


def value_sketches(df: DataFrame, col: str, by: str = "event_date", k: int = KLL_K) -> DataFrame:
    """``by, rows, values`` (binary): a day's values of ``col`` for baselines over many days."""
    return df.where(F.col(col).isNotNull()).groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias("values"))


def trailing_baselines(sketches: DataFrame, window_days: int = 7, by: str = "event_date", k: int = KLL_K) -> DataFrame:
    """For each stored day the quartiles over it and the ``window_days - 1`` days before:
    ``by, _cnt, _q1, _q3``. Every sketch is sent to the days that it counts for and merged there; days
    without a sketch of their own get no baseline."""
    sent = sketches.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(window_days - 1)), lambda i: F.date_add(
        F.col(by), i))).alias(by), "rows", "values")
    merged = sent.groupBy(by).agg(F.sum("rows").alias("_cnt"), F.kll_merge_agg_double("values", F.lit(k)).alias("_v"))
    return merged.join(sketches.select(by), by, "left_semi").select(
        by, "_cnt", F.kll_sketch_get_quantile_double("_v", F.lit(0.25).cast("double")).alias("_q1"),
        F.kll_sketch_get_quantile_double("_v", F.lit(0.75).cast("double")).alias("_q3"))


def iqr_trailing_days(df: DataFrame, col: str, sketches: DataFrame, window_days: int = 7, factor: float = 3.0,
                      by: str = "event_date", min_rows: int = MIN_ROWS) -> DataFrame:
    """A2 against a baseline over many days: rows of ``df`` outside the fences of the trailing
    window of their day, from the stored ``sketches`` (see :func:`value_sketches`)."""
    return iqr_from_quartiles(df, col, trailing_baselines(sketches, window_days, by), [by], factor, min_rows)


def store_sketches(df: DataFrame, out_root: str, name: str, by: str = "event_date") -> DataFrame:
    """Write sketches by day (replacing the days they hold) and read the stored table back."""
    FS.write_days(df, out_root, f"sketch_{name}", by)
    return FS.read_days(df.sparkSession, out_root, f"sketch_{name}")
