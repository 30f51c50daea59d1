"""Typed, keyed result tables (S7/W1), key-violation report, and the ``daily_summary``
view (W2).

The load contract is inferred from the result-table DDL: cast each metric column to its
declared type, keep one row per unique key, stamp ``loaded_at``. Decimals are rounded to
the declared scale but stored with 38 digits, so a value beyond the declared precision (an
extreme z-score) is reported by :func:`key_violations` and not lost. Rows that are null in
a ``NOT NULL`` column are reported too and kept out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Result-table columns (name, type, max length), unique keys, and the
# survivor order used when a metric produces several rows for one key.
TABLES = {
    "top_pages_by_time": {
        "columns": [("event_date", "date", None), ("page_url", "string", 512),
                    ("page_type", "string", 50), ("avg_time_seconds", "decimal(10,2)", None),
                    ("total_visits", "bigint", None)],
        "key": ["event_date", "page_url"],
        "prefer": [("total_visits", "desc"), ("page_type", "asc")],
    },
    "bounce_rate": {
        "columns": [("event_date", "date", None), ("page_type", "string", 50),
                    ("total_sessions", "bigint", None), ("bounce_sessions", "bigint", None),
                    ("bounce_rate_pct", "decimal(5,2)", None)],
        "key": ["event_date", "page_type"],
        "prefer": [("total_sessions", "desc")],
    },
    "time_by_device_country": {
        "columns": [("event_date", "date", None), ("device_type", "string", 20),
                    ("country", "string", 5), ("avg_time_seconds", "decimal(10,2)", None),
                    ("total_sessions", "bigint", None), ("unique_users", "bigint", None)],
        "key": ["event_date", "device_type", "country"],
        "prefer": [("total_sessions", "desc")],
    },
    "conversion_funnel": {
        "columns": [("event_date", "date", None), ("funnel_stage", "string", 50),
                    ("users", "bigint", None), ("conversion_rate_pct", "decimal(5,2)", None)],
        "key": ["event_date", "funnel_stage"],
        "prefer": [("users", "desc")],
    },
    "product_view_vs_cart": {
        "columns": [("event_date", "date", None), ("product_id", "string", 20),
                    ("category", "string", 50), ("price", "decimal(12,2)", None),
                    ("total_views", "bigint", None), ("cart_adds", "bigint", None),
                    ("view_to_cart_rate", "decimal(5,2)", None),
                    ("is_low_conversion", "boolean", None)],
        "key": ["event_date", "product_id"],
        "prefer": [("total_views", "desc"), ("category", "asc"), ("price", "asc")],
    },
    "navigation_paths": {
        "columns": [("event_date", "date", None), ("navigation_path", "string", None),
                    ("session_count", "bigint", None)],
        "key": ["event_date", "navigation_path"],
        "prefer": [("session_count", "desc")],
    },
    "anomalies": {
        "columns": [("event_date", "date", None), ("session_id", "string", 100),
                    ("user_id", "string", 100), ("page_url", "string", 512),
                    ("page_type", "string", 50), ("z_score", "decimal(8,4)", None),
                    ("anomaly_type", "string", 100), ("anomaly_field", "string", 100),
                    ("anomaly_value", "decimal(15,4)", None),
                    ("detected_at", "timestamp", None)],
        "key": None,
        "prefer": None,
    },
}


# Columns that may not be null, beside those of the unique key.
REQUIRED = {"anomalies": ["event_date", "session_id"]}


def required_columns(table: str) -> list[str]:
    return TABLES[table]["key"] or REQUIRED[table]


def _typed(name: str, typ: str) -> Column:
    c = F.col(name)
    if typ.startswith("decimal"):
        scale = int(typ.rstrip(")").split(",")[1])
        return F.round(c, scale).try_cast(f"decimal(38,{scale})")
    return c.cast(typ)


def _overflows(name: str, typ: str) -> Column:
    scale = int(typ.rstrip(")").split(",")[1])
    return F.col(name).isNotNull() & F.round(F.col(name), scale).try_cast(typ).isNull()


def load_table(metric: DataFrame, table: str, loaded_at: Column | None = None,
               with_loaded_at: bool = True) -> DataFrame:
    """A metric DataFrame shaped as result table ``table``.

    Columns the metric lacks (``detected_at``) are left out rather than invented. Rows
    sharing a unique key are reduced to the preferred one (quirk: the metric jobs
    group by more columns than the table's key).
    """
    spec = TABLES[table]
    cols = [(n, t) for n, t, _ in spec["columns"] if n in metric.columns]
    df = metric.select(*[_typed(n, t).alias(n) for n, t in cols]) \
               .dropna(subset=required_columns(table))
    if spec["key"]:
        order = [F.col(c).desc() if d == "desc" else F.col(c).asc()
                 for c, d in spec["prefer"]]
        w = Window.partitionBy(*spec["key"]).orderBy(*order)
        df = df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    if with_loaded_at:
        df = df.withColumn("loaded_at",
                           F.current_timestamp() if loaded_at is None else loaded_at)
    return df


# What identifies a row of a table without a unique key when late data are merged.
MERGE_KEYS = {"anomalies": ["event_date", "session_id", "anomaly_type"]}
# The columns that stored tables are laid out by, for the filters of the serving queries.
LAYOUT = {"anomalies": ["z_score"], "time_by_device_country": ["total_sessions"]}


def merged_days(stored: DataFrame, delta: DataFrame, table: str) -> DataFrame:
    """S7, late data: the rows of result table ``table`` for the days of ``delta``, as they are after
    the merge. A row of ``delta`` replaces the stored one of its key and keeps that one's ``loaded_at``;
    stored rows whose key ``delta`` lacks stay. Other days of ``stored`` are not read beyond a
    semi-join on the partition column."""
    key = TABLES[table]["key"] or MERGE_KEYS[table]
    days = delta.select("event_date").distinct()
    old = stored.join(days, "event_date", "left_semi")
    both = old.select(*delta.columns).withColumn("_new", F.lit(0)) \
        .unionByName(delta.withColumn("_new", F.lit(1)))
    values = [c for c in delta.columns if c not in (*key, "loaded_at")]
    return both.groupBy(*key).agg(
        F.max_by(F.struct(*values), "_new").alias("_row"), F.min("loaded_at").alias("loaded_at")) \
        .select(*[F.col(f"_row.{c}").alias(c) if c in values else F.col(c) for c in delta.columns])


def key_violations(metric: DataFrame, table: str) -> DataFrame:
    """W1 report: ``(table_name, violation, rows)`` for duplicate keys, over-long strings,
    values beyond the declared precision and nulls in columns that may not hold one. One
    grouped aggregate by key and one over the keys (no key: one global aggregate)."""
    spec = TABLES[table]
    conds = {f"null:{n}": F.col(n).isNull() for n in required_columns(table)}
    for n, t, length in spec["columns"]:
        if n not in metric.columns:
            continue
        if length:
            conds[f"too_long:{n}"] = F.length(n) > length
        if t.startswith("decimal"):
            conds[f"overflow:{n}"] = _overflows(n, t)
    names = {k: f"_c{i}" for i, k in enumerate(conds)}
    counted = [F.count_if(c).alias(names[k]) for k, c in conds.items()]
    if spec["key"]:
        by_key = metric.groupBy(*spec["key"]).agg(F.count(F.lit(1)).alias("_n"), *counted)
        names = {"duplicate_key": "_dup", **names}
        agg = by_key.agg(F.sum(F.col("_n") - 1).alias("_dup"),
                         *[F.sum(c).alias(c) for c in list(names.values())[1:]])
    else:
        agg = metric.agg(*counted)
    stack = ", ".join(f"'{k}', coalesce(`{c}`, 0)" for k, c in names.items())
    return agg.selectExpr(f"stack({len(names)}, {stack}) as (violation, rows)").select(
        F.lit(table).alias("table_name"), "violation", F.col("rows").cast("long").alias("rows"))


def daily_summary(funnel: DataFrame, bounce: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Per day, stage-1 users, summed bounce-table sessions (double counts across page
    types, as the published view does), mean bounce pct, checkout conversion and the
    anomaly count (0 when none), newest first. The correlated scalar subqueries of the
    view become left joins on per-day aggregates (what Catalyst produces for them)."""
    base = funnel.filter(F.col("funnel_stage") == "1_page_view") \
                 .select("event_date", F.col("users").alias("total_users"))
    b = bounce.groupBy("event_date").agg(
        F.sum("total_sessions").cast("long").alias("total_sessions"),
        F.round(F.avg("bounce_rate_pct"), 2).cast("decimal(7,2)").alias("avg_bounce_rate_pct"))
    c = funnel.filter(F.col("funnel_stage") == "4_checkout").groupBy("event_date") \
              .agg(F.max("conversion_rate_pct").alias("checkout_conversion_pct"))
    a = anomalies.groupBy("event_date").agg(F.count(F.lit(1)).alias("anomaly_count"))
    return (base.join(b, "event_date", "left").join(c, "event_date", "left")
                .join(a, "event_date", "left")
                .withColumn("anomaly_count", F.coalesce("anomaly_count", F.lit(0)).cast("long"))
                .orderBy(F.desc("event_date")))
