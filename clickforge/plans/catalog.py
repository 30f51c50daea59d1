"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's test tables (via :mod:`clickforge.sources.testdata`). Keys match
:func:`clickforge.plans.oracle.queries`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.operators import anomalies as A
from clickforge.operators import clean as C
from clickforge.operators import funnel as FN
from clickforge.operators import metrics as M
from clickforge.operators import paths as P
from clickforge.schemas import EVENT_TYPES
from clickforge.session import scratch_path
from clickforge.sources import raw as R
from clickforge.sources import testdata as T

Query = Callable[[SparkSession, str], DataFrame]


def _z6(df: DataFrame) -> DataFrame:
    # z-scores compared to 6 decimals: engines merge variance partials differently.
    return df.withColumn("z_score", F.round("z_score", 6))


def q_top_pages(spark, d):
    return M.top_pages_by_time(T.page_views(spark, d), min_visits=2, top_n=20)


def q_top_pages_all(spark, d):
    return M.top_pages_by_time(T.page_views(spark, d), by=None)


def q_bounce(spark, d):
    return M.bounce_rate(T.page_views(spark, d))


def q_device(spark, d):
    return M.time_by_device_country(T.page_views(spark, d))


def q_stage_users(spark, d):
    return FN.funnel_stage_users(T.page_views(spark, d), T.product_views(spark, d),
                                 T.cart_events(spark, d))


def q_funnel(spark, d):
    return FN.conversion_funnel(T.page_views(spark, d), T.product_views(spark, d),
                                T.cart_events(spark, d))


def q_product_conv(spark, d):
    return FN.product_view_vs_cart(T.product_views(spark, d), T.cart_events(spark, d))


def q_product_conv_all(spark, d):
    return FN.product_view_vs_cart(T.product_views(spark, d), T.cart_events(spark, d),
                                   by=None)


def q_low_conv(spark, d):
    return FN.low_conversion_products(T.product_views(spark, d), T.cart_events(spark, d),
                                      by=None)


def q_path_strings(spark, d):
    return P.session_path_strings(T.page_views(spark, d))


def q_nav_paths(spark, d):
    return P.navigation_paths(T.page_views(spark, d))


def q_zscore(spark, d):
    z = A.zscore_anomalies(T.page_views(spark, d), "time_on_page_seconds")
    return _z6(z.select("event_date", "event_id", "session_id", "time_on_page_seconds",
                        *A.RESULT_COLUMNS))


def q_iqr(spark, d):
    ev = T.derive(T.table(spark, d, "events"))
    z = A.iqr_anomalies(ev, "value", 3.0, exact=True)
    return _z6(z.select("event_date", "event_id", "value", *A.RESULT_COLUMNS))


def q_iqr_sketch(spark, d):
    """A2 by the default bounded sketch, whose quartiles are exact as long as a batch has fewer
    rows than the sketch's accuracy."""
    ev = T.derive(T.table(spark, d, "events"))
    z = A.iqr_anomalies(ev, "value", 1.0)
    return _z6(z.select("event_date", "event_id", "value", *A.RESULT_COLUMNS))


def q_click_anoms(spark, d):
    return _z6(A.click_count_anomalies(T.clicks(spark, d), factor=1.0, exact=True))


def q_dwell(spark, d):
    return _z6(A.dwell_time_anomalies(T.page_views(spark, d)))


def _anoms(spark, d):
    return A.anomalies(T.page_views(spark, d), T.clicks(spark, d), iqr_factor=1.0,
                       exact=True, with_detected_at=False)


def q_anomalies(spark, d):
    return _z6(_anoms(spark, d))


def q_anomaly_counts(spark, d):
    return A.anomaly_type_counts(_anoms(spark, d))


AS_OF = "2026-01-01 00:00:00"


def _raw(spark, d, et):
    lines = T.raw_event_lines(spark, d).filter(F.col("event_type") == et)
    return R.parse_json_lines(lines, et)


def _ts_text(df):
    return df.withColumn("event_timestamp",
                         F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss"))


def q_clean(et):
    def q(spark, d):
        return _ts_text(C.clean_events(_raw(spark, d, et), et,
                                       as_of=F.lit(AS_OF).cast("timestamp")))
    return q


def q_clean_counts(spark, d):
    raw = {et: _raw(spark, d, et) for et in EVENT_TYPES}
    return C.row_counts(raw, as_of=F.lit(AS_OF).cast("timestamp"))


def _batch_run(spark, d, types=EVENT_TYPES, tables=()):
    """S6, then the batch run over the written raw files, in a fresh folder of the shared
    scratch space, as far as the given clean types and result tables need it. Returns the
    folder of the stored tables."""
    from clickforge.plans import batch as B
    root = scratch_path(spark, f"batch-{uuid.uuid4().hex}")
    from clickforge.sources.files import split_by_type
    lines = T.raw_event_lines(spark, d)
    split_by_type(lines, f"{root}/raw", fmt="text")
    days = [r[0] for r in lines.select("event_date").distinct().collect()]
    report = B.run_days(spark, f"{root}/raw", f"{root}/out", days, min_visits=2, iqr_factor=1.0,
                        exact=True, as_of=F.lit(AS_OF).cast("timestamp"),
                        loaded_at=F.lit(AS_OF).cast("timestamp"), types=types, tables=tables)
    if report["failures"]:
        raise RuntimeError(f"the batch run failed for {report['failures']}")
    return f"{root}/out"


def q_ingested(et):
    def q(spark, d):
        t = _ts_text(spark.read.parquet(f"{_batch_run(spark, d, [et])}/clean_{et}"))
        return t.withColumn("batch_date", F.col("batch_date").cast("string"))
    return q


def _stored(spark, d, *tables):
    from clickforge.plans import batch as B
    types = sorted({et for t in tables for et in B.METRICS[t][0]})
    return B.stored_tables(spark, _batch_run(spark, d, types, tables), tables)


def q_stored(table):
    def q(spark, d):
        t = _stored(spark, d, table)[table]
        return t.drop("detected_at").withColumn(
            "loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))
    return q


def q_stored_report(spark, d):
    """D1 over stored tables."""
    from clickforge.plans import reports as RP
    w = _stored(spark, d, "time_by_device_country", "anomalies", "bounce_rate")
    return RP.timeline(w["time_by_device_country"], w["anomalies"], w["bounce_rate"])


#: Lines of one file of the written fixture.
FILE_LINES = 10_000


def q_stored_sessions(spark, d):
    """Q4 over the stored table."""
    from clickforge.plans import serving as S
    t = _stored(spark, d, "time_by_device_country")["time_by_device_country"]
    return S.session_summary(t, limit=S.SESSION_ROWS)


def q_stored_anomalies(spark, d):
    """Q7 over the stored table, every row from a z-score on."""
    from clickforge.plans import serving as S
    return S.anomaly_search(_stored(spark, d, "anomalies")["anomalies"].drop("detected_at"), min_zscore="3.5")


#: First and second load of :func:`q_late_days`.
LOADS = ("2026-01-01 00:00:00", "2026-02-01 00:00:00")


def q_late_days(spark, d):
    """S7, late data: on even days the page views of the afternoon, and those of some pages, arrive
    after the first load; their days are computed again and merged into the stored table."""
    from clickforge.plans import batch as B
    from clickforge.plans import warehouse as W
    from clickforge.sources import files as FS
    root = scratch_path(spark, f"late-{uuid.uuid4().hex}")
    views = T.page_views(spark, d)
    late = (F.dayofmonth("event_date") % 2 == 0) & (
        F.col("page_type").isin(LATE_PAGES) | (F.hour("event_timestamp") >= 12))

    def load(pv, at):
        return W.load_table(M.bounce_rate(pv), "bounce_rate", F.lit(at).cast("timestamp"))

    FS.write_days(load(views.where(~late), LOADS[0]), root, "warehouse_bounce_rate")
    days = views.where(late).select("event_date").distinct()
    B.merge_late_days(spark, root, "bounce_rate", load(views.join(days, "event_date", "left_semi"), LOADS[1]))
    t = B.stored_tables(spark, root, ["bounce_rate"])["bounce_rate"]
    return t.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


#: The page types whose views arrive late on even days.
LATE_PAGES = ["cart", "checkout"]


def q_unique_users(spark, d):
    """Q5's users over all days, from the stored daily sketches."""
    from clickforge.plans import sketches as K
    stored = K.store_sketches(K.user_sketches(T.page_views(spark, d)), scratch_path(
        spark, f"sketches-{uuid.uuid4().hex}"), "users")
    return K.unique_users(stored, "device_type", "country")


def q_iqr_trailing(spark, d):
    """A2 against the quartiles of seven days, from the stored daily sketches."""
    from clickforge.plans import sketches as K
    ev = T.derive(T.table(spark, d, "events"))
    stored = K.store_sketches(K.value_sketches(ev, "value"), scratch_path(
        spark, f"sketches-{uuid.uuid4().hex}"), "values")
    z = K.iqr_trailing_days(ev, "value", stored, factor=1.0)
    return _z6(z.select("event_date", "event_id", "value", *A.RESULT_COLUMNS))


def _ingested_files(spark, d):
    """The fixture as real files, with one of no bytes in every day folder, through the ingest run.
    Returns the folder of the outputs and that of the files."""
    from clickforge.sources.ingest_fixture import DAY_DIR, fixture_text
    from clickforge.sources.listing import write_files
    from clickforge.streaming.ingest import ingest_files
    root = scratch_path(spark, f"files-{uuid.uuid4().hex}")
    lines = fixture_text(spark, d).select(F.col("file_path").alias("key"), F.col("line_id").alias("n"), "line")
    voids = T.derive(T.table(spark, d, "events")).select(
        F.concat(F.expr(DAY_DIR), F.lit("/void.jsonl")).alias("key"), F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("string").alias("line")).distinct()
    write_files(lines.unionByName(voids), f"{root}/raw").write.parquet(f"{root}/written")
    ingest_files(spark, f"{root}/raw", f"{root}/out", "r", quarantined_at=F.lit(AS_OF).cast("timestamp"))
    return f"{root}/out", f"{root}/raw"


def q_file_metrics(spark, d):
    """V9 and V11 of real files, those of no bytes included."""
    out, raw = _ingested_files(spark, d)
    m = spark.read.parquet(f"{out}/ingest_metrics").drop("run_id")
    return m.withColumn("file_path", R.object_key(F.col("file_path"), raw))


def q_quarantine_copies(spark, d):
    """The flagged files' copies."""
    return spark.read.parquet(f"{_ingested_files(spark, d)[0]}/quarantine_copies").drop("run_id")


def _fixture(spark, d):
    """The faulty lines, written once in the shared scratch space as many files, as raw lines
    arrive: what reads them twice does not make them twice."""
    from clickforge.sources.ingest_fixture import fixture_text, with_sizes
    lines, path = fixture_text(spark, d), scratch_path(spark, f"fixture-{uuid.uuid4().hex}")
    lines.write.option("maxRecordsPerFile", FILE_LINES).parquet(path)
    return with_sizes(spark.read.schema(lines.schema).parquet(path))


def _records(spark, d):
    return R.lines_to_records(_fixture(spark, d).filter(~R.is_quarantined(F.col("file_path"))))


def _annotated(spark, d, profile="ingest"):
    from clickforge.operators import validate as V
    return V.annotate(_records(spark, d), profile)


def q_event_type(spark, d):
    lines = _fixture(spark, d).filter(~R.is_quarantined(F.col("file_path")))
    return lines.select("file_path", R.event_type_from_path(F.col("file_path"))
                        .alias("event_type")).distinct()


def q_skip_quarantine(spark, d):
    return _fixture(spark, d).filter(R.is_quarantined(F.col("file_path"))) \
        .select("file_path").distinct()


def q_errors(spark, d):
    from clickforge.operators import validate as V
    records = _records(spark, d)
    return V.validation_errors(V.annotate(records), records)


def _errors_of(*codes):
    def q(spark, d):
        return q_errors(spark, d).filter(F.col("error_code").isin(*codes))
    return q


def q_summary(spark, d):
    from clickforge.operators import validate as V
    return V.validation_summary(_annotated(spark, d))


def q_metrics(spark, d):
    from clickforge.operators import validate as V
    return V.ingest_metrics(q_summary(spark, d))


def q_empty(spark, d):
    return q_metrics(spark, d).filter(F.col("EmptyFiles") == 1).select("file_path",
                                                                        "event_type")


def q_run_summary(spark, d):
    from clickforge.operators import validate as V
    return V.run_summary(q_metrics(spark, d))


def q_valid(spark, d):
    from clickforge.operators import validate as V
    return V.valid_events(_annotated(spark, d))


def q_quarantine(spark, d):
    """S5 over the fixture: one row per quarantined file, the listed errors as JSON text
    (``quarantined_at`` is a wall-clock stamp)."""
    from clickforge.operators import quarantine as Q
    from clickforge.operators import validate as V
    records = _records(spark, d)
    m = Q.quarantine_metadata(V.annotate(records), F.lit(AS_OF).cast("timestamp"),
                              records=records)
    return m.select("source_key", "quarantine_key", "error_key", "error_count",
                    F.to_json("errors", {"ignoreNullFields": "false"}).alias("errors"))


def q_contract(spark, d):
    from clickforge.operators import validate as V
    records = _records(spark, d)
    return V.validation_errors(V.annotate(records, "contract"), records)


def _metrics(spark, d):
    pv, clk = T.page_views(spark, d), T.clicks(spark, d)
    prd, crt = T.product_views(spark, d), T.cart_events(spark, d)
    return {
        "top_pages_by_time": M.top_pages_by_time(pv, min_visits=2),
        "bounce_rate": M.bounce_rate(pv),
        "time_by_device_country": M.time_by_device_country(pv),
        "conversion_funnel": FN.conversion_funnel(pv, prd, crt),
        "product_view_vs_cart": FN.product_view_vs_cart(prd, crt),
        "navigation_paths": P.navigation_paths(pv),
        "anomalies": A.anomalies(pv, clk, iqr_factor=1.0, exact=True, with_detected_at=False),
    }


def _wh(spark, d):
    from clickforge.plans import warehouse as W
    return {t: W.load_table(m, t, with_loaded_at=False) for t, m in _metrics(spark, d).items()}


def _wh_query(table):
    def q(spark, d):
        return _wh(spark, d)[table]
    return q


def q_violations(spark, d):
    from clickforge.plans import warehouse as W
    parts = [W.key_violations(m, t) for t, m in _metrics(spark, d).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_daily_summary(spark, d):
    from clickforge.plans import warehouse as W
    w = _wh(spark, d)
    return W.daily_summary(w["conversion_funnel"], w["bounce_rate"], w["anomalies"])


def _serving(fn):
    def q(spark, d):
        from clickforge.plans import reports as RP
        from clickforge.plans import serving as S
        return fn(S, RP, _wh(spark, d))
    return q


SERVING = {
    "serve_top_pages": lambda S, RP, w: S.top_pages(w["top_pages_by_time"]),
    "serve_bounce": lambda S, RP, w: S.top_pages(None, metric="bounce_rate",
                                                 bounce_t=w["bounce_rate"]),
    "serve_dates": lambda S, RP, w: S.available_dates(w["bounce_rate"], limit=S.DATE_ROWS),
    "serve_sessions": lambda S, RP, w: S.session_summary(w["time_by_device_country"],
                                                         limit=S.SESSION_ROWS),
    "serve_sessions_filtered": lambda S, RP, w: S.session_summary(
        w["time_by_device_country"], date="2024-01-06", country="C3", device="Mobile",
        limit=S.SESSION_ROWS),
    "serve_session_totals": lambda S, RP, w: S.session_totals(
        S.session_summary(w["time_by_device_country"])),
    "serve_filters": lambda S, RP, w: S.available_filters(w["time_by_device_country"]),
    "serve_anomalies": lambda S, RP, w: S.anomaly_search(w["anomalies"],
                                                         limit=S.ANOMALY_ROWS),
    "serve_anomalies_filtered": lambda S, RP, w: S.anomaly_search(
        w["anomalies"], anomaly_type="zscore_time_on_page_seconds", min_zscore="3.5",
        limit=S.ANOMALY_ROWS),
    "serve_anomaly_counts": lambda S, RP, w: S.anomaly_counts(S.anomaly_search(w["anomalies"])),
    "report_timeline": lambda S, RP, w: RP.timeline(w["time_by_device_country"],
                                                    w["anomalies"], w["bounce_rate"]),
    "report_sessions_by_device": lambda S, RP, w: RP.sessions_by_device(
        S.session_summary(w["time_by_device_country"])),
    "report_anomaly_severity": lambda S, RP, w: RP.anomaly_severity(
        S.anomaly_search(w["anomalies"], limit=S.ANOMALY_ROWS)),
    "report_bounce_bands": lambda S, RP, w: RP.bounce_bands(
        S.bounce_summary(w["bounce_rate"])),
    "report_kpis": lambda S, RP, w: RP.kpis(
        S.session_totals(S.session_summary(w["time_by_device_country"])),
        S.anomaly_counts(S.anomaly_search(w["anomalies"])),
        S.top_pages(w["top_pages_by_time"]), S.available_dates(w["bounce_rate"])),
    "report_page_labels": lambda S, RP, w: RP.page_labels(S.top_pages(w["top_pages_by_time"])),
    "report_anomaly_labels": lambda S, RP, w: RP.anomaly_labels(
        S.anomaly_search(w["anomalies"], limit=S.ANOMALY_ROWS)),
    "report_top8_remainder": lambda S, RP, w: RP.top8_remainder(
        S.anomaly_search(w["anomalies"])),
}


def queries() -> dict[str, Query]:
    return {
        "top_pages_by_time": q_top_pages,
        "top_pages_by_time_all_days": q_top_pages_all,
        "bounce_rate": q_bounce,
        "time_by_device_country": q_device,
        "funnel_stage_users": q_stage_users,
        "conversion_funnel": q_funnel,
        "product_view_vs_cart": q_product_conv,
        "product_view_vs_cart_all_days": q_product_conv_all,
        "low_conversion_products": q_low_conv,
        "session_path_strings": q_path_strings,
        "navigation_paths": q_nav_paths,
        "zscore_anomalies": q_zscore,
        "iqr_anomalies": q_iqr,
        "iqr_anomalies_sketch": q_iqr_sketch,
        "click_count_anomalies": q_click_anoms,
        "dwell_time_anomalies": q_dwell,
        "anomalies": q_anomalies,
        "anomaly_type_counts": q_anomaly_counts,
        "clean_events": q_clean("page_view"),
        **{f"clean_{et}": q_clean(et) for et in EVENT_TYPES if et != "page_view"},
        "clean_row_counts": q_clean_counts,
        "ingest_event_type": q_event_type,
        "ingest_skip_quarantine": q_skip_quarantine,
        "validate_unknown_type": _errors_of("unknown_event_type"),
        "validate_required": _errors_of("missing_field", "null_field"),
        "validate_types": _errors_of("wrong_type"),
        "validate_enums": _errors_of("invalid_enum"),
        "validate_ranges": _errors_of("out_of_range"),
        "validate_timestamp": _errors_of("timestamp_type", "timestamp_format"),
        "validation_errors": q_errors,
        "validation_summary": q_summary,
        "ingest_empty_files": q_empty,
        "ingest_metrics": q_metrics,
        "ingest_run_summary": q_run_summary,
        "valid_events": q_valid,
        "quarantine_files": q_quarantine,
        "validate_contract": q_contract,
        **{f"warehouse_{t}": _wh_query(t) for t in (
            "top_pages_by_time", "bounce_rate", "time_by_device_country", "conversion_funnel",
            "product_view_vs_cart", "navigation_paths", "anomalies")},
        **{f"ingested_clean_{et}": q_ingested(et) for et in EVENT_TYPES},
        **{f"stored_{t}": q_stored(t) for t in (
            "top_pages_by_time", "bounce_rate", "time_by_device_country", "conversion_funnel",
            "product_view_vs_cart", "navigation_paths", "anomalies")},
        "stored_timeline": q_stored_report,
        "stored_serve_sessions": q_stored_sessions,
        "stored_serve_anomalies": q_stored_anomalies,
        "stored_after_late_days": q_late_days,
        "stored_unique_users": q_unique_users,
        "iqr_trailing_days": q_iqr_trailing,
        "ingested_file_metrics": q_file_metrics,
        "quarantine_copies": q_quarantine_copies,
        "warehouse_key_violations": q_violations,
        "daily_summary": q_daily_summary,
        **{k: _serving(f) for k, f in SERVING.items()},
    }
