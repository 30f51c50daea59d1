"""Late data in the stored result tables, and filters that skip what they do not need."""

import datetime as dt
import os

from pyspark.sql import functions as F

from clickforge.plans import batch as B
from clickforge.plans import serving as S
from clickforge.plans import warehouse as W
from clickforge.sources import files as FS

D1, D2, D3 = (dt.date(2030, 5, k) for k in (1, 2, 3))
BOUNCE = "event_date date, page_type string, total_sessions long, bounce_sessions long, bounce_rate_pct double"


def load(spark, rows, at):
    return W.load_table(spark.createDataFrame(rows, BOUNCE), "bounce_rate", F.lit(at).cast("timestamp"))


def files_of(root, day):
    folder = f"{root}/warehouse_bounce_rate/event_date={day}"
    return {f: os.stat(os.path.join(folder, f)).st_mtime_ns for f in os.listdir(folder)}


def test_only_affected_days_are_written_and_first_loads_are_kept(spark, tmp_dir):
    FS.write_days(load(spark, [(D1, "home", 5, 1, 20.0), (D1, "cart", 2, 2, 100.0), (D2, "home", 3, 0, 0.0)], "2030-06-01 00:00:00"),
                  tmp_dir, "warehouse_bounce_rate")
    before = files_of(tmp_dir, D2)
    late = load(spark, [(D1, "home", 9, 3, 33.33), (D1, "search", 1, 1, 100.0), (D3, "home", 1, 0, 0.0)], "2030-07-01 00:00:00")
    for _ in range(2):  # running it again gives the same table
        assert B.merge_late_days(spark, tmp_dir, "bounce_rate", late) == [str(D1), str(D3)]
        got = B.stored_tables(spark, tmp_dir, ["bounce_rate"])["bounce_rate"].collect()
        assert sorted((str(r.event_date), r.page_type, r.total_sessions, r.loaded_at.month) for r in got) == [
            (str(D1), "cart", 2, 6), (str(D1), "home", 9, 6), (str(D1), "search", 1, 7), (str(D2), "home", 3, 6),
            (str(D3), "home", 1, 7)]
    assert files_of(tmp_dir, D2) == before
    assert B.merge_late_days(spark, tmp_dir, "bounce_rate", late.limit(0)) == []


def test_anomalies_merge_by_session_and_type(spark, tmp_dir):
    cols = ("event_date date, session_id string, user_id string, page_url string, page_type string, z_score double, "
            "anomaly_type string, anomaly_field string, anomaly_value double")
    def table(rows, at):
        return W.load_table(spark.createDataFrame([(D1, s, "u", None, None, z, t, "x", 1.0) for s, z, t in rows], cols),
                            "anomalies", F.lit(at).cast("timestamp"))
    old = table([("s1", 4.0, "a"), ("s2", 5.0, "a")], "2030-06-01 00:00:00")
    new = table([("s1", 6.0, "a"), ("s1", 7.0, "b")], "2030-07-01 00:00:00")
    got = W.merged_days(old, new, "anomalies").collect()
    assert sorted((r.session_id, r.anomaly_type, float(r.z_score), r.loaded_at.month) for r in got) == [
        ("s1", "a", 6.0, 6), ("s1", "b", 7.0, 7), ("s2", "a", 5.0, 6)]


def test_serving_filters_reach_the_scan(spark, tmp_dir):
    cols = ("event_date date, session_id string, user_id string, page_url string, page_type string, z_score double, "
            "anomaly_type string, anomaly_field string, anomaly_value double")
    rows = [(D1 if i % 2 else D2, f"s{i}", "u", None, None, i / 10, "t", "x", 1.0) for i in range(100)]
    FS.write_days(W.load_table(spark.createDataFrame(rows, cols), "anomalies"), tmp_dir, "warehouse_anomalies",
                  sort=W.LAYOUT["anomalies"])
    table = B.stored_tables(spark, tmp_dir, ["anomalies"])["anomalies"]
    found = S.anomaly_search(table, date=str(D1), min_zscore="5.05")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(z_score,5.05" in plan
    assert "event_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert found.count() == sum(1 for i in range(100) if i % 2 and i / 10 >= 5.05)
