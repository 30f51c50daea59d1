"""The end-to-end batch run over raw day folders."""

import json
import os

from pyspark.sql import functions as F

from clickforge.plans import batch as B
from clickforge.plans import serving as S
from clickforge.sources import files as FS

D1, D2 = "2031-01-05", "2031-01-06"
AS_OF = "2031-06-01 00:00:00"


def view(user, session, page, second, day=D1):
    return {"event_type": "page_view", "user_id": user, "session_id": session, "page_url": f"/{page}", "page_type": page,
            "timestamp": f"{day}T10:00:{second:02d}+00:00", "time_on_page_seconds": 10 + second, "referrer": None,
            "device_type": "mobile", "country": "ES"}


def put(root, day, event_type, records):
    folder = os.path.join(root, f"event_date={day}", f"event_type={event_type}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part-0.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in records) + "\n")


def run(spark, tmp, days):
    return B.run_days(spark, f"{tmp}/raw", f"{tmp}/out", days, as_of=F.lit(AS_OF).cast("timestamp"), min_visits=1)


def test_run_and_rerun(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    pages = [view("u1", "s1", "home", 1), view("u1", "s1", "checkout", 2), view("u2", "s2", "home", 3), view("u2", "s2", "home", 3),
             view(None, "s3", "home", 4)]
    put(raw, D1, "page_view", pages)
    put(raw, D2, "page_view", [view("u1", "s4", "home", 1, D2), view("u3", "s4", "cart", 2, D2)])
    put(raw, D1, "cart_event", [{"user_id": "u1", "session_id": "s1", "product_id": None, "action": "add", "timestamp": f"{D1}T10:00:00+00:00"}])
    put(raw, D1, "product_view", [{"user_id": "u1", "session_id": "s1", "product_id": p, "category": "toys", "price": 1.0,
                                   "timestamp": f"{D1}T10:00:00+00:00", "time_on_page_seconds": 5} for p in ("p", None)])
    report = run(spark, tmp_dir, [D1, D2])
    assert report["failures"] == {} and report["rows"]["clean_page_view"] == 5
    tables = B.stored_tables(spark, f"{tmp_dir}/out")
    assert {r.product_id for r in tables["product_view_vs_cart"].collect()} == {"p"}   # a null key stays out
    pages = S.top_pages(tables["top_pages_by_time"], date=D1)
    assert {r.page_url: r.total_visits for r in pages.collect()} == {"/home": 2, "/checkout": 1}
    assert "PartitionFilters: [isnotnull(event_date" in pages._jdf.queryExecution().executedPlan().toString()
    assert tables["bounce_rate"].where("loaded_at is null").count() == 0
    # the second day is run again and has nothing now: its rows go, the first day stays
    put(raw, D2, "page_view", [])
    assert run(spark, tmp_dir, [D2])["failures"] == {}
    left = B.stored_tables(spark, f"{tmp_dir}/out")["bounce_rate"]
    assert {str(r.event_date) for r in left.select("event_date").distinct().collect()} == {D1}


def test_a_type_that_fails_at_run_time_is_isolated(spark, tmp_dir, monkeypatch):
    from clickforge.operators import clean as C
    raw = f"{tmp_dir}/raw"
    put(raw, D1, "page_view", [view("u1", "s1", "home", 1), view("u1", "s1", "cart", 2)])
    put(raw, D1, "click", [{"user_id": "u", "session_id": "s", "timestamp": f"{D1}T10:00:00+00:00"}])
    real = C.clean_events
    monkeypatch.setattr(C, "clean_events", lambda df, et, *a, **k: real(df, et, *a, **k) if et != "click" else
                        real(df, et, *a, **k).withColumn("element_id", F.raise_error(F.lit("broken")).cast("string")))
    report = run(spark, tmp_dir, [D1])
    assert set(report["failures"]) == {"clean_click", "metric_anomalies"} and "broken" in report["failures"]["clean_click"]
    assert report["rows"]["warehouse_navigation_paths"] == 1


def test_a_day_that_now_has_no_rows_is_cleared(spark, tmp_dir):
    df = spark.createDataFrame([(D1, 1), (D2, 2)], "d string, v int").select(F.to_date("d").alias("event_date"), "v")
    FS.write_days(df, tmp_dir, "m", days=[D1, D2])
    FS.write_days(df.where("v = 0"), tmp_dir, "m", days=[D2])
    assert [r.v for r in FS.read_days(spark, tmp_dir, "m").collect()] == [1]
    FS.write_days(df.where("v = 2"), tmp_dir, "m")
    assert sorted(r.v for r in FS.read_days(spark, tmp_dir, "m").collect()) == [1, 2]
