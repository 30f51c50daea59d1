"""Small fixtures for the guards of the metric operators, and the totals over all rows."""

import datetime as dt

from pyspark.sql import functions as F

from clickforge.operators import anomalies as A
from clickforge.operators import funnel as FN
from clickforge.operators import paths as P
from clickforge.plans import reports as RP
from clickforge.plans import serving as S
from clickforge.plans import warehouse as W

DAY = dt.date(2030, 5, 1)


def values(spark, xs):
    return spark.createDataFrame([(DAY, float(x)) for x in xs], "event_date date, x double")


def test_detectors_need_rows_and_spread(spark):
    spread = [1, 2, 3, 4, 5, 6, 7, 8]
    for run in (lambda df, **k: A.zscore_anomalies(df, "x", 2.0, **k),
                lambda df, **k: A.iqr_anomalies(df, "x", 1.0, **k),
                lambda df, **k: A.iqr_anomalies(df, "x", 1.0, exact=True, **k)):
        assert run(values(spark, [*spread, 99])).count() == 0            # 9 rows
        assert run(values(spark, [*spread, 5, 99])).count() == 1         # 10 rows
        assert run(values(spark, [*spread, 99]), min_rows=9).count() == 1
        empty = run(values(spark, [4] * 20))                             # no spread
        assert empty.count() == 0 and {"z_score", "anomaly_type"} <= set(empty.columns)
    assert A.iqr_anomalies(values(spark, [4] * 19 + [99]), "x").count() == 0  # IQR 0, some spread
    assert A.zscore_anomalies(values(spark, []), "x", by=None).count() == 0


def views(spark, rows):
    return spark.createDataFrame(rows, "event_date date, session_id string, user_id string, page_type string, "
                                       "event_timestamp timestamp")


def at(i):
    return dt.datetime(2030, 5, 1, 10, 0, i)


def test_funnel_of_nothing_and_without_a_base(spark):
    pv = views(spark, [])
    prd = spark.createDataFrame([(DAY, "u1")], "event_date date, user_id string")
    crt = spark.createDataFrame([], "event_date date, user_id string, action string")
    got = {r.funnel_stage: (r.users, r.conversion_rate_pct) for r in FN.conversion_funnel(pv, prd, crt).collect()}
    assert got == {"1_page_view": (0, 100.0), "2_product_view": (1, 0.0), "3_cart_add": (0, 0.0), "4_checkout": (0, 0.0)}
    nothing = FN.conversion_funnel(pv, prd.limit(0), crt, by=None).collect()
    assert [(r.users, r.conversion_rate_pct) for r in nothing] == [(0, 100.0), (0, 0.0), (0, 0.0), (0, 0.0)]


def test_products_without_cart_rows(spark):
    prd = spark.createDataFrame([(DAY, "p", "c", 2.0)] * 12, "event_date date, product_id string, category string, price double")
    crt = spark.createDataFrame([(DAY, "p", "remove")], "event_date date, product_id string, action string")
    r = FN.product_view_vs_cart(prd, crt).first()
    assert (r.total_views, r.cart_adds, r.view_to_cart_rate, r.is_low_conversion) == (12, 0, 0.0, True)


def test_paths_ties_length_and_full_path(spark):
    long = [(DAY, "s1", "u", t, at(i)) for i, t in enumerate("abcdefg")]
    ties = [(DAY, "s2", "u", t, at(0)) for t in ("z", "y")]
    pv = views(spark, long + ties + [(DAY, "s3", "u", "alone", at(0))])
    got = {r.session_id: r.path_string for r in P.session_path_strings(pv).collect()}
    assert got == {"s1": "a -> b -> c -> d -> e -> f", "s2": "y -> z"}
    full = {r.session_id: r.path_string for r in P.session_path_strings(pv, max_pages=None).collect()}
    assert full["s1"].endswith(" -> f -> g")


ANOMALIES = ("event_date date, session_id string, user_id string, page_url string, page_type string, z_score double, "
             "anomaly_type string, anomaly_field string, anomaly_value double")


def test_extreme_rows_and_all_rows_count(spark):
    rows = [(DAY, f"s{i}", "u", None, None, 4.0 + i / 1000, "iqr_x", "x", 1.0) for i in range(700)]
    rows += [(DAY, "top", "u", None, None, 12000.0, "iqr_x", "x", 1e15), (DAY, None, "u", None, None, 5.0, "t", "x", 1.0)]
    table = W.load_table(spark.createDataFrame(rows, ANOMALIES), "anomalies")
    search = S.anomaly_search(table)
    first = search.first()
    assert (first.session_id, float(first.z_score)) == ("top", 12000.0)
    assert S.anomaly_counts(search).first().anomalies == 701
    assert S.anomaly_search(table, limit=5).count() == 5
    top = RP.top8_remainder(search).collect()
    assert len(top) == 8 and {r.more for r in top} == {693}
    found = {r.violation: r.rows for r in W.key_violations(spark.createDataFrame(rows, ANOMALIES), "anomalies").collect()}
    assert found["overflow:z_score"] == found["overflow:anomaly_value"] == found["null:session_id"] == 1


def test_totals_and_timeline_read_every_row(spark):
    rows = [(DAY + dt.timedelta(days=d), "mobile", f"c{i}", 1.0, 2, 1) for d in range(40) for i in range(120)]
    tdc = spark.createDataFrame(rows, "event_date date, device_type string, country string, avg_time_seconds double, "
                                      "total_sessions long, unique_users long")
    totals = S.session_totals(S.session_summary(tdc)).first()
    assert (totals["total_sessions"], totals["count"]) == (9600, 4800)
    assert S.session_summary(tdc, limit=100).count() == 100
    bounce = tdc.select("event_date").distinct().withColumn("page_type", F.lit("home"))
    line = RP.timeline(tdc, spark.createDataFrame([], ANOMALIES), bounce).collect()
    assert len(line) == 40 and {r.sessions for r in line} == {240}
