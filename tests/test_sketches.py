"""Stored sketches: exact while small, within their stated error beyond, mergeable across days."""

import datetime as dt
import random

from pyspark.sql import functions as F

from clickforge.plans import sketches as K

DAYS = [dt.date(2030, 5, k) for k in range(1, 11)]


def test_users_of_several_days_count_once(spark, tmp_dir):
    rows = [(DAYS[i % 3], "mobile" if i % 2 else None, "ES", f"u{i % 40}" if i % 7 else None) for i in range(600)]
    views = spark.createDataFrame(rows, "event_date date, device_type string, country string, user_id string")
    stored = K.store_sketches(K.user_sketches(views), tmp_dir, "users")
    got = {r.device_type: r.unique_users for r in K.unique_users(stored, "device_type", "country").collect()}
    assert got == {d: len({u for _, e, _, u in rows if e == d and u}) for d in ("mobile", None)}
    one = K.unique_users(stored.where(F.col("event_date") == DAYS[0])).first()[0]
    assert one == len({r[3] for r in rows if r[0] == DAYS[0] and r[3]})


def test_error_of_many_users(spark):
    views = spark.range(60_000).select(F.lit(DAYS[0]).alias("event_date"), F.lit("m").alias("device_type"),
                                       F.lit("ES").alias("country"), F.col("id").cast("string").alias("user_id"))
    both = K.user_sketches(views, lg=10).unionByName(K.user_sketches(views.withColumn("event_date", F.lit(DAYS[1])), lg=10))
    got = K.unique_users(both, "country", lg=10).first().unique_users
    assert got != 120_000 and abs(got - 60_000) < 5 * 60_000 * 2 ** -5


def test_trailing_windows(spark):
    rnd = random.Random(4)
    rows = [(d, round(rnd.gauss(k, 3), 2) if rnd.random() > 0.1 else None) for k, d in enumerate(DAYS) if k != 4 for _ in range(30 + k)]
    df = spark.createDataFrame(rows, "event_date date, x double")
    got = {r.event_date: (r._cnt, r._q1, r._q3) for r in K.trailing_baselines(K.value_sketches(df, "x"), 3).collect()}
    want = {}
    for k, d in enumerate(DAYS):
        own = sorted(x for e, x in rows if x is not None and 0 <= (d - e).days < 3)
        if k != 4:
            want[d] = (len(own), own[-(-len(own) // 4) - 1], own[-(-3 * len(own) // 4) - 1])
    assert got == want
    found = K.iqr_trailing_days(df, "x", K.value_sketches(df, "x"), 3, factor=0.5).collect()
    fence = {d: (q1 - 0.5 * (q3 - q1), q3 + 0.5 * (q3 - q1)) for d, (_, q1, q3) in want.items()}
    assert sorted((r.event_date, r.x) for r in found) == sorted(
        (d, x) for d, x in rows if x is not None and not fence[d][0] <= x <= fence[d][1])


def test_ranks_beyond_the_exact_size(spark):
    df = spark.range(200_000).select(F.lit(DAYS[0]).alias("event_date"), F.col("id").cast("double").alias("x"))
    r = K.trailing_baselines(K.value_sketches(df, "x", k=1_024), k=1_024).first()
    assert r._cnt == 200_000 and abs(r._q1 - 50_000) < 1_000 and abs(r._q3 - 150_000) < 1_000
    assert K.trailing_baselines(K.value_sketches(df.limit(0), "x")).count() == 0
