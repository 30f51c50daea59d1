"""End-to-end batch run: raw day folders to clean tables, metrics and result tables.

``run_days`` reads the JSONL of some batch days (S1), cleans each event type (C1-C10),
writes day-partitioned tables (S4), computes the metric tables from what was stored (M, F,
N, A) and loads the typed result tables (S7). Every write replaces exactly the given days,
also those that now have no rows. An event type that fails at run time is reported, the
others go on (C9).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickforge.operators import anomalies as A
from clickforge.operators import clean as C
from clickforge.operators import funnel as FN
from clickforge.operators import metrics as M
from clickforge.operators import paths as P
from clickforge.plans import warehouse as W
from clickforge.schemas import EVENT_TYPES
from clickforge.session import scratch_path
from clickforge.sources import files as FS
from clickforge.sources import raw as R

DAY = "batch_date"

# The tables that are rolled up from the pre-aggregate, which is made in one pass.
CUBE_TABLES = ("top_pages_by_time", "bounce_rate", "time_by_device_country", "conversion_funnel")

# Metric tables and the clean tables that each is computed from. ``t`` has those by event type,
# and the shared pre-aggregate of the page views as "cube".
METRICS = {
    "top_pages_by_time": (("page_view",), lambda t, o: M.top_pages_of_cube(
        t["cube"], by=DAY, min_visits=o["min_visits"])),
    "bounce_rate": (("page_view",), lambda t, o: M.bounce_rate_of_cube(t["cube"], by=DAY)),
    "time_by_device_country": (("page_view",), lambda t, o: M.time_by_device_country_of_cube(
        t["cube"], by=DAY)),
    "conversion_funnel": (("page_view", "product_view", "cart_event"), lambda t, o:
                          FN.conversion_funnel(M.page_view_users_of_cube(t["cube"], by=DAY),
                                               t["product_view"], t["cart_event"], by=DAY)),
    "product_view_vs_cart": (("product_view", "cart_event"), lambda t, o:
                             FN.product_view_vs_cart(t["product_view"], t["cart_event"], by=DAY)),
    "navigation_paths": (("page_view",), lambda t, o: P.navigation_paths(t["page_view"], by=DAY)),
    "anomalies": (("page_view", "click"), lambda t, o: A.anomalies(
        t["page_view"], t["click"], by=DAY, iqr_factor=o["iqr_factor"], exact=o["exact"],
        detected_at=o["loaded_at"])),
}


def read_batch(spark: SparkSession, raw_root: str, event_type: str, days: list[str]) -> DataFrame:
    """S1 over ``<raw_root>/event_date=D/event_type=T/``: the declared fields and the batch day.
    Both filters are on partition columns, so other folders are not listed."""
    raw = R.read_raw_json(spark, raw_root, event_type)
    return raw.where((F.col("event_type") == event_type) & F.col("event_date").cast("string")
                     .isin(days)).withColumnRenamed("event_date", DAY)


def run_days(spark: SparkSession, raw_root: str, out_root: str, dates: Iterable,
             as_of: Column | None = None, loaded_at: Column | None = None,
             min_visits: int = 5, iqr_factor: float = 3.0, exact: bool = False,
             types: Iterable = EVENT_TYPES, tables: Iterable = tuple(METRICS)) -> dict:
    """Run the batch for ``dates`` (of some event ``types`` and result ``tables``, which need
    their clean tables among the types or stored earlier) and return ``{"rows": {table: rows written}, "failures":
    {table: error}}``. Tables below ``out_root``: ``clean_<type>``, ``cube_page_view`` and
    ``metric_<table>`` by ``batch_date``, ``warehouse_<table>`` by ``event_date``."""
    days, rows, failures = sorted({str(d) for d in dates}), {}, {}
    options = {"min_visits": min_visits, "iqr_factor": iqr_factor, "exact": exact,
               "loaded_at": loaded_at}

    def store(name: str, make, partition_col: str, sort: Iterable[str] = ()) -> None:
        seen = Observation()
        try:
            df = make().observe(seen, F.count(F.lit(1)).alias("rows"))
            FS.write_days(df, out_root, name, partition_col, days=days, sort=sort)
            rows[name] = seen.get["rows"]
        except Exception as e:  # noqa: BLE001 - isolation is the feature
            failures[name] = f"{type(e).__name__}: {str(e)[:500]}"

    for et in types:
        store(f"clean_{et}", lambda et=et: C.clean_events(
            read_batch(spark, raw_root, et, days), et, as_of, keep=(DAY,)), DAY)

    tables = tuple(tables)
    if set(tables) & set(CUBE_TABLES) and "clean_page_view" not in failures:
        store("cube_page_view", lambda: M.page_view_cube(stored_days(
            spark, out_root, "clean_page_view", days, DAY), by=DAY), DAY, ("kind",))

    for table in tables:
        needs, make = METRICS[table]
        sources = [f"clean_{et}" for et in needs] + ["cube_page_view"] * (table in CUBE_TABLES)
        lost = [name for name in sources if name in failures]
        if lost:
            failures[f"metric_{table}"] = f"not computed: {lost[0]} failed"
            continue
        clean = {et: stored_days(spark, out_root, f"clean_{et}", days, DAY) for et in needs}
        if table in CUBE_TABLES:
            clean["cube"] = stored_days(spark, out_root, "cube_page_view", days, DAY)
        store(f"metric_{table}", lambda m=make, t=clean: m(t, options), DAY)
        if f"metric_{table}" in failures:
            continue
        store(f"warehouse_{table}", lambda t=table: W.load_table(
            stored_days(spark, out_root, f"metric_{t}", days, DAY)
            .withColumnRenamed(DAY, "event_date"), t, loaded_at), "event_date", W.LAYOUT.get(table, ()))
    return {"rows": rows, "failures": failures}


def merge_late_days(spark: SparkSession, out_root: str, table: str, delta: DataFrame) -> list[str]:
    """S7, late data: merge ``delta`` (shaped by :func:`clickforge.plans.warehouse.load_table`) into the
    stored result table and return its days, the only ones that are written again.

    The merged days are written to the scratch space first: the table is never read while it is
    overwritten, and a run that fails before the last step leaves it as it was. Running it again
    gives the same table."""
    stored = FS.read_days(spark, out_root, f"warehouse_{table}")
    merged = W.merged_days(stored, delta, table)
    path = scratch_path(spark, f"merge-{uuid.uuid4().hex}")
    merged.write.parquet(path)
    merged = spark.read.schema(merged.schema).parquet(path)
    days = sorted(str(r[0]) for r in merged.select("event_date").distinct().collect())
    FS.write_days(merged, out_root, f"warehouse_{table}", days=days, sort=W.LAYOUT.get(table, ()))
    return days


def stored_days(spark: SparkSession, root: str, name: str, days, col: str = "event_date"
                ) -> DataFrame:
    """S3 for a table partitioned by ``col``."""
    df = spark.read.parquet(FS.table_path(root, name))
    return df.where(F.col(col).isin([F.lit(d).cast("date") for d in days]))


def stored_tables(spark: SparkSession, root: str, tables: Iterable = tuple(METRICS)
                  ) -> dict[str, DataFrame]:
    """The stored result tables, for the serving queries (Q) and reports (D): their date filters
    are partition filters."""
    return {t: FS.read_days(spark, root, f"warehouse_{t}") for t in tables}
