"""Clickstream views derived from the driver's ``events`` table.

The test tables carry a generic event stream ``events(event_id, ts, user_id, event_type,
value, props)``; these bindings map it onto the five clean clickstream tables with plain
column expressions (no row multiplication), so every query's work grows with ``events``.

Rule (shared with the SQL oracles in :mod:`clickforge.plans.oracle`):
  k = integer in ``props``; b = floor((day(ts) - 1) / 5)
  event_date = 2024-01-01 + 5*b days; user_id = 'usr-<id>'; session_id = 'sess-<id>-<b>'
  page_type = PAGE_TYPES[k % 7]; page_url = '/<page_type>/<k>'
  time_on_page_seconds = floor(value) + 1; device by id % 10; country = 'c<id % 8>'
  product_id = 'PROD-<k>'; category = 'cat<k % 8>'; price = k * 1.5
  action = remove when k % 3 = 0 else add
Views: page views = 'view', clicks = 'click', product views = 'error',
cart events = 'purchase', searches = 'signup'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Page types in their declared order (index = k % 7).
PAGE_TYPES = ["home", "category", "product", "cart", "checkout", "search", "other"]

VIEW_OF = {"page_view": "view", "click": "click", "product_view": "error",
           "cart_event": "purchase", "search": "signup"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.regexp_extract("props", r"([0-9]+)", 1).cast("int")


def _b() -> Column:
    return F.floor((F.dayofmonth("ts") - 1) / 5).cast("int")


def derive(events: DataFrame) -> DataFrame:
    """All clickstream columns for every ``events`` row (narrow projection)."""
    k, b = _k(), _b()
    uid = F.col("user_id").cast("string")
    page_type = F.element_at(F.array(*[F.lit(p) for p in PAGE_TYPES]), (k % 7) + 1)
    dev = F.col("user_id") % 10
    return events.select(
        "event_id",
        F.col("event_type").alias("source_type"),
        F.col("ts").alias("event_timestamp"),
        F.date_add(F.lit("2024-01-01").cast("date"), b * 5).alias("event_date"),
        F.concat(F.lit("usr-"), uid).alias("user_id"),
        F.concat(F.lit("sess-"), uid, F.lit("-"), b.cast("string")).alias("session_id"),
        page_type.alias("page_type"),
        F.concat(F.lit("/"), page_type, F.lit("/"), k.cast("string")).alias("page_url"),
        (F.floor("value") + 1).cast("int").alias("time_on_page_seconds"),
        F.when(dev < 5, "mobile").when(dev < 8, "desktop").otherwise("tablet")
         .alias("device_type"),
        F.concat(F.lit("c"), (F.col("user_id") % 8).cast("string")).alias("country"),
        F.concat(F.lit("PROD-"), k.cast("string")).alias("product_id"),
        F.concat(F.lit("cat"), (k % 8).cast("string")).alias("category"),
        (k * 1.5).cast("double").alias("price"),
        F.when(k % 3 == 0, "remove").otherwise("add").alias("action"),
        F.concat(F.lit("q"), k.cast("string")).alias("query"),
        k.alias("results_count"),
        F.col("value").alias("value"),
    )


_COLUMNS = {
    "page_view": ["event_id", "user_id", "session_id", "page_url", "page_type",
                  "time_on_page_seconds", "device_type", "country",
                  "event_timestamp", "event_date"],
    "click": ["event_id", "user_id", "session_id", "page_url", "event_timestamp",
              "event_date"],
    "product_view": ["event_id", "user_id", "session_id", "product_id", "category",
                     "price", "time_on_page_seconds", "event_timestamp", "event_date"],
    "cart_event": ["event_id", "user_id", "session_id", "product_id", "action",
                   "event_timestamp", "event_date"],
    "search": ["event_id", "user_id", "session_id", "query", "results_count",
               "event_timestamp", "event_date"],
}


def view(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    """Clean-table-shaped view of one clickstream type over ``events``.

    The filter on ``event_type`` reaches the Parquet scan as a pushed filter.
    """
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == VIEW_OF[event_type])
    return derive(ev).select(*_COLUMNS[event_type])


def page_views(spark, sf_dir):
    return view(spark, sf_dir, "page_view")


def clicks(spark, sf_dir):
    return view(spark, sf_dir, "click")


def product_views(spark, sf_dir):
    return view(spark, sf_dir, "product_view")


def cart_events(spark, sf_dir):
    return view(spark, sf_dir, "cart_event")


def searches(spark, sf_dir):
    return view(spark, sf_dir, "search")


# ---- raw JSONL fixture derived from ``events`` ------------------------------------------
# Element types in their declared order (index = k % 7).
ELEMENT_TYPES = ["button", "link", "image", "product_card", "menu", "banner",
                 "search_result"]

FILE_TYPE_OF = {v: k for k, v in VIEW_OF.items()}


def _raw_fields(d: DataFrame) -> dict[str, Column]:
    """Raw field expressions with faults injected by residue class (cleaning fixture):
    user null when id % 17 = 0, else date-only timestamp when id % 19 = 0, else year 2099
    when id % 23 = 0; page type / category null when k % 5 = 0; dwell / positions /
    results null when k % 3 = 0; enum-like strings padded and upper-cased on even ids."""
    i = F.col("event_id")
    k = F.col("results_count")
    ts = F.concat(F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    ts = (F.when(i % 17 == 0, ts).when(i % 19 == 0, F.substring(ts, 1, 10))
           .when(i % 23 == 0, F.concat(F.lit("2099"), F.substring(ts, 5, 100)))
           .otherwise(ts))
    even = i % 2 == 0

    def messy(c):
        return F.when(even, F.concat(F.lit(" "), F.upper(c))).otherwise(c)

    n5, n3 = k % 5 == 0, k % 3 == 0
    elem = F.element_at(F.array(*[F.lit(e) for e in ELEMENT_TYPES]), (k % 7) + 1)
    return {
        "user_id": F.when(i % 17 != 0, F.col("user_id")),
        "session_id": F.col("session_id"),
        "page_url": F.col("page_url"),
        "page_type": F.when(~n5, messy(F.col("page_type"))),
        "timestamp": ts,
        "time_on_page_seconds": F.when(~n3, F.col("time_on_page_seconds")),
        "referrer": F.when(k % 4 != 0, F.lit("")),
        "device_type": messy(F.col("device_type")),
        "country": F.upper("country"),
        "element_id": F.concat(F.lit("elem-"), i.cast("string")),
        "element_type": elem,
        "x_position": F.when(~n3, k * 10),
        "y_position": F.when(~n3, k * 5),
        "query": F.col("query"),
        "results_count": F.when(~n3, k),
        "product_id": F.col("product_id"),
        "category": F.when(~n5, messy(F.col("category"))),
        "price": F.when(~n5, F.col("price")),
        "action": messy(F.col("action")),
    }


def raw_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning fixture: one raw JSON line per ``events`` row, typed by its source type,
    with rows where ``event_id % 10 = 0`` appended a second time (exact duplicates).

    Columns: ``event_type`` (file type), ``event_date`` (batch date), ``line``.
    """
    from clickforge.schemas import RAW_SCHEMAS
    d = derive(table(spark, sf_dir, "events"))
    fields = _raw_fields(d)
    src = F.col("source_type")
    etype, line = F, F
    for s, et in FILE_TYPE_OF.items():
        names = [f.name for f in RAW_SCHEMAS[et].fields]
        obj = F.struct(*[(F.lit(et) if n == "event_type" else fields[n]).alias(n)
                         for n in names])
        etype = etype.when(src == s, F.lit(et))
        line = line.when(src == s, F.to_json(obj))
    # one pass: each row's text is built once; rows to duplicate are emitted twice
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))) \
              .otherwise(F.array(F.lit(0)))
    return d.filter(src.isin(list(FILE_TYPE_OF))).select(
        etype.alias("event_type"), "event_date", line.alias("line"),
        F.explode(copies).alias("_copy")).drop("_copy")
