"""Raw JSONL files with injected faults, derived from ``events`` (validation fixture).

Every ``events`` row becomes one line of a day file ``raw/year=2024/month=01/day=DD/<type>
.jsonl``; the fault is chosen by ``r = event_id % 20``. Some ``signup`` rows land in
``purchase.jsonl`` (an unknown type), some rows are also copied under ``quarantine/`` (to
be skipped) and some add a blank line to ``notes.jsonl`` (a file with no record).

The line text is one SQL expression valid in Spark SQL and DuckDB, so both engines see
byte-identical input; each then validates with its own JSON functions.

Faults (r): 1 user_id missing; 2 session_id null; 3 bad enum; 4 out of range; 5 date-only
timestamp; 6 numeric timestamp; 7 bad enum + out of range; 8 number sent as a string;
9 boolean as a number; 10 float value; 11 fractional timestamp; 12 not JSON; 13 blank;
14 list as enum value; 15 Feb 30; 16 'Z' offset; 17 missing + bad enum; 18 numeric
user_id; 0 and 19 valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.sources import testdata as T


def _js(x: str) -> str:
    return f"'\"' || {x} || '\"'"


R = "(event_id % 20)"
NUM = "CAST(time_on_page_seconds AS STRING)"

TS = (f"CASE WHEN {R} = 5 THEN '\"' || substr(tss, 1, 10) || '\"' "
      f"WHEN {R} = 6 THEN '1705312200' "
      f"WHEN {R} = 11 THEN '\"' || substr(tss, 1, 19) || '.123+00:00\"' "
      f"WHEN {R} = 15 THEN '\"2024-02-30T10:00:00+00:00\"' "
      f"WHEN {R} = 16 THEN '\"' || substr(tss, 1, 19) || 'Z\"' "
      f"ELSE '\"' || tss || '\"' END")


def _num(base: str, bad: str) -> str:
    """A numeric field: out of range on 4/7, a string on 8, a boolean on 9, a float on 10."""
    return (f"CASE WHEN {R} IN (4, 7) THEN '{bad}' "
            f"WHEN {R} = 8 THEN {_js(base)} "
            f"WHEN {R} = 9 THEN 'true' "
            f"WHEN {R} = 10 THEN {base} || '.0' "
            f"ELSE {base} END")


def _enum(value: str, bad: str) -> str:
    return (f"CASE WHEN {R} IN (3, 7, 17) THEN '\"{bad}\"' "
            f"WHEN {R} = 14 THEN '[' || {_js(value)} || ']' "
            f"ELSE {_js(value)} END")


USER = (f"CASE WHEN {R} IN (1, 17) THEN NULL WHEN {R} = 18 THEN '5' "
        f"ELSE {_js('user_id')} END")
SESSION = f"CASE WHEN {R} = 2 THEN 'null' ELSE {_js('session_id')} END"
KVAL = "CAST(results_count AS STRING)"

FIELDS = {
    "page_view": [("user_id", USER), ("session_id", SESSION),
                  ("page_url", _js("page_url")), ("page_type", _enum("page_type", "blog")),
                  ("timestamp", TS), ("time_on_page_seconds", _num(NUM, "0")),
                  ("referrer", "'\"\"'"), ("device_type", _js("device_type")),
                  ("country", _js("country"))],
    "click": [("user_id", USER), ("session_id", SESSION),
              ("element_id", _js("'elem-' || CAST(event_id AS STRING)")),
              ("element_type", _enum("'button'", "blog")), ("page_url", _js("page_url")),
              ("timestamp", TS), ("x_position", _num(KVAL, "-1")),
              ("y_position", KVAL)],
    "search": [("user_id", USER), ("session_id", SESSION), ("query", _js("query")),
               ("results_count", _num(KVAL, "-1")), ("timestamp", TS)],
    "product_view": [("user_id", USER), ("session_id", SESSION),
                     ("product_id", _js("product_id")),
                     ("category", _enum("'books'", "blog")),
                     ("price", _num(KVAL, "0")), ("timestamp", TS),
                     ("time_on_page_seconds", _num(NUM, "0"))],
    "cart_event": [("user_id", USER), ("session_id", SESSION),
                   ("product_id", _js("product_id")),
                   ("action", f"CASE WHEN {R} = 8 THEN '5' ELSE {_enum('action', 'update')} END"),
                   ("timestamp", TS)],
}
SOURCE = {"view": "page_view", "click": "click", "signup": "search",
          "error": "product_view", "purchase": "cart_event"}


def _object(et: str) -> str:
    parts = ", ".join(f"CASE WHEN ({v}) IS NULL THEN NULL ELSE '\"{f}\": ' || ({v}) END"
                      for f, v in FIELDS[et])
    return f"'{{' || concat_ws(', ', {parts}) || '}}'"


def line_sql() -> str:
    """The line text of a source row (columns of the binding plus ``tss``)."""
    objs = " ".join(f"WHEN source_type = '{s}' THEN {_object(et)}" for s, et in SOURCE.items())
    return (f"CASE WHEN {R} = 12 THEN 'not json {{' WHEN {R} = 13 THEN '   ' "
            f"ELSE CASE {objs} END END")


def file_type_sql() -> str:
    cases = " ".join(f"WHEN '{s}' THEN '{et}'" for s, et in SOURCE.items())
    return (f"CASE WHEN source_type = 'signup' AND event_id % 7 = 0 THEN 'purchase' "
            f"ELSE CASE source_type {cases} END END")


# Rows of ``events`` that stand for one split of the fixture's files.
SPLIT_ROWS = 2_000

DAY_DIR = "'raw/year=2024/month=01/day=' || lpad(CAST(day(event_date) AS STRING), 2, '0')"


def fixture_selects() -> list[tuple[str, str, str]]:
    """(file_path, line, filter) SQL triples; their union is the fixture."""
    main = (f"{DAY_DIR} || '/' || ({file_type_sql()}) || '.jsonl'", line_sql(), "TRUE")
    quarantined = (f"'quarantine/' || {DAY_DIR} || '/' || ({file_type_sql()}) || '.jsonl'",
                   line_sql(), "event_id % 37 = 0")
    notes = (f"{DAY_DIR} || '/notes.jsonl'", "''", "event_id % 31 = 0")
    return [main, quarantined, notes]


def fixture_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_path, block_start, line_id, line`` of the fixture's files."""
    d = T.derive(T.table(spark, sf_dir, "events")).withColumn(
        "tss", F.concat(F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss"),
                        F.lit("+00:00")))
    parts = [d.filter(F.expr(flt)).select(F.expr(path).alias("file_path"),
                                          F.col("event_id").alias("line_id"),
                                          F.expr(line).alias("line"))
             for path, line, flt in fixture_selects()]
    lines = parts[0]
    for p in parts[1:]:
        lines = lines.unionByName(p)
    return lines.select("file_path", (F.floor(F.col("line_id") / SPLIT_ROWS) * SPLIT_ROWS)
                        .cast("long").alias("block_start"), "line_id", "line")


def with_sizes(lines: DataFrame) -> DataFrame:
    """Columns ``file_path, file_size, block_start, line_id, line`` (the shape of
    :func:`clickforge.sources.raw.read_lines` before parsing)."""
    sizes = lines.groupBy("file_path").agg(
        F.sum(F.length("line") + 1).cast("long").alias("file_size"))
    return lines.join(sizes, "file_path").select("file_path", "file_size", "block_start", "line_id", "line")


def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture with its files' sizes."""
    return with_sizes(fixture_text(spark, sf_dir))
