"""Declared schemas of the five raw event types and of the clean tables.

Fixed values: these field lists, types, defaults and column sets must equal the
reference pipeline's for results to match.
"""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType)

S, I, D = StringType(), IntegerType(), DoubleType()


def _struct(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# ---- fixed values: raw batch schemas (field order as declared) -------------------------
RAW_SCHEMAS: dict[str, StructType] = {
    "page_view": _struct(
        ("event_type", S), ("user_id", S), ("session_id", S), ("page_url", S),
        ("page_type", S), ("timestamp", S), ("time_on_page_seconds", I),
        ("referrer", S), ("device_type", S), ("country", S)),
    "click": _struct(
        ("event_type", S), ("user_id", S), ("session_id", S), ("element_id", S),
        ("element_type", S), ("page_url", S), ("timestamp", S), ("x_position", I),
        ("y_position", I)),
    "search": _struct(
        ("event_type", S), ("user_id", S), ("session_id", S), ("query", S),
        ("results_count", I), ("timestamp", S)),
    "product_view": _struct(
        ("event_type", S), ("user_id", S), ("session_id", S), ("product_id", S),
        ("category", S), ("price", D), ("timestamp", S), ("time_on_page_seconds", I)),
    "cart_event": _struct(
        ("event_type", S), ("user_id", S), ("session_id", S), ("product_id", S),
        ("action", S), ("timestamp", S)),
}

EVENT_TYPES = tuple(RAW_SCHEMAS)

# ---- fixed values: cleaning -------------------------------------------------------------
# Columns whose null rows are dropped.
KEY_COLUMNS = ("user_id", "session_id", "timestamp")
# Null imputation defaults (applied only to columns present in the type).
IMPUTATION = {
    "referrer": "direct",
    "device_type": "unknown",
    "country": "XX",
    "page_type": "other",
    "category": "other",
    "price": 0.0,
    "time_on_page_seconds": 0,
    "results_count": 0,
    "x_position": 0,
    "y_position": 0,
}
# Timestamp format of raw events.
RAW_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
# Columns lower-cased and trimmed after imputation.
NORMALISED_COLUMNS = ("page_type", "device_type", "country", "category", "action")
