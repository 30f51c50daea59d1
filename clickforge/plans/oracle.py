"""DuckDB SQL oracles: the same binding and semantics written as plain SQL.

Used by ``__spark_entry__.oracle_sql`` and the tests. Each entry is a full statement over
the driver's pre-registered tables (only ``events`` is read).
"""

from __future__ import annotations

# Binding of clickstream columns onto ``events`` (mirrors clickforge.sources.testdata).
BINDING = """
ev0 AS (
  SELECT event_id, event_type AS source_type, ts AS event_timestamp, value,
         user_id AS uid,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CAST(floor((day(ts) - 1) / 5) AS INTEGER) AS b
  FROM events),
ev1 AS (
  SELECT *,
    CASE k % 7 WHEN 0 THEN 'home' WHEN 1 THEN 'category' WHEN 2 THEN 'product'
               WHEN 3 THEN 'cart' WHEN 4 THEN 'checkout' WHEN 5 THEN 'search'
               ELSE 'other' END AS page_type
  FROM ev0),
d AS (
  SELECT event_id, source_type, event_timestamp, value,
    DATE '2024-01-01' + 5 * b AS event_date,
    'usr-' || CAST(uid AS VARCHAR) AS user_id,
    'sess-' || CAST(uid AS VARCHAR) || '-' || CAST(b AS VARCHAR) AS session_id,
    page_type,
    '/' || page_type || '/' || CAST(k AS VARCHAR) AS page_url,
    CAST(floor(value) + 1 AS INTEGER) AS time_on_page_seconds,
    CASE WHEN uid % 10 < 5 THEN 'mobile' WHEN uid % 10 < 8 THEN 'desktop'
         ELSE 'tablet' END AS device_type,
    'c' || CAST(uid % 8 AS VARCHAR) AS country,
    'PROD-' || CAST(k AS VARCHAR) AS product_id,
    'cat' || CAST(k % 8 AS VARCHAR) AS category,
    CAST(k * 1.5 AS DOUBLE) AS price,
    CASE WHEN k % 3 = 0 THEN 'remove' ELSE 'add' END AS action,
    'q' || CAST(k AS VARCHAR) AS query,
    k AS results_count
  FROM ev1),
pv AS (SELECT * FROM d WHERE source_type = 'view'),
clk AS (SELECT * FROM d WHERE source_type = 'click'),
prd AS (SELECT * FROM d WHERE source_type = 'error'),
crt AS (SELECT * FROM d WHERE source_type = 'purchase'),
srch AS (SELECT * FROM d WHERE source_type = 'signup')"""


def _with(*ctes: str, select: str) -> str:
    parts = [BINDING.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


# ---- page metrics ------------------------------------------------------------------------
def top_pages_sql(min_visits: int, top_n: int, per_date: bool) -> tuple[str, str]:
    k = "event_date, " if per_date else ""
    cte = f"""tp AS (
  SELECT {k}page_url, page_type, avg(time_on_page_seconds) AS avg_time_seconds,
         count(*) AS total_visits
  FROM pv GROUP BY {k}page_url, page_type HAVING count(*) >= {min_visits}),
tpr AS (
  SELECT *, row_number() OVER ({'PARTITION BY event_date ' if per_date else ''}
         ORDER BY avg_time_seconds DESC, page_url, page_type) AS rn FROM tp)"""
    sel = f"SELECT {k}page_url, page_type, avg_time_seconds, total_visits FROM tpr " \
          f"WHERE rn <= {top_n}"
    return cte, sel


BOUNCE = """br AS (
  SELECT event_date, page_type, count(*) AS total_sessions,
         count(*) FILTER (WHERE n = 1) AS bounce_sessions,
         round(count(*) FILTER (WHERE n = 1) / count(*) * 100, 2) AS bounce_rate_pct
  FROM (SELECT event_date, session_id, page_type, count(*) AS n FROM pv
        GROUP BY event_date, session_id, page_type)
  GROUP BY event_date, page_type)"""

DEVICE = """tdc AS (
  SELECT event_date, device_type, country, avg(time_on_page_seconds) AS avg_time_seconds,
         count(session_id) AS total_sessions, count(DISTINCT user_id) AS unique_users
  FROM pv GROUP BY event_date, device_type, country HAVING count(session_id) >= 3)"""

# ---- funnel ---------------------------------------------------------------------------------
STAGE_USERS = """fu AS (
  SELECT event_date,
    count(DISTINCT user_id) FILTER (WHERE s = 1) AS page_view_users,
    count(DISTINCT user_id) FILTER (WHERE s = 2) AS product_view_users,
    count(DISTINCT user_id) FILTER (WHERE s = 3) AS cart_add_users,
    count(DISTINCT user_id) FILTER (WHERE s = 4) AS checkout_users
  FROM (SELECT event_date, user_id, 1 AS s FROM pv
        UNION ALL SELECT event_date, user_id, 4 FROM pv WHERE page_type = 'checkout'
        UNION ALL SELECT event_date, user_id, 2 FROM prd
        UNION ALL SELECT event_date, user_id, 3 FROM crt WHERE action = 'add')
  GROUP BY event_date)"""

FUNNEL = STAGE_USERS + """,
cf AS (
  SELECT event_date, funnel_stage, users,
    CASE WHEN funnel_stage = '1_page_view' THEN 100.0
         WHEN page_view_users > 0 THEN round(users / page_view_users * 100, 2)
         ELSE 0.0 END AS conversion_rate_pct
  FROM (SELECT event_date, page_view_users, '1_page_view' AS funnel_stage,
               page_view_users AS users FROM fu
        UNION ALL SELECT event_date, page_view_users, '2_product_view',
               product_view_users FROM fu
        UNION ALL SELECT event_date, page_view_users, '3_cart_add', cart_add_users FROM fu
        UNION ALL SELECT event_date, page_view_users, '4_checkout', checkout_users FROM fu))"""


def product_conv_sql(per_date: bool) -> str:
    k = "event_date, " if per_date else ""
    on = "v.event_date = a.event_date AND " if per_date else ""
    sel = "v.event_date, " if per_date else ""
    return f"""pvc AS (
  SELECT {sel}v.product_id, v.category, v.price, v.total_views,
         coalesce(a.cart_adds, 0) AS cart_adds,
         round(coalesce(a.cart_adds, 0) / v.total_views * 100, 2) AS view_to_cart_rate,
         v.total_views >= 10
           AND round(coalesce(a.cart_adds, 0) / v.total_views * 100, 2) < 5.0
           AS is_low_conversion
  FROM (SELECT {k}product_id, category, price, count(*) AS total_views FROM prd
        GROUP BY {k}product_id, category, price) v
  LEFT JOIN (SELECT {k}product_id, count(*) AS cart_adds FROM crt WHERE action = 'add'
             GROUP BY {k}product_id) a
  ON {on}v.product_id = a.product_id)"""


# ---- navigation paths -----------------------------------------------------------------------
PATHS = """sp AS (
  SELECT event_date, session_id,
         string_agg(page_type, ' -> ' ORDER BY rn) AS path_string
  FROM (SELECT event_date, session_id, page_type,
               row_number() OVER (PARTITION BY event_date, session_id
                                  ORDER BY event_timestamp, page_type) AS rn,
               count(*) OVER (PARTITION BY event_date, session_id) AS n
        FROM pv)
  WHERE rn <= 6 AND n >= 2
  GROUP BY event_date, session_id),
np AS (
  SELECT event_date, navigation_path, session_count FROM (
    SELECT event_date, path_string AS navigation_path, count(*) AS session_count,
           row_number() OVER (PARTITION BY event_date
                              ORDER BY count(*) DESC, path_string) AS rn
    FROM sp GROUP BY event_date, path_string)
  WHERE rn <= 10)"""

# ---- anomalies ------------------------------------------------------------------------------
DWELL = """zs AS (
  SELECT event_date, avg(time_on_page_seconds) AS m, stddev_samp(time_on_page_seconds) AS s,
         count(time_on_page_seconds) AS c
  FROM pv GROUP BY event_date),
za AS (
  SELECT p.*, abs((p.time_on_page_seconds - zs.m) / zs.s) AS z
  FROM pv p JOIN zs USING (event_date)
  WHERE zs.s IS NOT NULL AND zs.s <> 0 AND zs.c >= 10
    AND abs((p.time_on_page_seconds - zs.m) / zs.s) > 3.0)"""


def iqr_cte(name: str, src: str, col: str, factor: float) -> str:
    return f"""{name}_q AS (
  SELECT event_date, count(*) AS c,
         CAST(quantile_disc({col}, 0.25) AS DOUBLE) AS q1,
         CAST(quantile_disc({col}, 0.75) AS DOUBLE) AS q3
  FROM {src} GROUP BY event_date),
{name} AS (
  SELECT t.*, abs((t.{col} - (q.q1 + q.q3) / 2) / ((q.q3 - q.q1) / 2)) AS z
  FROM {src} t JOIN {name}_q q USING (event_date)
  WHERE q.c >= 10 AND q.q3 - q.q1 <> 0
    AND (t.{col} < q.q1 - {factor} * (q.q3 - q.q1) OR t.{col} > q.q3 + {factor} * (q.q3 - q.q1)))"""


CLICKS = """cps AS (
  SELECT event_date, session_id, user_id, count(*) AS click_count FROM clk
  GROUP BY event_date, session_id, user_id)"""

ANOMALIES = DWELL + ",\n" + CLICKS + ",\n" + iqr_cte("ca", "cps", "click_count", 1.0) + """,
au AS (
  SELECT event_date, session_id, user_id, page_url, page_type, z AS z_score,
         'zscore_time_on_page_seconds' AS anomaly_type,
         'time_on_page_seconds' AS anomaly_field,
         CAST(time_on_page_seconds AS DOUBLE) AS anomaly_value FROM za
  UNION ALL
  SELECT event_date, session_id, user_id, NULL, NULL, z, 'iqr_click_count', 'click_count',
         CAST(click_count AS DOUBLE) FROM ca),
an AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_date, session_id, anomaly_type
                                 ORDER BY z_score DESC, page_url, page_type, user_id) AS rn
    FROM au) WHERE rn = 1)"""


def queries() -> dict[str, str]:
    m1d_cte, m1d_sel = top_pages_sql(2, 20, True)
    m1a_cte, m1a_sel = top_pages_sql(5, 20, False)
    return {
        "top_pages_by_time": _with(m1d_cte, select=m1d_sel),
        "top_pages_by_time_all_days": _with(m1a_cte, select=m1a_sel),
        "bounce_rate": _with(BOUNCE, select="SELECT * FROM br"),
        "time_by_device_country": _with(DEVICE, select="SELECT * FROM tdc"),
        "funnel_stage_users": _with(STAGE_USERS, select="SELECT * FROM fu"),
        "conversion_funnel": _with(FUNNEL, select="SELECT * FROM cf"),
        "product_view_vs_cart": _with(product_conv_sql(True), select="SELECT * FROM pvc"),
        "product_view_vs_cart_all_days": _with(product_conv_sql(False),
                                               select="SELECT * FROM pvc"),
        "low_conversion_products": _with(product_conv_sql(False),
                                         select="SELECT * FROM pvc WHERE is_low_conversion"),
        "session_path_strings": _with(PATHS, select="SELECT * FROM sp"),
        "navigation_paths": _with(PATHS, select="SELECT * FROM np"),
        "zscore_anomalies": _with(DWELL, select="""
SELECT event_date, event_id, session_id, time_on_page_seconds, round(z, 6) AS z_score,
       'zscore_time_on_page_seconds' AS anomaly_type,
       'time_on_page_seconds' AS anomaly_field,
       CAST(time_on_page_seconds AS DOUBLE) AS anomaly_value FROM za"""),
        "iqr_anomalies": _with(iqr_cte("va", "d", "value", 3.0), select="""
SELECT event_date, event_id, value, round(z, 6) AS z_score, 'iqr_value' AS anomaly_type,
       'value' AS anomaly_field, value AS anomaly_value FROM va"""),
        "iqr_anomalies_sketch": _with(iqr_cte("va", "d", "value", 1.0), select="""
SELECT event_date, event_id, value, round(z, 6) AS z_score, 'iqr_value' AS anomaly_type,
       'value' AS anomaly_field, value AS anomaly_value FROM va"""),
        "stored_unique_users": _with(select="""
SELECT device_type, country, count(DISTINCT user_id) AS unique_users FROM pv GROUP BY device_type, country"""),
        "iqr_trailing_days": _with("""base AS (
  SELECT days.event_date, count(value) AS n, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
  FROM (SELECT DISTINCT event_date FROM d WHERE value IS NOT NULL) days
  JOIN d ON d.event_date BETWEEN days.event_date - 6 AND days.event_date
  GROUP BY days.event_date)""", select="""
SELECT event_date, event_id, value, round(abs((value - (q1 + q3) / 2) / ((q3 - q1) / 2)), 6) AS z_score,
       'iqr_value' AS anomaly_type, 'value' AS anomaly_field, value AS anomaly_value
FROM d JOIN base USING (event_date)
WHERE n >= 10 AND q3 <> q1 AND (value < q1 - (q3 - q1) OR value > q3 + (q3 - q1))"""),
        "click_count_anomalies": _with(CLICKS, iqr_cte("ca", "cps", "click_count", 1.0),
                                       select="""
SELECT event_date, session_id, user_id, click_count, round(z, 6) AS z_score,
       'iqr_click_count' AS anomaly_type, 'click_count' AS anomaly_field,
       CAST(click_count AS DOUBLE) AS anomaly_value FROM ca"""),
        "dwell_time_anomalies": _with(DWELL, select="""
SELECT event_date, session_id, user_id, page_url, page_type, round(z, 6) AS z_score,
       'zscore_time_on_page_seconds' AS anomaly_type,
       'time_on_page_seconds' AS anomaly_field,
       CAST(time_on_page_seconds AS DOUBLE) AS anomaly_value FROM za"""),
        "anomalies": _with(ANOMALIES, select="""
SELECT event_date, session_id, user_id, page_url, page_type, round(z_score, 6) AS z_score,
       anomaly_type, anomaly_field, anomaly_value FROM an"""),
        "anomaly_type_counts": _with(ANOMALIES, select="""
SELECT event_date, anomaly_type, count(*) AS anomaly_count FROM an
GROUP BY event_date, anomaly_type"""),
        **clean_queries(),
        **validation_queries(),
        **warehouse_queries(),
    }


# ---- cleaning ---------------------------------------------------------------------------------
# Raw field expressions of the cleaning fixture (mirrors testdata._raw_fields).
RAW_FIELD_SQL = {
    "user_id": "CASE WHEN event_id % 17 <> 0 THEN user_id END",
    "session_id": "session_id",
    "page_url": "page_url",
    "page_type": "CASE WHEN results_count % 5 <> 0 THEN (CASE WHEN event_id % 2 = 0 "
                 "THEN ' ' || upper(page_type) ELSE page_type END) END",
    "timestamp": "CASE WHEN event_id % 17 = 0 THEN tss WHEN event_id % 19 = 0 "
                 "THEN substr(tss, 1, 10) WHEN event_id % 23 = 0 THEN '2099' || substr(tss, 5) "
                 "ELSE tss END",
    "time_on_page_seconds": "CASE WHEN results_count % 3 <> 0 THEN time_on_page_seconds END",
    "referrer": "CASE WHEN results_count % 4 <> 0 THEN '' END",
    "device_type": "CASE WHEN event_id % 2 = 0 THEN ' ' || upper(device_type) "
                   "ELSE device_type END",
    "country": "upper(country)",
    "element_id": "'elem-' || CAST(event_id AS VARCHAR)",
    "element_type": "CASE results_count % 7 WHEN 0 THEN 'button' WHEN 1 THEN 'link' "
                    "WHEN 2 THEN 'image' WHEN 3 THEN 'product_card' WHEN 4 THEN 'menu' "
                    "WHEN 5 THEN 'banner' ELSE 'search_result' END",
    "x_position": "CASE WHEN results_count % 3 <> 0 THEN results_count * 10 END",
    "y_position": "CASE WHEN results_count % 3 <> 0 THEN results_count * 5 END",
    "query": "query",
    "results_count": "CASE WHEN results_count % 3 <> 0 THEN results_count END",
    "product_id": "product_id",
    "category": "CASE WHEN results_count % 5 <> 0 THEN (CASE WHEN event_id % 2 = 0 "
                "THEN ' ' || upper(category) ELSE category END) END",
    "price": "CASE WHEN results_count % 5 <> 0 THEN price END",
    "action": "CASE WHEN event_id % 2 = 0 THEN ' ' || upper(action) ELSE action END",
}

RAW_TYPE_FIELDS = {
    "page_view": ["user_id", "session_id", "page_url", "page_type", "timestamp",
                  "time_on_page_seconds", "referrer", "device_type", "country"],
    "click": ["user_id", "session_id", "element_id", "element_type", "page_url",
              "timestamp", "x_position", "y_position"],
    "search": ["user_id", "session_id", "query", "results_count", "timestamp"],
    "product_view": ["user_id", "session_id", "product_id", "category", "price",
                     "timestamp", "time_on_page_seconds"],
    "cart_event": ["user_id", "session_id", "product_id", "action", "timestamp"],
}
SOURCE_OF = {"page_view": "view", "click": "click", "product_view": "error",
             "cart_event": "purchase", "search": "signup"}
DEFAULTS = {"referrer": "'direct'", "device_type": "'unknown'", "country": "'XX'",
            "page_type": "'other'", "category": "'other'", "price": "0.0",
            "time_on_page_seconds": "0", "results_count": "0", "x_position": "0",
            "y_position": "0"}
LOWERED = ("page_type", "device_type", "country", "category", "action")
RAWSRC = """rawsrc AS (
  SELECT *, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS tss FROM d)"""


def raw_cte(et: str, batch: bool = False) -> str:
    cols = ", ".join(f"{RAW_FIELD_SQL[f]} AS {f}" for f in RAW_TYPE_FIELDS[et])
    cols = f"event_date AS batch_date, {cols}" if batch else cols
    src = SOURCE_OF[et]
    body = f"SELECT '{et}' AS event_type, {cols} FROM rawsrc WHERE source_type = '{src}'"
    return f"raw_{et} AS ({body}\n  UNION ALL {body} AND event_id % 10 = 0)"


def clean_cte(et: str, as_of: str = "TIMESTAMP '2026-01-01 00:00:00'",
              batch: bool = False) -> str:
    f = RAW_TYPE_FIELDS[et]
    filled = ", ".join(
        (f"lower(trim(coalesce({c}, {DEFAULTS[c]})))" if c in LOWERED and c in DEFAULTS
         else f"lower(trim({c}))" if c in LOWERED
         else f"coalesce({c}, {DEFAULTS[c]})" if c in DEFAULTS else c) + f" AS {c}"
        for c in f if c != "timestamp")
    return f"""clean_{et} AS (
  SELECT * FROM (
    SELECT event_type, {"batch_date, " if batch else ""}{filled},
           CAST(try_strptime(timestamp, '%Y-%m-%dT%H:%M:%S%z') AS TIMESTAMP) AS event_timestamp
    FROM (SELECT DISTINCT * FROM raw_{et})
    WHERE user_id IS NOT NULL AND session_id IS NOT NULL AND timestamp IS NOT NULL)
  WHERE event_timestamp IS NOT NULL AND event_timestamp <= {as_of})"""


def clean_queries() -> dict[str, str]:
    out = {}
    for et, fields in RAW_TYPE_FIELDS.items():
        cols = ", ".join(c for c in fields if c != "timestamp")
        last = """strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
       CAST(event_timestamp AS DATE) AS event_date"""
        out["clean_events" if et == "page_view" else f"clean_{et}"] = _with(
            RAWSRC, raw_cte(et), clean_cte(et),
            select=f"SELECT event_type, {cols}, {last} FROM clean_{et}")
        out[f"ingested_clean_{et}"] = _with(
            RAWSRC, raw_cte(et, batch=True), clean_cte(et, batch=True), select=f"""
SELECT event_type, CAST(batch_date AS VARCHAR) AS batch_date, {cols}, {last} FROM clean_{et}""")
    ctes = [RAWSRC] + [raw_cte(e) for e in RAW_TYPE_FIELDS] + \
           [clean_cte(e) for e in RAW_TYPE_FIELDS]
    counts = " UNION ALL ".join(
        f"SELECT '{e}' AS event_type, (SELECT count(*) FROM raw_{e}) AS raw_rows, "
        f"(SELECT count(*) FROM clean_{e}) AS clean_rows" for e in RAW_TYPE_FIELDS)
    out["clean_row_counts"] = _with(*ctes, select=counts)
    return out


def _stored(*ctes: str, select: str) -> str:
    """As :func:`_with`, with the views made from the cleaned raw lines of each batch day."""
    views = {"pv": "page_view", "clk": "click", "prd": "product_view", "crt": "cart_event"}
    parts = [BINDING.strip()[:BINDING.strip().index("pv AS (")].rstrip().rstrip(","), RAWSRC]
    for et in RAW_TYPE_FIELDS:
        parts += [raw_cte(et, batch=True), clean_cte(et, batch=True)]
    parts += [f"{v} AS (SELECT * RENAME (batch_date AS event_date) FROM clean_{et})"
              for v, et in views.items()]
    return "WITH " + ",\n".join([*parts, *(c.strip() for c in ctes)]) + "\n" + select.strip()


# ---- ingest validation --------------------------------------------------------------------
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _jt(f: str) -> str:
    return f"json_type(j, '$.{f}')"


def _pt(f: str) -> str:
    return (f"(CASE {_jt(f)} WHEN 'VARCHAR' THEN 'str' WHEN 'BIGINT' THEN 'int' "
            f"WHEN 'UBIGINT' THEN 'int' WHEN 'DOUBLE' THEN 'float' WHEN 'BOOLEAN' THEN 'bool' "
            f"WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict' WHEN 'NULL' THEN 'NoneType' "
            f"END)")


def _txt(f: str) -> str:
    return (f"(CASE WHEN {_pt(f)} = 'bool' THEN (CASE WHEN json_extract_string(j, '$.{f}') = "
            f"'true' THEN 'True' ELSE 'False' END) WHEN {_pt(f)} IN ('str', 'int', 'float') "
            f"THEN json_extract_string(j, '$.{f}') ELSE CAST(json_extract(j, '$.{f}') AS VARCHAR) "
            f"END)")


KIND_OK = {"str": "= 'str'", "num": "IN ('int', 'float', 'bool')", "int": "= 'int'"}
EXPECTED = {"str": "str", "num": "int o float", "int": "int"}
ISO_RE = (r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}T\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}"
          r"(\.\p{Nd}+)?(Z|[+-]\p{Nd}{2}:\p{Nd}{2})$")


# Fixed values of both rule profiles, written out apart from the library's rule table:
# (field, required, kind, allowed values, range); kind and range as (ingest, contract) where
# the profiles differ. A kind of None: the profile does not check the field.
PAGE_TYPES = ["home", "category", "product", "cart", "checkout", "search", "other"]
DWELL_RANGE = ((1, 7200), (1, 3600))
WHO = [("user_id", True, "str", None, None), ("session_id", True, "str", None, None)]
STAMP = ("timestamp", True, "str", None, None)
DWELL_FIELD = ("time_on_page_seconds", True, ("num", "int"), None, DWELL_RANGE)
RULES = {
    "page_view": [
        *WHO, ("page_url", True, "str", None, None), ("page_type", True, "str", PAGE_TYPES, None),
        STAMP, DWELL_FIELD,
        ("device_type", True, "str", ["mobile", "desktop", "tablet"], None),
        ("country", True, "str", None, None), ("referrer", False, (None, "str"), None, None)],
    "click": [
        *WHO, ("element_id", True, "str", None, None),
        ("element_type", True, "str", ["button", "link", "image", "product_card", "menu",
                                       "banner", "search_result"], None),
        ("page_url", True, "str", None, None), STAMP,
        ("x_position", True, ("num", "int"), None, ((0, 7680), (0, 3840))),
        ("y_position", True, ("num", "int"), None, ((0, 4320), (0, 2160)))],
    "search": [
        *WHO, ("query", True, "str", None, None),
        ("results_count", True, ("num", "int"), None, ((0, 1000000), (0, 10000))), STAMP],
    "product_view": [
        *WHO, ("product_id", True, "str", None, None),
        ("category", True, "str", ["electronics", "clothing", "home", "sports", "books", "beauty",
                                   "toys", "food"], None),
        ("price", True, "num", None, ((0.01, 1000000), (0.01, 100000))), STAMP, DWELL_FIELD],
    "cart_event": [
        *WHO, ("product_id", True, "str", None, None),
        ("action", True, "str", ["add", "remove"], None), STAMP],
}


def _profile(profile: str) -> dict:
    at = ("ingest", "contract").index(profile)
    out = {}
    for et, fields in RULES.items():
        kinds = {f: k if isinstance(k, str) else k[at] for f, _, k, _, _ in fields}
        out[et] = {"required": [f for f, need, *_ in fields if need],
                   "types": {f: k for f, k in kinds.items() if k},
                   "enums": {f: v for f, _, _, v, _ in fields if v},
                   "ranges": {f: r[at] for f, *_, r in fields if r}}
    return out


def validation_ctes(profile: str = "ingest") -> list[str]:
    from clickforge.sources.ingest_fixture import fixture_selects
    rules = _profile(profile)
    fx = " UNION ALL ".join(
        f"SELECT {p} AS file_path, event_id AS line_id, {ln} AS line FROM rawsrc WHERE {flt}"
        for p, ln, flt in fixture_selects())
    who = ("(CASE WHEN json_type(j, '$.user_id') IS NULL THEN 'unknown' "
           "WHEN json_type(j, '$.user_id') = 'NULL' THEN NULL ELSE " + _txt("user_id") +
           " END) AS user_id, (CASE WHEN json_type(j, '$.session_id') IS NULL THEN 'unknown' "
           "WHEN json_type(j, '$.session_id') = 'NULL' THEN NULL ELSE " + _txt("session_id") +
           " END) AS session_id")
    head = f"SELECT file_path, event_type, line_id, record_index, {who}"
    req, oth = [], []
    for et, spec in rules.items():
        for f in spec["required"]:
            req.append(f"{head}, 'missing_field' AS error_code, '{f}' AS field, "
                       f"{_q(f'Campo obligatorio faltante: {chr(39)}{f}{chr(39)}')} AS reason "
                       f"FROM recs WHERE event_type = '{et}' AND {_jt(f)} IS NULL")
            req.append(f"{head}, 'null_field', '{f}', "
                       f"{_q(f'Campo obligatorio es null: {chr(39)}{f}{chr(39)}')} "
                       f"FROM recs WHERE event_type = '{et}' AND {_jt(f)} = 'NULL'")
        for f, kind in spec["types"].items():
            oth.append(f"{head}, 'wrong_type', '{f}', "
                       f"'''{f}'' debe ser {EXPECTED[kind]}, recibido ' || {_pt(f)} "
                       f"FROM okrecs WHERE event_type = '{et}' AND {_jt(f)} IS NOT NULL "
                       f"AND NOT coalesce({_pt(f)} {KIND_OK[kind]}, FALSE)")
        for f, vals in spec["enums"].items():
            inl = ", ".join(_q(v) for v in vals)
            oth.append(f"{head}, 'invalid_enum', '{f}', "
                       f"'''{f}'' valor invalido: ''' || {_txt(f)} || '''' "
                       f"FROM okrecs WHERE event_type = '{et}' AND {_jt(f)} IS NOT NULL AND NOT "
                       f"({_pt(f)} = 'str' AND json_extract_string(j, '$.{f}') IN ({inl}))")
        for f, (lo, hi) in spec["ranges"].items():
            x = (f"(CASE WHEN {_pt(f)} = 'bool' THEN (CASE WHEN json_extract_string(j, '$.{f}')"
                 f" = 'true' THEN 1.0 ELSE 0.0 END) ELSE CAST(json_extract(j, '$.{f}') AS DOUBLE)"
                 f" END)")
            oth.append(f"{head}, 'out_of_range', '{f}', "
                       f"'''{f}'' fuera de rango [{lo}, {hi}]: ' || {_txt(f)} "
                       f"FROM okrecs WHERE event_type = '{et}' AND {_jt(f)} IS NOT NULL AND "
                       f"{_pt(f)} IN ('int', 'float', 'bool') AND NOT ({x} BETWEEN {lo} AND {hi})")
        oth.append(f"{head}, 'timestamp_type', 'timestamp', "
                   f"'timestamp debe ser string, recibido ' || {_pt('timestamp')} "
                   f"FROM okrecs WHERE event_type = '{et}' AND {_jt('timestamp')} IS NOT NULL "
                   f"AND {_pt('timestamp')} <> 'str'")
        oth.append(f"{head}, 'timestamp_format', 'timestamp', "
                   f"'timestamp no tiene formato ISO8601: ''' || "
                   f"json_extract_string(j, '$.timestamp') || '''' "
                   f"FROM okrecs WHERE event_type = '{et}' AND {_pt('timestamp')} = 'str' "
                   f"AND NOT regexp_matches(json_extract_string(j, '$.timestamp'), {_q(ISO_RE)})")
    # the place of a check in its record: required fields, types, enums, ranges, timestamp
    names = "(file_path, event_type, line_id, record_index, user_id, session_id, error_code, " \
            "field, reason)"
    req, oth = ([f"SELECT *, {i} AS pos FROM ({x}) t{names}" for i, x in enumerate(sel)]
                for sel in (req, oth))
    known = ", ".join(_q(e) for e in rules)
    unk = (f"{head}, 'unknown_event_type', NULL, "
           f"'Tipo de evento desconocido: ''' || event_type || '''', 0 "
           f"FROM recs WHERE event_type NOT IN ({known})")
    return [
        RAWSRC,
        f"fx AS ({fx})",
        "fxs AS (SELECT file_path, sum(length(line) + 1) AS file_size FROM fx GROUP BY file_path)",
        "lines AS (SELECT fx.*, fxs.file_size, regexp_replace(regexp_extract(fx.file_path, "
        "'([^/]*)$', 1), '\\.jsonl', '') AS event_type FROM fx JOIN fxs USING (file_path) "
        "WHERE NOT starts_with(fx.file_path, 'quarantine/'))",
        "recs AS (SELECT file_path, event_type, line_id, trim(line) AS j, row_number() OVER "
        "(PARTITION BY file_path ORDER BY line_id) - 1 AS record_index FROM lines "
        "WHERE trim(line) <> '' AND json_valid(trim(line)))",
        "req AS (" + " UNION ALL ".join(req) + ")",
        "okrecs AS (SELECT * FROM recs r WHERE NOT EXISTS (SELECT 1 FROM req q "
        "WHERE q.file_path = r.file_path AND q.line_id = r.line_id))",
        "errs AS (" + " UNION ALL ".join(req + oth + [unk]) + ")",
        """summ AS (
  SELECT l.file_path, l.event_type, max(l.file_size) AS file_size,
         count(*) FILTER (WHERE trim(l.line) <> '' AND json_valid(trim(l.line))) AS records,
         count(*) FILTER (WHERE trim(l.line) <> '' AND json_valid(trim(l.line))
                          AND e.n IS NULL) AS valid_count,
         CAST(coalesce(sum(e.n), 0) AS BIGINT) AS invalid_count,
         count(e.n) AS invalid_records,
         count(*) FILTER (WHERE trim(l.line) <> '' AND NOT json_valid(trim(l.line)))
           AS skipped_lines
  FROM lines l LEFT JOIN (SELECT file_path, line_id, count(*) AS n FROM errs
                          GROUP BY file_path, line_id) e
    ON l.file_path = e.file_path AND l.line_id = e.line_id
  GROUP BY l.file_path, l.event_type)""",
        """met AS (
  SELECT file_path, event_type,
    CASE WHEN records = 0 THEN 1 ELSE 0 END AS EmptyFiles,
    CASE WHEN records = 0 THEN 0 ELSE 1 END AS FilesProcessed,
    CASE WHEN records > 0 AND invalid_count > 0 THEN 1 ELSE 0 END AS FilesWithErrors,
    CASE WHEN records = 0 THEN 0 ELSE invalid_count END AS InvalidRecords,
    CASE WHEN records = 0 THEN 0 ELSE valid_count END AS ValidRecords,
    CASE WHEN records = 0 THEN 0 ELSE file_size END AS FileSizeBytes,
    0 AS ProcessingErrors
  FROM summ)""",
    ]


ERR_COLS = ("file_path, event_type, record_index, user_id, session_id, error_code, field, "
            "reason")
ERROR_CODE_KEYS = {
    "validate_unknown_type": ("unknown_event_type",),
    "validate_required": ("missing_field", "null_field"),
    "validate_types": ("wrong_type",),
    "validate_enums": ("invalid_enum",),
    "validate_ranges": ("out_of_range",),
    "validate_timestamp": ("timestamp_type", "timestamp_format"),
}


def validation_queries() -> dict[str, str]:
    c = validation_ctes("ingest")
    out = {
        "ingest_event_type": _with(*c, select="SELECT DISTINCT file_path, event_type FROM lines"),
        "ingest_skip_quarantine": _with(*c, select="""
SELECT DISTINCT file_path FROM fx WHERE starts_with(file_path, 'quarantine/')"""),
        "validation_errors": _with(*c, select=f"SELECT {ERR_COLS} FROM errs"),
        "validation_summary": _with(*c, select="SELECT * FROM summ"),
        "ingest_empty_files": _with(*c, select="""
SELECT file_path, event_type FROM met WHERE EmptyFiles = 1"""),
        "ingest_metrics": _with(*c, select="SELECT * FROM met"),
        "ingested_file_metrics": _with(*c, select=f"""
SELECT * FROM met UNION ALL
SELECT DISTINCT 'raw/year=2024/month=01/day=' || lpad(CAST(day(event_date) AS VARCHAR), 2, '0') || '/void.jsonl', 'void', 1, 0, 0, 0, 0, 0, 0 FROM rawsrc"""),
        "quarantine_copies": _with(*c, select="""
SELECT file_path AS source_key, 'quarantine/' || file_path AS quarantine_key,
       CAST(max(file_size) AS BIGINT) AS bytes, sha256(string_agg(line || chr(10), '' ORDER BY line_id)) AS sha256
FROM lines WHERE file_path IN (SELECT file_path FROM errs) GROUP BY file_path"""),
        "ingest_run_summary": _with(*c, select="""
SELECT CAST(sum(FilesProcessed) AS BIGINT) AS processed_files,
       CAST(sum(InvalidRecords) AS BIGINT) AS total_errors FROM met"""),
        "valid_events": _with(*c, select="""
SELECT file_path, event_type, line_id // 2000 * 2000 AS block_start, line_id, j AS line
FROM recs r
WHERE NOT EXISTS (SELECT 1 FROM errs e WHERE e.file_path = r.file_path
                  AND e.line_id = r.line_id)"""),
        "quarantine_files": _with(*c, select="""
SELECT file_path AS source_key, 'quarantine/' || file_path AS quarantine_key,
       'quarantine/' || file_path || '.errors.json' AS error_key,
       CAST(max(n) AS BIGINT) AS error_count,
       CAST(to_json(list({'record_index': record_index, 'user_id': user_id,
                          'session_id': session_id, 'reason': reason} ORDER BY rn)) AS VARCHAR)
         AS errors
FROM (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY record_index, pos) AS rn,
             count(*) OVER (PARTITION BY file_path) AS n FROM errs) e
WHERE rn <= 100 GROUP BY file_path"""),
        "validate_contract": _with(*validation_ctes("contract"),
                                   select=f"SELECT {ERR_COLS} FROM errs"),
    }
    for key, codes in ERROR_CODE_KEYS.items():
        inl = ", ".join(_q(x) for x in codes)
        out[key] = _with(*c, select=f"SELECT {ERR_COLS} FROM errs WHERE error_code IN ({inl})")
    return out


# ---- warehouse, serving, reports ---------------------------------------------------------
def _dec(x: str, typ: str) -> str:
    """Declared type; an overflow is null."""
    scale = int(typ.rstrip(")").split(",")[1])
    return f"TRY_CAST(round({x}, {scale}) AS {typ.upper()})"


def _wide(x: str, scale: int) -> str:
    return f"TRY_CAST(round({x}, {scale}) AS DECIMAL(38,{scale}))"


def warehouse_ctes() -> list[str]:
    tp_cte, _ = top_pages_sql(2, 20, True)
    return [
        tp_cte, BOUNCE, DEVICE, FUNNEL, product_conv_sql(True), PATHS, ANOMALIES,
        f"""w_tp AS (
  SELECT event_date, page_url, page_type,
         {_wide('avg_time_seconds', 2)} AS avg_time_seconds, total_visits
  FROM tpr WHERE rn <= 20
  QUALIFY row_number() OVER (PARTITION BY event_date, page_url
                             ORDER BY total_visits DESC, page_type) = 1)""",
        f"""w_br AS (
  SELECT event_date, page_type, total_sessions, bounce_sessions,
         {_wide('bounce_rate_pct', 2)} AS bounce_rate_pct FROM br
  QUALIFY row_number() OVER (PARTITION BY event_date, page_type
                             ORDER BY total_sessions DESC) = 1)""",
        f"""w_tdc AS (
  SELECT event_date, device_type, country,
         {_wide('avg_time_seconds', 2)} AS avg_time_seconds,
         total_sessions, unique_users FROM tdc
  QUALIFY row_number() OVER (PARTITION BY event_date, device_type, country
                             ORDER BY total_sessions DESC) = 1)""",
        f"""w_cf AS (
  SELECT event_date, funnel_stage, users,
         {_wide('conversion_rate_pct', 2)} AS conversion_rate_pct FROM cf
  QUALIFY row_number() OVER (PARTITION BY event_date, funnel_stage
                             ORDER BY users DESC) = 1)""",
        f"""w_pvc AS (
  SELECT event_date, product_id, category, {_wide('price', 2)} AS price,
         total_views, cart_adds,
         {_wide('view_to_cart_rate', 2)} AS view_to_cart_rate, is_low_conversion
  FROM pvc
  QUALIFY row_number() OVER (PARTITION BY event_date, product_id
                             ORDER BY total_views DESC, category, price) = 1)""",
        """w_np AS (
  SELECT event_date, navigation_path, session_count FROM np
  QUALIFY row_number() OVER (PARTITION BY event_date, navigation_path
                             ORDER BY session_count DESC) = 1)""",
        f"""w_an AS (
  SELECT event_date, session_id, user_id, page_url, page_type,
         {_wide('z_score', 4)} AS z_score, anomaly_type, anomaly_field,
         {_wide('anomaly_value', 4)} AS anomaly_value FROM an)""",
        """q4 AS (
  SELECT device_type, country, CAST(event_date AS VARCHAR) AS event_date,
         avg_time_seconds, total_sessions, unique_users FROM w_tdc)""",
        """q4p AS (
  SELECT * FROM q4 ORDER BY total_sessions DESC NULLS FIRST, event_date, device_type, country
  LIMIT 100)""",
        """q7 AS (
  SELECT session_id, user_id, page_url, page_type, round(z_score, 4) AS z_score,
         anomaly_type, anomaly_field, round(anomaly_value, 2) AS anomaly_value,
         CAST(event_date AS VARCHAR) AS event_date
  FROM w_an WHERE z_score >= 0)""",
        """q7p AS (
  SELECT * FROM q7 ORDER BY z_score DESC NULLS FIRST, event_date, session_id, anomaly_type
  LIMIT 500)""",
        """q1 AS (
  SELECT page_url, page_type, CAST(round(avg(avg_time_seconds), 2) AS DECIMAL(12,2))
           AS avg_time_seconds, CAST(sum(total_visits) AS BIGINT) AS total_visits
  FROM w_tp GROUP BY page_url, page_type
  ORDER BY avg_time_seconds DESC NULLS FIRST, page_url, page_type LIMIT 20)""",
        """q2 AS (
  SELECT page_type, CAST(sum(total_sessions) AS BIGINT) AS total_sessions,
         CAST(sum(bounce_sessions) AS BIGINT) AS bounce_sessions,
         CAST(round(avg(bounce_rate_pct), 2) AS DECIMAL(7,2)) AS bounce_rate_pct
  FROM w_br GROUP BY page_type ORDER BY bounce_rate_pct DESC NULLS FIRST, page_type LIMIT 20)""",
        """q3 AS (
  SELECT CAST(event_date AS VARCHAR) AS date FROM (SELECT DISTINCT event_date FROM w_br))""",
        """q5 AS (
  SELECT CAST(coalesce(sum(coalesce(total_sessions, 0)), 0) AS BIGINT) AS total_sessions,
         CAST(coalesce(sum(coalesce(unique_users, 0)), 0) AS BIGINT) AS total_users,
         count(*) AS count FROM q4)""",
        """q8 AS (
  SELECT coalesce(anomaly_type, 'unknown') AS anomaly_type, count(*) AS anomalies
  FROM q7 GROUP BY 1)""",
    ]


def _label(x: str, pairs) -> str:
    for old, new in pairs:
        x = (f"(CASE WHEN strpos({x}, '{old}') > 0 THEN substr({x}, 1, strpos({x}, '{old}') - 1)"
             f" || '{new}' || substr({x}, strpos({x}, '{old}') + {len(old)}) ELSE {x} END)")
    return x


TIMELINE = """
SELECT q3.date,
  CAST(coalesce((SELECT sum(coalesce(total_sessions, 0)) FROM w_tdc t
                 WHERE CAST(t.event_date AS VARCHAR) = q3.date), 0) AS BIGINT) AS sessions,
  (SELECT count(*) FROM w_an a
   WHERE CAST(a.event_date AS VARCHAR) = q3.date AND z_score >= 0) AS anomalies
FROM q3"""

# Label rewrites, written out apart from the library's own.
PAGE_LABEL_REWRITES = [("/producto/", ""), ("/categoria/", ""), ("/checkout", "chk"),
                       ("/carrito", "cart")]
ANOMALY_LABEL_REWRITES = [("zscore_", "z:"), ("iqr_", "iqr:")]


def warehouse_queries() -> dict[str, str]:
    c = warehouse_ctes()
    out = {f"warehouse_{t}": _with(*c, select=f"SELECT * FROM w_{a}")
           for t, a in [("top_pages_by_time", "tp"), ("bounce_rate", "br"),
                        ("time_by_device_country", "tdc"), ("conversion_funnel", "cf"),
                        ("product_view_vs_cart", "pvc"), ("navigation_paths", "np"),
                        ("anomalies", "an")]}
    out.update({
        "daily_summary": _with(*c, select="""
SELECT cf.event_date, cf.users AS total_users,
  (SELECT CAST(sum(b.total_sessions) AS BIGINT) FROM w_br b
   WHERE b.event_date = cf.event_date) AS total_sessions,
  (SELECT CAST(round(avg(b.bounce_rate_pct), 2) AS DECIMAL(7,2)) FROM w_br b
   WHERE b.event_date = cf.event_date) AS avg_bounce_rate_pct,
  (SELECT max(c2.conversion_rate_pct) FROM w_cf c2
   WHERE c2.event_date = cf.event_date AND c2.funnel_stage = '4_checkout')
     AS checkout_conversion_pct,
  (SELECT count(*) FROM w_an a WHERE a.event_date = cf.event_date) AS anomaly_count
FROM w_cf cf WHERE cf.funnel_stage = '1_page_view'"""),
        "serve_top_pages": _with(*c, select="SELECT * FROM q1"),
        "serve_bounce": _with(*c, select="SELECT * FROM q2"),
        "serve_dates": _with(*c, select="SELECT * FROM q3 ORDER BY date DESC LIMIT 30"),
        "serve_sessions": _with(*c, select="SELECT * FROM q4p"),
        "serve_sessions_filtered": _with(*c, select="""
SELECT device_type, country, CAST(event_date AS VARCHAR) AS event_date,
       avg_time_seconds, total_sessions, unique_users
FROM w_tdc WHERE event_date = DATE '2024-01-06' AND upper(country) = 'C3'
  AND device_type = 'mobile'
ORDER BY total_sessions DESC NULLS FIRST, event_date, device_type, country LIMIT 100"""),
        "serve_session_totals": _with(*c, select="SELECT * FROM q5"),
        "serve_filters": _with(*c, select="""
SELECT DISTINCT 'country' AS filter, country AS value FROM w_tdc
UNION SELECT DISTINCT 'device', device_type FROM w_tdc"""),
        "serve_anomalies": _with(*c, select="SELECT * FROM q7p"),
        "serve_anomalies_filtered": _with(*c, select="""
SELECT session_id, user_id, page_url, page_type, round(z_score, 4) AS z_score,
       anomaly_type, anomaly_field, round(anomaly_value, 2) AS anomaly_value,
       CAST(event_date AS VARCHAR) AS event_date
FROM w_an WHERE z_score >= 3.5 AND anomaly_type = 'zscore_time_on_page_seconds'
ORDER BY round(z_score, 4) DESC NULLS FIRST, w_an.event_date, session_id, anomaly_type
LIMIT 500"""),
        "serve_anomaly_counts": _with(*c, select="SELECT * FROM q8"),
        "report_timeline": _with(*c, select=TIMELINE),
        "report_sessions_by_device": _with(*c, select="""
SELECT device_type, CAST(sum(total_sessions) AS BIGINT) AS total_sessions FROM q4
GROUP BY device_type"""),
        "report_anomaly_severity": _with(*c, select="""
SELECT *, CASE WHEN z_score > 10 THEN 'high' WHEN z_score > 5 THEN 'med' ELSE 'low' END
          AS severity FROM q7p"""),
        "report_bounce_bands": _with(*c, select="""
SELECT *, CASE WHEN CAST(bounce_rate_pct AS DOUBLE) > 80 THEN 'red'
               WHEN CAST(bounce_rate_pct AS DOUBLE) > 60 THEN 'amber' ELSE 'green' END AS band,
       round(CAST(bounce_rate_pct AS DOUBLE) / max(CAST(bounce_rate_pct AS DOUBLE)) OVER ()
             * 100, 1) AS width_pct
FROM q2"""),
        "report_kpis": _with(*c, select="""
SELECT 'sessions' AS kpi, total_sessions AS value FROM q5
UNION ALL SELECT 'users', total_users FROM q5
UNION ALL SELECT 'anomalies', CAST(coalesce(sum(anomalies), 0) AS BIGINT) FROM q8
UNION ALL SELECT 'anomaly_types', count(*) FROM q8
UNION ALL SELECT 'pages', count(*) FROM q1
UNION ALL SELECT 'dates', count(*) FROM q3"""),
        "report_page_labels": _with(*c, select=f"""
SELECT page_url, {_label('page_url', PAGE_LABEL_REWRITES)} AS label FROM q1"""),
        "report_anomaly_labels": _with(*c, select=f"""
SELECT session_id, anomaly_type, {_label('anomaly_type', ANOMALY_LABEL_REWRITES)}
       AS type_label, substr(coalesce(session_id, ''), 6, 14) AS session_label FROM q7p"""),
        "report_top8_remainder": _with(*c, select="""
SELECT *, greatest(count(*) OVER () - 8, 0) AS more FROM q7
ORDER BY z_score DESC NULLS FIRST, event_date, session_id, anomaly_type LIMIT 8"""),
    })
    for t, a in [("top_pages_by_time", "tp"), ("bounce_rate", "br"),
                 ("time_by_device_country", "tdc"), ("conversion_funnel", "cf"),
                 ("product_view_vs_cart", "pvc"), ("navigation_paths", "np"), ("anomalies", "an")]:
        out[f"stored_{t}"] = _stored(*c, select=f"SELECT *, '2026-01-01 00:00:00' AS loaded_at "
                                                f"FROM w_{a}")
    out["stored_timeline"] = _stored(*c, select=TIMELINE)
    out["stored_serve_sessions"] = _stored(*c, select="SELECT * FROM q4p")
    out["stored_serve_anomalies"] = _stored(*c, select="SELECT * FROM q7 WHERE z_score >= 3.5")
    out["stored_after_late_days"] = _with(*c, select="""
SELECT *, CASE WHEN EXISTS (
  SELECT 1 FROM pv WHERE pv.event_date = b.event_date AND pv.page_type IS NOT DISTINCT FROM b.page_type
  AND NOT (day(pv.event_date) % 2 = 0 AND (page_type IN ('cart', 'checkout') OR hour(event_timestamp) >= 12)))
  THEN '2026-01-01 00:00:00' ELSE '2026-02-01 00:00:00' END AS loaded_at FROM w_br b""")
    out["warehouse_key_violations"] = _with(*c, select=violations_sql())
    return out


METRIC_SOURCE = {"top_pages_by_time": "(SELECT * FROM tpr WHERE rn <= 20)",
                 "bounce_rate": "br", "time_by_device_country": "tdc",
                 "conversion_funnel": "cf", "product_view_vs_cart": "pvc",
                 "navigation_paths": "np", "anomalies": "an"}


# Result-table checks, written out apart from the library's own table specification:
# (table, key, columns that may not be null, longest strings, declared decimals).
DDL_CHECKS = [
    ("top_pages_by_time", ["event_date", "page_url"], None,
     {"page_url": 512, "page_type": 50}, {"avg_time_seconds": "decimal(10,2)"}),
    ("bounce_rate", ["event_date", "page_type"], None, {"page_type": 50},
     {"bounce_rate_pct": "decimal(5,2)"}),
    ("time_by_device_country", ["event_date", "device_type", "country"], None,
     {"device_type": 20, "country": 5}, {"avg_time_seconds": "decimal(10,2)"}),
    ("conversion_funnel", ["event_date", "funnel_stage"], None, {"funnel_stage": 50},
     {"conversion_rate_pct": "decimal(5,2)"}),
    ("product_view_vs_cart", ["event_date", "product_id"], None,
     {"product_id": 20, "category": 50},
     {"price": "decimal(12,2)", "view_to_cart_rate": "decimal(5,2)"}),
    ("navigation_paths", ["event_date", "navigation_path"], None, {}, {}),
    ("anomalies", None, ["event_date", "session_id"],
     {"session_id": 100, "user_id": 100, "page_url": 512, "page_type": 50,
      "anomaly_type": 100, "anomaly_field": 100},
     {"z_score": "decimal(8,4)", "anomaly_value": "decimal(15,4)"}),
]


def violations_sql() -> str:
    parts = []
    for t, key, required, lengths, decimals in DDL_CHECKS:
        src = METRIC_SOURCE[t]
        if key:
            parts.append(f"SELECT '{t}' AS table_name, 'duplicate_key' AS violation, "
                         f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS rows FROM "
                         f"(SELECT count(*) AS n FROM {src} GROUP BY {', '.join(key)})")
        checks = {f"null:{n}": f"{n} IS NULL" for n in key or required}
        checks |= {f"too_long:{n}": f"length({n}) > {m}" for n, m in lengths.items()}
        checks |= {f"overflow:{n}": f"{n} IS NOT NULL AND {_dec(n, typ)} IS NULL"
                   for n, typ in decimals.items()}
        parts += [f"SELECT '{t}', '{name}', count(*) FILTER (WHERE {cond}) FROM {src}"
                  for name, cond in checks.items()]
    return " UNION ALL ".join(parts)
