"""Validation rule table with two named profiles.

``ingest`` is the file-arrival validator's rule set (the default); ``contract`` carries the
stricter ranges and integer kinds of the published JSON contracts. Both are expressed as
plain data; :mod:`clickforge.operators.validate` turns them into Column expressions.

Fixed values: required fields, kinds, enum sets and ranges below must equal the reference.
"""

from __future__ import annotations

# kind: "str" = JSON string; "num" = JSON number (a boolean passes, as it does for the
# reference's isinstance check); "int" = integral JSON number (contract profile only).

# ---- fixed values: ingest profile -------------------------------------------------------
INGEST = {
    "page_view": {
        "required": ["user_id", "session_id", "page_url", "page_type",
                     "timestamp", "time_on_page_seconds", "device_type", "country"],
        "types": {"user_id": "str", "session_id": "str", "page_url": "str",
                  "page_type": "str", "timestamp": "str", "time_on_page_seconds": "num",
                  "device_type": "str", "country": "str"},
        "enums": {"page_type": ["home", "category", "product", "cart", "checkout",
                                "search", "other"],
                  "device_type": ["mobile", "desktop", "tablet"]},
        "ranges": {"time_on_page_seconds": (1, 7200)},
    },
    "click": {
        "required": ["user_id", "session_id", "element_id", "element_type",
                     "page_url", "timestamp", "x_position", "y_position"],
        "types": {"user_id": "str", "session_id": "str", "element_id": "str",
                  "element_type": "str", "page_url": "str", "timestamp": "str",
                  "x_position": "num", "y_position": "num"},
        "enums": {"element_type": ["button", "link", "image", "product_card",
                                   "menu", "banner", "search_result"]},
        "ranges": {"x_position": (0, 7680), "y_position": (0, 4320)},
    },
    "search": {
        "required": ["user_id", "session_id", "query", "results_count", "timestamp"],
        "types": {"user_id": "str", "session_id": "str", "query": "str",
                  "results_count": "num", "timestamp": "str"},
        "enums": {},
        "ranges": {"results_count": (0, 1_000_000)},
    },
    "product_view": {
        "required": ["user_id", "session_id", "product_id", "category",
                     "price", "timestamp", "time_on_page_seconds"],
        "types": {"user_id": "str", "session_id": "str", "product_id": "str",
                  "category": "str", "price": "num", "timestamp": "str",
                  "time_on_page_seconds": "num"},
        "enums": {"category": ["electronics", "clothing", "home", "sports",
                               "books", "beauty", "toys", "food"]},
        "ranges": {"price": (0.01, 1_000_000), "time_on_page_seconds": (1, 7200)},
    },
    "cart_event": {
        "required": ["user_id", "session_id", "product_id", "action", "timestamp"],
        "types": {"user_id": "str", "session_id": "str", "product_id": "str",
                  "action": "str", "timestamp": "str"},
        "enums": {"action": ["add", "remove"]},
        "ranges": {},
    },
}

# ---- fixed values: contract profile (published JSON contracts) -------------------------
CONTRACT = {
    "page_view": {
        "required": INGEST["page_view"]["required"],
        "types": {**INGEST["page_view"]["types"], "time_on_page_seconds": "int",
                  "referrer": "str"},
        "enums": INGEST["page_view"]["enums"],
        "ranges": {"time_on_page_seconds": (1, 3600)},
    },
    "click": {
        "required": INGEST["click"]["required"],
        "types": {**INGEST["click"]["types"], "x_position": "int", "y_position": "int"},
        "enums": INGEST["click"]["enums"],
        "ranges": {"x_position": (0, 3840), "y_position": (0, 2160)},
    },
    "search": {
        "required": INGEST["search"]["required"],
        "types": {**INGEST["search"]["types"], "results_count": "int"},
        "enums": {},
        "ranges": {"results_count": (0, 10000)},
    },
    "product_view": {
        "required": INGEST["product_view"]["required"],
        "types": {**INGEST["product_view"]["types"], "time_on_page_seconds": "int"},
        "enums": INGEST["product_view"]["enums"],
        "ranges": {"price": (0.01, 100000), "time_on_page_seconds": (1, 3600)},
    },
    "cart_event": INGEST["cart_event"],
}

PROFILES = {"ingest": INGEST, "contract": CONTRACT}

# Timestamp rule: ISO-8601 with a zone offset, optional fraction, no calendar check.
# Digits are Unicode decimal digits (\p{Nd}), as a Python str pattern's \d matches.
ISO8601_PATTERN = (r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}T\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}"
                   r"(\.\p{Nd}+)?(Z|[+-]\p{Nd}{2}:\p{Nd}{2})$")
