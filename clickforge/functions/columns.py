"""Reusable Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def batch_keys(by: str | Iterable[str] | None) -> list[str]:
    """Normalise a batch-key argument: ``"event_date"`` (default), a list, or ``None``/``()``
    for "the whole input is one batch"."""
    if by is None:
        return []
    if isinstance(by, str):
        return [by]
    return list(by)


def pct(num, den, scale: int = 2) -> Column:
    """``round(num / den * 100, scale)`` (Spark's HALF_UP round); ``den`` must be non-zero."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.round(num / den * 100, scale)


def severity(z) -> Column:
    """Dashboard anomaly severity: z > 10 high, z > 5 med, else low."""
    z = F.col(z) if isinstance(z, str) else z
    return F.when(z > 10, "high").when(z > 5, "med").otherwise("low")


def first_replace(s: Column, old: str, new: str) -> Column:
    """Replace only the first occurrence of the literal ``old`` (JavaScript ``replace``)."""
    i = F.instr(s, old)
    head = s.substr(F.lit(1), i - 1)
    tail = s.substr(i + len(old), F.length(s) + 1)
    return F.when(i > 0, F.concat(head, F.lit(new), tail)).otherwise(s)


# Dashboard label rewrites, applied in this order, first occurrence each.
PAGE_LABEL_REWRITES = [("/producto/", ""), ("/categoria/", ""), ("/checkout", "chk"),
                       ("/carrito", "cart")]
ANOMALY_LABEL_REWRITES = [("zscore_", "z:"), ("iqr_", "iqr:")]


def shorten_label(s, rewrites) -> Column:
    s = F.col(s) if isinstance(s, str) else s
    for old, new in rewrites:
        s = first_replace(s, old, new)
    return s


def materialize(df, **cols: Column):
    """Add columns that are evaluated exactly once per row.

    ``withColumn`` results can be inlined by Catalyst into every later reference, which
    repeats an expensive expression (a parse, a higher-order function) per use. Emitting
    them through ``inline(array(struct(...)))`` makes them the output of a ``Generate``
    node, which later projections can only reference, never re-evaluate.
    """
    packed = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select("*", F.inline(F.array(packed)))
