"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from clickforge.functions.columns import batch_keys, pct, severity, shorten_label

__all__ = ["batch_keys", "pct", "severity", "shorten_label"]
