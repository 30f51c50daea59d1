"""Sources and sinks: raw JSONL, day-partitioned Parquet, quarantine, warehouse load,
and the bindings that derive clickstream views from the driver's test tables."""
