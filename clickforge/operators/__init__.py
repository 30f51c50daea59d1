"""DataFrame -> DataFrame operators: cleaning, validation, page metrics, funnel,
navigation paths and anomaly detection. All are keyed by a batch key (``by``,
default ``event_date``) so many days run in one job."""
