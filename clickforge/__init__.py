"""clickforge: clickstream behaviour analytics as Spark DataFrame functions.

Every public function takes DataFrames and returns a DataFrame. Metrics are keyed by a
batch key (``event_date`` by default) so one job can process any number of days at once
and Catalyst/AQE choose the physical plan.
"""

from clickforge.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
__version__ = "0.1.0"
