"""ridgeline: tabular profiling, regression and explanation on Spark.

Every stage is a lazy DataFrame or a Spark ML ``Pipeline``; actions happen
at writes, at ``fit`` and where a bounded summary (a few hundred rows at
most: one row per column, per bin or per category) is needed on the driver.
"""

from ridgeline.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
