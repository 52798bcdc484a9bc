"""Bronze, Silver and Gold tables from change feeds and event streams, on Spark.

Operators take and return DataFrames and stay lazy unless their docstring says
otherwise; only `sinks`, `streaming` and `plans.jobs` write.
"""

from tidemark.session import staged, tune

__all__ = ["staged", "tune"]
