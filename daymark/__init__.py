"""Daily point observations on Spark: ingest, quarantine, check, model, serve, profile.

Every public function takes DataFrames and returns DataFrames.  Nothing is
collected on the way, so each function is one more step of a lazy Spark plan.
"""

from daymark.schema import MART, WIDE, Layout

__all__ = ["Layout", "MART", "WIDE"]
