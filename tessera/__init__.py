"""tessera — Spark-native exploratory and predictive analytics.

Every operator takes DataFrames and returns DataFrames; the heavy work stays
in Catalyst expressions, Spark SQL aggregates, windows and joins, or Spark ML.
Only bounded aggregates (a handful of statistics, a features x features
matrix, a grid of parameters) ever reach the driver.
"""

from tessera.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
