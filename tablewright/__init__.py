"""tablewright: table preparation, regression and result analysis on Spark.

Every operator takes and returns DataFrames and is built from Spark's own
column expressions, joins, aggregates and windows.  Order and randomness are
always made explicit through key columns.
"""

from tablewright.session import get_session, checkpoint_dir, materialize

__all__ = ["get_session", "checkpoint_dir", "materialize"]
