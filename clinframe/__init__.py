"""clinframe: intensive-care cohort analytics on Spark DataFrames.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is
written with the DataFrame API so Catalyst plans it; nothing is collected to
the driver except the handful of rows a report produces.
"""

from clinframe.session import get_spark  # noqa: F401

__all__ = ["get_spark"]
