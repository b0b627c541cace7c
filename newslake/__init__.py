"""newslake: DataFrame operators for monitoring company news on Spark.

Every operator takes and returns a ``pyspark.sql.DataFrame``; the heavy lifting is
built-in Spark expressions, joins, aggregates, windows and Structured Streaming.
"""

from newslake.session import build_session, checkpoint_root, pin_session

__all__ = ["build_session", "checkpoint_root", "pin_session"]
