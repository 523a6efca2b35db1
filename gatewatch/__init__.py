"""gatewatch: Spark-native web-traffic analytics and anti-crawler scoring.

Every operator takes and returns DataFrames / Columns, so the same code runs
in batch and inside Structured Streaming ``foreachBatch``.
"""

__all__ = ["session", "config"]
