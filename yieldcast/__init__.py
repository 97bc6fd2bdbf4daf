"""yieldcast: weekly recovery-rate analytics and forecasting on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
expressions, so Catalyst sees the whole plan (pushdown, pruning, codegen).
"""

__version__ = "0.1.0"
