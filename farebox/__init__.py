"""farebox: trip analytics expressed as Spark DataFrame / SQL plans.

Every public function is ``DataFrame -> DataFrame`` (or builds a frame from a
path); nothing creates a session, collects unaggregated data or caches by
default.  The caller owns the ``SparkSession``.
"""

__version__ = "0.1.0"

__all__ = ["functions", "operators", "plans", "sinks", "sources"]
