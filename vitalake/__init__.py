"""vitalake: wearable-health medallion analytics on Spark.

Bronze (VARIANT documents) -> silver (typed, de-duplicated) -> gold (daily and
weekly aggregates) -> views, dashboard tiles and app queries, in batch and in
Structured Streaming.  Every operator is a DataFrame function built from
Spark SQL built-ins.
"""

__version__ = "0.1.0"
