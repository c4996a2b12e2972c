"""herald: campaign drift analytics for short-message traffic on Apache Spark.

Every public operator takes and returns a DataFrame keyed by ``originator_id``,
so all senders are processed in one distributed job.
"""

__version__ = "0.1.0"
