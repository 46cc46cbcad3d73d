"""Orders analytics on Spark.

Order and payment events are cleaned, deduplicated, enriched and upserted into
staging tables; a star schema and a daily rollup are built from them, checked by
declarative quality suites, and queried by the dashboard questions. Everything
is DataFrame code: Catalyst plans it, Spark partitions and shuffles it.
"""

__version__ = "0.1.0"
