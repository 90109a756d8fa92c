"""Retail sales analytics on Spark.

Extracts of orders, order lines and products go through three layers:

* bronze  - raw extracts landed as Parquet, orders partitioned by year/month/day
* silver  - rule-validated, cleaned tables plus a quarantine table per dataset
* gold    - four marts (country, product, returned product, day)

and are served as ordered pages, key figures and top-k series.

Every step is a ``DataFrame -> DataFrame`` function; nothing builds a
session at import time and no path is fixed in code.
"""

__version__ = "0.1.0"

__all__ = ["functions", "operators", "sources", "plans", "streaming", "schemas", "session"]
