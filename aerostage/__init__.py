"""Flight-operations staging and KPIs, written as Spark DataFrame plans.

Sub-packages:

* ``sources``   landed payload readers, driver-table adapters, request plan
* ``functions`` column expressions (text clean-up, casts, time parsing, flags)
* ``operators`` reusable DataFrame operators (keep-first, pair merge, keys, nesting)
* ``plans``     the staging models, data checks, store helpers and KPIs
* ``streaming`` Structured Streaming ingestion of landed payload files
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
