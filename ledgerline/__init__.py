"""ledgerline: a shop-sales ELT pipeline written as Spark DataFrame jobs.

Sub-packages:

* ``sources``   – readers (CSV, JSON arrays, JDBC, lake Parquet, driver test tables)
* ``sinks``     – writers (snapshot, append/replace load, materialise, quarantine, reports)
* ``functions`` – column expressions (casts, text clean-up, ids, messages)
* ``operators`` – reusable relational steps (sentinel filter, validation, latest-by,
                  high-water marks, cursor load, merge upsert, lookups)
* ``plans``     – the models and jobs a user calls (staging, marts, analytics, ingest,
                  whole pipeline)
* ``streaming`` – the cursor load as a Structured Streaming job
"""

__version__ = "0.1.0"
