"""tripkpi — Spark-native cleaning and monthly KPIs for rental-bike trip data.

Every public operator is a plain ``DataFrame -> DataFrame`` (or Column)
function built from Spark's own expressions, so Catalyst sees one plan.

Subpackages:
  functions   Column expressions (durations, timestamps, slots, distance, ...)
  sources     CSV layouts, station master, landing manifest, clean-table reads
  sinks       partitioned Parquet writes, KPI report tables
  operators   validation / quality, station joins, KPI aggregations
  plans       whole jobs (clean new / old layout, KPI report) and their CLI
  llm         operators of a training-data pipeline (nothing else imports it)
"""

__version__ = "0.1.0"
