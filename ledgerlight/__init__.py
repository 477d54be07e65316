"""ledgerlight: budget-control analytics as Spark DataFrame operators.

Layers:
  sources    raw text ingest (CSV), test-data staging, parquet sinks
  functions  column-expression helpers (text, dates, safe arithmetic)
  operators  reusable DataFrame operators (quality, cleansing, rules,
             calendar, joins, running totals, period metrics, grids, medians)
  plans      the composed pipeline: silver tables, gold views, measures
  streaming  incremental ledger ingest with Structured Streaming
"""

from ledgerlight.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
