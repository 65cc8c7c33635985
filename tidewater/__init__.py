"""tidewater: order-warehouse operators and jobs on Spark DataFrames.

Layers:
  sources/    table adapters, file / JDBC / CDC readers, dataset registry
  functions/  column-expression helpers (date parts, casts, ids, JSON)
  operators/  CDC slicing, enrichment joins, top-N, milestones, upsert, sinks
  plans/      the composite jobs and the query registry
  streaming/  Structured Streaming versions of the operators
"""

from tidewater.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
