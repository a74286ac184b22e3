"""carestar — dimensional analytics on Spark.

Reads a normalised operational (OLTP) hospital model, builds a star schema
(calendar and entity dimensions with surrogate keys, one fact table at the
encounter grain, two bridge tables), quarantines bad rows in a typed error
table, reconciles the result with data-quality checks, keeps an audit trail,
and answers four analytical questions on either model.

Layout:
  sources/    readers, sinks, the test adapter from the driver tables
  functions/  column-expression helpers (dates, bands, safe ratios)
  operators/  surrogate keys, dims, lookups, fact, bridges, rejects, quality, audit
  plans/      the four questions, the full-refresh pipeline, comparison report
  streaming/  the high-water mark (the only incremental hook of the workload)
"""

from carestar.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
