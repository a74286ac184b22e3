"""The workload has no stream (nightly full refresh); this holds its only incremental hook,
the fact-load high-water mark."""
