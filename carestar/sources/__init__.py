"""Sources and sinks: parquet / CSV / literal readers, staged publish, range replace, and the
test adapter from the driver's tables to the OLTP model."""
