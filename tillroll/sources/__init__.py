"""Sources and sinks: raw scans, the test-table adapter, incremental loads,
the run log and result files."""
