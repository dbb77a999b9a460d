"""DataFrame-in, DataFrame-out operators: silver, gold, marts, run-log
views, basket mining and quality checks."""
