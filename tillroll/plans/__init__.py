"""Plans: layer assembly, the persisted ETL run, the mining job, and the
registry of named queries."""
