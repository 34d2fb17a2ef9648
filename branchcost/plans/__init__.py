"""Plans: the jobs (full load, salary per period, incremental loads) and the
registered query catalog with its SQL oracles."""
