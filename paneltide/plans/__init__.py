"""Query plans: the panel built on the driver tables, the query catalogue and
its DuckDB oracle, and the landing-file stages (entry points 1-3)."""
