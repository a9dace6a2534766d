"""Scans and sinks: driver parquet tables, landing CSV extracts, parquet stages."""
