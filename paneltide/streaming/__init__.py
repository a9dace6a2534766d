"""Incremental ingest of landing files with Structured Streaming.

The reference has no stream operator (no watermark, window or state); its
landing files simply arrive over time.  This package re-expresses the same
file ingest incrementally: new files only, exactly once (checkpointed).
"""
