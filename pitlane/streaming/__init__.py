"""Incremental landing of lap files with Structured Streaming.

The reference has no streaming; its layers are batch.  The same row-level
bronze and silver operators are plain DataFrame -> DataFrame functions, so
they also run on a streaming DataFrame: new lap files are picked up, typed,
filtered and appended to the bronze/silver tables exactly once per file.
"""

from pitlane.streaming.ingest import ingest_laps, silver_rows  # noqa: F401
