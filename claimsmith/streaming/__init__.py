"""Structured Streaming entry points.

The source workloads are batch jobs; the one with an incremental mode - the
request list loaded by key-based merge - is exposed here as a file stream
whose micro-batches are merged into a versioned Parquet target
(``upsert_stream``), or into a bucketed one of which a batch rewrites only what it touches (``merge_stream``).
"""

from claimsmith.streaming.upsert import latest_version, merge_stream, upsert_stream  # noqa: F401
