"""strata: layered (bronze / silver / gold) data pipelines as Spark DataFrame jobs.

Sub-packages:
    sources    typed and tolerant readers, file selection, manifests; sinks
    functions  reusable column rules (casts, buckets, maps, ratios, parsers)
    operators  DataFrame -> DataFrame operators (validation, dedup, incremental
               loads, one-big-table joins, log analytics, skew-safe windows)
    streaming  file-stream ingestion with checkpoints, archival, schema evolution
    plans      end-to-end layer compositions over the driver tables
"""

from strata.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
