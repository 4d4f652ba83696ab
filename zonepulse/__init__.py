"""zonepulse: PySpark analytics for zone data and request telemetry.

Every operator is a DataFrame -> DataFrame transformation. Sub-packages:

* ``sources``   readers and writers (Parquet, CSV, JSON, Kafka-or-file streams)
* ``functions`` column expressions shared by several operators
* ``operators`` batch operators (telemetry, buildings, requests, lag, experiments)
* ``plans``     end-to-end compositions of operators
* ``streaming`` Structured Streaming wiring (windows, upsert sink, TTL state)
"""

from zonepulse.session import build_session, ensure_utc, scratch_path

__all__ = ["build_session", "ensure_utc", "scratch_path"]
