"""lakeride: trip-lakehouse analytics as Spark DataFrame jobs.

Sub-packages: ``sources`` (stream / table I/O, fixtures), ``functions``
(schemas, time and ordered-aggregate helpers), ``operators`` (ingest,
quality, gold, reports, maintenance, metrics, alerts), ``streaming``
(Structured Streaming medallion), ``plans`` (named query catalogue).
"""

__version__ = "0.1.0"
