"""fleetlake: device-fleet telemetry lakehouse operators on PySpark.

Layout: ``sources`` (topics, tables, blobs, fixtures), ``functions``
(column expressions and fixed domain values), ``operators`` (drift,
validation, linkage, quality, data tests, maintenance), ``plans`` (silver,
gold, reports, model build, registered queries), ``streaming`` (ingest,
monitoring, streaming aggregates), ``sinks`` (table writes).
"""
