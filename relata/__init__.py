"""relata: customer-relationship analytics written as Spark jobs.

Layers: ``sources`` (scans) -> ``operators`` (DataFrame -> DataFrame) -> ``sinks`` (layered
Parquet tables), ordered by ``plans`` and kept current by ``streaming``.
"""
