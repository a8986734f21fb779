"""Declarative bronze-to-silver tables and run logs on plain Apache Spark.

Layers, from small to large:

``functions``  column expressions (cleansing, JSON paths, elapsed time)
``operators``  DataFrame to DataFrame steps (silver transform, latest row, merge, layout)
``sources``    scans (files, JDBC) and the audit columns
``streaming``  incremental ingest and the streaming upsert
``plans``      whole flows built from the above (table flow, run log)
"""

from siltstone.spec import ColumnSpec, TableSpec, table_spec

__all__ = ["ColumnSpec", "TableSpec", "table_spec"]
