"""strata: layered (bronze / silver / gold) batch analytics as plain Spark jobs.

Sub-packages
------------
functions   Column-level helpers (cleansing, hash keys, scores, tiers).
operators   DataFrame -> DataFrame operators (SCD2 merge, distributed ranks,
            quality split, deterministic survivor pick).
sources     CSV ingest with lineage, table contracts, staged table swap, audit log.
plans       The star schema, the marts and the end-to-end pipeline.
streaming   Incremental (file-stream) variant of the bronze ingest.
"""

__version__ = "0.1.0"
