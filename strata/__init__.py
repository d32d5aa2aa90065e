"""strata: medallion-style annual indicators on Spark.

Every operator is a ``DataFrame -> DataFrame`` function over native Spark
column expressions, so Catalyst can prune columns, push filters into the
Parquet scan and keep the work inside whole-stage codegen.

Layout:

* ``strata.functions``  - column expressions (rounding, guarded ratios,
  ordered rule normalisers, number parsers).
* ``strata.operators``  - aggregates, windows, joins, cleaning and quality gates.
* ``strata.sources``    - CSV / JSON / Parquet readers and writers, header
  harmonisation, table overwrite modes, views and parameterised SQL.
* ``strata.plans``      - the domain jobs (tax, deforestation, spending,
  cross-domain) and the query set run over the driver tables.
* ``strata.streaming``  - incremental file ingestion and snapshot diffs.
"""

from strata.session import checkpoint_root, get_spark, scratch_path

__version__ = "0.1.0"

__all__ = ["__version__", "checkpoint_root", "get_spark", "scratch_path"]
