"""Registered queries: each operator of the survey exercised over the driver tables.

Every entry is ``fn(spark, sf_dir) -> DataFrame`` and has an equivalent SQL
text in ``ORACLE_SQL`` (DuckDB dialect, over views named after the tables).
Column names match between the two.  Integer outputs are BIGINT, money and
ratios DOUBLE; sums are exact decimals converted at the end, so both engines
produce bit-identical doubles.

Modules register in this order: gold KPIs, scalar operators, sources and
sinks, quality gates, views and SQL stages, incremental, whole runs, lake (mixed drops, versions, catalogue, order, spread keys).
"""

from strata.plans.queries.registry import ORACLE_SQL, QUERIES, register

# Importing a module registers its queries; keep this order (not alphabetical).
from strata.plans.queries import gold  # noqa: E402,F401
from strata.plans.queries import scalar  # noqa: E402,F401
from strata.plans.queries import sources  # noqa: E402,F401
from strata.plans.queries import quality  # noqa: E402,F401
from strata.plans.queries import views  # noqa: E402,F401
from strata.plans.queries import incremental  # noqa: E402,F401
from strata.plans.queries import runs  # noqa: E402,F401
from strata.plans.queries import lake  # noqa: E402,F401

__all__ = ["ORACLE_SQL", "QUERIES", "register"]
