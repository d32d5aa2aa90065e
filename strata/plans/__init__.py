"""Domain jobs and the registered query set.

* ``deforestation``, ``tax``, ``spending`` - bronze (typing, quarantine), silver
  (rules, ranges, rounding) and gold KPIs of each domain, as DataFrame functions.
* ``cross`` - the cross-domain KPIs over gold tables.
* ``medallion`` - whole runs: raw -> bronze -> silver -> gold tables, gates, views,
  year backfills, incremental runs over a landing folder.
* ``tpch_analogues`` - the domains re-shaped from the driver's TPC-H-like tables.
* ``queries`` - the registered queries and their oracle SQL.
"""
