"""lapsewise — policy lapse and retention analytics as Spark DataFrame jobs.

Layers:

* ``sources``   — readers/writers, table schemas and the adapter that maps the
  driver's TPC-H style tables onto the insurance star schema.
* ``functions`` — column-expression helpers (rates, buckets, flags, money).
* ``operators`` — DataFrame-in / DataFrame-out operators: profiling,
  cleaning, feature derivation, KPI and dashboard aggregates.
* ``plans``     — table-level compositions (clean → features → KPI) and the
  layer model that materialises stage outputs as Parquet.
"""

__version__ = "0.1.0"
