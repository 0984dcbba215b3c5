"""tessera: a retail medallion data product (bronze -> silver -> gold) on Spark.

Every model is a lazily composed DataFrame; Catalyst sees the whole plan from
the parquet scans to the gold aggregate.  Sub-packages:

* ``sources``   -- bronze: landing readers, the test-data adapter, writers
* ``functions`` -- Column -> Column helpers (conforming, money, dates)
* ``operators`` -- DataFrame -> DataFrame building blocks (dedupe, quarantine,
                   as-of carry-forward, identity resolution, contracts, profiles)
* ``plans``     -- the silver and gold models, snapshot/reconcile, the
                   full build (every layer written) and the registered query catalogue
* ``streaming`` -- incremental landing ingest as an ``availableNow`` stream
"""

from tessera.types import MONEY, RATE, COUNTRY

__all__ = ["MONEY", "RATE", "COUNTRY"]
