"""acqlens: attribution, reconciliation and growth analytics as Spark DataFrame jobs.

Layers (bronze -> silver -> gold), all plain ``DataFrame -> DataFrame`` functions:

* ``acqlens.sources``    raw sources: typed CSV loader, driver-table adapter, freshness
* ``acqlens.functions``  column expressions (channel canonicaliser, keys, day offsets, ratios)
* ``acqlens.operators``  staging, reconciliation, dimensions, facts, marts, checks, reports, extras
* ``acqlens.plans``      the model graph (lazy / materialised / published), the query registry, the
                         publish run with its circuit breaker, and incremental daily refreshes
* ``acqlens.streaming``  incremental backend de-duplication with a watermark
* ``python -m acqlens``  command line for the daily run (load, run, test, freshness, report, refresh,
                         snapshot)
"""

__version__ = "0.1.0"
