"""torque — Spark-native sales and supply-chain analytics.

Layers (each a set of ``DataFrame -> DataFrame`` functions, lazily composed
so Catalyst sees whole plans):

* ``torque.sources``   typed reads, loaders, snapshot sinks, generators, bindings
* ``torque.operators`` quality checks, staging, calendar, keys, merge, dims,
                       as-of link, fact, reports, insights, history
* ``torque.functions`` column-expression helpers (exact decimal rounding, dates)
* ``torque.plans``     the warehouse build (bronze -> silver -> gold) and the query catalogue
* ``torque.streaming`` change-driven loads with Structured Streaming
"""

__version__ = "0.1.0"
