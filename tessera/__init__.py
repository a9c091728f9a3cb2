"""tessera: wide statistics tables to a conformed star schema, on Spark.

Layers follow the usual raw / clean / star split:

* ``tessera.sources``   delimited-file scans with rejects, table sinks
* ``tessera.functions`` Column -> Column cleaning and conforming rules
* ``tessera.operators`` reshaping, surrogate keys, dimensions, star joins,
                        data-quality checks, marts
* ``tessera.plans``     the spec-driven layer loads and the registered queries
* ``tessera.streaming`` the same cleaning applied to files as they land

Everything is built from Spark SQL built-in expressions; no Python UDF runs.
"""

__version__ = "0.1.0"
