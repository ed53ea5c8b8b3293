"""strata: layered (raw -> clean -> dimensional -> marts) analytics on Spark.

Every operator is a plain function over DataFrames; nothing is executed until
the caller acts on the result.  Sub-packages:

* ``sources``    table scans, raw feed shapes, CSV file feeds
* ``functions``  column expressions (hashes, exact rounding, dates)
* ``operators``  reusable table operators, quality checks, history/CDC, ranks
* ``plans``      the concrete clean / dimensional / mart queries
* ``streaming``  Structured Streaming ingest and change application
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
