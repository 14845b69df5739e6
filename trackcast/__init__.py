"""trackcast: predict song downloads from artist and title, built on Spark DataFrames.

Layout
------
``functions``  scalar ``Column`` builders (cleaning, parsing, popularity, ...)
``sources``    readers for the delimited inputs and the test-table mappings
``operators``  relational building blocks (artist aggregates, terms, lookups, profiling)
``plans``      end-to-end jobs (feature tables, training matrix, training, scoring, report)
``streaming``  request scoring as a Structured Streaming query
``sinks``      writers for intermediate tables, feature files, averages and metrics
``catalog``    the registered queries used by ``__spark_entry__``
"""

__all__ = ["session"]
