"""Two-system record sync as Spark jobs.

Every operator is a function from DataFrame to DataFrame built on the public Spark SQL API.  Only
``twinsync.sources.tables`` and ``twinsync.streaming`` touch paths.
"""
