"""tidemark: turn a stream or table of records into batches, features, models and answers on Spark.

Sub-packages
------------
sources    line / CSV / Parquet / stream sources and sinks
functions  column-level helpers (strip, safe casts, vector arithmetic with higher-order functions)
operators  DataFrame -> DataFrame operators (label maps, assembly, regression, k-means, similarity,
           batching, requests)
streaming  Structured Streaming forms (file line stream, elapsed-time cutter, windowed counts)
plans      the query catalogue over the test tables and its SQL oracle
"""

__version__ = "0.1.0"
