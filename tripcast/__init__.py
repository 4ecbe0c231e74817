"""tripcast: trip-duration analytics and prediction as Spark DataFrame / MLlib /
Structured Streaming operators.

Sub-packages
------------
sources    scans, request parsing, sinks (parquet, models, run records)
functions  column-expression builders (calendar, hashing)
operators  cleaning, features, sampling, aggregates, windows, models
plans      query registry and the equivalent DuckDB SQL used as an oracle
streaming  file-stream ingest, scoring and drift monitoring
"""

__version__ = "0.1.0"
