"""tallyflow: payment/order stream analytics as Spark DataFrame operators.

Every operator is a DataFrame-in, DataFrame-out function built from
``pyspark.sql.functions`` so Catalyst can push filters and prune columns
into the parquet scan, and the same operator runs on batch and on
Structured Streaming frames where Spark allows it.
"""

from tallyflow.session import build_session, configure, shared_path

__all__ = ["build_session", "configure", "shared_path"]
