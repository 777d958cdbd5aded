"""starling: a Spark-native change-data sales warehouse.

Change files of four source tables (customers, products, orders, order lines)
become a star schema: bronze CSV -> typed silver Parquet -> stage and fact
tables -> versioned (SCD type 2) customer and product dimensions.

Every transformation is a DataFrame -> DataFrame function built from Spark SQL
expressions, so one function serves batch, incremental (Structured Streaming)
and the SQL oracle tests.
"""

from starling.session import build_session, shared_path

__all__ = ["build_session", "shared_path"]
