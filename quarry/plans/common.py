"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables

# Fixed values of the test-data stand-ins: urgent orders since
# 2001 leave customers without a match, so outer and anti joins have work.
URGENT = "1-URGENT"
URGENT_SINCE = "2001-01-01"
URGENT_SQL = "o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2001-01-01'"


def urgent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables(spark, sf_dir).orders
    return o.filter((F.col("o_orderpriority") == URGENT)
                    & (F.col("o_orderdate") >= F.lit(URGENT_SINCE).cast("timestamp_ntz")))


def sql_with_views(spark: SparkSession, sf_dir: str, text: str, names, args=None) -> DataFrame:
    """Run Spark SQL over temp views of the named tables."""
    t = tables(spark, sf_dir)
    t.register_views(names)
    return spark.sql(text, args=args) if args else spark.sql(text)
