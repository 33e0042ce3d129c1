"""R: temporary SQL functions. Spark inlines SQL UDF bodies into the plan,
so a function that reads a table becomes a join, not a call per row."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_order_value(spark: SparkSession, items_view: str = "lineitem") -> None:
    """order_value(k): total of the order's items in exact cents, 0 if none."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION order_value(k BIGINT) RETURNS DECIMAL(38,2)
        RETURN SELECT CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2))
               FROM {items_view} WHERE l_orderkey = k""")


def register_parts_of_brand(spark: SparkSession, part_view: str = "part") -> None:
    """parts_of_brand(b): a table function (RETURNS TABLE)."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION parts_of_brand(b STRING)
        RETURNS TABLE (p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE)
        RETURN SELECT p_partkey, p_name, p_retailprice FROM {part_view} WHERE p_brand = b""")


def register_sum_to(spark: SparkSession) -> None:
    """sum_to(n) = 1 + ... + n (the loop function); 0 for n < 1."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION sum_to(n INT) RETURNS BIGINT
        RETURN CASE WHEN n < 1 THEN 0L ELSE CAST(n AS BIGINT) * (CAST(n AS BIGINT) + 1) DIV 2 END""")
