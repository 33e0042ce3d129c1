"""R: SQL function surface."""

from __future__ import annotations

from ..functions import sqlfuncs as R
from ..sources import tables
from .registry import query


@query("sql_scalar_udf", sql="""
SELECT o.o_orderkey,
       (SELECT CAST(COALESCE(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)), 0) AS DOUBLE) / 100
        FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS order_value
FROM orders o
""")
def sql_scalar_udf(spark, sf_dir):
    """A scalar SQL function that reads a table, used in a SELECT."""
    tables(spark, sf_dir).register_views(["orders", "lineitem"])
    R.register_order_value(spark)
    return spark.sql("SELECT o_orderkey, order_value(o_orderkey) AS order_value FROM orders")


@query("sql_table_udf", sql="""
SELECT b.p_brand, p.p_partkey, p.p_name, p.p_retailprice
FROM (SELECT DISTINCT p_brand FROM part) b JOIN part p ON p.p_brand = b.p_brand
""")
def sql_table_udf(spark, sf_dir):
    """R2: a table function applied per row of another query (LATERAL)."""
    tables(spark, sf_dir).register_views(["part"])
    R.register_parts_of_brand(spark)
    return spark.sql("""
        SELECT b.p_brand, t.p_partkey, t.p_name, t.p_retailprice
        FROM (SELECT DISTINCT p_brand FROM part) b, LATERAL parts_of_brand(b.p_brand) t""")


@query("sql_loop_udf", sql="""
SELECT p_partkey, p_size, CAST(CASE WHEN p_size < 1 THEN 0 ELSE p_size * (p_size + 1) // 2 END AS BIGINT) AS soma
FROM part
""")
def sql_loop_udf(spark, sf_dir):
    """The loop function 1 + ... + n applied to a column."""
    tables(spark, sf_dir).register_views(["part"])
    R.register_sum_to(spark)
    return spark.sql("SELECT p_partkey, p_size, sum_to(p_size) AS soma FROM part")
