"""B: projections and filters; F: sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import asc_sql, desc_sql, money
from ..operators.relational import not_in, outer_join, with_scalars
from ..sources import tables
from .common import URGENT_SQL, sql_with_views, urgent_orders
from .registry import query


@query("project_alias", sql="""
SELECT p_partkey AS id, p_name AS title, p_brand AS publisher, p_retailprice AS price FROM part
""")
def project_alias(spark, sf_dir):
    p = tables(spark, sf_dir).part
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
                    F.col("p_brand").alias("publisher"), F.col("p_retailprice").alias("price"))


@query("computed_discount", sql="""
SELECT p_partkey AS id, p_retailprice AS price,
       CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 0.9, 2) AS DOUBLE) AS price_discounted,
       CAST(CAST(p_retailprice AS DECIMAL(18,2)) * p_size AS DOUBLE) AS stock_value
FROM part
""")
def computed_discount(spark, sf_dir):
    """Exact decimal arithmetic, ROUND half-up."""
    p = tables(spark, sf_dir).part
    return p.select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"),
                    F.round(money("p_retailprice") * F.lit(0.9).cast("decimal(2,1)"), 2)
                    .cast("double").alias("price_discounted"),
                    (money("p_retailprice") * F.col("p_size")).cast("double").alias("stock_value"))


@query("filter_compare", sql="""
SELECT p_partkey, p_name, p_type, p_retailprice FROM part
WHERE p_type = 'SMALL' AND p_retailprice > 950
""")
def filter_compare(spark, sf_dir):
    p = tables(spark, sf_dir).part
    return (p.filter((F.col("p_type") == "SMALL") & (F.col("p_retailprice") > 950))
            .select("p_partkey", "p_name", "p_type", "p_retailprice"))


@query("filter_between", sql="""
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderstatus = 'F'
  AND o_orderdate BETWEEN TIMESTAMP '1996-06-01' AND TIMESTAMP '1996-06-07 23:59:59'
  AND o_totalprice BETWEEN 100000 AND 300000
""")
def filter_between(spark, sf_dir):
    """BETWEEN is inclusive at both ends; both terms reach the scan."""
    o = tables(spark, sf_dir).orders
    lo, hi = F.lit("1996-06-01 00:00:00"), F.lit("1996-06-07 23:59:59")
    return (o.filter((F.col("o_orderstatus") == "F")
                     & F.col("o_orderdate").between(lo.cast("timestamp_ntz"), hi.cast("timestamp_ntz"))
                     & F.col("o_totalprice").between(100000, 300000))
            .select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"))


@query("filter_in", sql="SELECT p_partkey, p_size FROM part WHERE p_size IN (1, 5, 10, 42)")
def filter_in(spark, sf_dir):
    p = tables(spark, sf_dir).part
    return p.filter(F.col("p_size").isin(1, 5, 10, 42)).select("p_partkey", "p_size")


@query("filter_like", sql="""
SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt%'
""")
def filter_like(spark, sf_dir):
    """Case-sensitive LIKE; the prefix form pushes down as StringStartsWith."""
    p = tables(spark, sf_dir).part
    return (p.filter(F.col("p_name").like("red%") | F.col("p_name").like("%bolt%"))
            .select("p_partkey", "p_name"))


@query("filter_ilike", sql="""
SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%' OR upper(p_brand) = 'BRAND#7'
""")
def filter_ilike(spark, sf_dir):
    p = tables(spark, sf_dir).part
    return (p.filter(F.col("p_name").ilike("%RED%") | (F.upper("p_brand") == "BRAND#7"))
            .select("p_partkey", "p_name"))


@query("filter_is_null", sql=f"""
SELECT c.c_custkey, c.c_name, o.o_orderkey
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
WHERE o.o_orderkey IS NULL
""")
def filter_is_null(spark, sf_dir):
    """IS NULL on the optional side of a left join."""
    c = tables(spark, sf_dir).customer
    o = urgent_orders(spark, sf_dir).select("o_custkey", "o_orderkey")
    # only customers without a match pass the filter, so the join is an anti
    # join against the distinct keys (an order key itself is never NULL)
    keys = o.filter(F.col("o_orderkey").isNotNull()).select("o_custkey").distinct()
    alone = c.select("c_custkey", "c_name").join(keys, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    return alone.withColumn("o_orderkey", F.lit(None).cast("long"))


@query("filter_not_equal", sql="""
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus <> 'F' AND NOT (o_orderpriority = '5-LOW' OR o_totalprice < 50000)
""")
def filter_not_equal(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    return (o.filter((F.col("o_orderstatus") != "F")
                     & ~((F.col("o_orderpriority") == "5-LOW") | (F.col("o_totalprice") < 50000)))
            .select("o_orderkey", "o_orderstatus", "o_orderpriority"))


@query("null_safe_join", sql=f"""
WITH last_urgent AS (
  SELECT c.c_custkey, c.c_mktsegment, o.o_orderstatus
  FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey),
seg_status AS (
  SELECT DISTINCT c.c_mktsegment, o.o_orderstatus
  FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey)
SELECT s.c_mktsegment, s.o_orderstatus, COUNT(*) AS n_rows
FROM last_urgent l JOIN seg_status s
  ON l.c_mktsegment = s.c_mktsegment AND l.o_orderstatus IS NOT DISTINCT FROM s.o_orderstatus
GROUP BY s.c_mktsegment, s.o_orderstatus
""")
def null_safe_join(spark, sf_dir):
    """``<=>`` matches NULL with NULL where ``=`` would drop the row."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    o = urgent_orders(spark, sf_dir).select("o_custkey", "o_orderstatus")
    lj = outer_join(c, o, "c_custkey", "o_custkey", "left").select("c_custkey", "c_mktsegment", "o_orderstatus")
    dim = lj.select(F.col("c_mktsegment").alias("seg"), F.col("o_orderstatus").alias("st")).distinct()
    return (lj.join(dim, (lj.c_mktsegment == dim.seg) & lj.o_orderstatus.eqNullSafe(dim.st))
            .groupBy(F.col("seg").alias("c_mktsegment"), F.col("st").alias("o_orderstatus"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query("distinct_rows", sql="SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark, sf_dir):
    return tables(spark, sf_dir).orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("not_in_null", sql=f"""
SELECT o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT o.o_custkey FROM customer c
                        LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey)
""")
def not_in_null(spark, sf_dir):
    """NOT IN over a set holding NULL keeps no row (three-valued logic)."""
    t = tables(spark, sf_dir)
    c = t.customer.select("c_custkey")
    o = urgent_orders(spark, sf_dir).select("o_custkey")
    sub = outer_join(c, o, "c_custkey", "o_custkey", "left").select("o_custkey")
    return not_in(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", sub, "o_custkey").select("o_orderkey")


@query("not_in_plain", sql="""
SELECT o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def not_in_plain(spark, sf_dir):
    """B12 without NULLs in the set: an ordinary anti join."""
    t = tables(spark, sf_dir)
    sub = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return not_in(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", sub, "c_custkey").select("o_orderkey")


@query("exists_constant", sql="""
SELECT r_name FROM region
WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey < 0)
  AND EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F')
""")
def exists_constant(spark, sf_dir):
    """Uncorrelated [NOT] EXISTS is a one-row flag, not a join per row."""
    t = tables(spark, sf_dir)
    # the first row found ends the search
    neg = t.nation.filter(F.col("n_regionkey") < 0).limit(1).agg(F.count(F.lit(1)).alias("neg"))
    has_f = t.orders.filter(F.col("o_orderstatus") == "F").limit(1).agg(F.count(F.lit(1)).alias("has_f"))
    flags = with_scalars(neg, has_f)
    return (with_scalars(t.region, flags)
            .filter((F.col("neg") == 0) & (F.col("has_f") > 0)).select("r_name"))


@query("bind_params", sql="""
SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_nationkey = 7 AND s_acctbal > 1000.0
""")
def bind_params(spark, sf_dir):
    """Values travel as named parameters, never spliced into the text."""
    return sql_with_views(
        spark, sf_dir,
        "SELECT s_suppkey, s_name, s_acctbal FROM supplier "
        "WHERE s_nationkey = :nation AND s_acctbal > :min_balance",
        ["supplier"], args={"nation": 7, "min_balance": 1000.0})


@query("case_when", sql="""
SELECT o_orderkey,
       CASE WHEN o_totalprice >= 300000 THEN 'alto'
            WHEN o_totalprice >= 100000 THEN 'medio'
            ELSE 'baixo' END AS price_band,
       CASE o_orderstatus WHEN 'F' THEN 'Finalizado' WHEN 'O' THEN 'Aberto' ELSE 'Parcial' END AS status_label
FROM orders
""")
def case_when(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    band = (F.when(F.col("o_totalprice") >= 300000, "alto")
            .when(F.col("o_totalprice") >= 100000, "medio").otherwise("baixo"))
    st = (F.when(F.col("o_orderstatus") == "F", "Finalizado")
          .when(F.col("o_orderstatus") == "O", "Aberto").otherwise("Parcial"))
    return o.select("o_orderkey", band.alias("price_band"), st.alias("status_label"))


@query("range_overlap_lookup", sql="""
SELECT event_id, user_id, ts FROM events
WHERE user_id = 42
  AND ts < TIMESTAMP '2024-01-10 12:00:00'
  AND ts + INTERVAL 30 MINUTE > TIMESTAMP '2024-01-03 09:00:00'
""")
def range_overlap_lookup(spark, sf_dir):
    """Half-open [ts, ts+30min) && [q_start, q_end).

    Rewritten so the scan sees ``ts < q_end`` and ``ts > q_start - 30min``
    as plain column bounds (pushed to Parquet) instead of an expression on ts.
    """
    from ..operators.overlap import overlaps_literal

    e = tables(spark, sf_dir).events
    return overlaps_literal(e.filter(F.col("user_id") == 42), "ts", 30,
                            "2024-01-03 09:00:00", "2024-01-10 12:00:00").select("event_id", "user_id", "ts")


@query("masked_view", sql="SELECT c_custkey, c_name, c_mktsegment FROM customer")
def masked_view(spark, sf_dir):
    """A view that exposes only non-sensitive columns."""
    c = tables(spark, sf_dir).customer
    c.select("c_custkey", "c_name", "c_mktsegment").createOrReplaceTempView("customer_public")
    return spark.table("customer_public")


@query("sort_multi", sql="""
SELECT p_partkey, p_brand, p_retailprice FROM part ORDER BY p_brand ASC, p_retailprice DESC, p_partkey
""")
def sort_multi(spark, sf_dir):
    """explicit SQL-server NULL placement on every key."""
    p = tables(spark, sf_dir).part
    return (p.select("p_partkey", "p_brand", "p_retailprice")
            .orderBy(asc_sql("p_brand"), desc_sql("p_retailprice"), asc_sql("p_partkey")))


@query("topk", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def topk(spark, sf_dir):
    """ORDER BY + LIMIT plans as TakeOrderedAndProject (per-task top-k)."""
    o = tables(spark, sf_dir).orders
    return (o.select("o_orderkey", "o_custkey", "o_totalprice")
            .orderBy(desc_sql("o_totalprice"), asc_sql("o_orderkey")).limit(10))


@query("topk_agg", sql="""
SELECT s.s_suppkey, s.s_name, COUNT(*) AS n_lines
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE l.l_shipdate >= TIMESTAMP '1999-01-01'
GROUP BY s.s_suppkey, s.s_name
ORDER BY n_lines DESC, s.s_suppkey LIMIT 10
""")
def topk_agg(spark, sf_dir):
    """filter -> aggregate (partial agg before the shuffle) -> join -> top-k.

    The aggregate runs on the fact side before the dimension join, so the
    join sees one row per supplier; the key breaks count ties.
    """
    t = tables(spark, sf_dir)
    counts = (t.lineitem.filter(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
              .groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_lines")))
    s = t.supplier.select("s_suppkey", "s_name")
    return (counts.join(s, counts.l_suppkey == s.s_suppkey)
            .select("s_suppkey", "s_name", "n_lines")
            .orderBy(F.col("n_lines").desc(), F.col("s_suppkey").asc()).limit(10))
