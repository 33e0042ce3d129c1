"""D: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import cents, from_cents, sum_cents
from ..operators.relational import broadcast_small
from ..sources import tables
from ..sources.writers import stage
from .common import URGENT_SQL, urgent_orders
from .registry import query


@query("category_revenue", sql="""
SELECT p.p_type AS category,
       COUNT(DISTINCT l.l_orderkey) AS n_sales,
       CAST(SUM(l.l_quantity) AS BIGINT) AS units_sold,
       CAST(SUM(CAST(round(l.l_extendedprice * 100) AS BIGINT)) / 100.0 AS DOUBLE) AS revenue
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY p.p_type
""")
def category_revenue(spark, sf_dir):
    """Distinct sales, units and revenue per category.

    The order join of the source view only re-reads ``venda_id``, which the
    item row already carries under a declared foreign key, so it is dropped
    (join elimination): at scale that saves a full shuffle of both fact tables.
    """
    t = tables(spark, sf_dir)
    items = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    parts = t.part.select("p_partkey", F.col("p_type").alias("category"))
    return (items.join(parts, items.l_partkey == parts.p_partkey)
            .groupBy("category")
            .agg(F.countDistinct("l_orderkey").alias("n_sales"),
                 F.sum("l_quantity").cast("long").alias("units_sold"),
                 from_cents(sum_cents(cents("l_extendedprice"))).alias("revenue")))


@query("agg_global", sql="""
SELECT COUNT(*) AS n_lines, COUNT(DISTINCT o.o_custkey) AS n_customers
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""")
def agg_global(spark, sf_dir):
    """COUNT(*) and COUNT(DISTINCT) over a join. Lines are counted per
    order first, so the join carries one row per order."""
    t = tables(spark, sf_dir)
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = t.orders.select("o_orderkey", "o_custkey")
    j = per_order.join(o, per_order.l_orderkey == o.o_orderkey)
    return j.agg(F.sum("n").cast("long").alias("n_lines"), F.countDistinct("o_custkey").alias("n_customers"))


@query("agg_group_count", sql="""
SELECT n.n_name AS nation, COUNT(c.c_custkey) AS n_customers
FROM nation n JOIN customer c ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name ORDER BY n_customers DESC
""")
def agg_group_count(spark, sf_dir):
    """Count per group (partial + final hash aggregate), sorted."""
    t = tables(spark, sf_dir)
    cnt = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    n = t.nation.select("n_nationkey", "n_name")
    return (cnt.join(broadcast_small(n), cnt.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("nation")).agg(F.sum("n").cast("long").alias("n_customers"))
            .orderBy(F.col("n_customers").desc()))


@query("agg_left_zero", sql=f"""
SELECT c.c_name, COUNT(o.o_orderkey) AS n_urgent
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
GROUP BY c.c_name
""")
def agg_left_zero(spark, sf_dir):
    """D3: COUNT(col) over a left join counts 0 for unmatched groups."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    # count per key before the join: the join then sees one row per customer
    o = urgent_orders(spark, sf_dir).groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return (c.join(o, c.c_custkey == o.o_custkey, "left")
            .groupBy("c_name").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_urgent")))


@query("agg_having", sql="""
SELECT c.c_mktsegment, COUNT(o.o_orderkey) AS n_orders
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
WHERE o.o_orderpriority = '1-URGENT'
GROUP BY c.c_mktsegment HAVING COUNT(o.o_orderkey) >= 600
""")
def agg_having(spark, sf_dir):
    """HAVING is a filter after the aggregate."""
    t = tables(spark, sf_dir)
    o = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = t.customer.select("c_custkey", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment")
            .agg(F.sum("n").cast("long").alias("n_orders")).filter(F.col("n_orders") >= 600))


@query("agg_where_having", sql="""
SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'
GROUP BY l_returnflag, l_linestatus HAVING COUNT(*) >= 1000
""")
def agg_where_having(spark, sf_dir):
    """WHERE before (pushed to the scan) and HAVING after the aggregate."""
    l = tables(spark, sf_dir).lineitem
    return (l.filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
            .groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n_lines"))
            .filter(F.col("n_lines") >= 1000))


@query("monthly_order_stats", sql="""
SELECT year(o_orderdate) AS yr, month(o_orderdate) AS mon, COUNT(*) AS n_orders,
       CAST(sign(SUM(CAST(round(o_totalprice * 100) AS BIGINT)))
            * floor((2 * abs(SUM(CAST(round(o_totalprice * 100) AS BIGINT))) + COUNT(*)) / (2 * COUNT(*)))
            AS DOUBLE) / 100 AS avg_value
FROM orders GROUP BY 1, 2
""")
def monthly_order_stats(spark, sf_dir):
    """Per month count and ROUND(AVG(value), 2) in exact cents."""
    from ..operators.aggregates import monthly_stats

    return monthly_stats(tables(spark, sf_dir).orders, "o_orderdate", "o_totalprice")


@query("agg_listagg", sql="""
SELECT n.n_name AS nation, string_agg(DISTINCT c.c_mktsegment, ', ' ORDER BY c.c_mktsegment) AS segments
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name
""")
def agg_listagg(spark, sf_dir):
    """Ordered string aggregate (LISTAGG ... WITHIN GROUP). The list holds
    distinct values of a bounded domain, built by a partial (map-side) set
    aggregate, so a hot group never gathers its raw rows in one task."""
    from ..operators.aggregates import ordered_distinct_list

    t = tables(spark, sf_dir)
    per = ordered_distinct_list(t.customer, ["c_nationkey"], "c_mktsegment", ", ", "segments")
    n = t.nation.select("n_nationkey", F.col("n_name").alias("nation"))
    return per.join(broadcast_small(n), per.c_nationkey == n.n_nationkey).select("nation", "segments")


@query("agg_list_titles", sql="""
SELECT p_type AS category, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands
FROM part GROUP BY p_type
""")
def agg_list_titles(spark, sf_dir):
    """The source's unordered list (cursor-built), with an order added so
    it repeats. Listed are the publishers (brands) of each category: a domain
    of 25 values by the TPC-H spec, so the list stays bounded as data grows
    (titles, unbounded, would gather a whole category into one row)."""
    from ..operators.aggregates import ordered_distinct_list

    p = tables(spark, sf_dir).part
    return ordered_distinct_list(p, ["p_type"], "p_brand", ", ", "brands").withColumnRenamed("p_type", "category")


@query("order_totals", sql="""
SELECT o.o_orderkey,
       CAST(COALESCE(SUM(CAST(round(l.l_extendedprice * 100) AS BIGINT)), 0) AS DOUBLE) / 100 AS returned_value
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R'
GROUP BY o.o_orderkey
""")
def order_totals(spark, sf_dir):
    """Order total from its items, 0 when none: aggregate the items
    once, then a left join (no function call per order)."""
    t = tables(spark, sf_dir)
    items = (t.lineitem.filter(F.col("l_returnflag") == "R")
             .groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("c")))
    o = t.orders.select("o_orderkey")
    return (o.join(items, o.o_orderkey == items.l_orderkey, "left")
            .select("o_orderkey", from_cents(F.coalesce("c", F.lit(0))).alias("returned_value")))


@query("stock_value", sql="""
SELECT p_type AS category,
       CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2)) * p_size) AS DOUBLE) AS stock_value
FROM part GROUP BY p_type
""")
def stock_value(spark, sf_dir):
    """SUM(price * stock) per category (p_size stands for stock)."""
    from ..operators.aggregates import stock_value_by

    return stock_value_by(tables(spark, sf_dir).part, "p_type", "p_retailprice", "p_size")


@query("agg_filtered_count", sql="""
SELECT COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_finished,
       COUNT(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS n_finished_urgent
FROM orders
""")
def agg_filtered_count(spark, sf_dir):
    """Counts on selective equality filters in one scan."""
    o = tables(spark, sf_dir).orders
    f = F.col("o_orderstatus") == "F"
    return o.agg(F.count(F.when(f, 1)).alias("n_finished"),
                 F.count(F.when(f & (F.col("o_orderpriority") == "1-URGENT"), 1)).alias("n_finished_urgent"))


@query("monthly_volume_class", sql="""
WITH m AS (
  SELECT c.c_nationkey, strftime(o.o_orderdate, '%Y-%m') AS ym, COUNT(*) AS n_orders
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY 1, 2)
SELECT c_nationkey, ym, n_orders,
       CASE WHEN n_orders > 20 THEN 'ALTO' WHEN n_orders >= 10 THEN 'MEDIO' ELSE 'BAIXO' END AS class_if,
       CASE WHEN n_orders = 0 THEN 'SEM PEDIDOS' WHEN n_orders < 10 THEN 'BAIXO'
            WHEN n_orders <= 20 THEN 'MEDIO' ELSE 'ALTO' END AS class_case
FROM m
""")
def monthly_volume_class(spark, sf_dir):
    """Monthly volume classes in both the IF and the CASE forms."""
    from ..operators.aggregates import volume_classes

    t = tables(spark, sf_dir)
    o = t.orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(
        F.count(F.lit(1)).alias("n"))
    c = t.customer.select("c_custkey", "c_nationkey")
    m = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey", "ym")
         .agg(F.sum("n").cast("long").alias("n_orders")))
    return volume_classes(m, "n_orders")


@query("table_profile", sql="""
SELECT 'o_custkey' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(o_custkey) AS n_nulls,
       COUNT(DISTINCT o_custkey) AS n_distinct, CAST(MIN(o_custkey) AS VARCHAR) AS min_value,
       CAST(MAX(o_custkey) AS VARCHAR) AS max_value,
       ROUND(COUNT(DISTINCT o_custkey) / NULLIF(COUNT(*), 0), 6) AS distinct_ratio FROM orders
UNION ALL
SELECT 'o_orderstatus', COUNT(*), COUNT(*) - COUNT(o_orderstatus), COUNT(DISTINCT o_orderstatus),
       MIN(o_orderstatus), MAX(o_orderstatus),
       ROUND(COUNT(DISTINCT o_orderstatus) / NULLIF(COUNT(*), 0), 6) FROM orders
UNION ALL
SELECT 'o_orderpriority', COUNT(*), COUNT(*) - COUNT(o_orderpriority), COUNT(DISTINCT o_orderpriority),
       MIN(o_orderpriority), MAX(o_orderpriority),
       ROUND(COUNT(DISTINCT o_orderpriority) / NULLIF(COUNT(*), 0), 6) FROM orders
""")
def table_profile(spark, sf_dir):
    """Column profile (ANALYZE re-aimed) in one pass over the table."""
    from ..operators.aggregates import column_profile

    return column_profile(tables(spark, sf_dir).orders, ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("profile_sketches", sql="""
SELECT c AS column_name, n AS n_rows, nn AS n_nulls, top, true AS distinct_close, true AS median_close FROM (
  SELECT 'l_quantity' AS c, COUNT(*) AS n, COUNT(*) - COUNT(l_quantity) AS nn, CAST(NULL AS VARCHAR) AS top FROM lineitem
  UNION ALL SELECT 'l_extendedprice', COUNT(*), COUNT(*) - COUNT(l_extendedprice), NULL FROM lineitem
  UNION ALL SELECT 'l_partkey', COUNT(*), COUNT(*) - COUNT(l_partkey), NULL FROM lineitem
  UNION ALL SELECT 'l_returnflag', COUNT(*), COUNT(*) - COUNT(l_returnflag),
    (SELECT l_returnflag FROM lineitem GROUP BY l_returnflag ORDER BY COUNT(*) DESC, l_returnflag LIMIT 1) FROM lineitem) x
""")
def profile_sketches(spark, sf_dir):
    """D15 by mergeable sketches: one stored row per year and column, merged;
    the estimates of distinct values (within 5 %) and of the median (within 4 %
    in rank) are held against exact figures."""
    from ..operators import profile as P

    l = tables(spark, sf_dir).lineitem
    cols = ["l_quantity", "l_extendedprice", "l_partkey", "l_returnflag"]
    stored = P.sketch(l.withColumn("ano", F.year("l_shipdate")), cols, ["ano"])
    _, seen = stage(P.describe(P.merge(stored), points=(0.5,), top=1), "profile")
    est = {r["column_name"]: r for r in seen.collect()}   # one row per column
    checks = []
    for c in cols:
        median = est[c]["quantiles"][0] if est[c]["quantiles"] else None
        below, at = (F.count(F.when(F.col(c) < median, 1)), F.count(F.when(F.col(c) <= median, 1))) if median is not None else (F.lit(0), F.lit(0))
        n = F.count(c)
        ok = F.lit(True) if median is None else (below <= 0.54 * n) & (at >= 0.46 * n)
        checks += [ok.alias(f"m_{c}"), F.count_distinct(c).alias(f"d_{c}")]
    exact = l.agg(*checks)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m_{c}").alias("median_close"), F.col(f"d_{c}").alias("_d")) for c in cols])
    j = seen.join(exact.select(F.inline(rows)), "column_name")
    near = F.abs(F.col("n_distinct") - F.col("_d")) <= 0.05 * F.col("_d") + 1
    return j.select("column_name", "n_rows", "n_nulls", F.when(F.col("column_name") == "l_returnflag", F.get("frequent", 0)["item"]).alias("top"),
                    near.alias("distinct_close"), "median_close")


def _month_sql(label: str, year: int, month: int) -> str:
    c = "CAST(round(o_totalprice * 100) AS BIGINT)"
    return f"""SELECT '{label}' AS mes, COUNT(*) AS n_orders,
       COALESCE(CAST(sign(SUM({c})) * floor((2 * abs(SUM({c})) + COUNT(*)) / NULLIF(2 * COUNT(*), 0)) AS DOUBLE) / 100,
                0.0) AS avg_value
FROM orders WHERE year(o_orderdate) = {year} AND month(o_orderdate) = {month}"""


@query("monthly_order_summary", sql=_month_sql("1998-03", 1998, 3) + "\nUNION ALL\n" + _month_sql("2010-01", 2010, 1))
def monthly_order_summary(spark, sf_dir):
    """The procedure form -- IN (year, month), OUT (count, average):
    one row per call, COALESCE(ROUND(AVG), 2), 0) when the month has no order."""
    from ..operators.aggregates import month_summary

    o = tables(spark, sf_dir).orders
    a = month_summary(o, "o_orderdate", "o_totalprice", 1998, 3).select(F.lit("1998-03").alias("mes"), "*")
    b = month_summary(o, "o_orderdate", "o_totalprice", 2010, 1).select(F.lit("2010-01").alias("mes"), "*")
    return a.unionByName(b)


@query("monthly_any_year_summary", sql="""
SELECT CAST(m.mon AS INTEGER) AS mon, COUNT(o.o_orderkey) AS n_orders,
       COALESCE(CAST(sign(SUM(CAST(round(o_totalprice * 100) AS BIGINT)))
         * floor((2 * abs(SUM(CAST(round(o_totalprice * 100) AS BIGINT))) + COUNT(o.o_orderkey))
                 / NULLIF(2 * COUNT(o.o_orderkey), 0)) AS DOUBLE) / 100, 0.0) AS avg_value
FROM range(1, 13) m(mon) LEFT JOIN orders o ON month(o.o_orderdate) = m.mon
GROUP BY m.mon
""")
def monthly_any_year_summary(spark, sf_dir):
    """The procedure takes a month only: that month of any year."""
    from ..operators.aggregates import any_year_summary

    return any_year_summary(tables(spark, sf_dir).orders, "o_orderdate", "o_totalprice")
