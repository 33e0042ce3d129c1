"""C: joins and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import money
from ..operators.overlap import conflict_counts, overlap_counts
from ..operators.relational import broadcast_small, outer_join, quantified
from ..sources import tables
from .common import URGENT_SQL, urgent_orders
from .registry import query


@query("join_inner_multi", sql="""
SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, c.c_name, n.n_name, l.l_extendedprice
FROM lineitem l
JOIN orders o   ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n   ON n.n_nationkey = c.c_nationkey
""")
def join_inner_multi(spark, sf_dir):
    """4-way inner join. nation is a fixed 25-row dimension (broadcast);
    the fact joins are left to AQE (sort-merge, or broadcast when the runtime
    size of a side is under the threshold)."""
    t = tables(spark, sf_dir)
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    cn = c.join(broadcast_small(n), c.c_nationkey == n.n_nationkey)
    return (l.join(o, l.l_orderkey == o.o_orderkey)
            .join(cn, F.col("o_custkey") == F.col("c_custkey"))
            .select("l_orderkey", "l_linenumber", "o_orderdate", "c_name", "n_name", "l_extendedprice"))


@query("view_catalog", sql="""
SELECT DISTINCT p.p_partkey, p.p_name, s.s_name AS supplier, n.n_name AS nation, p.p_type AS category,
       p.p_retailprice
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) ps
JOIN part p     ON p.p_partkey = ps.l_partkey
JOIN supplier s ON s.s_suppkey = ps.l_suppkey
JOIN nation n   ON n.n_nationkey = s.s_nationkey
""")
def view_catalog(spark, sf_dir):
    """Catalogue view over four tables, registered as a temp view."""
    t = tables(spark, sf_dir)
    ps = t.lineitem.select(F.col("l_partkey"), F.col("l_suppkey")).distinct()
    s = t.supplier.select("s_suppkey", F.col("s_name").alias("supplier"), "s_nationkey")
    n = t.nation.select("n_nationkey", F.col("n_name").alias("nation"))
    p = t.part.select("p_partkey", "p_name", F.col("p_type").alias("category"), "p_retailprice")
    v = (ps.join(p, ps.l_partkey == p.p_partkey)
         .join(s, F.col("l_suppkey") == s.s_suppkey)
         .join(broadcast_small(n), F.col("s_nationkey") == n.n_nationkey)
         .select("p_partkey", "p_name", "supplier", "nation", "category", "p_retailprice"))
    v.createOrReplaceTempView("vw_catalog")
    return spark.table("vw_catalog")


@query("view_sale_detail", sql="""
SELECT o.o_orderkey, o.o_orderdate, c.c_name AS customer, p.p_name AS item, l.l_quantity,
       p.p_retailprice AS unit_price,
       CAST(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS subtotal
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p     ON p.p_partkey = l.l_partkey
""")
def view_sale_detail(spark, sf_dir):
    """Sale detail view with an exact decimal subtotal."""
    t = tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_orderdate", "o_custkey")
    c = t.customer.select("c_custkey", F.col("c_name").alias("customer"))
    l = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    p = t.part.select("p_partkey", F.col("p_name").alias("item"), "p_retailprice")
    v = (l.join(o, l.l_orderkey == o.o_orderkey)
         .join(c, F.col("o_custkey") == c.c_custkey)
         .join(p, F.col("l_partkey") == p.p_partkey)
         .select("o_orderkey", "o_orderdate", "customer", "item", "l_quantity",
                 F.col("p_retailprice").alias("unit_price"),
                 (money("l_quantity") * money("p_retailprice")).cast("double").alias("subtotal")))
    v.createOrReplaceTempView("vw_sale_detail")
    return spark.table("vw_sale_detail")


def _cust_urgent(spark, sf_dir, how):
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    return outer_join(c, o, "c_custkey", "o_custkey", how).select("c_name", "o_orderkey", "o_orderdate")


@query("join_left", sql=f"""
SELECT c.c_name, o.o_orderkey, o.o_orderdate
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
""")
def join_left(spark, sf_dir):
    """Every customer, with its urgent orders or NULLs."""
    return _cust_urgent(spark, sf_dir, "left")


@query("join_left_null_anti", sql=f"""
SELECT c.c_custkey, c.c_name
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
WHERE o.o_orderkey IS NULL
""")
def join_left_null_anti(spark, sf_dir):
    """C4: LEFT JOIN ... IS NULL written as a left anti join (no outer join + filter)."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir).select("o_custkey").distinct()  # one row per key before the shuffle
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti")


@query("join_right", sql=f"""
SELECT c.c_name, o.o_orderkey, o.o_orderdate
FROM (SELECT * FROM orders WHERE {URGENT_SQL}) o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def join_right(spark, sf_dir):
    """Right outer join (customer is the preserved side)."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    return outer_join(o, c, "o_custkey", "c_custkey", "right").select("c_name", "o_orderkey", "o_orderdate")


@query("join_full", sql=f"""
SELECT c.c_name, o.o_orderkey
FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c
FULL OUTER JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
""")
def join_full(spark, sf_dir):
    """Full outer join; both sides keep unmatched rows."""
    c = tables(spark, sf_dir).customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    return outer_join(c, o, "c_custkey", "o_custkey", "full").select("c_name", "o_orderkey")


@query("join_legacy_outer", sql="""
SELECT 'left' AS form, n.n_name, s.s_name
FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey AND s.s_acctbal > 9000
UNION ALL
SELECT 'right' AS form, n.n_name, s.s_name
FROM (SELECT * FROM nation WHERE n_regionkey = 1) n RIGHT JOIN supplier s ON s.s_nationkey = n.n_nationkey
""")
def join_legacy_outer(spark, sf_dir):
    """The two ``(+)`` forms. Left: ``WHERE s.k(+) = n.k AND s.bal(+) > 9000``
    -- a predicate marked (+) belongs to the join condition, so nations without
    a rich supplier stay. Right: ``WHERE s.k = n.k(+) AND n.region(+) = 1`` --
    every supplier, with its nation only when that nation is in region 1."""
    t = tables(spark, sf_dir)
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    rich = t.supplier.filter(F.col("s_acctbal") > 9000).select("s_nationkey", "s_name")
    left = outer_join(n.select("n_nationkey", "n_name"), rich, "n_nationkey", "s_nationkey", "left")
    n1 = n.filter(F.col("n_regionkey") == 1).select("n_nationkey", "n_name")
    right = outer_join(n1, t.supplier.select("s_nationkey", "s_name"), "n_nationkey", "s_nationkey", "right")
    return (left.select(F.lit("left").alias("form"), "n_name", "s_name")
            .unionByName(right.select(F.lit("right").alias("form"), "n_name", "s_name")))


@query("join_cross", sql="SELECT r.r_name, n.n_name FROM region r CROSS JOIN nation n")
def join_cross(spark, sf_dir):
    """Cross product of two fixed-size dimensions (5 x 25 rows by the
    TPC-H spec); the smaller is broadcast. Never applied to growing tables."""
    t = tables(spark, sf_dir)
    return t.nation.select("n_name").crossJoin(broadcast_small(t.region.select("r_name"))).select("r_name", "n_name")


@query("join_lateral", sql=f"""
SELECT c.c_custkey, c.c_name, x.n_urgent, x.statuses
FROM customer c
LEFT JOIN LATERAL (
  SELECT COUNT(*) AS n_urgent, string_agg(DISTINCT o.o_orderstatus, ',' ORDER BY o.o_orderstatus) AS statuses
  FROM orders o WHERE o.o_custkey = c.c_custkey AND o.{URGENT_SQL.replace(' AND ', ' AND o.')}
) x ON TRUE
""")
def join_lateral(spark, sf_dir):
    """LEFT JOIN LATERAL with a per-row aggregate = aggregate per key, then
    a left join (COUNT of nothing is 0, the list is NULL)."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir)
    agg = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_urgent"),
        F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"))
    return (c.join(agg, c.c_custkey == agg.o_custkey, "left")
            .select("c_custkey", "c_name", F.coalesce("n_urgent", F.lit(0)).alias("n_urgent"), "statuses"))


@query("semi_in", sql=f"""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {URGENT_SQL})
""")
def semi_in(spark, sf_dir):
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir).select("o_custkey").distinct()  # one row per key before the shuffle
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi")


@query("semi_exists", sql="""
SELECT c.c_custkey, c.c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
              AND o.o_orderstatus = 'P' AND o.o_totalprice > c.c_acctbal * 100)
""")
def semi_exists(spark, sf_dir):
    """C11: correlated EXISTS with a non-equi term. ``EXISTS (o.total > x)``
    holds exactly when ``max(o.total) > x``, so the orders are reduced to one
    row per customer (map-side) before a semi join on unique keys."""
    t = tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_name", "c_acctbal")
    o = (t.orders.filter(F.col("o_orderstatus") == "P")
         .groupBy("o_custkey").agg(F.max("o_totalprice").alias("max_total")))
    return (c.join(o, (o.o_custkey == c.c_custkey) & (o.max_total > c.c_acctbal * 100), "left_semi")
            .select("c_custkey", "c_name"))


@query("anti_not_exists", sql="""
SELECT c.c_custkey, c.c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
                  WHERE o.o_custkey = c.c_custkey AND l.l_returnflag = 'R'
                    AND l.l_shipdate >= TIMESTAMP '2000-01-01')
""")
def anti_not_exists(spark, sf_dir):
    """NOT EXISTS over a joined subquery = anti join on the pre-joined side."""
    t = tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_name")
    l = (t.lineitem.filter((F.col("l_returnflag") == "R")
                           & (F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))
         .select("l_orderkey").distinct())
    o = t.orders.select("o_orderkey", "o_custkey")
    bad = o.join(l, o.o_orderkey == l.l_orderkey, "left_semi").select("o_custkey").distinct()
    return c.join(bad, c.c_custkey == bad.o_custkey, "left_anti")


@query("scalar_subquery", sql=f"""
SELECT c.c_custkey, c.c_name,
       (SELECT COUNT(*) FROM orders o WHERE o.o_custkey = c.c_custkey
          AND o.{URGENT_SQL.replace(' AND ', ' AND o.')}) AS n_urgent
FROM customer c
""")
def scalar_subquery(spark, sf_dir):
    """Correlated COUNT(*) -> aggregate + left join + coalesce(…, 0)."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    cnt = urgent_orders(spark, sf_dir).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return (c.join(cnt, c.c_custkey == cnt.o_custkey, "left")
            .select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("n_urgent")))


@query("quantified_any", sql="""
SELECT c_custkey, c_acctbal FROM customer
WHERE c_acctbal > ANY (SELECT c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3)
""")
def quantified_any(spark, sf_dir):
    """C14: ``> ANY`` = greater than the set minimum (with SQL NULL rules)."""
    c = tables(spark, sf_dir).customer
    s = c.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 3))
    return quantified(c.select("c_custkey", "c_acctbal"), "c_acctbal", s, "c_acctbal", ">", "ANY")


@query("quantified_all", sql="""
SELECT c_custkey, c_acctbal FROM customer
WHERE c_acctbal > ALL (SELECT c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3)
""")
def quantified_all(spark, sf_dir):
    """``> ALL`` = greater than the set maximum; TRUE on an empty set."""
    c = tables(spark, sf_dir).customer
    s = c.filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 3))
    return quantified(c.select("c_custkey", "c_acctbal"), "c_acctbal", s, "c_acctbal", ">", "ALL")


@query("quantified_all_empty", sql="""
SELECT c_custkey, c_acctbal FROM customer
WHERE c_acctbal > ALL (SELECT c_acctbal FROM customer WHERE c_mktsegment = 'NO SUCH SEGMENT')
""")
def quantified_all_empty(spark, sf_dir):
    """C15 edge: ALL over an empty set keeps every row."""
    c = tables(spark, sf_dir).customer
    s = c.filter(F.col("c_mktsegment") == "NO SUCH SEGMENT")
    return quantified(c.select("c_custkey", "c_acctbal"), "c_acctbal", s, "c_acctbal", ">", "ALL")


@query("derived_table_avg", sql="""
SELECT c_mktsegment,
       CAST(floor((20 * SUM(n_orders) + COUNT(*)) / (2 * COUNT(*))) AS DOUBLE) / 10 AS avg_orders
FROM (SELECT c.c_mktsegment, c.c_nationkey, COUNT(o.o_orderkey) AS n_orders
      FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
      GROUP BY c.c_mktsegment, c.c_nationkey) sub
GROUP BY c_mktsegment
""")
def derived_table_avg(spark, sf_dir):
    """Aggregate of an aggregate; ROUND(AVG(n), 1) half-up in integer math."""
    t = tables(spark, sf_dir)
    o = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))  # pre-aggregate the fact
    c = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    sub = (c.join(o, c.c_custkey == o.o_custkey)
           .groupBy("c_mktsegment", "c_nationkey").agg(F.sum("n").alias("n_orders")))
    s, n = F.sum("n_orders"), F.count(F.lit(1))
    return sub.groupBy("c_mktsegment").agg((F.call_function("div", s * 20 + n, n * 2).cast("decimal(19,0)") * F.lit("0.1").cast("decimal(1,1)")).alias("avg_orders"))


@query("cte_absences", sql=f"""
WITH urgent_per_customer AS (
  SELECT c.c_name, COUNT(o.o_orderkey) AS n_urgent
  FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
  GROUP BY c.c_name)
SELECT c_name, n_urgent FROM urgent_per_customer WHERE n_urgent > 0
""")
def cte_absences(spark, sf_dir):
    """C17: a named sub-result (CTE) reused by the outer query; grouping by
    name merges namesakes exactly as the source does."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    per = (c.join(o, c.c_custkey == o.o_custkey, "left")
           .groupBy("c_name").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_urgent")))
    return per.filter(F.col("n_urgent") > 0)


@query("overlap_conflicts", sql="""
WITH live AS (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'error')
SELECT a.event_id, a.user_id, a.ts, COUNT(*) AS n_conflicts
FROM live a JOIN live b
  ON a.user_id = b.user_id AND a.event_id <> b.event_id
 AND b.ts < a.ts + INTERVAL 30 MINUTE AND a.ts < b.ts + INTERVAL 30 MINUTE
GROUP BY a.event_id, a.user_id, a.ts
""")
def overlap_conflicts(spark, sf_dir):
    """Double bookings of the same key (user = doctor), 30-minute
    half-open slots, cancelled ones ('error' stands for CANCELADA) excluded.
    Reports each conflicting slot with its number of overlapping partners,
    computed by a distributed sort and rank probes (no pair list)."""
    e = tables(spark, sf_dir).events.filter(F.col("event_type") != "error").select("event_id", "user_id", "ts")
    return conflict_counts(e, "user_id", "ts", "event_id", 30).select("event_id", "user_id", "ts", "n_conflicts")


@query("overlap_slots", sql="""
WITH slot AS (SELECT event_id, user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS dia, ts AS starts,
                     ts + to_minutes(CAST(floor(value) AS INTEGER)) AS ends
              FROM events WHERE event_type <> 'error' AND value >= 1)
SELECT a.event_id, a.user_id, a.dia, a.starts, a.ends, COUNT(*) AS n_conflicts
FROM slot a JOIN slot b ON a.user_id = b.user_id AND a.dia = b.dia AND a.event_id <> b.event_id
 AND a.starts < b.ends AND b.starts < a.ends
GROUP BY a.event_id, a.user_id, a.dia, a.starts, a.ends
""")
def overlap_slots(spark, sf_dir):
    """C21, room booking form: slots with a start and an end of their own, same
    room (user) and day; each slot with its number of overlapping partners."""
    e = tables(spark, sf_dir).events.filter((F.col("event_type") != "error") & (F.col("value") >= 1))
    slot = e.select("event_id", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("dia"),
                    F.col("ts").alias("starts"),
                    (F.col("ts") + F.expr("make_dt_interval(0, 0, CAST(floor(value) AS INT))")).alias("ends"))
    return overlap_counts(slot, ["user_id", "dia"], "starts", "ends", "event_id")


@query("join_hint", sql="""
SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
""")
def join_hint(spark, sf_dir):
    """``USE_HASH`` -> ``shuffle_hash`` hint: same rows, a hash join plan."""
    t = tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_name").hint("shuffle_hash")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")


@query("join_role_alias", sql="""
SELECT sn.n_name AS supplier_nation, cn.n_name AS customer_nation, COUNT(*) AS n_lines
FROM lineitem l
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation sn  ON sn.n_nationkey = s.s_nationkey
JOIN orders o   ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
GROUP BY sn.n_name, cn.n_name
""")
def join_role_alias(spark, sf_dir):
    """One table (nation) in two roles under two aliases, the optional
    role as a left join. Facts are reduced to (supplier, customer) counts
    before the dimension joins."""
    t = tables(spark, sf_dir)
    l = t.lineitem.select("l_orderkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    pairs = (l.join(o, l.l_orderkey == o.o_orderkey)
             .groupBy("l_suppkey", "o_custkey").agg(F.count(F.lit(1)).alias("n")))
    s = t.supplier.select("s_suppkey", "s_nationkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    sn = t.nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("supplier_nation"))
    cn = t.nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("customer_nation"))
    return (pairs.join(s, pairs.l_suppkey == s.s_suppkey)
            .join(c, F.col("o_custkey") == c.c_custkey)
            .join(broadcast_small(sn), F.col("s_nationkey") == F.col("sn_key"))
            .join(broadcast_small(cn), F.col("c_nationkey") == F.col("cn_key"), "left")
            .groupBy("supplier_nation", "customer_nation").agg(F.sum("n").alias("n_lines")))


@query("join_subtypes", sql="""
SELECT n.n_nationkey, n.n_name,
       COALESCE(s.n_sup, 0) AS n_suppliers, COALESCE(c.n_cust, 0) AS n_customers,
       CASE WHEN s.n_sup IS NOT NULL AND c.n_cust IS NOT NULL THEN 'both'
            WHEN s.n_sup IS NOT NULL THEN 'supplier'
            WHEN c.n_cust IS NOT NULL THEN 'customer' ELSE 'none' END AS kind
FROM nation n
LEFT JOIN (SELECT s_nationkey, COUNT(*) AS n_sup FROM supplier GROUP BY s_nationkey) s ON s.s_nationkey = n.n_nationkey
LEFT JOIN (SELECT c_nationkey, COUNT(*) AS n_cust FROM customer GROUP BY c_nationkey) c ON c.c_nationkey = n.n_nationkey
""")
def join_subtypes(spark, sf_dir):
    """Supertype with optional subtypes sharing its key: left joins of
    the pre-aggregated subtype tables plus a type flag."""
    t = tables(spark, sf_dir)
    s = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_sup"))
    c = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_cust"))
    n = t.nation.select("n_nationkey", "n_name")
    j = (n.join(s, n.n_nationkey == s.s_nationkey, "left").join(c, n.n_nationkey == c.c_nationkey, "left"))
    kind = (F.when(F.col("n_sup").isNotNull() & F.col("n_cust").isNotNull(), "both")
            .when(F.col("n_sup").isNotNull(), "supplier")
            .when(F.col("n_cust").isNotNull(), "customer").otherwise("none"))
    return j.select("n_nationkey", "n_name", F.coalesce("n_sup", F.lit(0)).alias("n_suppliers"),
                    F.coalesce("n_cust", F.lit(0)).alias("n_customers"), kind.alias("kind"))
