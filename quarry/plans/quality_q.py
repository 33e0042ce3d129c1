"""M: constraint checks as data-quality jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cascade as C
from ..operators import quality as M
from ..operators.relational import outer_join
from ..sources import tables
from .common import URGENT_SQL, urgent_orders
from .registry import query


@query("dq_not_null", sql=f"""
WITH j AS (SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_orderdate
           FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey)
SELECT 'c_custkey' AS column_name, COUNT(*) - COUNT(c_custkey) AS n_nulls FROM j
UNION ALL SELECT 'c_name', COUNT(*) - COUNT(c_name) FROM j
UNION ALL SELECT 'o_orderkey', COUNT(*) - COUNT(o_orderkey) FROM j
UNION ALL SELECT 'o_orderdate', COUNT(*) - COUNT(o_orderdate) FROM j
""")
def dq_not_null(spark, sf_dir):
    """M1: NOT NULL per column in one pass."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_orderdate")
    j = outer_join(c, o, "c_custkey", "o_custkey", "left")
    return M.null_counts(j, ["c_custkey", "c_name", "o_orderkey", "o_orderdate"])


@query("dq_unique", sql="""
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def dq_unique(spark, sf_dir):
    """M2: composite primary key (l_orderkey, l_linenumber) duplicates."""
    return M.duplicate_keys(tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_foreign_key", sql="""
SELECT 'orders.o_custkey' AS fk_name, (SELECT COUNT(*) FROM orders) AS n_checked,
       (SELECT COUNT(*) FROM orders o WHERE o.o_custkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)) AS n_orphans
UNION ALL
SELECT 'lineitem.(l_orderkey)', (SELECT COUNT(*) FROM lineitem),
       (SELECT COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
UNION ALL
SELECT 'lineitem.(l_partkey,l_suppkey)', (SELECT COUNT(*) FROM lineitem),
       (SELECT COUNT(*) FROM lineitem l WHERE NOT EXISTS (
          SELECT 1 FROM (SELECT DISTINCT l_partkey AS pk, l_suppkey AS sk FROM lineitem WHERE l_returnflag <> 'R') ps
          WHERE ps.pk = l.l_partkey AND ps.sk = l.l_suppkey))
""")
def dq_foreign_key(spark, sf_dir):
    """M3: orphan counts for single and composite foreign keys."""
    t = tables(spark, sf_dir)
    l = t.lineitem
    ps = l.filter(F.col("l_returnflag") != "R").select("l_partkey", "l_suppkey").distinct()
    return (M.fk_summary("orders.o_custkey", t.orders, ["o_custkey"], t.customer, ["c_custkey"])
            .unionByName(M.fk_summary("lineitem.(l_orderkey)", l, ["l_orderkey"], t.orders, ["o_orderkey"]))
            .unionByName(M.fk_summary("lineitem.(l_partkey,l_suppkey)", l, ["l_partkey", "l_suppkey"],
                                      ps, ["l_partkey", "l_suppkey"])))


@query("dq_check", sql=f"""
WITH j AS (SELECT c.c_custkey, o.o_orderkey, o.o_totalprice, o.o_orderstatus
           FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey)
SELECT c_custkey, o_orderkey, 'valor_minimo' AS rule FROM j WHERE (o_totalprice >= 5000) IS FALSE
UNION ALL
SELECT c_custkey, o_orderkey, 'status_valido' FROM j WHERE (o_orderstatus IN ('F', 'O')) IS FALSE
""")
def dq_check(spark, sf_dir):
    """M4: CHECK range and enum; a NULL value passes (violation = IS FALSE)."""
    c = tables(spark, sf_dir).customer.select("c_custkey")
    o = urgent_orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    j = outer_join(c, o, "c_custkey", "o_custkey", "left")
    return M.violations(j, {"valor_minimo": F.col("o_totalprice") >= 5000,
                            "status_valido": F.col("o_orderstatus").isin("F", "O")}, ["c_custkey", "o_orderkey"])


@query("dq_cross_column", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, 'envio_antes_do_pedido' AS rule
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE (l.l_shipdate >= o.o_orderdate + INTERVAL 3 DAY) IS FALSE
""")
def dq_cross_column(spark, sf_dir):
    """M5: cross-column rule end >= start (+3 days of handling) across the
    line and its order."""
    t = tables(spark, sf_dir)
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    rule = F.col("l_shipdate") >= F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")
    return M.violations(j, {"envio_antes_do_pedido": rule}, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("dq_deferred_fk", sql="""
SELECT 'imediata' AS mode, COUNT(*) AS n_violations FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'BUILDING')
UNION ALL
SELECT 'diferida', COUNT(*) FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
""")
def dq_deferred_fk(spark, sf_dir):
    """M6: a batch adds BUILDING customers together with all orders. Checked
    row by row (immediate) orders of the new customers fail; checked after
    the whole batch (deferred: existing ∪ batch parents) nothing fails."""
    t = tables(spark, sf_dir)
    existing = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select("c_custkey")
    batch_parents = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    children = t.orders.select("o_orderkey", "o_custkey")
    imm = M.orphans(children, ["o_custkey"], existing, ["c_custkey"]).agg(F.count(F.lit(1)).alias("n_violations"))
    dfr = (M.orphans(children, ["o_custkey"], existing.unionByName(batch_parents), ["c_custkey"])
           .agg(F.count(F.lit(1)).alias("n_violations")))
    return (imm.select(F.lit("imediata").alias("mode"), "n_violations")
            .unionByName(dfr.select(F.lit("diferida").alias("mode"), "n_violations")))


@query("dq_reject_reasons", sql="""
WITH b AS (SELECT p_partkey, p_name, CAST(CAST(p_retailprice AS DECIMAL(18,2)) - 950 AS DOUBLE) AS preco,
                  p_size - 3 AS estoque FROM part),
d AS (SELECT p_name AS k, COUNT(*) AS n FROM b GROUP BY p_name)
SELECT p_partkey, p_name,
       concat_ws(',', CASE WHEN d.n > 1 THEN '23505' END, CASE WHEN preco <= 0 THEN 'P0001' END,
                 CASE WHEN estoque < 0 THEN 'P0002' END) AS reasons,
       CASE WHEN d.n > 1 OR preco <= 0 OR estoque < 0 THEN 'REJECTED' ELSE 'ACCEPTED' END AS status
FROM b JOIN d ON d.k = b.p_name
""")
def dq_reject_reasons(spark, sf_dir):
    """M7: split a batch into accepted and rejected rows with all reasons:
    23505 duplicate key (the title is the key here), P0001 price <= 0,
    P0002 negative stock."""
    p = tables(spark, sf_dir).part
    batch = p.select("p_partkey", "p_name",
                     (F.col("p_retailprice").cast("decimal(18,2)") - 950).cast("double").alias("preco"),
                     (F.col("p_size") - 3).alias("estoque"))
    out = M.split_good_rejected(batch, "p_name", {"P0001": F.col("preco") <= 0, "P0002": F.col("estoque") < 0},
                                "23505")
    return out.select("p_partkey", "p_name", F.array_join("reasons", ",").alias("reasons"), "status")


@query("delete_restrict", sql="""
SELECT c.c_custkey, c.c_name,
       CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
            THEN 'BLOCKED' ELSE 'DELETED' END AS outcome
FROM customer c WHERE c.c_nationkey = 3
""")
def delete_restrict(spark, sf_dir):
    """M8: try to delete the customers of nation 3; those referenced by an
    open (P) order are blocked (RESTRICT), the rest go."""
    t = tables(spark, sf_dir)
    parents = t.customer.filter(F.col("c_nationkey") == 3).select("c_custkey", "c_name")
    kids = t.orders.filter(F.col("o_orderstatus") == "P")
    return M.restrict_delete(parents, "c_custkey", kids, "o_custkey")


@query("delete_cascade", sql="""
SELECT 'orders' AS level, COUNT(*) AS n_deleted FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01'
UNION ALL
SELECT 'lineitem', COUNT(*) FROM lineitem l
WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01')
""")
def delete_cascade(spark, sf_dir):
    """M9: deleting old orders cascades to their lines; deleted rows per level."""
    t = tables(spark, sf_dir)
    doomed = t.orders.filter(F.col("o_orderdate") < F.lit("1995-07-01").cast("timestamp_ntz"))
    o_gone, l_gone = M.cascade_delete(doomed, "o_orderkey", [(t.lineitem, "l_orderkey", "l_orderkey")])
    return (o_gone.agg(F.count(F.lit(1)).alias("n_deleted")).select(F.lit("orders").alias("level"), "n_deleted")
            .unionByName(l_gone.agg(F.count(F.lit(1)).alias("n_deleted"))
                         .select(F.lit("lineitem").alias("level"), "n_deleted")))


@query("view_check_option", sql="""
SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN 'MACHINERY' ELSE c_mktsegment END AS new_segment,
       (CASE WHEN c_acctbal < 1000 THEN 'MACHINERY' ELSE c_mktsegment END) = 'BUILDING' AS accepted,
       CASE WHEN (CASE WHEN c_acctbal < 1000 THEN 'MACHINERY' ELSE c_mktsegment END) = 'BUILDING'
            THEN NULL ELSE 'CHECK_OPTION' END AS reason
FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def view_check_option(spark, sf_dir):
    """Writes through a view WHERE segment = 'BUILDING' WITH CHECK
    OPTION: an update that moves a row out of the view is refused."""
    c = tables(spark, sf_dir).customer
    visible = c.filter(F.col("c_mktsegment") == "BUILDING")
    # the change batch: every customer with a balance under 1000 moves to MACHINERY
    new_seg = F.when(F.col("c_acctbal") < 1000, F.lit("MACHINERY")).otherwise(F.col("c_mktsegment"))
    changed = visible.select("c_custkey", new_seg.alias("new_segment"))
    return M.with_check_option(changed, F.col("new_segment") == "BUILDING")


def _foreign_key_graph(spark, sf_dir):
    """The tables with their keys; a customer is sponsored by the one with half its number."""
    t = tables(spark, sf_dir)
    sponsor = F.when(F.col("c_custkey") > 1, F.floor(F.col("c_custkey") / 2))
    line = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), "l_orderkey", "l_suppkey")
    return {
        "region": (t.region.select(F.col("r_regionkey").cast("long").alias("r_regionkey"), "r_name"), "r_regionkey"),
        "nation": (t.nation.select(F.col("n_nationkey").cast("long").alias("n_nationkey"),
                                   F.col("n_regionkey").cast("long").alias("n_regionkey"), "n_name"), "n_nationkey"),
        "customer": (t.customer.select("c_custkey", F.col("c_nationkey").cast("long").alias("c_nationkey"),
                                       sponsor.alias("c_sponsor")), "c_custkey"),
        "supplier": (t.supplier.select("s_suppkey", F.col("s_nationkey").cast("long").alias("s_nationkey")), "s_suppkey"),
        "orders": (t.orders.select("o_orderkey", "o_custkey"), "o_orderkey"),
        "lineitem": (line, "line"),
    }


FK_GRAPH = [C.ForeignKey("nation", "n_regionkey", "region"), C.ForeignKey("customer", "c_nationkey", "nation"),
            C.ForeignKey("supplier", "s_nationkey", "nation"), C.ForeignKey("customer", "c_sponsor", "customer"),
            C.ForeignKey("orders", "o_custkey", "customer"), C.ForeignKey("lineitem", "l_orderkey", "orders"),
            C.ForeignKey("lineitem", "l_suppkey", "supplier")]


@query("cascade_graph", sql="""
WITH RECURSIVE refs AS (
  SELECT 'region' AS parent, CAST(n_regionkey AS BIGINT) AS ref, 'nation' AS child, CAST(n_nationkey AS BIGINT) AS key FROM nation
  UNION ALL SELECT 'nation', c_nationkey, 'customer', c_custkey FROM customer
  UNION ALL SELECT 'nation', s_nationkey, 'supplier', s_suppkey FROM supplier
  UNION ALL SELECT 'customer', c_custkey // 2, 'customer', c_custkey FROM customer WHERE c_custkey > 1
  UNION ALL SELECT 'customer', o_custkey, 'orders', o_orderkey FROM orders
  UNION ALL SELECT 'orders', l_orderkey, 'lineitem', l_orderkey * 10 + l_linenumber FROM lineitem
  UNION ALL SELECT 'supplier', l_suppkey, 'lineitem', l_orderkey * 10 + l_linenumber FROM lineitem),
gone AS (
  SELECT 'region' AS tab, CAST(r_regionkey AS BIGINT) AS key FROM region WHERE r_name = 'ASIA'
  UNION
  SELECT r.child, r.key FROM gone g JOIN refs r ON r.parent = g.tab AND r.ref = g.key)
SELECT tab, key FROM gone
""")
def cascade_graph(spark, sf_dir):
    """M9 over a graph of foreign keys: deleting a region takes its nations,
    their customers and suppliers, all that these sponsored (a reference of the
    table to itself), the orders, and lines by two paths."""
    t = _foreign_key_graph(spark, sf_dir)
    doomed = t["region"][0].filter(F.col("r_name") == "ASIA").select("r_regionkey")
    gone = C.delete_cascade(t, FK_GRAPH, "region", doomed).gone
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("tab"), "key") for n, df in gone.items()])


@query("cascade_set_null", sql="""
WITH gone AS (SELECT n_nationkey FROM nation WHERE n_name IN ('FRANCE', 'CHINA')),
c_gone AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM gone)),
left_ AS (SELECT 'supplier' AS tab, s_suppkey AS key,
                 CASE WHEN s_nationkey NOT IN (SELECT n_nationkey FROM gone) THEN CAST(s_nationkey AS BIGINT) END AS ref FROM supplier
  UNION ALL SELECT 'customer', c_custkey, CAST(c_nationkey AS BIGINT) FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM c_gone)
  UNION ALL SELECT 'orders', o_orderkey, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM c_gone) THEN o_custkey END FROM orders)
SELECT tab, CAST(key AS VARCHAR) AS key, CAST(ref AS VARCHAR) AS ref FROM left_
""")
def cascade_set_null(spark, sf_dir):
    """M8, M9 mixed: two nations go with their customers; suppliers of these
    nations and orders of these customers stay without a reference."""
    t = {n: v for n, v in _foreign_key_graph(spark, sf_dir).items() if n in ("nation", "customer", "supplier", "orders")}
    keys = [C.ForeignKey("customer", "c_nationkey", "nation"), C.ForeignKey("supplier", "s_nationkey", "nation", C.SET_NULL),
            C.ForeignKey("orders", "o_custkey", "customer", C.SET_NULL)]
    doomed = t["nation"][0].filter(F.col("n_name").isin("FRANCE", "CHINA")).select("n_nationkey")
    left = C.remaining(t, C.delete_cascade(t, keys, "nation", doomed))
    cols = {"supplier": ("s_suppkey", "s_nationkey"), "customer": ("c_custkey", "c_nationkey"), "orders": ("o_orderkey", "o_custkey")}
    return reduce(DataFrame.unionByName, [left[n].select(F.lit(n).alias("tab"), F.col(k).cast("string").alias("key"),
                                                         F.col(r).cast("string").alias("ref")) for n, (k, r) in cols.items()])


@query("view_check_insert", sql="""
SELECT s_suppkey + 1000000000 AS c_custkey, CASE WHEN s_acctbal < 0 THEN 'MACHINERY' ELSE 'BUILDING' END AS c_mktsegment,
       s_acctbal >= 0 AS accepted, CASE WHEN s_acctbal < 0 THEN 'CHECK_OPTION' END AS reason
FROM supplier
""")
def view_check_insert(spark, sf_dir):
    """Inserts through the same view: a new row that the view would not
    show is refused."""
    s = tables(spark, sf_dir).supplier
    new = s.select((F.col("s_suppkey") + 1000000000).alias("c_custkey"),
                   F.when(F.col("s_acctbal") < 0, "MACHINERY").otherwise("BUILDING").alias("c_mktsegment"))
    return M.with_check_option(new, F.col("c_mktsegment") == "BUILDING")


@query("dq_validate_batch", sql="""
SELECT 'lote' AS scope, COUNT(*) AS n_checked, COUNT(*) FILTER (WHERE (o_totalprice >= 5000) IS FALSE) AS n_violations
FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
UNION ALL
SELECT 'tabela', COUNT(*), COUNT(*) FILTER (WHERE (o_totalprice >= 5000) IS FALSE) FROM orders
""")
def dq_validate_batch(spark, sf_dir):
    """NOT VALID then VALIDATE: the new batch is checked at once, the
    whole table later; both in one scan."""
    o = tables(spark, sf_dir).orders
    bad = F.col("o_totalprice") >= 5000
    is_new = F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")
    a = o.agg(F.count(F.when(is_new, 1)).alias("b_n"), F.count(F.when(is_new & (bad == F.lit(False)), 1)).alias("b_v"),
              F.count(F.lit(1)).alias("t_n"), F.count(F.when(bad == F.lit(False), 1)).alias("t_v"))
    rows = F.array(F.struct(F.lit("lote").alias("scope"), F.col("b_n").alias("n_checked"),
                            F.col("b_v").alias("n_violations")),
                   F.struct(F.lit("tabela").alias("scope"), F.col("t_n").alias("n_checked"),
                            F.col("t_v").alias("n_violations")))
    return a.select(F.explode(rows).alias("x")).select("x.*")
