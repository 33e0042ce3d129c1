"""E: window functions (skew-proof forms from ``operators.windows``)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scalars import avg_money, cents, div_round_half_up, from_cents
from ..operators import windows as W
from ..sources import tables
from .registry import query

CENTS_SQL = "CAST(round({c} * 100) AS BIGINT)"


def _half_up_sql(num: str, den: str) -> str:
    return f"(sign({num}) * floor((2 * abs({num}) + ({den})) / (2 * ({den}))))"


@query("win_ranks", sql="""
SELECT s_suppkey, s_name, s_acctbal,
       ROW_NUMBER() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS row_num,
       RANK()       OVER (ORDER BY s_acctbal DESC) AS rank_num,
       DENSE_RANK() OVER (ORDER BY s_acctbal DESC) AS dense_num
FROM supplier
""")
def win_ranks(spark, sf_dir):
    """ROW_NUMBER / RANK / DENSE_RANK over one global order, in one
    distributed scan instead of a single-task global window."""
    s = tables(spark, sf_dir).supplier.select("s_suppkey", "s_name", "s_acctbal")
    return W.all_ranks(s, [], [("s_acctbal", False)], [("s_suppkey", True)])


@query("win_top3", sql="""
SELECT c_name, c_mktsegment, c_acctbal, posicao FROM (
  SELECT c_name, c_mktsegment, c_acctbal,
         RANK() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS posicao
  FROM customer) sub
WHERE posicao <= 3
""")
def win_top3(spark, sf_dir):
    """Top 3 per group by RANK (ties kept). Spark plans a partial
    WindowGroupLimit before the shuffle, so each task forwards at most the
    top rows (plus ties) of each group."""
    c = tables(spark, sf_dir).customer.select("c_name", "c_mktsegment", "c_acctbal")
    w = Window.partitionBy("c_mktsegment").orderBy(F.col("c_acctbal").desc_nulls_first())
    return c.withColumn("posicao", F.rank().over(w)).filter(F.col("posicao") <= 3)


@query("win_lag_lead", sql=f"""
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
       LAG(o_totalprice)  OVER w AS anterior,
       LEAD(o_totalprice) OVER w AS proximo,
       CAST({CENTS_SQL.format(c='o_totalprice')} - LAG({CENTS_SQL.format(c='o_totalprice')}) OVER w AS DOUBLE) / 100
         AS variacao
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def win_lag_lead(spark, sf_dir):
    """LAG / LEAD / delta over a named window (key added to the order:
    32 (customer, date) pairs repeat)."""
    o = tables(spark, sf_dir).orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    order = [("o_orderdate", True), ("o_orderkey", True)]
    # one range exchange; rows at the borders of its partitions see a halo of their neighbours
    r = W.frames(o, ["o_custkey"], order, {"anterior": W.Frame("lag", "o_totalprice", preceding=1),
                                           "proximo": W.Frame("lead", "o_totalprice", following=1)})
    return r.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "anterior", "proximo",
                    from_cents(cents("o_totalprice") - cents("anterior")).alias("variacao"))


@query("win_first_last", sql="""
SELECT DISTINCT o_custkey,
       FIRST_VALUE(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS primeiro_pedido,
       LAST_VALUE(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ultimo_pedido
FROM orders
""")
def win_first_last(spark, sf_dir):
    """FIRST_VALUE / LAST_VALUE over the whole frame + DISTINCT is one
    row per group: min_by / max_by aggregates (combined map-side)."""
    o = tables(spark, sf_dir).orders
    k = F.struct("o_orderdate", "o_orderkey")
    return o.groupBy("o_custkey").agg(F.min_by("o_totalprice", k).alias("primeiro_pedido"),
                                      F.max_by("o_totalprice", k).alias("ultimo_pedido"))


@query("win_moving_avg", sql=f"""
WITH x AS (
  SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
         SUM({CENTS_SQL.format(c='o_totalprice')}) OVER w AS s3, COUNT(*) OVER w AS n3
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
       CAST({_half_up_sql('s3', 'n3')} AS DOUBLE) / 100 AS media_movel_3
FROM x
""")
def win_moving_avg(spark, sf_dir):
    """E5: ROUND(AVG(x) OVER (ROWS 2 PRECEDING .. CURRENT ROW), 2) from exact
    sums in cents and counts of the frame."""
    o = tables(spark, sf_dir).orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    order = [("o_orderdate", True), ("o_orderkey", True)]
    r = W.frames(o.withColumn("_c", cents("o_totalprice")), ["o_custkey"], order,
                 {"_s": W.Frame("sum", "_c", preceding=2), "_n": W.Frame("count", "_c", preceding=2)})
    return r.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice",
                    from_cents(div_round_half_up(F.col("_s"), F.col("_n"))).alias("media_movel_3"))


@query("win_frame_extremes", sql="""
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
       MIN(o_totalprice) OVER w AS menor, MAX(o_totalprice) OVER w AS maior, COUNT(o_totalprice) OVER w AS n_pedidos,
       FIRST_VALUE(o_orderdate) OVER w AS primeira_data, LAST_VALUE(o_orderkey) OVER w AS ultimo_pedido,
       MAX(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                               ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS maior_dos_proximos
FROM orders
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND 2 FOLLOWING)
""")
def win_frame_extremes(spark, sf_dir):
    """Any ROWS frame: moving minimum, maximum and count, the frame's
    first and last row, and a frame that lies ahead of the row."""
    o = tables(spark, sf_dir).orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    kinds = {"menor": ("min", "o_totalprice"), "maior": ("max", "o_totalprice"), "n_pedidos": ("count", "o_totalprice"),
             "primeira_data": ("first", "o_orderdate"), "ultimo_pedido": ("last", "o_orderkey")}
    specs = {n: W.Frame(k, c, preceding=4, following=2) for n, (k, c) in kinds.items()}
    specs["maior_dos_proximos"] = W.Frame("max", "o_totalprice", preceding=-1, following=3)
    return W.frames(o, ["o_custkey"], [("o_orderdate", True), ("o_orderkey", True)], specs)


@query("win_running_total", sql=f"""
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
       CAST(SUM({CENTS_SQL.format(c='o_totalprice')}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 100 AS total_acumulado
FROM orders
""")
def win_running_total(spark, sf_dir):
    """Running total per customer, exact (cents) and skew-proof."""
    o = tables(spark, sf_dir).orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    r = W.running_total(o.withColumn("_c", cents("o_totalprice")), ["o_custkey"],
                        [("o_orderdate", True), ("o_orderkey", True)], "_c", "_s")
    return r.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice",
                    from_cents("_s").alias("total_acumulado"))


@query("win_named_default_frame", sql=f"""
WITH x AS (
  SELECT c_name, c_mktsegment, c_acctbal, c_custkey,
         SUM({CENTS_SQL.format(c='c_acctbal')}) OVER w AS s, COUNT(*) OVER w AS n
  FROM customer
  WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC))
SELECT c_name, c_mktsegment, c_acctbal,
       ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS pos,
       CAST({_half_up_sql('s', 'n')} AS DOUBLE) / 100 AS media_depto
FROM x
""")
def win_named_default_frame(spark, sf_dir):
    """``AVG(x) OVER w`` with ORDER BY and no frame is a running average
    up to the last peer (RANGE frame), not a group average."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    c = c.withColumn("_c", cents("c_acctbal"))
    r = W.row_number(c, ["c_mktsegment"], [("c_acctbal", False), ("c_custkey", True)], "pos")
    r = W.running_peers(r, ["c_mktsegment"], [("c_acctbal", False)], "_c", "_s", "_n")
    return r.select("c_name", "c_mktsegment", "c_acctbal", "pos", avg_money("_s", "_n").alias("media_depto"))
