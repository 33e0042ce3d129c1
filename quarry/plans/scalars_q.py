"""G: string scalars; H: date/time scalars; I: math and NULL scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import epoch_millis, cents, div_round_half_up, from_cents, money, months_between_whole
from ..operators.relational import outer_join
from ..sources import tables
from .common import URGENT_SQL, urgent_orders
from .registry import query

# H1: "now" is an explicit argument so results repeat; the checked queries
# use this fixed as-of date.
AS_OF = "2002-01-01"


def _as_of():
    return F.lit(AS_OF).cast("date")


@query("str_case", sql="SELECT c_custkey, upper(c_name) AS name_upper, lower(c_mktsegment) AS segment_lower FROM customer")
def str_case(spark, sf_dir):
    c = tables(spark, sf_dir).customer
    return c.select("c_custkey", F.upper("c_name").alias("name_upper"), F.lower("c_mktsegment").alias("segment_lower"))


@query("str_len_substr", sql="""
SELECT p_partkey, length(p_name) AS name_len, substring(p_name, 1, 5) AS name_prefix,
       substring(p_brand, 7) AS brand_no FROM part
""")
def str_len_substr(spark, sf_dir):
    """1-based SUBSTRING; LENGTH counts characters."""
    p = tables(spark, sf_dir).part
    return p.select("p_partkey", F.length("p_name").alias("name_len"),
                    F.substring("p_name", 1, 5).alias("name_prefix"),
                    F.expr("substring(p_brand, 7)").alias("brand_no"))


@query("str_replace", sql="SELECT c_custkey, replace(c_name, 'Customer#', 'Cliente ') AS nome FROM customer")
def str_replace(spark, sf_dir):
    c = tables(spark, sf_dir).customer
    return c.select("c_custkey", F.replace("c_name", F.lit("Customer#"), F.lit("Cliente ")).alias("nome"))


@query("str_concat", sql=f"""
SELECT c.c_custkey, c.c_name || ' / ' || COALESCE(CAST(o.o_orderkey AS VARCHAR), 'sem pedido') AS label,
       c.c_name || ' / ' || CAST(o.o_orderkey AS VARCHAR) AS label_unguarded
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
""")
def str_concat(spark, sf_dir):
    """``||`` propagates NULL (as PG does); COALESCE guards it."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    o = urgent_orders(spark, sf_dir).select("o_custkey", "o_orderkey")
    j = outer_join(c, o, "c_custkey", "o_custkey", "left")
    key = F.col("o_orderkey").cast("string")
    return j.select("c_custkey",
                    F.concat("c_name", F.lit(" / "), F.coalesce(key, F.lit("sem pedido"))).alias("label"),
                    F.concat("c_name", F.lit(" / "), key).alias("label_unguarded"))


@query("str_lpad", sql="""
SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS cpf,
       'CRM-' || lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS crm FROM customer
""")
def str_lpad(spark, sf_dir):
    c = tables(spark, sf_dir).customer
    return c.select("c_custkey", F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("cpf"),
                    F.concat(F.lit("CRM-"), F.lpad(F.col("c_nationkey").cast("string"), 6, "0")).alias("crm"))


@query("str_uuid_format", sql=r"""
SELECT c_custkey,
       regexp_replace(lower(md5(c_name)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') AS name_uuid
FROM customer
""")
def str_uuid_format(spark, sf_dir):
    """Hex of 16 bytes formatted 8-4-4-4-12 with back-references ($n)."""
    c = tables(spark, sf_dir).customer
    return c.select("c_custkey", F.regexp_replace(
        F.lower(F.md5("c_name")), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5").alias("name_uuid"))


@query("casts", sql="""
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_orderdate AS DATE) AS order_day,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total_text,
       CAST(substring(CAST(o_orderkey AS VARCHAR), 1, 3) AS BIGINT) AS key_prefix_num
FROM orders
""")
def casts(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    return o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("key_text"),
                    F.col("o_orderdate").cast("date").alias("order_day"),
                    F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("total_text"),
                    F.substring(F.col("o_orderkey").cast("string"), 1, 3).cast("long").alias("key_prefix_num"))


@query("date_to_char", sql="""
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS dia, strftime(o_orderdate, '%Y-%m') AS mes FROM orders
""")
def date_to_char(spark, sf_dir):
    """H2: TO_CHAR(d, 'DD/MM/YYYY') -> date_format(d, 'dd/MM/yyyy')."""
    o = tables(spark, sf_dir).orders
    return o.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("dia"),
                    F.date_format("o_orderdate", "yyyy-MM").alias("mes"))


@query("date_diff_days", sql=f"""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS days_since FROM orders
""")
def date_diff_days(spark, sf_dir):
    """H3: whole days between two dates (PG integer meaning)."""
    o = tables(spark, sf_dir).orders
    return o.select("o_orderkey", F.datediff(_as_of(), F.to_date("o_orderdate")).alias("days_since"))


@query("date_months_between", sql=f"""
SELECT o_orderkey,
       CAST((year(DATE '{AS_OF}') - year(o_orderdate)) * 12 + (month(DATE '{AS_OF}') - month(o_orderdate))
            - CASE WHEN day(DATE '{AS_OF}') < day(o_orderdate) THEN 1 ELSE 0 END AS INTEGER) AS months
FROM orders
""")
def date_months_between(spark, sf_dir):
    """H4: whole months as AGE + EXTRACT gives them."""
    o = tables(spark, sf_dir).orders
    return o.select("o_orderkey", months_between_whole(_as_of(), "o_orderdate").alias("months"))


@query("date_last_day", sql="SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders")
def date_last_day(spark, sf_dir):
    o = tables(spark, sf_dir).orders
    return o.select("o_orderkey", F.last_day("o_orderdate").alias("month_end"))


@query("date_add_months", sql="""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month FROM orders
""")
def date_add_months(spark, sf_dir):
    """H6: +1 month keeps the day number, clamped at month end (PG meaning)."""
    o = tables(spark, sf_dir).orders
    return o.select("o_orderkey", F.add_months(F.to_date("o_orderdate"), 1).alias("next_month"))


@query("date_plus_interval", sql="""
SELECT event_id, CAST(ts AS DATE) + 14 AS due_day,
       ts + INTERVAL 2 HOUR + INTERVAL 30 MINUTE AS slot_end,
       ts + INTERVAL 3 DAY AS plus_days
FROM events
""")
def date_plus_interval(spark, sf_dir):
    """H7: date + n days; timestamp + day/hour/minute intervals."""
    e = tables(spark, sf_dir).events
    return e.select("event_id", F.date_add(F.to_date("ts"), 14).alias("due_day"),
                    (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(2), F.lit(30))).alias("slot_end"),
                    (F.col("ts") + F.expr("INTERVAL 3 DAYS")).alias("plus_days"))


@query("date_extract", sql="""
SELECT event_id, year(ts) AS yr, month(ts) AS mon, epoch_us(ts) // 1000 AS epoch_millis FROM events
""")
def date_extract(spark, sf_dir):
    e = tables(spark, sf_dir).events
    return e.select("event_id", F.year("ts").alias("yr"), F.month("ts").alias("mon"),
                    epoch_millis("ts").alias("epoch_millis"))


@query("date_trunc_day", sql="""
SELECT CAST(ts AS DATE) AS dia, COUNT(*) AS n_events FROM events GROUP BY 1
""")
def date_trunc_day(spark, sf_dir):
    """H9: TRUNC(d) to the day, here as the key of a daily count."""
    e = tables(spark, sf_dir).events
    return e.groupBy(F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("n_events"))


@query("math_round", sql="""
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS net,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                  * (1 + CAST(l_tax AS DECIMAL(4,2))), 2) AS DOUBLE) AS gross
FROM lineitem
""")
def math_round(spark, sf_dir):
    """ROUND half-up on exact decimals; + - *."""
    l = tables(spark, sf_dir).lineitem
    disc, tax = F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
    net = money("l_extendedprice") * (F.lit(1) - disc)
    return l.select("l_orderkey", "l_linenumber", "l_partkey",
                    F.round(net, 2).cast("double").alias("net"),
                    F.round(net * (F.lit(1) + tax), 2).cast("double").alias("gross"))


@query("math_mod_abs", sql="""
SELECT c_custkey, c_custkey % 7 AS bucket, abs(CAST(c_acctbal AS DECIMAL(18,2))) AS abs_balance,
       CAST(sign(CAST(round(c_acctbal * 100) AS BIGINT))
            * floor((2 * abs(CAST(round(c_acctbal * 100) AS BIGINT)) + NULLIF(c_nationkey, 0))
                    / (2 * NULLIF(c_nationkey, 0))) AS DOUBLE) / 100 AS per_nation_unit
FROM customer
""")
def math_mod_abs(spark, sf_dir):
    """MOD, ABS and a division guarded by NULLIF (ANSI mode raises on /0)."""
    c = tables(spark, sf_dir).customer
    return c.select("c_custkey", (F.col("c_custkey") % 7).alias("bucket"),
                    F.abs(money("c_acctbal")).alias("abs_balance"),
                    from_cents(div_round_half_up(cents("c_acctbal"), F.nullif(F.col("c_nationkey"), F.lit(0))))
                    .alias("per_nation_unit"))


@query("null_coalesce", sql=f"""
SELECT c.c_custkey, COALESCE(o.o_orderpriority, o.o_orderstatus, c.c_mktsegment, 'n/a') AS label
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
""")
def null_coalesce(spark, sf_dir):
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    o = urgent_orders(spark, sf_dir).select("o_custkey", "o_orderpriority", "o_orderstatus")
    j = outer_join(c, o, "c_custkey", "o_custkey", "left")
    return j.select("c_custkey", F.coalesce("o_orderpriority", "o_orderstatus", "c_mktsegment",
                                            F.lit("n/a")).alias("label"))


@query("null_nvl2", sql=f"""
SELECT c.c_custkey, CASE WHEN o.o_orderkey IS NOT NULL THEN 'com pedido urgente' ELSE 'sem pedido urgente' END AS flag
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE {URGENT_SQL}) o ON o.o_custkey = c.c_custkey
""")
def null_nvl2(spark, sf_dir):
    """NVL2(x, a, b)."""
    c = tables(spark, sf_dir).customer.select("c_custkey")
    o = urgent_orders(spark, sf_dir).select("o_custkey", "o_orderkey")
    j = outer_join(c, o, "c_custkey", "o_custkey", "left")
    return j.select("c_custkey", F.nvl2("o_orderkey", F.lit("com pedido urgente"),
                                        F.lit("sem pedido urgente")).alias("flag"))


@query("null_nullif", sql="""
SELECT s_suppkey, s_acctbal / NULLIF(s_nationkey, 0) AS balance_per_key, NULLIF(s_nationkey, 0) AS nation_or_null
FROM supplier
""")
def null_nullif(spark, sf_dir):
    s = tables(spark, sf_dir).supplier
    return s.select("s_suppkey", (F.col("s_acctbal") / F.nullif(F.col("s_nationkey"), F.lit(0))).alias("balance_per_key"),
                    F.nullif(F.col("s_nationkey"), F.lit(0)).alias("nation_or_null"))
