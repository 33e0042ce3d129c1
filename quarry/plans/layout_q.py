"""N: schema change and physical layout; D16 partition profile."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import layout as N
from ..session import scratch_path
from ..sources import tables
from ..sources.writers import read_partitioned, write_partitioned, year_range_partition
from .registry import query

P_RANGE_SQL = """CASE WHEN year(o_orderdate) <= 1996 THEN 'ate_1996'
            WHEN year(o_orderdate) <= 2000 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE 'futuro' END"""


BY_YEAR = "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_totalprice DOUBLE, p_range STRING"


def _orders_by_year(spark, sf_dir):
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    path = scratch_path(spark, "orders_by_year")
    write_partitioned(o.withColumn("p_range", year_range_partition("o_orderdate", 1996, 2000)), path, "p_range",
                      ["o_orderdate", "o_orderkey"])
    return path


@query("partition_profile", sql=f"""
SELECT {P_RANGE_SQL} AS p_range, COUNT(*) AS n_rows, MIN(o_orderdate) AS first_date, MAX(o_orderdate) AS last_date
FROM orders GROUP BY 1
""")
def partition_profile(spark, sf_dir):
    """Rows and date bounds per partition of the written table."""
    d = read_partitioned(spark, _orders_by_year(spark, sf_dir), BY_YEAR)
    return d.groupBy("p_range").agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderdate").alias("first_date"),
                                    F.max("o_orderdate").alias("last_date"))


@query("partition_pruned_read", sql="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1998-02-01'
""")
def partition_pruned_read(spark, sf_dir):
    """A date-range read of the year-partitioned table; the partition
    predicate is derived from the date range so only two folders are listed
    (PartitionFilters in the plan)."""
    return _pruned(spark, _orders_by_year(spark, sf_dir))


def _pruned(spark, path):
    d = read_partitioned(spark, path, BY_YEAR)
    return N.prune_by_date(d, "o_orderdate", "p_range", "1997-03-01", "1998-02-01",
                           N.partition_labels(spark, path, "p_range")).select("o_orderkey", "o_orderdate")


@query("partition_read_after_merge", sql="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1998-02-01'
""")
def partition_read_after_merge(spark, sf_dir):
    """N4 after N5: the same read once 1997 and 1998 are one partition."""
    path = _orders_by_year(spark, sf_dir)
    N.merge_partitions(spark, path, "p_range", ["1997", "1998"], "1997_1998", BY_YEAR, ["o_orderdate", "o_orderkey"])
    return _pruned(spark, path)


@query("partition_add", sql="""
SELECT o_orderkey, o_orderdate, '2030' AS p_range FROM orders WHERE year(o_orderdate) = 1999
""")
def partition_add(spark, sf_dir):
    """ADD / ATTACH PARTITION: rows of a new year arrive as a folder of
    their own (the year 1999's orders stand for 2030's)."""
    path = _orders_by_year(spark, sf_dir)
    new = tables(spark, sf_dir).orders.filter(F.year("o_orderdate") == 1999).select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").withColumn("p_range", F.lit("2030"))
    N.add_partition(new, path, "p_range", ["o_orderdate", "o_orderkey"])
    d = read_partitioned(spark, path, BY_YEAR).filter(F.col("p_range") == "2030")
    return d.select("o_orderkey", "o_orderdate", "p_range")


@query("partition_detach", sql=f"""
SELECT p_range, COUNT(*) AS n_rows, 'destacada' AS tabela FROM (SELECT {P_RANGE_SQL} AS p_range FROM orders) x
WHERE p_range = '1997' GROUP BY p_range
UNION ALL
SELECT p_range, COUNT(*), 'principal' FROM (SELECT {P_RANGE_SQL} AS p_range FROM orders) x
WHERE p_range <> '1997' GROUP BY p_range
""")
def partition_detach(spark, sf_dir):
    """DETACH PARTITION: 1997 becomes a table of its own."""
    path = _orders_by_year(spark, sf_dir)
    gone = N.detach_partition(spark, path, "p_range", "1997", scratch_path(spark, "orders_1997"))
    rest = read_partitioned(spark, path, BY_YEAR)
    count = lambda d, name: d.groupBy("p_range").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "tabela", F.lit(name))
    return count(gone, "destacada").unionByName(count(rest, "principal"))


@query("partition_retention", sql=f"""
SELECT o_orderkey, {P_RANGE_SQL} AS p_range FROM orders WHERE year(o_orderdate) > 1996
""")
def partition_retention(spark, sf_dir):
    """Retention drops the oldest partition (a folder delete, no scan of
    the kept data)."""
    path = _orders_by_year(spark, sf_dir)
    N.drop_partitions(spark, path, "p_range", ["ate_1996"])
    return read_partitioned(spark, path, BY_YEAR).select("o_orderkey", "p_range")


@query("partition_merge", sql=f"""
SELECT CASE WHEN p IN ('1997', '1998') THEN '1997_1998' ELSE p END AS p_range, COUNT(*) AS n_rows
FROM (SELECT {P_RANGE_SQL} AS p FROM orders) x GROUP BY 1
""")
def partition_merge(spark, sf_dir):
    """MERGE PARTITIONS 1997, 1998 -> one: only those two folders are
    rewritten, compacted; the new folder is checked before they are dropped."""
    path = _orders_by_year(spark, sf_dir)
    N.merge_partitions(spark, path, "p_range", ["1997", "1998"], "1997_1998", BY_YEAR, ["o_orderdate", "o_orderkey"])
    d = read_partitioned(spark, path, BY_YEAR)
    return d.groupBy("p_range").agg(F.count(F.lit(1)).alias("n_rows"))


@query("clustered_lookup", sql="""
SELECT event_id, user_id, ts FROM events
WHERE user_id = 42 AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12 23:59:59'
""")
def clustered_lookup(spark, sf_dir):
    """(key, time) lookup on a table clustered by (user_id, ts): rows of
    one key sit in few files and row groups, whose min/max stats let the
    reader skip the rest."""
    e = tables(spark, sf_dir).events.select("event_id", "user_id", "ts")
    path = scratch_path(spark, "events_clustered")
    N.write_clustered(e, path, ["user_id", "ts"])
    d = spark.read.parquet(path)
    lo, hi = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-12 23:59:59").cast("timestamp_ntz")
    return d.filter((F.col("user_id") == 42) & F.col("ts").between(lo, hi))


@query("interleaved_lookup", sql="""
SELECT 'por_cliente' AS consulta, o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_custkey BETWEEN 40 AND 60
UNION ALL
SELECT 'por_data', o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31'
""")
def interleaved_lookup(spark, sf_dir):
    """N6 for two ranges: one table whose files are narrow in the customer and
    in the date, looked up by either; only files that meet the range are opened."""
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    path = scratch_path(spark, "orders_interleaved")
    N.write_interleaved(o, path, ["o_custkey", "o_orderdate"], bloom=["o_orderkey"])
    by_customer = N.read_ranges(spark, path, o.schema, {"o_custkey": (40, 60)})
    by_date = N.read_ranges(spark, path, o.schema, {"o_orderdate": ("1997-03-01", "1997-03-31")})
    return by_customer.select(F.lit("por_cliente").alias("consulta"), "*").unionByName(
        by_date.select(F.lit("por_data").alias("consulta"), "*"))


@query("bucketed_join_hot", sql="""
SELECT l.l_orderkey, l.l_linenumber, n.n_name FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
""")
def bucketed_join_hot(spark, sf_dir):
    """N7 with hot keys (25 nations hold all lines): their rows are dealt over
    sub-buckets, the nation's row is copied to each, and the join needs no shuffle."""
    t = tables(spark, sf_dir)
    s = t.supplier.select("s_suppkey", "s_nationkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    big, small = N.write_bucketed_pair(lines.drop("s_suppkey"), "s_nationkey", t.nation.select("n_nationkey", "n_name"),
                                       "n_nationkey", "lines_by_nation")
    return N.join_bucketed(big, small).select("l_orderkey", "l_linenumber", "n_name")


@query("bucketed_join", sql="""
SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
""")
def bucketed_join(spark, sf_dir):
    """Both sides bucketed by the customer key into the same number of
    buckets, so the join reads co-located buckets without a shuffle."""
    t = tables(spark, sf_dir)
    b = N.bucket_count(spark)  # same count on both sides: co-located buckets
    o = N.write_bucketed(t.orders.select("o_orderkey", "o_custkey"), "orders_b", "o_custkey", b)
    c = N.write_bucketed(t.customer.select("c_custkey", "c_name"), "customer_b", "c_custkey", b)
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")


@query("schema_add_default", sql="SELECT c_custkey, c_name, 'S' AS ativo FROM customer")
def schema_add_default(spark, sf_dir):
    """ADD COLUMN ... DEFAULT 'S': files written before the change lack
    the column; readers use the new schema and fill the default."""
    c = tables(spark, sf_dir).customer.select("c_custkey", "c_name")
    path = scratch_path(spark, "customer_v1")
    c.write.mode("overwrite").parquet(path)
    return N.read_with_added_column(spark, path, c.schema, "ativo", T.StringType(), "'S'")


@query("schema_evolve", sql="""
SELECT c_custkey, c_name AS nome, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal FROM customer
""")
def schema_evolve(spark, sf_dir):
    """Widen a type, rename and drop a column: a rewrite to a new folder."""
    c = tables(spark, sf_dir).customer
    path = scratch_path(spark, "customer_v2")
    N.evolve(c, path, widen={"c_nationkey": "bigint"}, rename={"c_name": "nome"}, drop=["c_mktsegment"])
    return spark.read.parquet(path)


@query("insert_defaults", sql="""
SELECT o_orderkey AS pedido_id, o_custkey AS cliente_id, DATE '2025-09-15' AS data_pedido,
       'PENDENTE' AS status, 0.0 AS valor_total
FROM orders WHERE o_orderstatus = 'O'
""")
def insert_defaults(spark, sf_dir):
    """An insert that names only some columns; the others take their
    declared defaults (CURRENT_DATE as an explicit as-of, 'PENDENTE', 0)."""
    o = tables(spark, sf_dir).orders.filter(F.col("o_orderstatus") == "O")
    incoming = o.select(F.col("o_orderkey").alias("pedido_id"), F.col("o_custkey").alias("cliente_id"))
    return N.fill_defaults(incoming, {"data_pedido": F.lit("2025-09-15").cast("date"),
                                      "status": F.lit("PENDENTE"), "valor_total": F.lit(0.0)})
