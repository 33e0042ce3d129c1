"""A: sources, sinks and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import money
from ..session import scratch_path
from ..sources import tables
from ..sources.generators import visits_from_ids
from ..sources.writers import read_partitioned, stage, write_partitioned, year_range_partition
from .registry import query

PRIORITY_LABELS_SQL = """(VALUES ('1-URGENT', 'Urgente'), ('2-HIGH', 'Alta'), ('3-MEDIUM', 'Media'),
                                 ('4-NOT SPECIFIED', 'Nao informada'), ('5-LOW', 'Baixa')) AS v(code, label)"""


@query("scan_all", sql="SELECT * FROM part")
def scan_all(spark, sf_dir):
    """A1: full scan with the declared schema."""
    return tables(spark, sf_dir).part


@query("inline_values", sql=f"""
SELECT v.code, v.label, COUNT(o.o_orderkey) AS n_orders
FROM {PRIORITY_LABELS_SQL}
LEFT JOIN orders o ON o.o_orderpriority = v.code
GROUP BY v.code, v.label
""")
def inline_values(spark, sf_dir):
    """A2: a multi-row VALUES source (a lookup of five fixed labels) joined
    to the order counts; the counts are aggregated before the join."""
    labels = spark.createDataFrame(
        [("1-URGENT", "Urgente"), ("2-HIGH", "Alta"), ("3-MEDIUM", "Media"),
         ("4-NOT SPECIFIED", "Nao informada"), ("5-LOW", "Baixa")], "code string, label string")
    cnt = tables(spark, sf_dir).orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return (labels.join(cnt, labels.code == cnt.o_orderpriority, "left")
            .select("code", "label", F.coalesce("n", F.lit(0)).alias("n_orders")))


@query("insert_all", sql="""
SELECT p_partkey AS livro_id, 'preco_cheio' AS tabela, p_retailprice AS preco FROM part
UNION ALL
SELECT p_partkey, 'preco_promocional', CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 0.85, 2) AS DOUBLE) FROM part
WHERE p_type = 'PROMO'
""")
def insert_all(spark, sf_dir):
    """A3: INSERT ALL INTO t ... INTO t ...: each branch is a projection of
    the one source scan; the branches are unioned and written once."""
    from ..operators.change import insert_all as fan_out

    p = tables(spark, sf_dir).part
    full = p.select(F.col("p_partkey").alias("livro_id"), F.lit("preco_cheio").alias("tabela"),
                    F.col("p_retailprice").alias("preco"))
    promo = p.filter(F.col("p_type") == "PROMO").select(
        F.col("p_partkey").alias("livro_id"), F.lit("preco_promocional").alias("tabela"),
        F.round(money("p_retailprice") * F.lit(0.85).cast("decimal(3,2)"), 2).cast("double").alias("preco"))
    return fan_out([full, promo])


@query("insert_select", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, 'F', o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice < 100000
""")
def insert_select(spark, sf_dir):
    """A4: INSERT INTO target SELECT ...: the new state is old ∪ new rows,
    appended to the target folder and read back."""
    from ..operators.change import insert_select as append

    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    target = o.filter(F.col("o_orderstatus") == "F")
    new = (o.filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 100000))
           .withColumn("o_orderstatus", F.lit("F")))
    path = scratch_path(spark, "insert_select")
    target.write.mode("overwrite").parquet(path)
    append(new, path)
    return spark.read.schema(target.schema).parquet(path)


@query("generate_visits", sql="""
WITH g AS (SELECT o_orderkey + 1 AS g FROM orders)
SELECT g AS consulta_id, g % 50000 + 1 AS paciente_id, g % 200 + 1 AS medico_id, g % 3 + 1 AS convenio_id,
       TIMESTAMP '2024-01-01 08:00:00' + to_days(CAST(g % 730 AS INTEGER)) + to_hours(CAST(g % 10 AS INTEGER)) AS data_hora,
       CASE g % 20 WHEN 0 THEN 'CANCELADA' WHEN 1 THEN 'AGENDADA' ELSE 'REALIZADA' END AS status,
       CAST((8000 + (g * 7919) % 42001) / 100.0 AS DECIMAL(10,2)) AS valor,
       'CRM-' || lpad(CAST(g % 200 + 1 AS VARCHAR), 6, '0') AS crm
FROM g
""")
def generate_visits(spark, sf_dir):
    """Generator formulas applied to the ids of a driving table."""
    ids = tables(spark, sf_dir).orders.select((F.col("o_orderkey") + 1).alias("g"))
    return visits_from_ids(ids, "g")


@query("partitioned_write", sql="""
SELECT o_orderkey, o_orderdate,
       CASE WHEN year(o_orderdate) <= 1996 THEN 'ate_1996'
            WHEN year(o_orderdate) <= 2000 THEN CAST(year(o_orderdate) AS VARCHAR)
            ELSE 'futuro' END AS p_range
FROM orders
""")
def partitioned_write(spark, sf_dir):
    """Range-partitioned write by year with a DEFAULT partition; read back."""
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    path = scratch_path(spark, "orders_by_year")
    write_partitioned(o.withColumn("p_range", year_range_partition("o_orderdate", 1996, 2000)), path, "p_range",
                      ["o_orderdate", "o_orderkey"])
    return read_partitioned(spark, path, "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ, p_range STRING").select("o_orderkey", "o_orderdate", "p_range")


@query("staging_feed", sql="""
SELECT l_partkey AS livro_id, CAST(SUM(l_quantity) AS BIGINT) AS quantidade_nova
FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_partkey
""")
def staging_feed(spark, sf_dir):
    """The supplier's feed of new counts, landed as files and read back
    with its declared schema before the upsert (K6/K15) consumes it."""
    from ..operators.change import staging_counts

    feed = staging_counts(tables(spark, sf_dir).lineitem)
    _, landed = stage(feed, "staging_feed")
    return landed


@query("docs_nested", sql="""
SELECT o.o_orderkey AS _id, o.o_custkey AS id_cliente, COUNT(l.l_orderkey) AS n_itens,
       CAST(COALESCE(SUM(l.l_quantity), 0) AS DOUBLE) AS qtd_total
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey, o.o_custkey
""")
def docs_nested(spark, sf_dir):
    """Nested documents written as JSON and read back with an explicit
    ``ArrayType(StructType)`` schema; summarised per document."""
    from ..operators.nested import doc_sum
    from ..sources.documents import read_sale_documents, sale_documents, write_json

    t = tables(spark, sf_dir)
    path = scratch_path(spark, "sale_docs")
    write_json(sale_documents(t.orders, t.lineitem), path)
    d = read_sale_documents(spark, path)
    return d.select("_id", "id_cliente", F.size("itens").cast("long").alias("n_itens"),
                    doc_sum("itens", "quantidade").alias("qtd_total"))


@query("graph_edges", sql="""
SELECT DISTINCT 'S:' || CAST(l_suppkey AS VARCHAR) AS src, 'P:' || CAST(l_partkey AS VARCHAR) AS dst, 'SUPPLIES' AS type
FROM lineitem
UNION ALL
SELECT 'P:' || CAST(p_partkey AS VARCHAR), 'B:' || p_brand, 'IN' FROM part
""")
def graph_edges(spark, sf_dir):
    """Property-graph source: typed edges derived from the tables."""
    from ..operators.graph import build_graph

    t = tables(spark, sf_dir)
    _, edges = build_graph(t.lineitem, t.supplier, t.part)
    return edges
