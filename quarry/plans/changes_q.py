"""K: change sets on a table state (DML as DataFrame transforms)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import money
from ..operators import change as K
from ..sources import tables
from .registry import query

AS_OF = "2025-09-15"
STOCK_DATE = "2025-09-01"

STOCK_SQL = f"""(SELECT p_partkey AS livro_id, CAST(p_size AS BIGINT) AS quantidade_disponivel,
        DATE '{STOCK_DATE}' AS ultima_atualizacao FROM part WHERE p_type <> 'PROMO')"""
STAGING_SQL = """(SELECT l_partkey AS livro_id, CAST(SUM(l_quantity) AS BIGINT) AS quantidade_nova
        FROM lineitem WHERE l_returnflag = 'N' GROUP BY l_partkey)"""


def stock(spark, sf_dir):
    """Stock table stand-in: one row per non-PROMO part (p_size = units)."""
    p = tables(spark, sf_dir).part
    return p.filter(F.col("p_type") != "PROMO").select(
        F.col("p_partkey").alias("livro_id"), F.col("p_size").cast("long").alias("quantidade_disponivel"),
        F.lit(STOCK_DATE).cast("date").alias("ultima_atualizacao"))


def staging(spark, sf_dir):
    return K.staging_counts(tables(spark, sf_dir).lineitem).withColumn("_as_of", F.lit(AS_OF).cast("date"))


def _upsert(spark, sf_dir, **kw):
    return K.upsert(stock(spark, sf_dir), staging(spark, sf_dir), "livro_id",
                    {"quantidade_disponivel": "quantidade_nova", "ultima_atualizacao": "_as_of"}, **kw)


@query("dml_update", sql="""
SELECT p_partkey, p_type,
       CASE WHEN p_type = 'STANDARD' THEN CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 1.10, 2) AS DOUBLE)
            ELSE p_retailprice END AS p_retailprice
FROM part
""")
def dml_update(spark, sf_dir):
    """K1: UPDATE part SET price = ROUND(price * 1.10, 2) WHERE type = 'STANDARD'."""
    p = tables(spark, sf_dir).part.select("p_partkey", "p_type", "p_retailprice")
    new = F.round(money("p_retailprice") * F.lit(1.10).cast("decimal(3,2)"), 2).cast("double")
    return K.update(p, F.col("p_type") == "STANDARD", {"p_retailprice": new})


@query("dml_update_old_values", sql="""
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size - 25 ELSE p_size END AS p_size,
       CASE WHEN p_size > 25 THEN p_brand || '/' || CAST(p_size AS VARCHAR) ELSE p_brand END AS p_brand
FROM part
""")
def dml_update_old_values(spark, sf_dir):
    """K1: SET size = size - 25, brand = brand || '/' || size WHERE size > 25:
    condition and both values are those of the old row."""
    p = tables(spark, sf_dir).part.select("p_partkey", "p_size", "p_brand")
    return K.update(p, F.col("p_size") > 25, {
        "p_size": F.col("p_size") - 25,
        "p_brand": F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string"))})


@query("dml_update_from", sql=f"""
SELECT s.livro_id,
       CASE WHEN EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = s.livro_id AND p.p_brand = 'Brand#13')
            THEN 0 ELSE s.quantidade_disponivel END AS quantidade_disponivel
FROM {STOCK_SQL} s
""")
def dml_update_from(spark, sf_dir):
    """K2: UPDATE ... WHERE EXISTS (other table): zero the stock of a
    discontinued brand."""
    s = stock(spark, sf_dir).select("livro_id", "quantidade_disponivel")
    gone = tables(spark, sf_dir).part.filter(F.col("p_brand") == "Brand#13")
    return K.update_from(s, "livro_id", gone, "p_partkey", {"quantidade_disponivel": F.lit(0).cast("long")})


@query("dml_update_case", sql="""
SELECT o_orderkey,
       CASE o_orderpriority WHEN '5-LOW' THEN '5-BAIXA' WHEN '1-URGENT' THEN '1-URGENTE' ELSE o_orderpriority END
         AS o_orderpriority
FROM orders
""")
def dml_update_case(spark, sf_dir):
    """K3: UPDATE with CASE on every row."""
    o = tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority")
    c = F.col("o_orderpriority")
    new = F.when(c == "5-LOW", "5-BAIXA").when(c == "1-URGENT", "1-URGENTE").otherwise(c)
    return K.update(o, F.lit(True), {"o_orderpriority": new})


@query("dml_delete", sql="SELECT p_partkey, p_size FROM part WHERE NOT (p_size < 3)")
def dml_delete(spark, sf_dir):
    """K4: DELETE WHERE size < 3 (a NULL condition would keep the row)."""
    p = tables(spark, sf_dir).part.select("p_partkey", "p_size")
    return K.delete(p, F.col("p_size") < 3)


@query("dml_delete_subquery", sql=f"""
SELECT s.livro_id, s.quantidade_disponivel FROM {STOCK_SQL} s
WHERE NOT (s.quantidade_disponivel < 5
           AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = s.livro_id AND l.l_returnflag = 'R'))
""")
def dml_delete_subquery(spark, sf_dir):
    """K5: DELETE low stock that was never returned (NOT EXISTS)."""
    s = stock(spark, sf_dir).select("livro_id", "quantidade_disponivel")
    ret = tables(spark, sf_dir).lineitem.filter(F.col("l_returnflag") == "R")
    return K.delete_unless_exists(s, "livro_id", F.col("quantidade_disponivel") < 5, ret, "l_partkey")


UPSERT_SQL = f"""
SELECT COALESCE(t.livro_id, s.livro_id) AS livro_id,
       CASE WHEN t.livro_id IS NULL OR ({{guard}}) THEN s.quantidade_nova ELSE t.quantidade_disponivel END
         AS quantidade_disponivel,
       CASE WHEN t.livro_id IS NULL OR ({{guard}}) THEN DATE '{AS_OF}' ELSE t.ultima_atualizacao END
         AS ultima_atualizacao,
       CASE WHEN t.livro_id IS NULL THEN 'insert' WHEN ({{guard}}) THEN 'update' ELSE 'unchanged' END AS _action
FROM {STOCK_SQL} t FULL OUTER JOIN {STAGING_SQL} s ON s.livro_id = t.livro_id
"""


@query("dml_upsert", sql=UPSERT_SQL.format(guard="s.livro_id IS NOT NULL"))
def dml_upsert(spark, sf_dir):
    """K6: INSERT ... ON CONFLICT DO UPDATE / MERGE: source wins, new keys
    are inserted; duplicate source keys fail the job."""
    return _upsert(spark, sf_dir)


@query("dml_insert_ignore", sql=f"""
SELECT livro_id, quantidade_disponivel, ultima_atualizacao, 'unchanged' AS _action FROM {STOCK_SQL} t
UNION ALL
SELECT s.livro_id, s.quantidade_nova, DATE '{AS_OF}', 'insert' FROM {STAGING_SQL} s
WHERE NOT EXISTS (SELECT 1 FROM {STOCK_SQL} t WHERE t.livro_id = s.livro_id)
""")
def dml_insert_ignore(spark, sf_dir):
    """K7: ON CONFLICT DO NOTHING."""
    src = staging(spark, sf_dir).select("livro_id", F.col("quantidade_nova").alias("quantidade_disponivel"),
                                        F.col("_as_of").alias("ultima_atualizacao"))
    return K.insert_ignore(stock(spark, sf_dir), src, "livro_id")


@query("dml_upsert_where", sql=UPSERT_SQL.format(guard="s.livro_id IS NOT NULL AND s.quantidade_nova > 150"))
def dml_upsert_where(spark, sf_dir):
    """K8: DO UPDATE ... WHERE new > 150: the guard only blocks updates; an
    absent key is inserted whatever its value."""
    return _upsert(spark, sf_dir, update_when=F.col("src_quantidade_nova") > 150)


@query("dml_merge_delete", sql=f"""
SELECT * FROM ({UPSERT_SQL.format(guard="s.livro_id IS NOT NULL")}) m
WHERE NOT (_action = 'update' AND quantidade_disponivel < 60)
""")
def dml_merge_delete(spark, sf_dir):
    """K9: MERGE ... UPDATE ... DELETE WHERE qty < 60: only rows just updated
    can be deleted (tested on the new value); inserts stay even when small."""
    return _upsert(spark, sf_dir, delete_when=F.col("quantidade_disponivel") < 60)


@query("dml_merge_matched", sql="""
SELECT s.s_suppkey,
       CASE WHEN b.s_suppkey IS NOT NULL THEN b.s_acctbal
            ELSE CAST(CAST(s.s_acctbal AS DECIMAL(18,2)) + 1000 AS DOUBLE) END AS s_acctbal,
       CASE WHEN b.s_suppkey IS NOT NULL THEN 'update' ELSE 'unchanged' END AS _action
FROM supplier s LEFT JOIN (SELECT s_suppkey, s_acctbal FROM supplier WHERE s_nationkey < 10) b
  ON b.s_suppkey = s.s_suppkey
""")
def dml_merge_matched(spark, sf_dir):
    """Restore balances from a backup (MERGE WHEN MATCHED only): the
    current state has every balance off by +1000; the backup holds the
    suppliers of nations 0-9."""
    s = tables(spark, sf_dir).supplier
    current = s.select("s_suppkey", (money("s_acctbal") + 1000).cast("double").alias("s_acctbal"))
    backup = s.filter(F.col("s_nationkey") < 10).select("s_suppkey", F.col("s_acctbal").alias("bal"))
    return K.merge_matched(current, backup, "s_suppkey", {"s_acctbal": "bal"})


@query("dml_action_counts", sql=f"""
SELECT 'update' AS statement, CASE WHEN p_type = 'STANDARD' THEN 'update' ELSE 'unchanged' END AS _action,
       COUNT(*) AS n_rows
FROM part GROUP BY 1, 2
UNION ALL
SELECT 'delete', CASE WHEN p_size < 3 THEN 'delete' ELSE 'unchanged' END, COUNT(*) FROM part GROUP BY 1, 2
UNION ALL
SELECT 'upsert', _action, COUNT(*) FROM ({UPSERT_SQL.format(guard="s.livro_id IS NOT NULL")}) m GROUP BY 1, 2
""")
def dml_action_counts(spark, sf_dir):
    """Affected-row counts per statement and action: the UPDATE of K1,
    the DELETE of K4 and the upsert of K6 (what the clients print)."""
    p = tables(spark, sf_dir).part
    upd = K.action_counts(K.tag_update(p, F.col("p_type") == "STANDARD"))
    dele = K.action_counts(K.tag_delete(p, F.col("p_size") < 3))
    ups = K.action_counts(_upsert(spark, sf_dir))
    return (upd.select(F.lit("update").alias("statement"), "_action", "n_rows")
            .unionByName(dele.select(F.lit("delete").alias("statement"), "_action", "n_rows"))
            .unionByName(ups.select(F.lit("upsert").alias("statement"), "_action", "n_rows")))


@query("insert_returning", sql=f"""
WITH t AS {STOCK_SQL},
new AS (SELECT s.livro_id FROM {STAGING_SQL} s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.livro_id = s.livro_id))
SELECT livro_id, (SELECT COUNT(*) FROM t) + ROW_NUMBER() OVER (ORDER BY livro_id) AS estoque_id FROM new
""")
def insert_returning(spark, sf_dir):
    """INSERT ... RETURNING id: existing rows hold ids 1..n; the new
    rows get the next ids in business-key order, returned with their key."""
    from ..operators.keys import append_identity, assign_identity

    t = assign_identity(stock(spark, sf_dir).select("livro_id"), [("livro_id", True)], "estoque_id")
    new = staging(spark, sf_dir).select("livro_id").join(t.select(F.col("livro_id").alias("k")),
                                                         F.col("livro_id") == F.col("k"), "left_anti")
    return append_identity(t, "estoque_id", new, [("livro_id", True)]).select("livro_id", "estoque_id")
