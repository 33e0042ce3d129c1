"""Streaming upsert and streaming audit over landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import tables
from ..streaming.audit_stream import run_audit_stream
from ..streaming.upsert_stream import run_upsert_stream
from .changes_q import STOCK_SQL, stock
from .history_q import V2_SQL, customer_v1, customer_v2
from .registry import query

D1, D2 = "2025-09-01", "2025-09-02"


def _delivery(spark, sf_dir, before: bool, day: str, seq: int):
    l = tables(spark, sf_dir).lineitem.filter(F.col("l_returnflag") == "N")
    cut = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    l = l.filter(cut if before else ~cut)
    return (l.groupBy(F.col("l_partkey").alias("livro_id"))
            .agg(F.sum("l_quantity").cast("long").alias("quantidade_nova"))
            .withColumn("data_entrega", F.lit(day).cast("date")).withColumn("seq", F.lit(seq).cast("long")))


@query("stream_upsert", sql=f"""
WITH d1 AS (SELECT l_partkey AS livro_id, CAST(SUM(l_quantity) AS BIGINT) AS q FROM lineitem
            WHERE l_returnflag = 'N' AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1),
     d2 AS (SELECT l_partkey AS livro_id, CAST(SUM(l_quantity) AS BIGINT) AS q FROM lineitem
            WHERE l_returnflag = 'N' AND l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1),
     feed AS (SELECT COALESCE(d2.livro_id, d1.livro_id) AS livro_id,
                     CASE WHEN d2.livro_id IS NOT NULL THEN d2.q ELSE d1.q END AS q,
                     CASE WHEN d2.livro_id IS NOT NULL THEN DATE '{D2}' ELSE DATE '{D1}' END AS dt
              FROM d1 FULL OUTER JOIN d2 ON d1.livro_id = d2.livro_id)
SELECT COALESCE(t.livro_id, f.livro_id) AS livro_id,
       CASE WHEN f.livro_id IS NOT NULL THEN f.q ELSE t.quantidade_disponivel END AS quantidade_disponivel,
       CASE WHEN f.livro_id IS NOT NULL THEN f.dt ELSE t.ultima_atualizacao END AS ultima_atualizacao
FROM {STOCK_SQL} t FULL OUTER JOIN feed f ON f.livro_id = t.livro_id
""")
def stream_upsert(spark, sf_dir):
    """Two supplier deliveries land as files; a file stream merges each
    micro-batch into the stock state (newer delivery wins per key)."""
    src = scratch_path(spark, "feed")
    for before, day, seq in ((True, D1, 1), (False, D2, 2)):
        _delivery(spark, sf_dir, before, day, seq).repartition(2, "livro_id").write.mode("append").parquet(src)
    feed_schema = _delivery(spark, sf_dir, True, D1, 1).schema
    initial = stock(spark, sf_dir).withColumn("seq", F.lit(0).cast("long"))
    state = run_upsert_stream(spark, src, feed_schema, initial, scratch_path(spark, "stock_stream"), "livro_id",
                              {"quantidade_disponivel": "quantidade_nova", "ultima_atualizacao": "data_entrega",
                               "seq": "seq"}, "seq")
    return state.select("livro_id", "quantidade_disponivel", "ultima_atualizacao")


@query("stream_audit", sql=f"""
SELECT COALESCE(o.c_custkey, n.c_custkey) AS c_custkey,
       CASE WHEN o.c_custkey IS NULL THEN 'INSERT' WHEN n.c_custkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS _op,
       o.c_name AS old_c_name, o.c_mktsegment AS old_c_mktsegment,
       n.c_name AS new_c_name, n.c_mktsegment AS new_c_mktsegment
FROM customer o FULL OUTER JOIN {V2_SQL} n ON n.c_custkey = o.c_custkey
WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL
   OR o.c_name IS DISTINCT FROM n.c_name OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment
""")
def stream_audit(spark, sf_dir):
    """The snapshot (LOAD) and then the change rows arrive as files; the
    stream compares each change with its key's state (equals the batch audit
    of O1)."""
    v1, v2 = customer_v1(spark, sf_dir), customer_v2(spark, sf_dir)
    src = scratch_path(spark, "changes")
    load = v1.withColumn("op", F.lit("LOAD"))
    upd = v2.join(v1.select("c_custkey"), "c_custkey", "left_semi").withColumn("op", F.lit("UPSERT"))
    ins = v2.join(v1.select("c_custkey"), "c_custkey", "left_anti").withColumn("op", F.lit("UPSERT"))
    dele = (v1.join(v2.select("c_custkey"), "c_custkey", "left_anti")
            .withColumn("op", F.lit("DELETE")))
    for i, part in enumerate((load, upd, ins.unionByName(dele))):
        part.withColumn("seq", F.lit(i).cast("long")).repartition(2, "c_custkey") \
            .write.mode("append").parquet(src)
    feed_schema = load.withColumn("seq", F.lit(0).cast("long")).schema
    audit = run_audit_stream(spark, src, feed_schema, scratch_path(spark, "audit_stream"),
                             "c_custkey", ["c_name", "c_mktsegment"], "seq", "op", late_by=2)
    return audit.select("c_custkey", "_op", "old_c_name", "old_c_mktsegment", "new_c_name", "new_c_mktsegment")
