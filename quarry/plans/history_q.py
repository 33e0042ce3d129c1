"""O: change capture and time travel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import history as O
from ..operators.change import merge_matched
from ..sources import tables
from .registry import query

AS_OF_TS = "2024-01-15 12:00:00"
OLD_STAMP = "2024-01-01 00:00:00"
NOW_STAMP = "2025-09-15 10:00:00"

V2_SQL = """(SELECT c_custkey,
        CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' *' ELSE c_name END AS c_name, c_mktsegment
 FROM customer WHERE NOT (c_acctbal < 100)
 UNION ALL
 SELECT s_suppkey + 1000000000, s_name, 'SUPPLIER' FROM supplier)"""

CHANGES_SQL = """(SELECT event_id, ts, user_id, value,
        CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op
 FROM events)"""


def customer_v1(spark, sf_dir):
    return tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment")


def customer_v2(spark, sf_dir):
    """The next snapshot: low balances deleted, BUILDING names changed,
    suppliers added as customers."""
    t = tables(spark, sf_dir)
    c = t.customer.filter(~(F.col("c_acctbal") < 100))
    c = c.select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.concat("c_name", F.lit(" *")))
                 .otherwise(F.col("c_name")).alias("c_name"), "c_mktsegment")
    s = t.supplier.select((F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
                          F.lit("SUPPLIER").alias("c_mktsegment"))
    return c.unionByName(s)


def change_log(spark, sf_dir):
    e = tables(spark, sf_dir).events
    op = (F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE")
          .otherwise("UPDATE"))
    return e.select("event_id", "ts", "user_id", "value", op.alias("op"))


@query("audit_diff", sql=f"""
SELECT COALESCE(o.c_custkey, n.c_custkey) AS c_custkey,
       CASE WHEN o.c_custkey IS NULL THEN 'INSERT' WHEN n.c_custkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS _op,
       o.c_name AS old_c_name, o.c_mktsegment AS old_c_mktsegment,
       n.c_name AS new_c_name, n.c_mktsegment AS new_c_mktsegment
FROM customer o FULL OUTER JOIN {V2_SQL} n ON n.c_custkey = o.c_custkey
WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL
   OR o.c_name IS DISTINCT FROM n.c_name OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment
""")
def audit_diff(spark, sf_dir):
    """O1: the audit trigger's rows (operation, old and new values)."""
    return O.audit_diff(customer_v1(spark, sf_dir), customer_v2(spark, sf_dir), "c_custkey",
                        ["c_name", "c_mktsegment"])


@query("stamp_changed", sql=f"""
SELECT n.c_custkey, n.c_name, n.c_mktsegment,
       CASE WHEN o.c_custkey IS NULL OR o.c_name IS DISTINCT FROM n.c_name
                 OR o.c_mktsegment IS DISTINCT FROM n.c_mktsegment
            THEN TIMESTAMP '{NOW_STAMP}' ELSE TIMESTAMP '{OLD_STAMP}' END AS atualizado_em
FROM {V2_SQL} n LEFT JOIN customer o ON o.c_custkey = n.c_custkey
""")
def stamp_changed(spark, sf_dir):
    """O2: last-changed stamp set on insert/update only."""
    old = customer_v1(spark, sf_dir).withColumn("atualizado_em", F.lit(OLD_STAMP).cast("timestamp_ntz"))
    return O.stamp_changed(old, customer_v2(spark, sf_dir), "c_custkey", ["c_name", "c_mktsegment"],
                           "atualizado_em", NOW_STAMP)


@query("as_of_state", sql=f"""
SELECT user_id, ts AS changed_at, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM {CHANGES_SQL} c WHERE ts <= TIMESTAMP '{AS_OF_TS}') x
WHERE rn = 1 AND op <> 'DELETE'
""")
def as_of_state(spark, sf_dir):
    """O3: AS OF TIMESTAMP t from the change log (latest change per key)."""
    return O.as_of(change_log(spark, sf_dir), "user_id", "ts", "event_id", "op", ["value"], AS_OF_TS)


@query("as_of_join", sql=f"""
SELECT p.event_id, p.user_id AS probe_user, p.at, CASE WHEN h.op <> 'DELETE' THEN h.ts END AS changed_at,
       CASE WHEN h.op <> 'DELETE' THEN h.value END AS value
FROM (SELECT event_id, user_id, ts - INTERVAL 5 MINUTE AS at FROM events) p
ASOF LEFT JOIN (SELECT * FROM {CHANGES_SQL} c) h ON h.user_id = p.user_id AND p.at >= h.ts
""")
def as_of_join(spark, sf_dir):
    """O3 for many keys and times: for every event, its user's state five
    minutes earlier, as the recovery lesson reads it."""
    probes = tables(spark, sf_dir).events.select(
        "event_id", F.col("user_id").alias("probe_user"), (F.col("ts") - F.expr("INTERVAL 5 MINUTES")).alias("at"))
    return O.as_of_join(probes, "probe_user", "at", change_log(spark, sf_dir), "user_id", "ts", "event_id", "op", ["value"])


@query("restore_as_of", sql=f"""
WITH cur AS (SELECT user_id, value FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM {CHANGES_SQL} c) x WHERE rn = 1 AND op <> 'DELETE'),
     past AS (SELECT user_id, value FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM {CHANGES_SQL} c WHERE ts <= TIMESTAMP '{AS_OF_TS}') x WHERE rn = 1 AND op <> 'DELETE')
SELECT cur.user_id, COALESCE(past.value, cur.value) AS value,
       CASE WHEN past.user_id IS NOT NULL THEN 'update' ELSE 'unchanged' END AS _action
FROM cur LEFT JOIN past ON past.user_id = cur.user_id
""")
def restore_as_of(spark, sf_dir):
    """Restore the current table to time t for the keys that exist in
    both (MERGE ... WHEN MATCHED with the AS OF read as source)."""
    log = change_log(spark, sf_dir)
    current = O.as_of(log, "user_id", "ts", "event_id", "op", ["value"], "9999-12-31 23:59:59")
    past = O.as_of(log, "user_id", "ts", "event_id", "op", ["value"], AS_OF_TS)
    return merge_matched(current.select("user_id", "value"), past.select("user_id", F.col("value").alias("v")),
                         "user_id", {"value": "v"})


@query("restore_table", sql=f"""
WITH past AS (SELECT user_id, value FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM {CHANGES_SQL} c WHERE ts <= TIMESTAMP '{AS_OF_TS}') x WHERE rn = 1 AND op <> 'DELETE'),
     cur AS (SELECT user_id FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM {CHANGES_SQL} c) x WHERE rn = 1 AND op <> 'DELETE')
SELECT past.user_id, past.value, CASE WHEN cur.user_id IS NULL THEN 'reinserted' ELSE 'kept' END AS _action
FROM past LEFT JOIN cur ON cur.user_id = past.user_id
""")
def restore_table(spark, sf_dir):
    """O4, whole table: keys created since t are gone, keys deleted since are
    back, all others have their values of t."""
    log = change_log(spark, sf_dir)
    current = O.as_of(log, "user_id", "ts", "event_id", "op", ["value"], "9999-12-31 23:59:59")
    return O.restore_table(current, "user_id", O.as_of(log, "user_id", "ts", "event_id", "op", ["value"], AS_OF_TS))
