"""L: keys."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..functions.scalars import epoch_millis
from ..operators import keys as L
from ..sources import tables
from ..sources.writers import stage
from .registry import query

UUID7_SQL = """(WITH x AS (
  SELECT event_id, ts,
         lpad(lower(hex(epoch_us(ts) // 1000)), 12, '0') || '7' || substr(md5(CAST(event_id AS VARCHAR)), 1, 3)
         || substr('89ab', (strpos('0123456789abcdef', substr(md5(CAST(event_id AS VARCHAR)), 4, 1)) - 1) % 4 + 1, 1)
         || substr(md5(CAST(event_id AS VARCHAR)), 5, 15) AS raw
  FROM events)
SELECT event_id, ts, substr(raw, 1, 8) || '-' || substr(raw, 9, 4) || '-' || substr(raw, 13, 4) || '-'
       || substr(raw, 17, 4) || '-' || substr(raw, 21, 12) AS uuid FROM x)"""


@query("assign_identity", sql="""
SELECT c_custkey, (ROW_NUMBER() OVER (ORDER BY c_custkey) - 1) * 10 + 1000 AS cliente_id FROM customer
""")
def assign_identity(spark, sf_dir):
    """L1: identity START WITH 1000 INCREMENT BY 10 in a stable order."""
    c = tables(spark, sf_dir).customer.select("c_custkey")
    return L.assign_identity(c, [("c_custkey", True)], "cliente_id", start=1000, increment=10)


@query("uuid4_keys")
def uuid4_keys(spark, sf_dir):
    """L2: random UUID v4 keys, materialised once (they are not repeatable)."""
    e = tables(spark, sf_dir).events.select("event_id")
    _, landed = stage(L.uuid4_keys(e, "uuid"), "uuid4_keys")
    return landed


@query("uuid4_properties", sql="""
SELECT COUNT(*) AS n_keys, COUNT(*) AS n_distinct, COUNT(*) AS n_length, COUNT(*) AS n_version, COUNT(*) AS n_variant
FROM events
""")
def uuid4_properties(spark, sf_dir):
    """L2: what can be said of random keys: all distinct, 36 characters,
    version 4 and variant marks in place."""
    e = tables(spark, sf_dir).events.select("event_id")
    _, k = stage(L.uuid4_keys(e, "uuid"), "uuid4_keys")
    one = lambda c: F.count(F.when(c, 1))
    return k.agg(F.count("uuid").alias("n_keys"), F.countDistinct("uuid").alias("n_distinct"),
                 one(F.length("uuid") == 36).alias("n_length"), one(F.substring("uuid", 15, 1) == "4").alias("n_version"),
                 one(F.substring("uuid", 20, 1).isin("8", "9", "a", "b")).alias("n_variant"))


@query("uuid7_keys", sql=f"SELECT event_id, uuid FROM {UUID7_SQL} u")
def uuid7_keys(spark, sf_dir):
    """L3: UUID v7 per event (time-ordered: 48-bit ms prefix)."""
    e = tables(spark, sf_dir).events
    return e.select("event_id", L.uuid7("ts", "event_id").alias("uuid"))


@query("uuid7_extract", sql=f"""
SELECT event_id, CAST('0x' || substr(replace(uuid, '-', ''), 1, 12) AS BIGINT) AS key_millis,
       CAST('0x' || substr(replace(uuid, '-', ''), 1, 12) AS BIGINT) = epoch_us(ts) // 1000 AS matches_ts
FROM {UUID7_SQL} u
""")
def uuid7_extract(spark, sf_dir):
    """L4: the timestamp read back from the key equals the event time in ms."""
    e = tables(spark, sf_dir).events
    k = e.select("event_id", "ts", L.uuid7("ts", "event_id").alias("uuid"))
    ms = L.uuid7_millis("uuid")
    return k.select("event_id", ms.alias("key_millis"),
                    (ms == epoch_millis("ts")).alias("matches_ts"))
