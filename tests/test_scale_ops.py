"""The skew-proof primitives against brute force, and the clinic generator
checks of FIXTURES section 3."""

import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import windows as W
from quarry.operators.overlap import conflict_counts
from quarry.operators.scan import running_sum
from quarry.sources.generators import visits_from_ids


def test_running_sum_matches_window_with_hot_and_null_groups(spark):
    random.seed(7)
    rows = []
    for i in range(6000):
        g = 0 if random.random() < 0.5 else random.randint(1, 40)
        rows.append((None if random.random() < 0.03 else g, random.randint(0, 300), i, random.randint(-5, 50)))
    df = spark.createDataFrame(rows, "g long, o long, id long, v long").cache()
    r = running_sum(df, ["g"], ["o", "id"], ["v"], n_partitions=11)
    w = Window.partitionBy("g").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.sum("v").over(w)).select("id", "ref")
    assert r.join(ref, "id").filter(F.col("v_cum") != F.col("ref")).count() == 0
    assert r.count() == 6000
    df.unpersist()


def test_running_sum_many_batches(spark):
    # partitions larger than one Arrow batch: the carry between batches
    df = spark.range(0, 120000).select((F.col("id") % 7).alias("g"), (F.col("id") % 97).alias("o"),
                                       F.col("id"), F.lit(1).cast("long").alias("v"))
    r = running_sum(df, ["g"], ["o", "id"], ["v"], n_partitions=3)
    w = Window.partitionBy("g").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.sum("v").over(w)).select("id", "ref")
    assert r.join(ref, "id").filter(F.col("v_cum") != F.col("ref")).count() == 0


import pytest


def test_global_ranks(spark):
    vals = [5.0, 3.0, 5.0, None, 1.0, 3.0, 3.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    r = W.row_number(df, [], [("x", False), ("id", True)], "rn")
    r = W.rank_dense_rank(r, [], [("x", False)], "rk", "dr")
    got = {row.id: (row.rn, row.rk, row.dr) for row in r.collect()}
    pdf = pd.DataFrame({"id": range(7), "x": vals})
    # SQL DESC puts NULL first
    order = sorted(range(7), key=lambda i: (0 if vals[i] is None else 1, -(vals[i] or 0), i))
    assert [got[i][0] for i in order] == list(range(1, 8))
    assert got[3] == (1, 1, 1)               # NULL first
    assert got[0][1:] == (2, 2) and got[2][1:] == (2, 2)
    assert got[1][1:] == (4, 3) and got[4][1:] == (7, 4)
    assert pdf is not None


def test_conflict_counts_brute_force(spark):
    random.seed(3)
    import datetime as dt

    base = dt.datetime(2025, 6, 1, 8)
    rows = [(i, random.randint(1, 4), base + dt.timedelta(minutes=random.choice([0, 10, 29, 30, 31, 45, 60, 90])
                                                            + 60 * random.randint(0, 3)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k long, t timestamp_ntz")
    got = {r.id: r.n_conflicts for r in conflict_counts(df, "k", "t", "id", 30, n_partitions=5).collect()}
    want = {}
    for i, k, t in rows:
        n = sum(1 for j, k2, t2 in rows if j != i and k2 == k and abs((t2 - t).total_seconds()) < 1800)
        if n:
            want[i] = n
    assert got == want


def test_clinic_generator_counts(spark):
    v = visits_from_ids(spark.range(1, 300001).withColumnRenamed("id", "g"), "g").cache()
    st = {r.status: r["count"] for r in v.groupBy("status").count().collect()}
    assert st == {"CANCELADA": 15000, "AGENDADA": 15000, "REALIZADA": 270000}
    assert v.filter((F.col("status") == "REALIZADA") & (F.col("convenio_id") == 2)).count() == 90000
    lo, hi = F.lit("2025-06-01 00:00:00").cast("timestamp_ntz"), F.lit("2025-06-07 23:59:59").cast("timestamp_ntz")
    week = v.filter(F.col("data_hora").between(lo, hi))
    assert week.count() == 2877
    d42 = week.filter(F.col("medico_id") == 42)
    assert d42.count() == 21
    assert {r.d for r in d42.select(F.to_date("data_hora").alias("d")).distinct().collect()} == {
        __import__("datetime").date(2025, 6, 5)}
    # top doctors since 2025-01-01: 8 tie at 762, then 24 at 761
    top = (v.filter(F.col("data_hora") >= F.lit("2025-01-01").cast("timestamp_ntz"))
           .groupBy("medico_id").count().orderBy(F.col("count").desc(), "medico_id").limit(32).collect())
    assert [r["count"] for r in top] == [762] * 8 + [761] * 24
    # double bookings among live visits: pairs counted twice, once per side
    live = v.filter(F.col("status") != "CANCELADA").select("consulta_id", "medico_id", "data_hora")
    cc = conflict_counts(live, "medico_id", "data_hora", "consulta_id", 30, n_partitions=16)
    agg = cc.agg(F.sum("n_conflicts").alias("s"),
                 F.countDistinct("medico_id", "data_hora").alias("slots")).first()
    assert agg.s == 2 * 2787300 and agg.slots == 13870
    v.unpersist()


def test_uuid7_roundtrip(spark):
    from quarry.functions.scalars import epoch_millis
    from quarry.operators.keys import uuid7, uuid7_millis

    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    k = e.select("event_id", "ts", uuid7("ts", "event_id").alias("u"))
    bad = k.filter((uuid7_millis("u") != epoch_millis("ts"))
                   | (F.substring("u", 15, 1) != "7") | ~F.substring("u", 20, 1).isin("8", "9", "a", "b")
                   | (F.length("u") != 36))
    assert bad.count() == 0
    # key order = time order (ms prefix)
    rows = k.select("u", epoch_millis("ts").alias("ms")).orderBy("u").collect()
    ms = [r.ms for r in rows]
    assert ms == sorted(ms)


def test_order_intake_brute_force(spark):
    from __spark_entry__ import queries

    got = queries()["order_intake"](spark, "/root/testdata/sf0.001").toPandas()
    got = got.sort_values(["l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"])
    ok = True
    for _, g in got.groupby("l_partkey"):
        left = g["stock"].iloc[0]
        for q, a in zip(g["l_quantity"], g["accepted"]):
            want = q <= left
            if want:
                left -= q
            ok &= bool(want) == bool(a)
    assert ok


def test_epoch_millis_ignores_session_time_zone(spark):
    from quarry.functions.scalars import epoch_millis

    df = spark.createDataFrame([("2024-01-01 00:00:07.179575",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert df.select(epoch_millis("ts")).first()[0] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_windows_match_spark(spark, kind, descending):
    """Every function against Spark's Window: NULL and NaN order keys,
    descending strings, NULL values."""
    from pyspark.sql import Window

    random.seed(11)
    def key():
        o = random.choice([None, *range(20)])
        return o if kind == "long" or o is None else (f"k{o}é" if kind == "string" else (float("nan") if o == 7 else o / 3))

    rows = [(i, random.choice([1, 1, 1, 2, 3, None]), key(), random.choice([None, *range(99)])) for i in range(1500)]
    df = spark.createDataFrame(rows, f"id long, g long, o {kind}, v long").cache()
    order = [("o", not descending), ("id", True)]
    r = W.row_number(df, ["g"], order, "rn", n_partitions=7)
    r = W.rank_dense_rank(r, ["g"], order[:1], "rk", "dr", n_partitions=7)
    r = W.running_total(r, ["g"], order, "v", "rt", n_partitions=7)
    r = W.running_peers(r, ["g"], order[:1], "v", "ps", "pn", n_partitions=7)
    r = W.lag_lead(r, ["g"], order, "v", 1, "lg")
    r = W.lag_lead(r, ["g"], order, "v", -2, "ld")
    o = F.col("o").desc_nulls_first() if descending else F.col("o").asc_nulls_first()
    peers, w = Window.partitionBy("g").orderBy(o), Window.partitionBy("g").orderBy(o, "id")
    rows_w = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.row_number().over(w).alias("rn"), F.rank().over(peers).alias("rk"),
                     F.dense_rank().over(peers).alias("dr"), F.sum("v").over(rows_w).alias("rt"),
                     F.sum("v").over(peers).alias("ps"), F.count(F.lit(1)).over(peers).alias("pn"),
                     F.lag("v", 1).over(w).alias("lg"), F.lead("v", 2).over(w).alias("ld"))
    cols = ["id", "rn", "rk", "dr", "rt", "ps", "pn", "lg", "ld"]
    assert sorted(map(tuple, r.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    df.unpersist()


def test_overlap_counts_brute_force(spark):
    import datetime as dt

    from quarry.operators.overlap import overlap_counts

    random.seed(5)
    base = dt.datetime(2025, 6, 1, 8)
    rows = []
    for i in range(300):
        s = base + dt.timedelta(minutes=10 * random.randint(0, 30))
        rows.append((i, random.choice([1, 1, 2, None]), s, s + dt.timedelta(minutes=10 * random.randint(0, 9))))
    df = spark.createDataFrame(rows, "id long, k long, s timestamp_ntz, e timestamp_ntz")
    got = {r.id: r.n_conflicts for r in overlap_counts(df, ["k"], "s", "e", "id", n_partitions=5).collect()}
    live = [r for r in rows if r[1] is not None and r[2] < r[3]]
    want = {a[0]: n for a in live if (n := sum(b[0] != a[0] and b[1] == a[1] and a[2] < b[3] and b[2] < a[3] for b in live))}
    assert got == want


def test_hot_group_spreads_over_partitions(spark):
    """One group holding 60% of the rows is cut into many range partitions
    by the scan's sort key (group, order, tiebreak), not sent to one task."""
    df = spark.range(0, 50000).select(
        F.when(F.col("id") % 5 < 3, F.lit(0)).otherwise(F.col("id") % 97).alias("g"),
        (F.col("id") % 1000).alias("o"), F.col("id"))
    sizes = [r["count"] for r in df.repartitionByRange(10, "g", "o", "id")
             .groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * (50000 / 10)
    hot = [r["count"] for r in df.repartition(10, "g").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(hot) >= 30000  # what a plain Window.partitionBy(g) would give one task
    r = running_sum(df.withColumn("v", F.lit(1).cast("long")), ["g"], ["o", "id"], ["v"], n_partitions=10)
    assert r.filter(F.col("g") == 0).agg(F.max("v_cum")).first()[0] == df.filter(F.col("g") == 0).count()


def test_running_sum_large_nullable_keys(spark):
    big = 2 ** 62
    rows = [(big, 1, 1), (big + 1, 1, 2), (None, 1, 3), (big + 1, 2, 4), (big, 2, 5), (None, 2, 6)]
    df = spark.createDataFrame([(g, o, i, 1) for g, o, i in rows], "g long, o long, id long, v long")
    r = running_sum(df, ["g"], ["o", "id"], ["v"], n_partitions=1)
    assert {x.id: x.v_cum for x in r.collect()} == {1: 1, 5: 2, 2: 1, 4: 2, 3: 1, 6: 2}


def test_intake_rounds_with_a_hot_product(spark):
    """A product with a third of the requests, small and large ones in turn."""
    from quarry.operators.domain import order_intake

    rng = random.Random(5)
    rows = [(i, 0 if i % 3 == 0 else rng.randint(1, 40), float(rng.choice([1, 2, 49, 50]) if i % 3 == 0 else rng.randint(1, 50)))
            for i in range(3000)] + [(3000, 1, None), (3001, 999, 5.0)]
    stock = {p: float(rng.choice([0, 10, 150])) for p in range(1, 41)} | {0: 4000.0, 999: None}
    df = spark.createDataFrame([(i, p, q, stock[p]) for i, p, q in rows], "id long, p long, q double, s double")
    got = {r.id: (r.accepted, r.remaining) for r in order_intake(df, "p", ["id"], "q", "s", n_partitions=6).collect()}
    left = dict(stock)
    for i, p, q in rows:
        ok = q is not None and left[p] is not None and q <= left[p]
        if ok:
            left[p] -= q
        assert got[i] == (ok, left[p]), i
