"""Scans over ordered groups against Spark's own Window, which may put a group into one task."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import windows as W
from quarry.operators.scan import Frame, last_known, ranks


def table(spark, seed, n=400):
    """A third of the rows in one group; NULL groups, values and order keys; ties; NaN and -0.0."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = rng.choice(["hot", None, "a", "b", "c", "hot"])
        rows.append((i, g, rng.choice([None, 1, 2, 3, 4]), rng.choice([None, *range(-9, 9)]),
                     rng.choice([None, float("nan"), -0.0, 0.0, 1.5, -2.25]),
                     None if rng.random() < .2 else dt.datetime(2024, 1, 1 + rng.randrange(28)),
                     None if rng.random() < .2 else dt.date(2024, 1, 1 + rng.randrange(28)), f"s{rng.randrange(9)}"))
    return spark.createDataFrame(rows, "id long, g string, o int, v long, d double, t timestamp_ntz, day date, s string")


def shown(df):
    """Rows as text; -0.0 equals 0.0, and either may be the least of a frame."""
    return sorted(re.sub(r"-0\.0(?=[,)])", "0.0", str(tuple(r))) for r in df.collect())


SPECS = {
    "lag1": Frame("lag", "s", preceding=1), "lag5": Frame("lag", "v", preceding=5), "lead2": Frame("lead", "t", following=2),
    "sum": Frame("sum", "v", 3, 1), "n": Frame("count", "d", 2, 2), "lo": Frame("min", "d", 4, 0), "hi": Frame("max", "d", 1, 5),
    "lo_v": Frame("min", "v", 0, 3), "hi_t": Frame("max", "t", 2, 0), "lo_day": Frame("min", "day", 2, 3),
    "first": Frame("first", "day", 3, 0), "last": Frame("last", "s", 1, 1), "next": Frame("max", "v", -1, 3),
    "before": Frame("sum", "v", 4, -2), "one": Frame("lead", "id", following=0),
}


@pytest.mark.parametrize("parts, batch", [(1, 10_000), (7, 3), (40, 10_000), (150, 2)])
def test_frames_equal_windows(spark, parts, batch):
    """150 partitions of 400 rows: frames are wider than a partition."""
    df = table(spark, parts)
    order = [("o", False), ("id", True)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = shown(W.frames(df, ["g"], order, SPECS, n_partitions=parts))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    keys = [F.col("o").desc_nulls_first(), F.col("id").asc_nulls_first()]
    want = df.select("*", *[f.column(["g"], keys).alias(n) for n, f in SPECS.items()])
    assert got == shown(want)


def test_wide_frames_and_no_group(spark):
    df = table(spark, 5)
    specs = {"m": Frame("max", "v", 90, 60), "s": Frame("sum", "v", 200, 0), "f": Frame("first", "id", 300, 300)}
    got = shown(W.frames(df, [], ["id"], specs, n_partitions=9))
    want = df.select("*", *[f.column([], [F.col("id")]).alias(n) for n, f in specs.items()])
    assert got == shown(want)


@pytest.mark.parametrize("parts, batch", [(3, 10_000), (60, 4)])
def test_ranks_in_one_scan(spark, parts, batch):
    df = table(spark, parts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for group in (["g"], []):
            for col in ("o", "d"):
                got = shown(ranks(df, group, [(col, False), ("id", True)], [col], "n", "r", "k", n_partitions=parts))
                w = Window.partitionBy(*group).orderBy(F.col(col).desc_nulls_first())
                by_id = Window.partitionBy(*group).orderBy(F.col(col).desc_nulls_first(), "id")
                want = df.select("*", F.row_number().over(by_id).alias("n"), F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("k"))
                assert got == shown(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("parts", [1, 6, 80])
def test_last_known_row(spark, parts):
    df = table(spark, parts).withColumn("h", F.col("id") % 7 == 0).withColumn("x", F.struct("id", "v"))
    df = df.withColumn("x", F.when(F.col("id") % 14 != 0, F.col("x")))
    got = shown(last_known(df, ["g"], ["o", "id"], "h", "x", "seen", n_partitions=parts))
    w = Window.partitionBy("g").orderBy(F.col("o").asc_nulls_first(), "id").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("h"), F.struct(F.col("x").alias("y"))), ignorenulls=True).over(w)
    assert got == shown(df.select("*", seen["y"].alias("seen")))


def test_empty_and_single_rows(spark):
    df = table(spark, 1, 1)
    assert W.frames(df.limit(0), ["g"], ["id"], SPECS).count() == 0
    assert W.all_ranks(df.limit(0), ["g"], [("o", True)], [("id", True)]).count() == 0
    r = W.frames(df, ["g"], ["id"], {"a": Frame("lag", "id", 1), "b": Frame("sum", "id", 1, 1)}).first()
    assert (r.a, r.b) == (None, 0)
    with pytest.raises(ValueError):
        W.frames(df.withColumn("m", F.lit(1).cast("decimal(9,2)")), ["g"], ["id"], {"a": Frame("sum", "m", 1)})


def test_plan_has_no_join_and_reads_the_staged_rows(spark):
    """The rows pass one range exchange, when they are written; the result reads
    them back without a shuffle, and only the edge rows meet in a Window."""
    df = table(spark, 2)
    plan = W.frames(df, ["g"], ["id"], {"a": Frame("lag", "v", 1)})._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "RepartitionByExpression" not in plan and plan.count("Window") >= 1
    edges = next(x for x in plan.splitlines() if "Window" in x)
    assert edges
    scans = W.frames(df, ["g"], ["id"], {"a": Frame("lag", "v", 1)})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_scan_edge" in scans


def test_as_of_join_of_many_probes(spark):
    from quarry.operators.history import as_of_join

    rng = random.Random(8)
    keys = ["hot", "hot", "a", "b", None]
    hist = [(rng.choice(keys), rng.choice([None, *range(40)]), i, rng.choice(["UPSERT", "UPSERT", "DELETE"]), rng.choice([None, i])) for i in range(120)]
    asks = [(i, rng.choice([*keys, "nobody"]), rng.choice([None, *range(-2, 45)]), rng.choice([None, 1])) for i in range(200)]
    asks += asks[:5]
    h = spark.createDataFrame(hist, "k string, ts long, n long, op string, value long")
    p = spark.createDataFrame(asks, "id long, who string, at long, value2 long")
    want = []
    for i, k, t, x in asks:
        past = [r for r in hist if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        last = max(past, key=lambda r: (r[1], r[2]), default=None)
        dead = last is None or last[3] == "DELETE"
        want.append((i, k, t, x, None if dead else last[1], None if dead else last[4]))
    for parts in (1, 9, 100):
        got = as_of_join(p, "who", "at", h, "k", "ts", "n", "op", ["value"], n_partitions=parts)
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    assert as_of_join(p, "who", "at", h.limit(0), "k", "ts", "n", "op", ["value"]).filter("changed_at IS NOT NULL").count() == 0
