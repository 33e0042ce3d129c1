"""Sketched profiles: exact counts, estimates within the stated errors, merging, and the plan."""

import datetime as dt
import random

from pyspark.sql import functions as F

from quarry.operators import profile as P


def table(spark, n=30_000):
    rng = random.Random(3)
    rows = [(i % 5, None if i % 11 == 0 else rng.randrange(9000), rng.lognormvariate(2, 1), rng.choice("aaaabbc"), f"u{i}",
             dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(n)]
    return spark.createDataFrame(rows, "day long, k long, x double, s string, u string, t timestamp_ntz")


COLS = ["k", "x", "s", "u", "t"]


def test_estimates_within_the_stated_errors(spark):
    df = table(spark)
    stored = P.sketch(df, COLS, ["day"])
    assert stored.count() == 25
    merged = P.merge(stored, kinds={"k": "bigint", "x": "double"})
    got = {r.column_name: r for r in P.describe(merged).collect()}
    whole = {r.column_name: r for r in P.describe(P.sketch(df, COLS)).collect()}
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in COLS]).first()
    for c in COLS:
        for r in (got[c], whole[c]):
            assert r.n_rows == 30_000 and r.n_nulls == df.filter(F.col(c).isNull()).count()
            assert abs(r.n_distinct - exact[c]) <= 4 * P.DISTINCT_ERROR * exact[c] + 1
    assert (got["k"].least, got["k"].greatest) == tuple(map(str, df.agg(F.min("k"), F.max("k")).first()))
    assert float(got["x"].greatest) == df.agg(F.max("x")).first()[0]
    assert [(t["item"], t["count"]) for t in got["s"].frequent] == [
        (r.s, r["count"]) for r in df.groupBy("s").count().orderBy(F.desc("count")).collect()]
    for c in ("k", "x"):
        n = df.filter(F.col(c).isNotNull()).count()
        for q, v in zip((.25, .5, .75), got[c].quantiles):
            assert abs(df.filter(F.col(c) <= v).count() / n - q) <= 2.5 * P.RANK_ERROR
    assert got["s"].quantiles is None and got["u"].quantiles is None
    mid = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15_000)
    assert abs(got["t"].quantiles[1] - mid.replace(tzinfo=dt.timezone.utc).timestamp()) < 30_000 * 60 * 2.5 * P.RANK_ERROR


def test_a_new_group_is_merged_into_stored_ones(spark, tmp_path):
    df = table(spark, 4000)
    P.sketch(df.filter("day < 4"), COLS, ["day"]).write.parquet(str(tmp_path / "p"))
    P.sketch(df.filter("day = 4"), COLS, ["day"]).write.mode("append").parquet(str(tmp_path / "p"))
    a = P.describe(P.merge(spark.read.parquet(str(tmp_path / "p")))).select("column_name", "n_rows", "n_nulls", "frequent")
    b = P.describe(P.sketch(df, COLS)).select("column_name", "n_rows", "n_nulls", "frequent")
    pick = lambda d: sorted((r.column_name, r.n_rows, r.n_nulls, r.frequent if r.column_name == "s" else None) for r in d.collect())
    assert pick(a) == pick(b)


def test_empty_and_all_null(spark):
    df = table(spark, 50)
    r = P.describe(P.sketch(df.limit(0), COLS)).collect()
    assert len(r) == 5 and all((x.n_rows, x.n_nulls, x.n_distinct, x.quantiles) == (0, 0, 0, None) for x in r)
    nul = P.describe(P.merge(P.sketch(df.withColumn("k", F.lit(None).cast("long")), ["k"], ["day"]))).first()
    assert (nul.n_nulls, nul.n_distinct, nul.least, nul.quantiles) == (50, 0, None, None)


def test_plan_copies_no_row_per_column(spark):
    plan = P.sketch(table(spark, 10), COLS, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1


def test_most_values_null(spark, tmp_path):
    """NULL takes no place among the most frequent values, and the query finds one where most flags are NULL or all are."""
    from __spark_entry__ import queries

    df = table(spark, 700).withColumn("s", F.when(F.col("day") == 1, F.col("s")))
    got = P.describe(P.merge(P.sketch(df, ["s"], ["day"])), top=1).first().frequent
    assert [t["item"] for t in got] == ["a"]
    for name, flag in (("some", F.when(F.col("id") % 5 == 0, "R")), ("none", F.lit(None).cast("string"))):
        line = spark.range(300).select(
            F.col("id").alias("l_partkey"), (F.col("id") % 50).cast("double").alias("l_quantity"), F.col("id").cast("double").alias("l_extendedprice"),
            flag.alias("l_returnflag"), F.lit(dt.datetime(1996, 5, 1)).cast("timestamp_ntz").alias("l_shipdate"))
        line.write.parquet(str(tmp_path / name / "lineitem.parquet"))
        rows = {r.column_name: r for r in queries()["profile_sketches"](spark, str(tmp_path / name)).collect()}
        assert rows["l_returnflag"].top == ("R" if name == "some" else None)
        assert rows["l_returnflag"].n_nulls == (240 if name == "some" else 300) and rows["l_quantity"].median_close
