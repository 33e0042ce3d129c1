"""Interleaved layout: files opened by either column; hot keys in buckets: balance and plans."""

import random

from pyspark.sql import functions as F

from quarry.operators import layout as N


def points(spark, n=40_000, seed=1):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, 7, 7, *range(2000)]), None if rng.random() < .01 else rng.expovariate(1 / 500)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a long, b double")


def test_z_value_interleaves(spark):
    row = spark.range(1).select(N.z_value([F.lit(0b101), F.lit(0b011)], 3).alias("z"), N.z_value([F.lit(5)], 3).alias("one")).first()
    assert (row.z, row.one) == (0b100111, 5)


def test_either_column_opens_few_files(spark, tmp_path):
    df = points(spark)
    N.write_interleaved(df, str(tmp_path / "z"), ["a", "b"], n_partitions=64)
    whole = len(spark.read.parquet(str(tmp_path / "z" / "data")).inputFiles())
    assert whole >= 60
    for ranges in ({"a": (500, 520)}, {"b": (100.0, 110.0)}, {"a": (7, 7)}, {"a": (500, 520), "b": (0.0, 300.0)}, {"b": (2000.0, None)}):
        got = N.read_ranges(spark, str(tmp_path / "z"), df.schema, ranges)
        want = df
        for c, (lo, hi) in ranges.items():
            want = want.filter(((F.col(c) >= lo) if lo is not None else F.lit(True)) & ((F.col(c) <= hi) if hi is not None else F.lit(True)))
        assert sorted(got.collect()) == sorted(want.collect()) and want.count()
        if ranges != {"a": (7, 7)}:     # one value in a fifth of the rows fills files of its own
            assert len(got.inputFiles()) <= whole / 3, (ranges, len(got.inputFiles()))
    both = N.read_ranges(spark, str(tmp_path / "z"), df.schema, {"a": (500, 520), "b": (100.0, 110.0)})
    assert len(both.inputFiles()) <= 6
    assert N.read_ranges(spark, str(tmp_path / "z"), df.schema, {"a": (10 ** 9, None)}).count() == 0
    rows = spark.read.parquet(str(tmp_path / "z" / "data"))
    assert rows.count() == df.count()     # NULLs in both columns are kept


def test_bloom_filter_skips_row_groups(spark, tmp_path):
    """Ids are spread over all files, so ranges say nothing; the filters leave the files that may hold one."""
    df = points(spark, 20_000).withColumn("id", F.col("id") * 2)
    N.write_interleaved(df, str(tmp_path / "z"), ["a", "b"], bloom=["id"], n_partitions=16)
    d = spark.read.schema(df.schema).parquet(str(tmp_path / "z" / "data"))

    def rows_read(value):
        q = d.filter(F.col("id") == value)
        n = len(q.collect())
        plan = q._jdf.queryExecution().executedPlan()
        scan = plan.collectLeaves().head()
        return n, scan.metrics().apply("numOutputRows").value()

    assert rows_read(20_001) == (0, 0)          # within every file's range, in none
    found, read = rows_read(20_000)
    assert found == 1 and read < 20_000 / 4


def test_heavy_hitters_are_exact(spark):
    rows = [(7,)] * 5000 + [(i,) for i in range(8000)] + [(None,)] * 3000 + [(3,)] * 900
    df = spark.createDataFrame(rows, "k long").repartition(6)
    assert N.heavy_hitters(df, "k", 10) == {7: 5001, 3: 901}
    assert N.heavy_hitters(df.limit(0), "k", 10) == {} and N.heavy_hitters(df.filter("k < 0"), "k", 10) == {}


def test_hot_key_is_spread_and_joined_without_a_shuffle(spark):
    """A third of the rows in one key: balanced files, one copy of its row per sub-bucket, no exchange in the join."""
    rng = random.Random(4)
    big = spark.createDataFrame([(i, 5 if i % 3 == 0 else rng.randrange(400)) for i in range(12_000)] + [(-1, None), (-2, 999)], "id long, k long")
    small = spark.createDataFrame([(i, f"n{i}") for i in range(400)] + [(5, "second"), (None, "none")], "pk long, name string")
    b, s = N.write_bucketed_pair(big, "k", small, "pk", "hot", buckets=12)
    joined = N.join_bucketed(b, s)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = N.join_bucketed(b, s)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(joined.select("id", "k", "name").collect()) == sorted(big.join(small, F.col("k") == F.col("pk")).select("id", "k", "name").collect())
    sizes = [r["count"] for r in b.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / 12
    assert s.count() <= small.count() + 2 * 12 / N.HOT_SHARE and s.filter("pk = 5").count() > 2
