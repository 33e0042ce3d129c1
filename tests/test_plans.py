"""Plan assertions: the physical plan is the one we want, not just the rows."""

from pyspark.sql import functions as F

from __spark_entry__ import entry, queries

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"category", "n_sales", "units_sold", "revenue"}


def test_partition_pruning(spark):
    df = queries()["partition_pruned_read"](spark, SF)
    p = _plan(df)
    assert "PartitionFilters: [isnotnull(p_range" in p or "PartitionFilters: [p_range" in p
    assert "PartitionFilters: []" not in p


def test_bucketed_join_no_shuffle(spark):
    df = queries()["bucketed_join"](spark, SF)
    p = _final_plan(df)
    assert "SortMergeJoin" in p or "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning" not in p


def test_top_three_uses_window_group_limit(spark):
    p = _plan(queries()["win_top3"](spark, SF))
    assert "WindowGroupLimit" in p


def test_topk_is_take_ordered(spark):
    p = _plan(queries()["topk"](spark, SF))
    assert "TakeOrderedAndProject" in p


def test_like_prefix_pushed(spark):
    p = _plan(queries()["filter_like"](spark, SF))
    assert "StringStartsWith(p_name,red)" in p


def test_projection_pruned(spark):
    p = _plan(queries()["category_revenue"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in p


def test_scan_reads_staged_partitions(spark):
    # the result reads the stored scan once and attaches one carry per partition; no Window, no shuffle
    from quarry.operators.windows import running_total
    from quarry.sources import tables

    o = tables(spark, SF).orders.select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("c"))
    p = _plan(running_total(o, [], [("o_orderkey", True)], "c", "s", n_partitions=7))
    assert "BroadcastHashJoin" in p and p.count("FileScan parquet") == 1
    assert "Window" not in p and "MapInArrow" not in p and "hashpartitioning" not in p
    p = _plan(queries()["win_running_total"](spark, SF))     # one partition has nothing to carry
    assert "Window" not in p and "Exchange hashpartitioning" not in p and p.count("FileScan parquet") == 1


def test_global_ranks_without_single_partition_window(spark):
    p = _plan(queries()["win_ranks"](spark, SF))
    assert "MapInPandas" not in p  # the scan was materialised; the plan reads it back
    assert "Window [" not in p.split("BroadcastExchange")[0]


def test_month_range_is_pushed(spark):
    p = _plan(queries()["monthly_order_summary"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_lossless_check_has_one_wide_join(spark):
    p = _plan(queries()["normalize_bcnf"](spark, SF))
    assert p.count("Location: InMemoryFileIndex") <= 5 or p.count("FileScan parquet") <= 5


def test_sql_udf_inlined(spark):
    p = _plan(queries()["sql_scalar_udf"](spark, SF))
    assert "Join" in p and "PythonUDF" not in p


def test_output_casts_consistent(spark):
    """Every DATE column a query yields is listed for the SQL side; no DATE or
    DECIMAL column leaves, and no integer key leaves as a double."""
    from pyspark.sql import types as T

    from __spark_entry__ import SQL_OUTPUT_CASTS, portable
    from quarry.plans import all_queries

    raw = {}
    for k, fn in all_queries().items():
        if k.startswith("stream_"):
            continue
        df = fn(spark, SF)
        before = {f.name: f.dataType for f in df.schema.fields}
        after = {f.name: f.dataType for f in portable(df, k).schema.fields}
        assert not [c for c, t in after.items() if isinstance(t, (T.DateType, T.DecimalType))], k
        assert not [c for c, t in after.items() if isinstance(t, T.DoubleType)
                    and not isinstance(before[c], (T.DoubleType, T.DecimalType))], k
        cols = {c: "TIMESTAMP" for c, t in before.items() if isinstance(t, T.DateType)}
        if cols:
            raw[k] = cols
    listed = {k: {c: t for c, t in v.items() if t == "TIMESTAMP"}
              for k, v in SQL_OUTPUT_CASTS.items() if not k.startswith("stream_")}
    assert raw == {k: v for k, v in listed.items() if v}


def test_bucketed_write_one_file_per_bucket(spark):
    from quarry.operators.layout import write_bucketed

    t = write_bucketed(spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey"),
                       "bucket_files", "o_custkey", 4)
    assert len(t.inputFiles()) <= 4


def test_left_join_on_fact_side_is_inner_plus_anti(spark):
    p = _plan(queries()["join_left"](spark, SF))
    assert "LeftOuter" not in p and "LeftAnti" in p and "Inner" in p
