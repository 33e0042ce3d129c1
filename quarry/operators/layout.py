"""N: schema change and physical layout of Parquet datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def partition_labels(spark: SparkSession, path: str, part_col: str) -> list[str]:
    """Labels of the partition folders that exist (a listing of one folder)."""
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{part_col}="))


def label_years(label: str) -> tuple[int, int]:
    """Years that a label of ``year_range_partition`` or of a merge covers:
    ``ate_Y`` all up to Y, ``Y`` one, ``Y_Z`` from Y to Z, else (the DEFAULT
    label) any year."""
    parts = label.split("_")
    if len(parts) == 2 and parts[0] == "ate" and parts[1].isdigit():
        return -10**9, int(parts[1])
    if all(p.isdigit() for p in parts) and len(parts) <= 2:
        return int(parts[0]), int(parts[-1])
    return -10**9, 10**9


def prune_by_date(df: DataFrame, date_col: str, part_col: str, lo: str, hi: str, labels: list[str]) -> DataFrame:
    """Filter a year-partitioned dataset by a date range. Spark cannot infer a
    partition filter from a filter on the date column, so the labels (those
    that exist: see ``partition_labels``) whose years meet the range are
    filtered explicitly, merged ones included."""
    y0, y1 = int(lo[:4]), int(hi[:4])
    hit = [x for x in labels if label_years(x)[0] <= y1 and label_years(x)[1] >= y0]
    cond = F.col(date_col).between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))
    return df.filter(F.col(part_col).isin(hit) & cond)


def drop_partitions(spark: SparkSession, path: str, part_col: str, values: list[str]) -> None:
    """Retention: remove whole partition folders through the Hadoop
    FileSystem API (works on any shared file system)."""
    for v in values:
        fs, p = _fs(spark, f"{path}/{part_col}={v}")
        if fs.exists(p):
            fs.delete(p, True)


def merge_partitions(spark: SparkSession, path: str, part_col: str, values: list[str], new_value: str,
                     schema: T.StructType, cluster_cols: list[str] | None = None) -> None:
    """Rewrite the rows of some partitions under one new label, compacted;
    other partitions are not touched. The new folder is written and counted
    before the old ones are dropped, so a failed write loses nothing."""
    from ..sources.writers import read_partitioned, write_partitioned

    if new_value in values or new_value in partition_labels(spark, path, part_col):
        raise ValueError(f"partition {new_value} exists already")
    old = read_partitioned(spark, path, schema).filter(F.col(part_col).isin(values))
    write_partitioned(old.withColumn(part_col, F.lit(new_value)), path, part_col, cluster_cols, mode="append")
    counts = {r[0]: r[1] for r in read_partitioned(spark, path, schema).filter(
        F.col(part_col).isin([*values, new_value])).groupBy(part_col).count().collect()}  # one row per label
    if counts.get(new_value, 0) != sum(n for v, n in counts.items() if v != new_value):
        raise OSError(f"merge into {new_value} is incomplete; the old partitions are kept")
    drop_partitions(spark, path, part_col, values)


def write_clustered(df: DataFrame, path: str, cols: list[str], n_partitions: int | None = None) -> None:
    """Range-partition and sort by the lookup key so each file (and row
    group) covers a narrow key range: min/max statistics then skip data."""
    ranged = df.repartitionByRange(n_partitions, *cols) if n_partitions else df.repartitionByRange(*cols)
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def bucket_count(spark: SparkSession) -> int:
    """Buckets per table: ``quarry.buckets`` or the shuffle partition count."""
    return int(spark.conf.get("quarry.buckets", spark.conf.get("spark.sql.shuffle.partitions")))


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """Hash-bucketed, sorted table stored in the shared checkpoint area;
    returned as a table scan so its bucketing is known to the planner.

    Rows are first hash-partitioned on the key into as many tasks as buckets
    (the same hash Spark uses for bucket ids), so each task writes exactly one
    bucket file instead of one file per bucket per task."""
    spark = df.sparkSession
    b = buckets or bucket_count(spark)
    path = scratch_path(spark, name)
    table = f"{name}_{path.rsplit('-', 1)[-1]}"
    (df.repartition(b, key).write.mode("overwrite").option("path", path)
     .bucketBy(b, key).sortBy(key).saveAsTable(table))
    return spark.table(table)


def read_with_added_column(spark: SparkSession, path: str, old_schema: T.StructType, name: str,
                           dtype: T.DataType, default_sql: str) -> DataFrame:
    """Read with the new schema: files without the column give the declared
    default (the schema's existence default); a NULL that was written later
    stays NULL."""
    field = T.StructField(name, dtype, True, {"EXISTS_DEFAULT": default_sql, "CURRENT_DEFAULT": default_sql})
    return spark.read.schema(T.StructType([*old_schema.fields, field])).parquet(path)


def evolve(df: DataFrame, path: str, widen: dict | None = None, rename: dict | None = None,
           drop: list | None = None) -> None:
    for c, t in (widen or {}).items():
        df = df.withColumn(c, F.col(c).cast(t))
    for a, b in (rename or {}).items():
        df = df.withColumnRenamed(a, b)
    df = df.drop(*(drop or []))
    df.write.mode("overwrite").parquet(path)


def fill_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Columns not named by an insert take their DEFAULT expression; an
    explicit NULL stays NULL."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def add_partition(df: DataFrame, path: str, part_col: str, cluster_cols: list[str] | None = None) -> None:
    """ADD / ATTACH PARTITION: append rows under their partition folders."""
    from ..sources.writers import write_partitioned

    write_partitioned(df, path, part_col, cluster_cols, mode="append")


def detach_partition(spark: SparkSession, path: str, part_col: str, value: str, dest: str) -> DataFrame:
    """DETACH PARTITION: the folder leaves the table but keeps its data, as a
    table of its own at ``dest`` (a metadata-only move on the file system)."""
    fs, src = _fs(spark, f"{path}/{part_col}={value}")
    _, dst = _fs(spark, dest)
    if fs.exists(src):
        parent = dst.getParent()
        if parent is not None and not fs.exists(parent):
            fs.mkdirs(parent)
        if not fs.rename(src, dst):
            raise OSError(f"could not detach {src} to {dst}")
    return spark.read.parquet(dest).withColumn(part_col, F.lit(value))


def z_value(columns: list[Column], bits: int) -> Column:
    """Numbers of ``bits`` bits each, bits interleaved (the first column's are
    the higher ones): near in all columns means near in this order."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for j, c in enumerate(reversed(columns)):
            one = F.shiftright(c.cast("long"), bit).bitwiseAND(1)
            out = out.bitwiseOR(F.shiftleft(one, bit * len(columns) + j))
    return out


def _rank_bits(df: DataFrame, cols: list[str], bits: int) -> tuple[DataFrame, list[str]]:
    """``df`` with the position of each column's value among its own 2^bits
    quantiles (``_z_<c>``; NULL comes first), so that skewed values still spread
    over all bits. The driver sees 2^bits - 1 numbers per column."""
    from pyspark.ml.feature import Bucketizer

    as_number = {c: F.col(c).cast("timestamp").cast("double") if isinstance(df.schema[c].dataType, (T.TimestampNTZType, T.DateType))
                 else F.col(c).cast("double") for c in cols}
    steps = [k / 2 ** bits for k in range(1, 2 ** bits)]
    found = df.agg(*[F.percentile_approx(as_number[c], steps, 10_000).alias(c) for c in cols]).first()
    out = df.withColumns({f"_zv_{c}": v for c, v in as_number.items()})
    for c in cols:
        edges = sorted({x for x in found[c] or [] if x == x})
        splits = [-float("inf"), *edges, float("inf")] if edges else [-float("inf"), 0.0, float("inf")]
        out = Bucketizer(splits=splits, inputCol=f"_zv_{c}", outputCol=f"_zb_{c}", handleInvalid="keep").transform(out)
        out = out.withColumn(f"_z_{c}", F.when(F.col(f"_zv_{c}").isNull(), 0).otherwise(F.col(f"_zb_{c}")).cast("long"))
    return out.drop(*[f"_zv_{c}" for c in cols], *[f"_zb_{c}" for c in cols]), [f"_z_{c}" for c in cols]


def write_interleaved(df: DataFrame, path: str, cols: list[str], bits: int = 8, bloom: list[str] | None = None,
                      n_partitions: int | None = None) -> None:
    """Cluster by several columns at once: rows in the order of the interleaved
    bits of the columns' quantile numbers, so that a file covers a narrow range of
    each of them, and a manifest of the files' ranges (``read_ranges``) beside
    the data. ``bloom`` columns get Parquet bloom filters for equality lookups."""
    ranked, names = _rank_bits(df, cols, bits)
    z = ranked.withColumn("_z", z_value([F.col(n) for n in names], bits))
    ranged = z.repartitionByRange(n_partitions, "_z", *cols) if n_partitions else z.repartitionByRange("_z", *cols)
    writer = ranged.sortWithinPartitions("_z", *cols).select(*df.columns).write.mode("overwrite")
    for c in bloom or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(f"{path}/data")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data").select(F.input_file_name().alias("file"), *cols)
    ends = [x for c in cols for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    written.groupBy("file").agg(*ends).write.mode("overwrite").parquet(f"{path}/manifest")


def read_ranges(spark: SparkSession, path: str, schema: T.StructType, ranges: dict[str, tuple]) -> DataFrame:
    """Rows of an interleaved table with every column of ``ranges`` within its
    (low, high), both included, None for open. Only files whose ranges meet them
    are opened; the driver sees the names of these files."""
    files = spark.read.parquet(f"{path}/manifest")
    rows: Column = F.lit(True)
    for c, (low, high) in ranges.items():
        kind = schema[c].dataType
        if low is not None:
            files = files.filter(F.col(f"max_{c}") >= F.lit(low).cast(kind))
            rows = rows & (F.col(c) >= F.lit(low).cast(kind))
        if high is not None:
            files = files.filter(F.col(f"min_{c}") <= F.lit(high).cast(kind))
            rows = rows & (F.col(c) <= F.lit(high).cast(kind))
    names = [r["file"] for r in files.select("file").collect()]
    found = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    return found.filter(rows)


HOT_SHARE = 0.5     # a key with more rows than this share of a mean bucket gets sub-buckets
HOT_KEYS = 1000     # at most so many hot keys (fewer exist: each holds over HOT_SHARE / buckets of all rows)


def heavy_hitters(df: DataFrame, key: str, buckets: int) -> dict:
    """{key: rows} of the keys with more than HOT_SHARE of a mean bucket's rows.

    A mergeable sketch (``approx_top_k``, counters per task) names the keys that
    could be that frequent, one more aggregate over these few counts them
    exactly. There can be no more than buckets / HOT_SHARE such keys."""
    n_top = int(min(HOT_KEYS, buckets / HOT_SHARE + 1))
    keys = df.filter(F.col(key).isNotNull())
    # the sketch errs by a share of the rows that falls with its counters: 16 per key asked for
    found = keys.agg(F.expr(f"approx_top_k(`{key}`, {n_top}, {min(1_000_000, max(10_000, 16 * n_top))})").alias("t"),
                     F.count(F.lit(1)).alias("n")).first()
    mean = found["n"] / buckets
    names = [r[0] for r in found["t"] or []]
    if not names:
        return {}
    exact = keys.filter(F.col(key).isin(names)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return {r[0]: r[1] for r in exact.collect() if r[1] > HOT_SHARE * mean}


def write_bucketed_pair(big: DataFrame, big_key: str, small: DataFrame, small_key: str, name: str,
                        buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables bucketed for a join without a shuffle even if some keys of
    ``big`` are hot: the rows of a hot key are dealt over sub-buckets by a salt,
    and the row of ``small`` is copied to each of them. Both sides carry
    (``_key``, ``_salt``) and are bucketed by the two; ``join_bucketed`` joins them.

    ``small`` is copied for its hot keys only, as often as the key has sub-buckets
    (rows over HOT_SHARE of a mean bucket), so it grows by at most buckets /
    HOT_SHARE rows per distinct row of a key."""
    b = buckets or bucket_count(big.sparkSession)
    hot = heavy_hitters(big, big_key, b)
    total = big.filter(F.col(big_key).isNotNull()).count() if hot else 0
    mean = max(1.0, HOT_SHARE * total / b)
    parts = {k: int(-(-n // mean)) for k, n in hot.items()}
    n_parts = F.lit(1)
    for k, p in sorted(parts.items(), key=str):
        n_parts = F.when(F.col("_key") == F.lit(k), F.lit(p)).otherwise(n_parts)
    rest = [F.col(f"`{c}`") for c in big.columns]
    big_rows = big.withColumn("_key", F.col(big_key)).withColumn("_salt", F.pmod(F.xxhash64(*rest), n_parts).cast("int"))
    small_rows = small.withColumn("_key", F.col(small_key)).withColumn("_salt", F.explode(F.sequence(F.lit(0), n_parts - 1)))
    return _bucket_by(big_rows, f"{name}_big", b), _bucket_by(small_rows, f"{name}_small", b)


def _bucket_by(df: DataFrame, name: str, b: int) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"{name}_{path.rsplit('-', 1)[-1]}"
    (df.repartition(b, "_key", "_salt").write.mode("overwrite").option("path", path)
     .bucketBy(b, "_key", "_salt").sortBy("_key", "_salt").saveAsTable(table))
    return spark.table(table)


def join_bucketed(big: DataFrame, small: DataFrame) -> DataFrame:
    """Inner join of a pair written by ``write_bucketed_pair``: bucket by bucket, no shuffle."""
    s = small.withColumnsRenamed({"_key": "_sk", "_salt": "_ss"})
    return big.join(s, (F.col("_key") == F.col("_sk")) & (F.col("_salt") == F.col("_ss"))).drop("_key", "_salt", "_sk", "_ss")
