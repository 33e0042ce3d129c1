"""Sinks and layouts: append, range-partitioned writes, staging files,
clustered and bucketed tables. Paths live under the shared checkpoint
folder of the session (never a machine-local temp dir)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def year_range_partition(date_col: str, first_year: int, last_year: int, default: str = "futuro") -> Column:
    """Partition label: ``ate_<first_year>`` for everything up to it, one label
    per year after it, and a DEFAULT label past ``last_year``."""
    y = F.year(date_col)
    return (F.when(y <= first_year, F.lit(f"ate_{first_year}"))
            .when(y <= last_year, y.cast("string"))
            .otherwise(F.lit(default)))


def write_partitioned(df: DataFrame, path: str, part_col: str, cluster_cols: list[str] | None = None,
                      mode: str = "overwrite", n_partitions: int | None = None) -> None:
    """One folder per partition value.

    With ``cluster_cols`` the rows are range-partitioned on (partition value,
    cluster key): tasks stay balanced even when one partition value holds a
    third of the rows, and each task writes one or two files. Without it the
    rows are only sorted within the existing tasks (no shuffle)."""
    if cluster_cols:
        # no fixed count: AQE sizes the range partitions from the data
        ranged = (df.repartitionByRange(n_partitions, part_col, *cluster_cols) if n_partitions
                  else df.repartitionByRange(part_col, *cluster_cols))
        df = ranged.sortWithinPartitions(part_col, *cluster_cols)
    else:
        df = df.sortWithinPartitions(part_col)
    df.write.mode(mode).partitionBy(part_col).parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema) -> DataFrame:
    """The schema names the partition column's type too: inferred from the
    folder names it would change with the labels present."""
    return spark.read.schema(schema).parquet(path)


def stage(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """Write ``df`` to a fresh folder in the shared checkpoint area and read it
    back: a durable cut of the lineage that survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)
