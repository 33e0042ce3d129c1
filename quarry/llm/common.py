"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import load_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors, and lets several consumers share one run."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit(""))


def worker_store(owner: str) -> dict:
    """A per-process dict that outlives a task. Functions are shipped by
    value, so module globals start afresh in each task; ``sys.modules`` does
    not. A worker keeps the tables of one operator at a time: another one's are
    dropped when it asks, so that the stages of a pipeline do not add up."""
    name = "_quarry_llm_worker_store"
    mod = sys.modules.get(name)
    if mod is None:
        mod = types.ModuleType(name)
        sys.modules[name] = mod
    if getattr(mod, "owner", None) != owner:
        mod.owner, mod.store = owner, {}
    return mod.store
