"""Document update operators ($set, $inc, delete_many) on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_fields(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """``$set``: assign fields on matching documents; a new field is created
    and is NULL on the documents that do not match."""
    def old(name: str, v: Column) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(df.select(v).schema[0].dataType)

    # all values are computed on the old document
    return df.withColumns({name: F.when(where, v).otherwise(old(name, v)) for name, v in values.items()})


def inc_field(df: DataFrame, where: Column, name: str, amount: float) -> DataFrame:
    """``$inc``: add an amount (exact two-decimal money)."""
    inc = (F.col(name).cast("decimal(18,2)") + F.lit(amount).cast("decimal(18,2)")).cast("double")
    return df.withColumn(name, F.when(where, inc).otherwise(F.col(name)))


def delete_many(df: DataFrame, where: Column) -> DataFrame:
    """``delete_many``: a NULL condition keeps the document."""
    return df.filter(~F.coalesce(where, F.lit(False)))
