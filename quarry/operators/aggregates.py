"""Aggregation helpers (all partial/final hash aggregates: a hot group is
combined map-side before the shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import avg_money, cents, money, sum_cents


def monthly_stats(df: DataFrame, date_col: str, value_col: str) -> DataFrame:
    """Count and ROUND(AVG(value), 2) per calendar month, exact in cents."""
    g = df.groupBy(F.year(date_col).alias("yr"), F.month(date_col).alias("mon")).agg(
        F.count(F.lit(1)).alias("n_orders"), sum_cents(cents(value_col)).alias("_c"))
    return g.select("yr", "mon", "n_orders", avg_money("_c", "n_orders").alias("avg_value"))


def month_summary(df: DataFrame, date_col: str, value_col: str, year: int, month: int) -> DataFrame:
    """R4 procedure form: one row (count, COALESCE(ROUND(AVG), 2), 0)) for a month,
    also when the month has no rows."""
    first = f"{year:04d}-{month:02d}-01"
    after = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    # a half-open range on the bare column: it reaches the scan as pushed filters
    m = df.filter((F.col(date_col) >= F.lit(first).cast("timestamp_ntz"))
                  & (F.col(date_col) < F.lit(after).cast("timestamp_ntz")))
    a = m.agg(F.count(F.lit(1)).alias("n_orders"), sum_cents(cents(value_col)).alias("_c"))
    return a.select("n_orders", F.coalesce(avg_money("_c", "n_orders"), F.lit(0).cast("decimal(38,2)"))
                    .alias("avg_value"))


def any_year_summary(df: DataFrame, date_col: str, value_col: str) -> DataFrame:
    """The procedure's month-only form for every month 1..12: orders of that
    month in any year, count and COALESCE(ROUND(AVG, 2), 0); one grouped scan."""
    months = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("mon"))
    g = df.groupBy(F.month(date_col).alias("mon")).agg(
        F.count(F.lit(1)).alias("_n"), sum_cents(cents(value_col)).alias("_c"))
    return months.join(g, "mon", "left").select(
        "mon", F.coalesce("_n", F.lit(0)).cast("long").alias("n_orders"),
        F.coalesce(avg_money("_c", "_n"), F.lit(0).cast("decimal(38,2)")).alias("avg_value"))


def ordered_distinct_list(df: DataFrame, group: list[str], value: str, sep: str, name: str) -> DataFrame:
    """LISTAGG(DISTINCT value, sep) WITHIN GROUP (ORDER BY value)."""
    return df.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_set(value)), sep).alias(name))


def stock_value_by(df: DataFrame, group: str, price: str, qty: str) -> DataFrame:
    return df.groupBy(F.col(group).alias("category")).agg(
        F.sum(money(price) * F.col(qty)).cast("double").alias("stock_value"))


def stock_value_of(df: DataFrame, group: str, price: str, qty: str, category: str) -> DataFrame:
    """One row; NULL when the category has no rows (SUM over nothing)."""
    return (df.filter(F.col(group) == category)
            .agg(F.sum(money(price) * F.col(qty)).cast("double").alias("stock_value")))


def volume_classes(df: DataFrame, n: str) -> DataFrame:
    """The two classification forms of the monthly volume routine. They only
    differ at 0 (IF form: BAIXO, CASE form: SEM PEDIDOS)."""
    c = F.col(n)
    class_if = F.when(c > 20, "ALTO").when(c >= 10, "MEDIO").otherwise("BAIXO")
    class_case = (F.when(c == 0, "SEM PEDIDOS").when(c < 10, "BAIXO")
                  .when(c <= 20, "MEDIO").otherwise("ALTO"))
    return df.withColumn("class_if", class_if).withColumn("class_case", class_case)


def column_profile(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """Rows, NULLs, distinct, min, max and a NULLIF-guarded ratio per column,
    from a single aggregate pass (``exact=False`` uses HyperLogLog++)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        d = F.countDistinct(c) if exact else F.approx_count_distinct(c)
        aggs += [F.count(c).alias(f"{c}__nn"), d.alias(f"{c}__nd"),
                 F.min(c).cast("string").alias(f"{c}__min"), F.max(c).cast("string").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    # unpivot the single result row (no second pass over the table)
    per_col = []
    for c in cols:
        nd = F.col(f"{c}__nd")
        per_col.append(F.struct(
            F.lit(c).alias("column_name"), F.col("n_rows"),
            (F.col("n_rows") - F.col(f"{c}__nn")).alias("n_nulls"), nd.alias("n_distinct"),
            F.col(f"{c}__min").alias("min_value"), F.col(f"{c}__max").alias("max_value"),
            F.round(nd / F.nullif(F.col("n_rows"), F.lit(0)), 6).alias("distinct_ratio")))
    return wide.select(F.explode(F.array(*per_col)).alias("p")).select("p.*")
