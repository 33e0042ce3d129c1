"""Nested documents and normalisation jobs (J*, A6, B17, C18, K11).

Documents are ``ArrayType(StructType)`` columns, one document per key, as the
reader of a nested source expects. A document is one row and so has to fit a
task, which its size (the items of one sale) bounds, not the table's. Queries
that only need facts about the items (count, existence, sums) read the flat
child rows instead and never build the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str,
         item_fields: list[tuple[str, str]], name: str = "itens") -> DataFrame:
    """One document per parent: parent columns + ``name`` = sorted array of
    child structs (empty if none). ``item_fields`` maps child columns to struct
    field names, in sort order."""
    items = child.select(F.col(child_key).alias("_nk"),
                         F.struct(*[F.col(c).alias(f) for c, f in item_fields]).alias("_it"))
    grouped = items.groupBy("_nk").agg(F.sort_array(F.collect_list("_it")).alias(name))
    docs = parent.join(grouped, parent[parent_key] == grouped["_nk"], "left")
    return docs.withColumn(name, F.coalesce(F.col(name), F.array().cast(grouped.schema[name].dataType))).drop("_nk")


def unnest(docs: DataFrame, keep: list[str], array_col: str, outer: bool = False) -> DataFrame:
    """1NF: one row per array element (``explode``; empty documents dropped
    unless ``outer``)."""
    ex = F.explode_outer(array_col) if outer else F.explode(array_col)
    return docs.select(*keep, ex.alias("_el")).select(*keep, "_el.*")


def doc_sum(array_col: str, field: str) -> Column:
    """Sum of one numeric field over the array of a document."""
    return F.aggregate(F.col(array_col), F.lit(0.0), lambda acc, x: acc + x[field].cast("double"))


def lookup_unwind(docs: DataFrame, local_field: str, other: DataFrame, foreign_field: str) -> DataFrame:
    """``$lookup`` + ``$unwind``: documents without a match are dropped by
    ``$unwind``, so the pair is an inner equi-join (no array is built)."""
    return docs.join(other, docs[local_field] == other[foreign_field], "inner")


def project_distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    """Normal-form split: one relation = distinct projection of the wide one."""
    return df.select(*cols).distinct()


def fd_violations(df: DataFrame, determinant: list[str], dependent: list[str]) -> DataFrame:
    """Functional dependency X -> Y fails for X values with more than one Y; a
    NULL is a value of Y like any other."""
    return (df.groupBy(*determinant).agg(F.countDistinct(F.struct(*dependent)).alias("n_variants"))
            .filter(F.col("n_variants") > 1))


def lossless_check(original: DataFrame, left_cols: list[str], right_cols: list[str], on: list[str]) -> DataFrame:
    """One row: distinct rows of the original, of the re-join of its two
    projections, and whether they are equal.

    With a shared key the re-join holds every original row whose key has no
    NULL, so the split is lossless exactly when the counts agree. The re-join's
    count is the sum over the key of |left| * |right|, so it is never formed: a
    hot key costs two counts, not a product.
    """
    cols = original.columns
    if set(left_cols) | set(right_cols) != set(cols) or set(left_cols) & set(right_cols) != set(on):
        raise ValueError("the projections must cover the columns and share exactly the key")
    # one pass: distinct rows, then per key the rows and the distinct halves
    rows = original.distinct()
    l_rest = F.struct(*[c for c in left_cols if c not in on], F.lit(0).alias("_z"))
    r_rest = F.struct(*[c for c in right_cols if c not in on], F.lit(0).alias("_z"))
    per = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.countDistinct(l_rest).alias("_l"),
                                F.countDistinct(r_rest).alias("_r"))
    full = F.lit(True)
    for c in on:
        full = full & F.col(c).isNotNull()
    big = lambda c: F.col(c).cast("decimal(19,0)")
    product = F.when(full, big("_l") * big("_r")).otherwise(F.lit(0))
    one = per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_input"),
                  F.coalesce(F.sum(product), F.lit(0)).cast("long").alias("n_rejoined"))
    return one.withColumn("lossless", F.col("n_input") == F.col("n_rejoined"))
