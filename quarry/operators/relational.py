"""Relational operators Spark lacks in its grammar or runs badly at scale.

* ``with_scalars``: attach the columns of a one-row aggregate as a scalar
  subquery (computed once, no join).
* ``not_in``: SQL NOT IN with three-valued logic, as an anti join plus a
  one-row NULL flag, instead of a null-aware nested-loop join.
* ``quantified``: ``x > ANY (S)`` / ``x > ALL (S)`` from min/max/count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a global aggregate (exactly one row) to each row,
    as one scalar subquery: evaluated once, then read as a constant (no join)."""
    sub = one_row.select(F.struct(*one_row.columns)).scalar()
    return df.select("*", *[sub.getField(c).alias(c) for c in one_row.columns])


def not_in(outer: DataFrame, outer_col: str, inner: DataFrame, inner_col: str) -> DataFrame:
    """Rows of ``outer`` where ``outer_col NOT IN (SELECT inner_col FROM inner)`` is TRUE.

    Empty set: every row (even a NULL key). A NULL in the set: no row.
    Otherwise: keys not in the set, and never a NULL key.
    """
    k = "__nin_key"
    keys = inner.select(F.col(inner_col).alias(k))
    stats = keys.agg(F.count(F.lit(1)).alias("__nin_n"), F.count(k).alias("__nin_nn"))
    anti = outer.join(keys.filter(F.col(k).isNotNull()).distinct(),
                      F.col(outer_col) == F.col(k), "left_anti")
    keep = (F.col("__nin_n") == 0) | ((F.col("__nin_nn") == F.col("__nin_n"))
                                      & F.col(outer_col).isNotNull())
    return with_scalars(anti, stats).filter(keep).drop("__nin_n", "__nin_nn")


def quantified(df: DataFrame, x: str, subset: DataFrame, s_col: str, op: str,
               quantifier: str) -> Column | DataFrame:
    """Filter ``df`` by ``x <op> ANY|ALL (SELECT s_col FROM subset)``.

    Follows SQL rules: ANY over an empty set is FALSE, ALL is TRUE; a NULL in
    the set turns a would-be FALSE (ANY) / TRUE (ALL) into NULL, which drops
    the row; a NULL ``x`` is NULL unless the set is empty.
    """
    if op not in (">", ">=", "<", "<="):
        raise ValueError("op must be one of > >= < <=")
    q = quantifier.upper()
    s = subset.select(F.col(s_col).alias("__q"))
    stats = s.agg(F.min("__q").alias("__q_min"), F.max("__q").alias("__q_max"),
                  F.count(F.lit(1)).alias("__q_n"), F.count("__q").alias("__q_nn"))
    xv = F.col(x)
    greater = op in (">", ">=")
    # ANY: compare with the extreme that is easiest to beat; ALL: the hardest.
    if q == "ANY":
        bound = F.col("__q_min") if greater else F.col("__q_max")
    elif q == "ALL":
        bound = F.col("__q_max") if greater else F.col("__q_min")
    else:
        raise ValueError("quantifier must be ANY or ALL")
    cmp = {">": xv > bound, ">=": xv >= bound, "<": xv < bound, "<=": xv <= bound}[op]
    has_null = F.col("__q_nn") < F.col("__q_n")
    empty = F.col("__q_n") == 0
    if q == "ANY":
        # true if some non-null element satisfies; NULLs can only make it unknown
        keep = ~empty & xv.isNotNull() & (F.col("__q_nn") > 0) & F.coalesce(cmp, F.lit(False))
    else:
        keep = empty | (xv.isNotNull() & ~has_null
                        & F.when(F.col("__q_nn") > 0, F.coalesce(cmp, F.lit(False))).otherwise(True))
    return with_scalars(df, stats).filter(keep).drop("__q_min", "__q_max", "__q_n", "__q_nn")


def _null_cols(df: DataFrame, exclude: set[str] | None = None) -> list:
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields
            if not exclude or f.name not in exclude]


def outer_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    """LEFT / RIGHT / FULL outer equi-join written as inner join ∪ anti joins.

    AQE can split a skewed partition of either side of an inner join, but
    never the non-preserved side of an outer join; when that side is the fact
    table, one hot key would be one task. The unmatched rows come from anti
    joins against the *distinct* keys of the other side (aggregated map-side,
    so a hot key is one row per task). Output columns: left's, then right's."""
    how = how.lower()
    inner = left.join(right, left[left_key] == right[right_key], "inner")
    cols = left.columns + right.columns
    parts = [inner.select(*cols)]
    if how in ("left", "full"):
        rk = right.select(F.col(right_key).alias("__oj_rk")).filter(F.col("__oj_rk").isNotNull()).distinct()
        lonly = left.join(rk, left[left_key] == F.col("__oj_rk"), "left_anti")
        parts.append(lonly.select(*left.columns, *_null_cols(right)))
    if how in ("right", "full"):
        lk = left.select(F.col(left_key).alias("__oj_lk")).filter(F.col("__oj_lk").isNotNull()).distinct()
        ronly = right.join(lk, right[right_key] == F.col("__oj_lk"), "left_anti")
        parts.append(ronly.select(*_null_cols(left), *right.columns))
    if how not in ("left", "right", "full"):
        raise ValueError("how must be left, right or full")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def broadcast_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the optimizer's size estimate (from file
    metadata, no job) is under ``max_bytes``; otherwise no hint, and AQE
    picks the join from the measured size at run time."""
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # pragma: no cover - plan statistics unavailable
        return df
    return F.broadcast(df) if size <= max_bytes else df
