"""M: constraints as data-quality jobs (Spark enforces none of them).

Each check is one pass (aggregate, anti join or filter) and reports rows or
counts; none collects data to the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """NOT NULL: NULLs per column, one aggregate pass, unpivoted."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_nn_{c}") for c in cols])
    per = [F.struct(F.lit(c).alias("column_name"), (F.col("_n") - F.col(f"_nn_{c}")).alias("n_nulls"))
           for c in cols]
    return wide.select(F.explode(F.array(*per)).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """PRIMARY KEY / UNIQUE: key values held by more than one row. UNIQUE
    ignores rows with a NULL key part."""
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def orphans(child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    """FOREIGN KEY: child rows whose (non-NULL) key has no parent."""
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in fk])
    p = parent.select(*[F.col(a).alias(f"_pk{i}") for i, a in enumerate(pk)]).distinct()
    cond = reduce(lambda a, b: a & b, [child[f] == F.col(f"_pk{i}") for i, f in enumerate(fk)])
    return child.filter(nn).join(p, cond, "left_anti")


def fk_summary(name: str, child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    from .relational import with_scalars

    n = child.agg(F.count(F.lit(1)).alias("n_checked"))
    o = orphans(child, fk, parent, pk).agg(F.count(F.lit(1)).alias("n_orphans"))
    return with_scalars(n, o).select(F.lit(name).alias("fk_name"), "n_checked", "n_orphans")


def violations(df: DataFrame, rules: dict[str, Column], keep: list[str]) -> DataFrame:
    """CHECK: a row violates a rule when the rule is FALSE (NULL passes).
    One output row per (row, violated rule)."""
    names = F.array(*[F.when(cond == F.lit(False), F.lit(name)) for name, cond in rules.items()])
    return (df.select(*keep, F.explode(F.array_compact(names)).alias("rule")))


def reasons(df: DataFrame, rules: dict[str, Column], name: str = "reasons") -> DataFrame:
    """Array of reason codes per row (empty = good row)."""
    arr = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(code)) for code, cond in rules.items()])
    return df.withColumn(name, F.array_compact(arr))


def split_good_rejected(df: DataFrame, key: str, rules: dict[str, Column], dup_code: str) -> DataFrame:
    """Adds ``reasons`` (duplicate key + rule codes) and ``status``
    ACCEPTED / REJECTED. Duplicates are found with a per-key count joined
    back (a hot key is split by AQE's skew join, not held in one window)."""
    cnt = df.groupBy(F.col(key).alias("_sg_k")).agg(F.count(F.lit(1)).alias("_sg_n"))
    j = df.join(cnt, F.col(key) == F.col("_sg_k"), "left")
    allrules = {dup_code: F.col("_sg_n") > 1, **rules}
    out = reasons(j, allrules).drop("_sg_k", "_sg_n")
    return out.withColumn("status", F.when(F.size("reasons") == 0, "ACCEPTED").otherwise("REJECTED"))


def with_check_option(rows: DataFrame, inside: Column) -> DataFrame:
    """Rows written through a view WITH CHECK OPTION: ``accepted`` where the
    view's condition is TRUE on the new row; else the reason. A NULL condition
    refuses the row."""
    ok = F.coalesce(inside, F.lit(False))
    return rows.withColumns({"accepted": ok, "reason": F.when(~ok, F.lit("CHECK_OPTION"))})


def restrict_delete(parents: DataFrame, pk: str, children: DataFrame, fk: str) -> DataFrame:
    """ON DELETE RESTRICT: parents with children are blocked, others deleted."""
    has = children.select(F.col(fk).alias("_rd_k")).distinct().withColumn("_rd_hit", F.lit(True))
    j = parents.join(has, parents[pk] == F.col("_rd_k"), "left")
    return j.withColumn("outcome", F.when(F.col("_rd_hit"), "BLOCKED").otherwise("DELETED")).drop("_rd_k", "_rd_hit")


def cascade_delete(doomed: DataFrame, key: str, levels: list[tuple[DataFrame, str, str]]) -> list[DataFrame]:
    """ON DELETE CASCADE: the deleted rows of the parent (``doomed``) and of
    each (table, key, parent_fk) level below it; survivors are ``anti`` joins."""
    out = [doomed]
    keys = doomed.select(F.col(key).alias("_cd_k")).distinct()
    for table, own_key, parent_fk in levels:
        gone = table.join(keys, table[parent_fk] == F.col("_cd_k"), "left_semi")
        out.append(gone)
        keys = gone.select(F.col(own_key).alias("_cd_k")).distinct()
    return out
