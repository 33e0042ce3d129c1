"""K: table changes (DML) as pure DataFrame transforms: old state in, new
state out. Nothing is updated in place; the caller writes the result to a
new folder (or appends for inserts)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_all(branches: list[DataFrame]) -> DataFrame:
    """A3: rows of every branch, one write."""
    return reduce(lambda a, b: a.unionByName(b), branches)


def insert_select(new_rows: DataFrame, target_path: str) -> None:
    """A4: append the result of a query to the target folder."""
    new_rows.write.mode("append").parquet(target_path)


def staging_counts(lineitem: DataFrame) -> DataFrame:
    """The supplier feed stand-in: new stock count per part from the
    not-yet-returned lines (l_returnflag = 'N')."""
    return (lineitem.filter(F.col("l_returnflag") == "N")
            .groupBy(F.col("l_partkey").alias("livro_id"))
            .agg(F.sum("l_quantity").cast("long").alias("quantidade_nova")))


ACTION = "_action"


def update(df: DataFrame, where, assignments: dict) -> DataFrame:
    """UPDATE t SET c = v, ... WHERE cond: the condition and every new value are
    computed on the old row; a NULL condition leaves the row alone."""
    cond = F.coalesce(where, F.lit(False))
    return df.withColumns({c: F.when(cond, v).otherwise(F.col(c)) for c, v in assignments.items()})


def update_from(target: DataFrame, key: str, source_keys: DataFrame, source_key: str,
                assignments: dict) -> DataFrame:
    """UPDATE ... FROM / WHERE EXISTS: rows whose key is in the source get the
    assignments. The source is reduced to distinct keys first (a semi-join
    flag), so source duplicates cannot multiply target rows."""
    flag = source_keys.select(F.col(source_key).alias("_uf_k")).distinct().withColumn("_uf_hit", F.lit(True))
    j = target.join(flag, target[key] == F.col("_uf_k"), "left")
    return update(j, F.col("_uf_hit"), assignments).drop("_uf_k", "_uf_hit")


def delete(df: DataFrame, where) -> DataFrame:
    """DELETE WHERE cond; NULL keeps the row."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def delete_unless_exists(target: DataFrame, key: str, where, related: DataFrame, related_key: str) -> DataFrame:
    """DELETE FROM t WHERE cond AND NOT EXISTS (related rows)."""
    flag = related.select(F.col(related_key).alias("_de_k")).distinct().withColumn("_de_hit", F.lit(True))
    j = target.join(flag, target[key] == F.col("_de_k"), "left")
    doomed = F.coalesce(where, F.lit(False)) & F.col("_de_hit").isNull()
    return j.filter(~doomed).drop("_de_k", "_de_hit")


def _unique_source(source: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One row per source key; a duplicated or NULL key fails the job (as the
    staging table's primary key would) instead of picking a row."""
    g = source.groupBy(key).agg(F.count(F.lit(1)).alias("_us_n"), *[F.first(c).alias(c) for c in cols])
    bad = (F.col("_us_n") > 1) | F.col(key).isNull()
    checked = F.when(bad, F.raise_error(F.concat(F.lit("duplicate or NULL source key in upsert: "),
                                                 F.col(key).cast("string")))).otherwise(F.col(key))
    return g.select(checked.alias(key), *cols)


def upsert(target: DataFrame, source: DataFrame, key: str, set_cols: dict[str, str],
           insert_defaults: dict | None = None, update_when=None, delete_when=None) -> DataFrame:
    """MERGE / INSERT ... ON CONFLICT DO UPDATE as one full outer join by key.

    ``set_cols`` maps target column -> source column. Unmatched source rows are
    inserted (missing target columns from ``insert_defaults``); matched rows
    are updated where ``update_when`` (a condition over ``src_<col>`` and
    target columns) holds -- the guard never blocks an insert (K8). With
    ``delete_when`` (over the updated values), updated rows that satisfy it
    are removed (Oracle MERGE ... DELETE WHERE, K9). Adds ``_action``:
    insert / update / unchanged / delete (deleted rows are dropped)."""
    insert_defaults = insert_defaults or {}
    scols = list(set_cols.values())
    src = _unique_source(source, key, scols)
    src = src.select(F.col(key).alias("_src_key"), *[F.col(c).alias(f"src_{c}") for c in scols])
    j = target.withColumn("_tgt_hit", F.lit(True)).join(src, F.col(key) == F.col("_src_key"), "full")
    matched = F.col("_tgt_hit").isNotNull() & F.col("_src_key").isNotNull()
    inserted = F.col("_tgt_hit").isNull()
    guard = F.lit(True) if update_when is None else F.coalesce(update_when, F.lit(False))
    do_update = matched & guard
    out = j
    for c in target.columns:
        if c == key:
            v = F.coalesce(F.col(key), F.col("_src_key"))
        elif c in set_cols:
            v = F.when(inserted | do_update, F.col(f"src_{set_cols[c]}")).otherwise(F.col(c))
        elif c in insert_defaults:
            v = F.when(inserted, insert_defaults[c]).otherwise(F.col(c))
        else:
            v = F.when(inserted, F.lit(None)).otherwise(F.col(c))
        out = out.withColumn(f"_new_{c}", v)
    action = F.when(inserted, "insert").when(do_update, "update").otherwise("unchanged")
    out = out.withColumn(ACTION, action)
    out = out.select(*[F.col(f"_new_{c}").alias(c) for c in target.columns], ACTION)
    if delete_when is not None:
        out = out.withColumn(ACTION, F.when((F.col(ACTION) == "update") & F.coalesce(delete_when, F.lit(False)),
                                            "delete").otherwise(F.col(ACTION)))
        out = out.filter(F.col(ACTION) != "delete")
    return out


def insert_ignore(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: target ∪ (source rows whose key is
    new). Duplicate source keys keep one row, chosen deterministically (the
    smallest row)."""
    cols = target.columns
    others = [c for c in cols if c != key]
    dedup = (source.groupBy(key).agg(F.min(F.struct(*others)).alias("_ii"))
             .select(key, *[F.col(f"_ii.{c}").alias(c) for c in others]))
    new = dedup.join(target.select(F.col(key).alias("_ii_k")), F.col(key) == F.col("_ii_k"), "left_anti")
    return (target.withColumn(ACTION, F.lit("unchanged"))
            .unionByName(new.select(*cols).withColumn(ACTION, F.lit("insert"))))


def merge_matched(target: DataFrame, source: DataFrame, key: str, set_cols: dict[str, str]) -> DataFrame:
    """MERGE ... WHEN MATCHED THEN UPDATE only: unmatched source rows are ignored."""
    scols = list(set_cols.values())
    src = _unique_source(source, key, scols).select(F.col(key).alias("_mm_k"),
                                                   *[F.col(c).alias(f"src_{c}") for c in scols])
    j = target.join(src, F.col(key) == F.col("_mm_k"), "left")
    hit = F.col("_mm_k").isNotNull()
    j = j.withColumns({c: F.when(hit, F.col(f"src_{s}")).otherwise(F.col(c)) for c, s in set_cols.items()})
    j = j.withColumn(ACTION, F.when(hit, "update").otherwise("unchanged"))
    return j.select(*target.columns, ACTION)


def tag_update(df: DataFrame, where) -> DataFrame:
    """``_action`` of UPDATE ... WHERE: update where the condition is TRUE."""
    return df.withColumn(ACTION, F.when(F.coalesce(where, F.lit(False)), "update").otherwise("unchanged"))


def tag_delete(df: DataFrame, where) -> DataFrame:
    """``_action`` of DELETE ... WHERE: delete where the condition is TRUE."""
    return df.withColumn(ACTION, F.when(F.coalesce(where, F.lit(False)), "delete").otherwise("unchanged"))


def action_counts(changed: DataFrame) -> DataFrame:
    """Affected rows per action (the rowcount a client sees)."""
    return changed.groupBy(ACTION).agg(F.count(F.lit(1)).alias("n_rows"))
