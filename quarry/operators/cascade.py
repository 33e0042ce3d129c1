"""Deletes through a graph of foreign keys (M8, M9).

``delete_cascade`` follows every foreign key, over any number of levels, several
paths to one table and references of a table to itself. Tables are taken parents
first, those that refer to each other in a circle (or to themselves) together: a
table outside of circles is read once per foreign key, against all keys that its
parent loses. A circle is a semi-naive fixpoint: in each round only the keys that
the round before has newly condemned look for children, and children that were
condemned before are left out. A round is a semi join per foreign key against
distinct keys (a hot parent is one key there, and AQE splits its children); rounds
are as many as the longest chain of references within a circle. What is found is
written each round, so no plan grows and a lost executor repeats one round at most.
The keys of every step are counted: only a few are left to Spark to broadcast, more
are joined by a shuffle, as a broadcast passes through the driver.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.writers import stage

CASCADE, RESTRICT, SET_NULL = "cascade", "restrict", "set null"
BROADCAST_KEYS = 100_000   # more keys than these are never broadcast


class ForeignKey(NamedTuple):
    """``child``.``column`` refers to the key of ``parent``; ``rule`` says what
    a delete of the parent row does to the child row."""
    child: str
    column: str
    parent: str
    rule: str = CASCADE


class Deleted(NamedTuple):
    """Per table: ``gone``, the keys of deleted rows (column ``key``), and
    ``cleared``, the (key, column) references set to NULL in rows that stay;
    ``blockers``: (table, column, key) of the surviving rows that forbid the delete."""
    gone: dict[str, DataFrame]
    cleared: dict[str, DataFrame]
    blockers: DataFrame
    rounds: int


class _Keys(NamedTuple):
    """Condemned keys of a table (column ``key``) and how many they are."""
    df: DataFrame
    n: int

    def hinted(self) -> DataFrame:
        return self.df if self.n <= BROADCAST_KEYS else self.df.hint("merge")


def _joined(parts: list[_Keys]) -> list[_Keys]:
    """All keys of a table as one set of rows (none if it has no part): what is
    known is joined once, not once per round."""
    return [_Keys(reduce(DataFrame.unionByName, [k.df for k in parts]), sum(k.n for k in parts))] if parts else []


def _parents_first(tables: list[str], keys: list[ForeignKey]) -> list[set[str]]:
    """The tables in circles of references (mostly of one table), each after
    those that its tables refer to."""
    reach = {t: {t} for t in tables}   # the table and all whose loss can reach it
    grown = True
    while grown:
        grown = False
        for fk in keys:
            more = reach[fk.parent] - reach[fk.child]
            reach[fk.child] |= more
            grown = grown or bool(more)
    circles: list[set[str]] = []
    for t in sorted(tables, key=lambda t: len(reach[t])):
        if not any(t in c for c in circles):
            circles.append({u for u in reach[t] if t in reach[u]})
    return circles


def delete_cascade(tables: dict[str, tuple[DataFrame, str]], keys: list[ForeignKey], table: str, doomed: DataFrame) -> Deleted:
    """Delete the rows of ``table`` whose key is in ``doomed`` (one column).

    ``tables`` maps a name to (rows, key column). A NULL reference refers to
    nothing; keys that are not there delete nothing. A RESTRICT reference forbids
    the delete if its row survives it (it is checked at the end, so a row that
    the same delete condemns by another path does not forbid it)."""
    any_df = tables[table][0]
    spark = any_df.sparkSession
    rows, key = tables[table]
    start = rows.select(F.col(key).alias("key")).join(doomed.toDF("key").dropna().distinct(), "key", "left_semi").distinct()
    parts: dict[str, list[_Keys]] = {t: [] for t in tables}

    def condemn(t: str, new: DataFrame) -> _Keys | None:
        """Write the keys of ``t`` that were not condemned before; none if there are none."""
        for known in _joined(parts[t]):
            new = new.join(known.hinted(), "key", "left_anti")
        df = stage(new, "cascade")[1]
        fresh = _Keys(df, df.count())
        if fresh.n or not parts[t]:
            parts[t].append(fresh)
        return fresh if fresh.n else None

    def children(fk: ForeignKey, parent: _Keys) -> DataFrame:
        child, child_key = tables[fk.child]
        return child.select(F.col(child_key).alias("key"), F.col(fk.column).alias("_ref")).join(
            parent.hinted().withColumnRenamed("key", "_ref"), "_ref", "left_semi").select("key")

    condemn(table, start)
    rounds = 0
    follow = [fk for fk in keys if fk.rule == CASCADE]
    for circle in _parents_first(list(tables), follow):
        # what the tables before have lost condemns first; then round by round within the circle
        fresh = {t: [k for k in _joined(parts[t]) if k.n] for t in {fk.parent for fk in follow}}
        todo = [fk for fk in follow if fk.child in circle]
        while True:
            found: dict[str, list[DataFrame]] = {}
            for fk in todo:
                for parent in fresh.get(fk.parent, []):
                    found.setdefault(fk.child, []).append(children(fk, parent))
            if not found:
                break
            rounds += 1
            new = {t: condemn(t, reduce(DataFrame.unionByName, hits).dropna().distinct()) for t, hits in found.items()}
            fresh = {t: [k] for t, k in new.items() if k}
            todo = [fk for fk in todo if fk.parent in circle]
    condemned = {t: one for t, p in parts.items() for one in _joined(p)}
    gone = {t: k.df for t, k in condemned.items()}

    def survivors(fk: ForeignKey) -> DataFrame:
        child, child_key = tables[fk.child]
        left = child.select(F.col(child_key).alias("key"), F.col(fk.column).alias("_ref"))
        left = left.join(condemned[fk.parent].hinted().withColumnRenamed("key", "_ref"), "_ref", "left_semi").select("key")
        return left.join(condemned[fk.child].hinted(), "key", "left_anti") if fk.child in gone else left

    hit = [fk for fk in keys if fk.parent in gone]
    blocked = [survivors(fk).select(F.lit(fk.child).alias("table"), F.lit(fk.column).alias("column"), F.col("key").cast("string"))
               for fk in hit if fk.rule == RESTRICT]
    blockers = reduce(DataFrame.unionByName, blocked) if blocked else spark.createDataFrame([], "table string, column string, key string")
    cleared: dict[str, DataFrame] = {}
    for fk in hit:
        if fk.rule == SET_NULL:
            one = survivors(fk).select("key", F.lit(fk.column).alias("column"))
            cleared[fk.child] = cleared[fk.child].unionByName(one) if fk.child in cleared else one
    return Deleted(gone, cleared, blockers, rounds)


def remaining(tables: dict[str, tuple[DataFrame, str]], deleted: Deleted) -> dict[str, DataFrame]:
    """The tables after the delete: as they were if a blocker forbids it, else
    without the deleted rows and with cleared references."""
    if not deleted.blockers.isEmpty():
        return {t: df for t, (df, _) in tables.items()}
    out = {}
    for t, (df, key) in tables.items():
        rows = df
        if t in deleted.gone:
            rows = rows.join(deleted.gone[t].select(F.col("key").alias("_gone")), rows[key] == F.col("_gone"), "left_anti")
        if t in deleted.cleared:
            named = deleted.cleared[t].groupBy(F.col("key").alias("_ck")).agg(F.collect_set("column").alias("_cols"))
            rows = rows.join(named, rows[key] == F.col("_ck"), "left")
            for c in sorted(r[0] for r in deleted.cleared[t].select("column").distinct().collect()):
                rows = rows.withColumn(c, F.when(F.coalesce(F.array_contains("_cols", c), F.lit(False)), F.lit(None)).otherwise(F.col(c)))
            rows = rows.drop("_ck", "_cols")
        out[t] = rows.select(*df.columns)
    return out
