"""Interval overlap (half-open ``[start, start + d)``).

``overlaps_literal`` is the B16 lookup against one slot. ``conflict_counts``
is the C21 double-booking check: for every live slot, how many other live
slots of the same key overlap it; ``overlap_counts`` is the same for slots with
a start and an end. Both are two rank probes over one distributed sort (see
``operators.scan``), linear in the rows and without lists of pairs: one key
holding a third of the rows, or thousands of identical slots, spread over all
tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import running_sum


def _ts(v) -> F.Column:
    return F.lit(v).cast("timestamp_ntz")


def overlaps_literal(df: DataFrame, start: str, minutes: int, q_start, q_end) -> DataFrame:
    """Rows whose ``[start, start+minutes)`` overlaps ``[q_start, q_end)``.

    ``start < q_end AND start + d > q_start`` is rewritten as two bounds on the
    bare column so both reach the Parquet scan as pushed filters.
    """
    lo = _ts(q_start) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return df.filter((F.col(start) < _ts(q_end)) & (F.col(start) > lo))


def overlap_counts(df: DataFrame, key: list[str], start: str, end: str, ident: str,
                   n_partitions: int | None = None) -> DataFrame:
    """Per row: ``n_conflicts`` = other rows of the same key whose half-open
    slot [start, end) overlaps its own; rows without conflicts are dropped.

    Of the key's other slots, all that start before my end overlap mine but
    for those that end at or before my start: the count is #{start' < end} -
    #{end' <= start} - 1. Both come from one running count over four tagged
    points per row (its start, its end, and a probe at each), made by one scan
    of the rows. Rows without a key, a start before its end, or an id have no
    slot; ``ident`` must identify a row.
    """
    slot = df.filter(F.col(start) < F.col(end)).dropna(subset=[*key, ident])
    point = lambda at, kind, s, e: F.struct(
        F.col(at).alias("_t"), F.lit(kind).alias("_kind"), F.lit(s).cast("long").alias("_s"),
        F.lit(e).cast("long").alias("_e"))
    # at one instant: the probe of starts < t (0) comes before starts and ends
    # at t (1, 2), the probe of ends <= t (3) after them
    points = F.array(point(end, 0, 0, 0), point(start, 1, 1, 0), point(end, 2, 0, 1), point(start, 3, 0, 0))
    merged = slot.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], F.col(ident).alias("_id"),
                         F.inline(points))
    scanned = running_sum(merged, [f"_k{i}" for i in range(len(key))], ["_t", "_kind", "_id"], ["_s", "_e"],
                          n_partitions)
    probes = scanned.filter(F.col("_kind").isin(0, 3)).groupBy("_id").agg(
        F.max(F.when(F.col("_kind") == 0, F.col("_s_cum"))).alias("_started"),
        F.max(F.when(F.col("_kind") == 3, F.col("_e_cum"))).alias("_ended"))
    counts = probes.select(F.col("_id").alias(ident), (F.col("_started") - F.col("_ended") - 1).alias("n_conflicts"))
    return df.join(counts.filter("n_conflicts > 0"), ident)


def conflict_counts(df: DataFrame, key: str, start: str, ident: str, minutes: int,
                    n_partitions: int | None = None) -> DataFrame:
    """``overlap_counts`` of slots that all last ``minutes``; ``ident`` must
    identify a row."""
    until = df.withColumn("_until", F.col(start) + F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    return overlap_counts(until, [key], start, "_until", ident, n_partitions).drop("_until")
