"""Window functions that stay balanced when one partition key is hot.

Built on the scans of ``scan``: prefix sums, ranks, and ROWS frames by a halo of
border rows; there is one path at every size and no self-join. For the RANGE
frame, peers (rows with equal ORDER BY values) are aggregated first, so a hot run
of ties costs one partial aggregate, not one task.

Order keys: ``(column, ascending)`` pairs of any orderable type; NULLs come
first either way, as the SQL servers do for DESC and Spark for ASC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import Frame, frames, ranks, running_sum


def row_number(df: DataFrame, group: list[str], order: list[tuple[str, bool]], name: str = "row_num",
               n_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY group ORDER BY order); ``order`` must be total."""
    base = df.withColumn("_rn_one", F.lit(1).cast("long"))
    out = running_sum(base, group, order, ["_rn_one"], n_partitions)
    return out.withColumnRenamed("_rn_one_cum", name).drop("_rn_one")


def _join_peers(df: DataFrame, peers: DataFrame, cols: list[str]) -> DataFrame:
    cond = None
    for c in cols:
        e = df[c].eqNullSafe(peers[f"_pk_{c}"])
        cond = e if cond is None else cond & e
    return df.join(peers, cond).drop(*[f"_pk_{c}" for c in cols])


def all_ranks(df: DataFrame, group: list[str], order: list[tuple[str, bool]], tiebreak: list[tuple[str, bool]],
              number: str = "row_num", rank: str = "rank_num", dense: str = "dense_num",
              n_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER over ``order`` and ``tiebreak`` (together total), RANK and
    DENSE_RANK over ``order``: one scan, no join."""
    return ranks(df, group, [*order, *tiebreak], [c for c, _ in order], number, rank, dense, n_partitions)


def rank_dense_rank(df: DataFrame, group: list[str], order: list[tuple[str, bool]],
                    rank: str = "rank_num", dense: str = "dense_num",
                    n_partitions: int | None = None) -> DataFrame:
    """RANK() and DENSE_RANK() of rows that no tiebreak tells apart: ranks of
    the distinct order values per group, joined back."""
    ocols = [c for c, _ in order]
    peers = df.groupBy(*group, *ocols).agg(F.count(F.lit(1)).alias("_pr_n"))
    p = peers.withColumn("_pr_one", F.lit(1).cast("long"))
    p = running_sum(p, group, order, ["_pr_n", "_pr_one"], n_partitions)
    p = p.select(*[F.col(c).alias(f"_pk_{c}") for c in group + ocols],
                 (F.col("_pr_n_cum") - F.col("_pr_n") + 1).alias(rank),
                 F.col("_pr_one_cum").alias(dense))
    return _join_peers(df, p, group + ocols)


def running_total(df: DataFrame, group: list[str], order: list[tuple[str, bool]], value: str,
                  name: str, n_partitions: int | None = None) -> DataFrame:
    """SUM(value) OVER (... ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW);
    ``order`` must be total. NULLs are skipped; before the first value the sum
    is NULL. ``value`` should be a long (e.g. cents) for an exact result."""
    return running_totals(df, group, order, {value: name}, n_partitions)


def running_totals(df: DataFrame, group: list[str], order: list[tuple[str, bool]], values: dict[str, str],
                   n_partitions: int | None = None) -> DataFrame:
    """Several ROWS UNBOUNDED PRECEDING sums in one pass: ``values`` maps a
    column to the name of its running sum."""
    sums, counts = {}, {}
    base = df
    for i, v in enumerate(values):
        sums[v], counts[v] = f"_rts_v{i}", f"_rts_n{i}"
        kind = df.schema[v].dataType
        base = base.withColumn(sums[v], F.coalesce(F.col(v), F.lit(0).cast(kind))).withColumn(
            counts[v], F.col(v).isNotNull().cast("long"))
    out = running_sum(base, group, order, [*sums.values(), *counts.values()], n_partitions)
    for v, name in values.items():
        out = out.withColumn(name, F.when(F.col(f"{counts[v]}_cum") > 0, F.col(f"{sums[v]}_cum")))
    drop = [*sums.values(), *counts.values()]
    return out.drop(*drop, *[f"{c}_cum" for c in drop])


def running_peers(df: DataFrame, group: list[str], order: list[tuple[str, bool]], value: str,
                  sum_name: str, count_name: str, n_partitions: int | None = None) -> DataFrame:
    """Default frame (RANGE UNBOUNDED PRECEDING .. CURRENT ROW, peers included):
    running sum of ``value`` (NULLs skipped) and count of rows up to the last
    peer."""
    ocols = [c for c, _ in order]
    kind = df.schema[value].dataType
    peers = df.groupBy(*group, *ocols).agg(
        F.coalesce(F.sum(value), F.lit(0).cast(kind)).alias("_rp_s"), F.count(value).alias("_rp_v"),
        F.count(F.lit(1)).alias("_rp_n"))
    p = running_sum(peers, group, order, ["_rp_s", "_rp_v", "_rp_n"], n_partitions)
    p = p.select(*[F.col(c).alias(f"_pk_{c}") for c in group + ocols],
                 F.when(F.col("_rp_v_cum") > 0, F.col("_rp_s_cum")).alias(sum_name),
                 F.col("_rp_n_cum").alias(count_name))
    return _join_peers(df, p, group + ocols)


def lag_lead(df: DataFrame, group: list[str], order: list[tuple[str, bool]], value: str, offset: int,
             name: str, n_partitions: int | None = None) -> DataFrame:
    """LAG (offset > 0) / LEAD (offset < 0) of ``value``; ``order`` must be total."""
    frame = Frame("lag", value, preceding=offset) if offset >= 0 else Frame("lead", value, following=-offset)
    return frames(df, group, order, {name: frame}, n_partitions)
