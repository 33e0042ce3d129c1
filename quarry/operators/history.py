"""O: change capture and time travel as DataFrame jobs.

* ``audit_diff``: the trigger's audit log = full outer join of two
  snapshots by key with a null-safe compare (INSERT / UPDATE / DELETE).
* ``stamp_changed``: last-changed stamp for inserted/updated rows.
* ``as_of``: state of each key at time t from a change log (latest change
  with ts <= t in a total order, deletes dropped) -- a max_by aggregate, so
  a hot key is reduced map-side.
* ``as_of_join``: the same for many keys and times at once -- one scan over the
  union of changes and probes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import last_known

OP = "_op"


def audit_diff(old: DataFrame, new: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One row per changed key: (key, _op, old_<c>, new_<c>...)."""
    o = old.select(F.col(key).alias("_k_old"), *[F.col(c).alias(f"old_{c}") for c in cols],
                   F.lit(True).alias("_in_old"))
    n = new.select(F.col(key).alias("_k_new"), *[F.col(c).alias(f"new_{c}") for c in cols],
                   F.lit(True).alias("_in_new"))
    j = o.join(n, F.col("_k_old") == F.col("_k_new"), "full")
    same = reduce(lambda a, b: a & b, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in cols])
    op = (F.when(F.col("_in_old").isNull(), "INSERT").when(F.col("_in_new").isNull(), "DELETE")
          .when(~same, "UPDATE"))
    out = j.select(F.coalesce("_k_old", "_k_new").alias(key), op.alias(OP),
                   *[F.col(f"old_{c}") for c in cols], *[F.col(f"new_{c}") for c in cols])
    return out.filter(F.col(OP).isNotNull())


def stamp_changed(old: DataFrame, new: DataFrame, key: str, cols: list[str], stamp: str, as_of) -> DataFrame:
    """New state where ``stamp`` = as_of on inserted/updated rows and keeps
    the old stamp otherwise (BEFORE INSERT OR UPDATE trigger)."""
    diff = audit_diff(old, new, key, cols).select(F.col(key).alias("_sk"), OP)
    prev = old.select(F.col(key).alias("_pk"), F.col(stamp).alias("_old_stamp"))
    j = new.join(diff, new[key] == F.col("_sk"), "left").join(prev, new[key] == F.col("_pk"), "left")
    v = F.when(F.col(OP).isin("INSERT", "UPDATE"), F.lit(as_of).cast("timestamp_ntz")).otherwise(F.col("_old_stamp"))
    return j.withColumn(stamp, v).drop("_sk", "_pk", "_old_stamp", OP)


def as_of(changes: DataFrame, key: str, ts: str, tiebreak: str, op: str, values: list[str], t) -> DataFrame:
    """Latest change per key with ts <= t; keys whose latest change is a
    DELETE are absent."""
    upto = changes.filter(F.col(ts) <= F.lit(t).cast("timestamp_ntz"))
    last = upto.groupBy(key).agg(F.max_by(F.struct(op, ts, *values), F.struct(ts, tiebreak)).alias("_last"))
    return (last.filter(F.col("_last")[op] != "DELETE")
            .select(key, F.col(f"_last.{ts}").alias("changed_at"), *[F.col(f"_last.{v}").alias(v) for v in values]))


def as_of_join(probes: DataFrame, key: str, at: str, history: DataFrame, hist_key: str, ts: str, tiebreak: str, op: str,
               values: list[str], n_partitions: int | None = None) -> DataFrame:
    """Each probe row with ``changed_at`` and ``values`` as they were for its key
    at its time: those of the latest change with ts <= at, NULL if there is none
    or it is a DELETE. All probes are kept; a NULL key or time knows nothing.

    Changes and probes are put in one order (key, time; a change before the
    probes of its moment) and each probe takes the last change before it
    (``scan.last_known``): no join, no pairs, and a key with a third of all
    changes or probes is spread over many tasks. (ts, tiebreak) must order a
    key's changes.
    """
    change = F.struct(F.col(op).alias("op"), F.col(ts).alias("ts"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    row = F.struct(*[F.col(f"`{c}`") for c in probes.columns])
    known = history.filter(F.col(hist_key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(hist_key).alias("_k"), F.col(ts).alias("_t"), F.lit(True).alias("_is"), F.col(tiebreak).alias("_o"),
        F.lit(None).cast("long").alias("_x"), change.alias("_c"))
    asks = F.col(key).isNotNull() & F.col(at).isNotNull()
    asked = probes.filter(asks).select(
        F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(False).alias("_is"), F.xxhash64(row).alias("_x"), row.alias("_p"))
    both = known.unionByName(asked, allowMissingColumns=True)
    seen = last_known(both, ["_k"], ["_t", ("_is", False), "_o", "_x"], "_is", "_c", "_seen", n_partitions)
    there = F.col("_seen")["op"] != "DELETE"
    found = [F.when(there, F.col("_seen")["ts"]).alias("changed_at"),
             *[F.when(there, F.col("_seen")[f"v{i}"]).alias(v) for i, v in enumerate(values)]]
    out = seen.filter(~F.col("_is")).select("_p.*", *found)
    return out.unionByName(probes.filter(~asks), allowMissingColumns=True)


def restore_table(current: DataFrame, key: str, past: DataFrame) -> DataFrame:
    """The table as it was: the rows of ``past`` (an ``as_of`` read), each with
    ``_action`` reinserted (not in the current table) or kept."""
    now = current.select(F.col(key).alias("_rt_k")).distinct()
    j = past.drop("changed_at").join(now, F.col(key) == F.col("_rt_k"), "left")
    return j.withColumn("_action", F.when(F.col("_rt_k").isNull(), "reinserted").otherwise("kept")).drop("_rt_k")
