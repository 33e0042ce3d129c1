"""Streaming audit over a change feed.

Change rows ``(key, values..., op, seq)`` arrive as files; ``op`` is LOAD (the
initial snapshot), UPSERT or DELETE. INSERT: a new key; UPDATE: a value differs
(NULL-safe); DELETE: the key is removed.

* ``run_audit_stream`` is incremental: a stateful operator keeps, per key, the
  last settled change and the changes that a late one could still precede. A
  micro-batch reads and writes the state of its own keys only; each new change is
  compared with the one before it, and the change after it, if that was audited
  already, is audited anew. The rows go to an append-only Parquet sink with a
  version per key; ``read_audit`` takes the newest version of each change, so the
  result does not depend on how files were batched or ordered.
* ``audit_log`` is the same audit of a whole change log as one batch job (a
  distributed row number and a join on it), for history and repair.

A stream of one hot key is one key's state: its changes are handled in order by
one task, as many per micro-batch as ``max_files_per_trigger`` lets in; the
history of such a key belongs in ``audit_log``, which spreads it over all tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.history import OP
from ..operators.windows import row_number

VERSION, LATE = "_version", "LATE"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def audit_log(changes: DataFrame, key: str, cols: list[str], seq: str, op: str) -> DataFrame:
    """Audit rows (key, _op, old values, new values, seq) of a change log.
    Repeated rows count once; changes of one key and seq are ordered by op
    (LOAD before UPSERT, DELETE first), then values."""
    log = changes.select(key, seq, op, *cols).distinct()
    order = [(seq, True), (op, True), *[(c, True) for c in cols]]
    r = row_number(log, [key], order, "_n").select(
        key, seq, "_n", F.col(op).alias("_now"), *[F.col(c).alias(f"new_{c}") for c in cols])
    before = r.select(F.col(key).alias("_k"), (F.col("_n") + 1).alias("_m"), F.col("_now").alias("_was"),
                      *[F.col(f"new_{c}").alias(f"old_{c}") for c in cols])
    j = r.join(before, r[key].eqNullSafe(before["_k"]) & (r["_n"] == before["_m"]), "left")
    had = F.coalesce(F.col("_was") != "DELETE", F.lit(False))
    has = F.col("_now") != "DELETE"
    same = reduce(lambda a, b: a & b, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in cols], F.lit(True))
    what = (F.when((F.col("_now") == "UPSERT") & ~had, "INSERT").when((F.col("_now") == "UPSERT") & ~same, "UPDATE")
            .when((F.col("_now") == "DELETE") & had, "DELETE"))
    return j.select(key, what.alias(OP), *[F.when(had, F.col(f"old_{c}")).alias(f"old_{c}") for c in cols],
                    *[F.when(has, F.col(f"new_{c}")).alias(f"new_{c}") for c in cols], seq).filter(F.col(OP).isNotNull())


def _rank(change: tuple) -> tuple:
    """Order of a key's changes: seq, op, values; NULL first."""
    return tuple((v is not None, v) for v in change)


def _judge(before: tuple | None, now: tuple) -> tuple | None:
    """(op, old values, new values) of a change (seq, op, values...) after
    ``before``; None if it changes nothing."""
    old = before[2:] if before is not None and before[1] != "DELETE" else None
    none = (None,) * (len(now) - 2)
    if now[1] == "DELETE":
        return None if old is None else ("DELETE", old, none)
    if now[1] != "UPSERT" or old == now[2:]:
        return None
    return ("INSERT", none, now[2:]) if old is None else ("UPDATE", old, now[2:])


class AuditProcessor(StatefulProcessor):
    """State of a key: ``base``, the last change that is settled, ``open``, the
    later ones, and the number of micro-batches that saw the key.

    A change settles when a change ``late_by`` or more ahead of it has come;
    what comes before ``base`` after that is reported as LATE instead of being
    audited (repeats of ``base`` are ignored). With ``late_by`` None nothing
    settles: any order gives the same audit, and the state holds all changes.
    """

    def __init__(self, feed: T.StructType, key: str, cols: list[str], seq: str, op: str, late_by: int | None):
        self.cols, self.late_by, self.fields = cols, late_by, [seq, op, *cols]
        self.out = audit_schema(feed, key, cols, seq, op).names
        self.state = T.StructType([T.StructField(f"f{i}", feed[c].dataType) for i, c in enumerate(self.fields)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.base = handle.getValueState("base", self.state)
        self.open = handle.getListState("open", self.state)
        self.version = handle.getValueState("version", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - Spark's names
        base = tuple(self.base.get()) if self.base.exists() else None
        known = sorted((tuple(r) for r in self.open.get()), key=_rank) if self.open.exists() else []
        version = self.version.get()[0] + 1 if self.version.exists() else 0
        new = {tuple(r[c] for c in self.fields) for r in rows} - set(known) - {base}
        late = {c for c in new if base is not None and _rank(c) < _rank(base)}
        new -= late
        out = [(LATE, (None,) * len(self.cols), c[2:], c) for c in sorted(late, key=_rank)]
        series = sorted([*known, *new], key=_rank)
        for i, change in enumerate(series):
            before = series[i - 1] if i else base
            if change in new or before in new:
                verdict = _judge(before, change)
                if verdict or change not in new:   # a verdict given before may have to be withdrawn
                    out.append((*(verdict or (None, (None,) * len(self.cols), (None,) * len(self.cols))), change))
        if series and self.late_by is not None:
            settled = [c for c in series if c[0] is None or c[0] <= series[-1][0] - self.late_by]
            if settled:
                base, series = settled[-1], series[len(settled):]
                self.base.update(base)
        if series:
            self.open.put(series)
        elif known:
            self.open.clear()
        self.version.update((version,))
        for what, old, now, change in out:
            yield Row(**dict(zip(self.out, (*key, what, *old, *now, *change, version))))


def audit_schema(feed: T.StructType, key: str, cols: list[str], seq: str, op: str) -> T.StructType:
    kind = {f.name: f.dataType for f in feed.fields}
    named = [(key, kind[key]), (OP, T.StringType()), *[(f"old_{c}", kind[c]) for c in cols],
             *[(f"new_{c}", kind[c]) for c in cols], (seq, kind[seq]), ("_change_op", kind[op]),
             *[(f"_change_{c}", kind[c]) for c in cols], (VERSION, T.LongType())]
    return T.StructType([T.StructField(n, t) for n, t in named])


def read_audit(spark: SparkSession, root: str, feed: T.StructType, key: str, cols: list[str], seq: str, op: str,
               late: bool = False) -> DataFrame:
    """Audit rows (key, _op, old values, new values, seq) written so far, the
    newest verdict of each change; with ``late`` the changes that came too late
    (key, op, values, seq) instead."""
    rows = spark.read.schema(audit_schema(feed, key, cols, seq, op)).parquet(f"{root}/audit")
    change = [seq, "_change_op", *[f"_change_{c}" for c in cols]]
    if late:
        return rows.filter(F.col(OP) == LATE).select(key, F.col("_change_op").alias(op),
                                                     *[F.col(f"_change_{c}").alias(c) for c in cols], seq).distinct()
    verdict = F.struct(OP, *[f"old_{c}" for c in cols], *[f"new_{c}" for c in cols])
    newest = rows.filter(~F.col(OP).eqNullSafe(LATE)).groupBy(key, *change).agg(F.max_by(verdict, VERSION).alias("_v"))
    return newest.filter(F.col("_v")[OP].isNotNull()).select(key, "_v.*", seq)


def run_audit_stream(spark: SparkSession, source_dir: str, feed_schema: T.StructType, root: str,
                     key: str, cols: list[str], seq: str, op: str, max_files_per_trigger: int | None = None,
                     late_by: int | None = None) -> DataFrame:
    """Audit every change file available now; return all audit rows so far.
    ``late_by``: in units of ``seq``, how far behind the newest change of its key
    a change may come (None: any distance; the state then holds all changes)."""
    reader = spark.readStream.schema(feed_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    audited = reader.parquet(source_dir).select(key, seq, op, *cols).groupBy(key).transformWithState(
        AuditProcessor(feed_schema, key, cols, seq, op, late_by), audit_schema(feed_schema, key, cols, seq, op),
        "Append", "None")
    provider = "spark.sql.streaming.stateStore.providerClass"
    usual = spark.conf.get(provider, None)
    spark.conf.set(provider, ROCKSDB)    # the only store that holds this kind of state; read when the query starts
    try:
        q = (audited.writeStream.format("parquet").outputMode("append").option("path", f"{root}/audit")
             .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
    finally:
        if usual is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, usual)
    q.awaitTermination()
    return read_audit(spark, root, feed_schema, key, cols, seq, op)
