"""Skew-proof scans over ordered groups.

Spark's ``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one
task, so one hot group (a third of the rows) becomes one 30 TB task. The scans
here instead

1. range-partition on (group, order). The order must be total, so that the range
   sampler can cut even a single hot group into many balanced partitions. The
   rows are sorted within partitions;
2. pass each partition once, as Arrow batches, through a vectorised function that
   knows nothing of other partitions, and write the result once into the shared
   checkpoint folder. Rows next to a partition's border (``EDGE``) go to a folder
   of their own, as a second, small output. Whatever is read later are these same
   bytes, so all passes agree on the borders (two range exchanges would sample
   different ones), and a lost executor does not force the scan to be redone;
3. mend what crosses a border from the edge rows alone. Their number is bounded by
   the number of partitions, not by the data.

* ``running_sum``: prefix sums; the edges give one carry per partition.
* ``ranks``: ROW_NUMBER, RANK and DENSE_RANK in one scan, carried the same way.
* ``frames``: LAG, LEAD and ROWS frames (sum, count, min, max, first, last). A halo
  of edge rows on both sides of each border answers the rows whose frame crosses it.
* ``last_known``: the last row of a kind at or before each row (as-of reads).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PID = "_scan_pid"
EDGE = "_scan_edge"    # the row is kept in the folder of edge rows
END = "_scan_end"      # 1: first row of its partition, 2: last row, 3: both, 0: neither
HEAD = "_scan_head"    # the row belongs to the group with which its partition begins
_G = ("_scan_g1", "_scan_g2")
_P = ("_scan_p1", "_scan_p2")
_CONCURRENT = "spark.sql.maxConcurrentOutputFileWriters"


def identity(df: DataFrame, cols: list[str]) -> list[Column]:
    """128 bits that tell neighbouring values of ``cols`` apart; NULL is a value, -0.0 is 0.0."""
    parts: list[Column] = []
    for c in cols:
        v = F.col(f"`{c}`")
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            v = v + F.lit(0.0)
        parts += [v.isNull(), v]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def _sort_keys(group: list[str], order: list) -> list[Column]:
    """Group ascending, then the order: names (ascending) or (name, ascending); NULLs first either way."""
    pairs = [(c, True) for c in group] + [(c, True) if isinstance(c, str) else tuple(c) for c in order]
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_first() for c, asc in pairs]


def _scan(df: DataFrame, group: list[str], order: list, fn: Callable, added: list[T.StructField], name: str,
          n_partitions: int | None, helpers: dict[str, Column] | None = None) -> DataFrame:
    """``df`` ordered, passed through ``fn`` once and written: its columns, PID, ``added`` and EDGE."""
    from ..session import scratch_path

    keys = _sort_keys(group, order)
    # without a fixed count AQE may merge adjacent range partitions; merged
    # partitions keep key order, and the partition id is taken in that stage
    ranged = df.repartitionByRange(n_partitions, *keys) if n_partitions else df.repartitionByRange(*keys)
    extra = dict(zip(_G, identity(df, group))) | (helpers or {})
    ranged = ranged.withColumns({PID: F.spark_partition_id(), **extra}).sortWithinPartitions(*keys)
    schema = T.StructType([*df.schema.fields, T.StructField(PID, T.IntegerType()), *added, T.StructField(EDGE, T.BooleanType())])
    drop = set(extra)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b, new in fn(b for b in batches if b.num_rows):
            kept = [(n, a) for n, a in zip(b.schema.names, b.columns) if n not in drop]
            yield pa.RecordBatch.from_arrays([*(a for _, a in kept), *new], schema.names)

    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(_CONCURRENT, None)
    spark.conf.set(_CONCURRENT, "4")    # two files per task at once instead of a sort by EDGE
    try:
        ranged.mapInArrow(run, schema).write.partitionBy(EDGE).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CONCURRENT)
        else:
            spark.conf.set(_CONCURRENT, before)
    return spark.read.schema(schema).parquet(path)


def _longs(b, names) -> list[np.ndarray]:
    return [b.column(n).to_numpy(zero_copy_only=False) for n in names]


class _Runs:
    """Where runs of equal rows begin, across the batches of one partition."""

    def __init__(self, names: tuple[str, ...]):
        self.names, self.last, self.count = names, None, 0

    def starts(self, b) -> np.ndarray:
        cols = _longs(b, self.names)
        out = np.zeros(b.num_rows, bool)
        for i, c in enumerate(cols):
            out[1:] |= c[1:] != c[:-1]
            out[0] |= self.last is None or self.last[i] != c[0]
        self.last = [c[-1] for c in cols]
        return out

    def numbers(self, starts: np.ndarray) -> np.ndarray:
        """1 for the partition's first run, and so on."""
        out = np.cumsum(starts) + self.count
        self.count = int(out[-1])
        return out


def _since_start(starts: np.ndarray) -> np.ndarray:
    """Position of the last start at or before each row; -1 before the first one."""
    return np.maximum.accumulate(np.where(starts, np.arange(len(starts)), -1))


def _ends(items: Iterator) -> Iterator:
    """Adds END and EDGE to (batch, arrays): one item is held back until it is known to be the last."""
    import pyarrow as pa

    held, first = None, True
    for item in items:
        if held is not None:
            yield _ended(pa, *held, first, False)
            first = False
        held = item
    if held is not None:
        yield _ended(pa, *held, first, True)


def _ended(pa, b, arrays, first: bool, last: bool):
    end = np.zeros(b.num_rows, np.int32)
    end[0] += first
    end[-1] += 2 * last
    return b, [*arrays, pa.array(end), pa.array(end > 0)]


def _cumulate(values: np.ndarray, starts: np.ndarray, carry):
    """Running sums within runs; ``carry`` continues the run of the batch before."""
    if values.dtype.kind in "iu":
        total = np.cumsum(values)
        at = _since_start(starts)
        return total - np.where(at >= 0, total[at] - values[at], -carry)
    import pandas as pd

    run = np.cumsum(starts)   # (differences of long sums would lose digits of doubles)
    out = pd.Series(values).groupby(run, sort=False).cumsum().to_numpy()
    return np.where(run == 0, out + carry, out) if values.dtype.kind == "f" else \
        np.array([x + carry if r == 0 else x for x, r in zip(out, run)], object)


def _local_sums(sum_cols: list[str]):
    def each(batches):
        import pyarrow as pa

        runs, carry = _Runs(_G), [0] * len(sum_cols)
        for b in batches:
            starts = runs.starts(b)
            head = runs.numbers(starts) == 1
            cums = [_cumulate(v, starts, c) for v, c in zip(_longs(b, sum_cols), carry)]
            carry = [c[-1] for c in cums]
            yield b, [*(pa.array(c, b.column(n).type) for c, n in zip(cums, sum_cols)), pa.array(head)]

    return lambda batches: _ends(each(batches))


def _edges(rows: DataFrame, cols: list) -> list[tuple]:
    """(first edge row, last edge row) per non-empty partition, in order."""
    found: dict[int, list] = {}
    for r in rows.filter(EDGE).select(PID, END, *cols).collect():
        at = found.setdefault(r[PID], [None, None])
        if r[END] & 1:
            at[0] = r
        if r[END] & 2:
            at[1] = r
    return [(p, *found[p]) for p in sorted(found)]


def running_sum(df: DataFrame, group_cols: list[str], order_cols: list,
                sum_cols: list[str], n_partitions: int | None = None) -> DataFrame:
    """Add ``<c>_cum``: inclusive running sum of ``c`` within each group, in
    ``order_cols`` order: column names (ascending, NULLs first) or
    ``(name, ascending)`` pairs of any orderable type; descending puts NULLs
    first as well. ``group_cols`` + ``order_cols`` must identify a row;
    ``sum_cols`` must be non-null numeric columns: longs for exact results
    (money in cents), doubles for approximate ones.
    """
    kinds = {c: df.schema[c].dataType for c in sum_cols}
    cums = [f"{c}_cum" for c in sum_cols]
    added = [*[T.StructField(cc, kinds[c]) for c, cc in zip(sum_cols, cums)],
             T.StructField(HEAD, T.BooleanType()), T.StructField(END, T.IntegerType())]
    rows = _scan(df, group_cols, order_cols, _local_sums(sum_cols), added, "scan", n_partitions)

    # per partition: what its first group has summed up in the partitions before
    g1, g2 = identity(df, group_cols)
    carries, group, total = [], None, None
    for pid, first, last in _edges(rows, [g1.alias(_G[0]), g2.alias(_G[1]), HEAD, *cums]):
        goes_on = group == (first[_G[0]], first[_G[1]])
        if goes_on:
            carries.append((pid, *total))
        own = [last[c] for c in cums]
        total = [a + b for a, b in zip(own, total)] if goes_on and last[HEAD] else own
        group = (last[_G[0]], last[_G[1]])
    out = rows
    if carries:
        schema = T.StructType([T.StructField("_c_pid", T.IntegerType()),
                               *[T.StructField(f"_c_{i}", kinds[c]) for i, c in enumerate(sum_cols)]])
        carry = df.sparkSession.createDataFrame(carries, schema)   # at most one row per partition
        out = rows.join(F.broadcast(carry), F.col(PID) == F.col("_c_pid"), "left")
        reached = F.col(HEAD) & F.col("_c_pid").isNotNull()
        out = out.withColumns({cc: F.when(reached, F.col(cc) + F.col(f"_c_{i}")).otherwise(F.col(cc)).cast(kinds[c])
                               for i, (c, cc) in enumerate(zip(sum_cols, cums))})
    return out.select(*df.columns, *cums)


def _local_ranks():
    def each(batches):
        import pyarrow as pa

        runs, peers = _Runs(_G), _Runs((*_G, *_P))
        n, rank, dense = 0, 0, 0
        for b in batches:
            starts, tops = runs.starts(b), peers.starts(b)
            head, head_peer = runs.numbers(starts) == 1, peers.numbers(tops) == 1
            i = np.arange(b.num_rows)
            at, top = _since_start(starts), _since_start(tops)
            number = np.where(at >= 0, i - at + 1, i + 1 + n)
            ranked = np.where(top >= 0, number[top], rank)
            dense_ = _cumulate(tops.astype(np.int64), starts, dense)
            n, rank, dense = int(number[-1]), int(ranked[-1]), int(dense_[-1])
            yield b, [pa.array(number), pa.array(ranked), pa.array(dense_), pa.array(head), pa.array(head_peer)]

    return lambda batches: _ends(each(batches))


def ranks(df: DataFrame, group: list[str], order: list, peers: list[str], number: str | None = None, rank: str | None = None,
          dense: str | None = None, n_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER, RANK and DENSE_RANK under the given names, in one scan.
    ``order`` must be total; rows equal in ``peers`` (its leading columns) share a rank."""
    long, flag = T.LongType(), T.BooleanType()
    added = [*[T.StructField(c, long) for c in ("_rk_n", "_rk_r", "_rk_d")], T.StructField(HEAD, flag),
             T.StructField("_rk_h", flag), T.StructField(END, T.IntegerType())]
    same = identity(df, peers)
    rows = _scan(df, group, order, _local_ranks(), added, "ranks", n_partitions, dict(zip(_P, same)))
    g1, g2 = identity(df, group)
    marks = [g1.alias(_G[0]), g2.alias(_G[1]), same[0].alias(_P[0]), same[1].alias(_P[1])]
    carries, group_, peer, state = [], None, None, (0, 0, 0)
    for pid, first, last in _edges(rows, [*marks, HEAD, "_rk_h", "_rk_n", "_rk_r", "_rk_d"]):
        n = d = 0
        r = None
        if group_ == (first[_G[0]], first[_G[1]]):
            n, d = state[0], state[2]
            if peer == (first[_P[0]], first[_P[1]]):
                r, d = state[1], d - 1
            carries.append((pid, n, r, d))
        own = (last["_rk_n"], last["_rk_r"], last["_rk_d"])
        if last[HEAD]:
            own = (own[0] + n, r if last["_rk_h"] and r is not None else own[1] + n, own[2] + d)
        group_, peer, state = (last[_G[0]], last[_G[1]]), (last[_P[0]], last[_P[1]]), own
    carry = df.sparkSession.createDataFrame(carries, "_c_pid int, _c_n long, _c_r long, _c_d long")
    j = rows.join(F.broadcast(carry), F.col(PID) == F.col("_c_pid"), "left") if carries else rows.withColumns(
        {"_c_n": F.lit(0), "_c_r": F.lit(None).cast("long"), "_c_d": F.lit(0)})
    more = lambda c: F.when(F.col(HEAD), F.coalesce(F.col(c), F.lit(0))).otherwise(0)
    out = {number: F.col("_rk_n") + more("_c_n"),
           rank: F.when(F.col("_rk_h") & F.col("_c_r").isNotNull(), F.col("_c_r")).otherwise(F.col("_rk_r") + more("_c_n")),
           dense: F.col("_rk_d") + more("_c_d")}
    return j.select(*df.columns, *[v.cast("long").alias(k) for k, v in out.items() if k])


@dataclass(frozen=True)
class Frame:
    """What a row sees of its group: ``kind`` of ``value`` over the rows from
    ``preceding`` rows before it to ``following`` rows after it. Kinds: "lag"
    (the row ``preceding`` before), "lead" (the row ``following`` after), "first"
    and "last" of the frame, "sum", "count" (values that are not NULL), "min" and
    "max" (NULLs skipped; NULL if none is left). Sums, minima and maxima take
    numbers, dates and timestamps."""
    kind: str
    value: str
    preceding: int = 0
    following: int = 0

    def reach(self) -> tuple[int, int]:
        return max(self.preceding, -self.following, 0), max(self.following, -self.preceding, 0)

    def column(self, group: list[str], keys: list[Column]) -> Column:
        """The same as a Window expression, for the few rows at the borders."""
        w = Window.partitionBy(*group).orderBy(*keys)
        v = F.col(f"`{self.value}`")
        if self.kind == "lag":
            return F.lag(v, self.preceding).over(w)
        if self.kind == "lead":
            return F.lead(v, self.following).over(w)
        fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "first": F.first, "last": F.last}[self.kind]
        return fn(v).over(w.rowsBetween(-self.preceding, self.following))

    def type_of(self, df: DataFrame) -> T.DataType:
        kind = df.schema[self.value].dataType
        if self.kind == "count":
            return T.LongType()
        if self.kind in ("sum", "min", "max") and isinstance(kind, (T.DecimalType, T.StringType)):
            raise ValueError(f"{self.kind} of {kind.simpleString()}: cast it to long (scaled) or double")
        if self.kind == "sum":
            return T.DoubleType() if isinstance(kind, (T.DoubleType, T.FloatType)) else T.LongType()
        return kind

    def compute(self, table, lo: np.ndarray, hi: np.ndarray, first: np.ndarray, last: np.ndarray, out_type):
        """Values for rows whose group spans [first, last] in ``table``; ``lo`` and
        ``hi`` are the rows asked for."""
        import pyarrow as pa
        import pyarrow.compute as pc

        col = table.column(self.value)
        i = np.arange(len(col))[lo:hi]
        first, last = first[lo:hi], last[lo:hi]
        if self.kind in ("lag", "lead"):
            at = i - self.preceding if self.kind == "lag" else i + self.following
            return col.take(pa.array(at, mask=(at < first) | (at > last))).cast(out_type)
        a, z = np.maximum(i - self.preceding, first), np.minimum(i + self.following, last)
        empty = a > z
        if self.kind in ("first", "last"):
            return col.take(pa.array(a if self.kind == "first" else z, mask=empty)).cast(out_type)
        there = col.is_valid().to_numpy(zero_copy_only=False)
        seen = np.concatenate([[0], np.cumsum(there)])
        a, z1 = np.where(empty, 0, a), np.where(empty, 0, z + 1)
        n = seen[z1] - seen[a]
        if self.kind == "count":
            return pa.array(n)
        if pa.types.is_floating(col.type):
            v = pc.fill_null(col, 0.0).to_numpy(zero_copy_only=False).astype(float)
        else:
            v = pc.fill_null(col.cast(pa.int64(), safe=False) if not pa.types.is_date32(col.type)
                             else col.cast(pa.int32()).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        if self.kind == "sum":
            if v.dtype.kind == "f":   # slice by slice: differences of long sums would lose digits
                got = np.add.reduceat(np.append(v, 0.0), np.stack([a, z1], 1).ravel())[::2]
            else:
                total = np.concatenate([[0], np.cumsum(v)])
                got = total[z1] - total[a]
            return pa.array(got, mask=n == 0)
        got = _extreme(v, there, a, z1, self.kind == "min")
        if pa.types.is_date32(out_type):
            return pa.array(got, mask=n == 0).cast(pa.int32()).cast(out_type)
        return pa.array(got, mask=n == 0).cast(out_type)


def _extreme(v: np.ndarray, there: np.ndarray, a: np.ndarray, z1: np.ndarray, least: bool) -> np.ndarray:
    """Minima or maxima of the slices [a, z1) by tables of the minima of 1, 2, 4, ... values.
    NaN is the greatest value, as in Spark."""
    if v.dtype.kind == "f":
        none, greatest = (np.inf, np.nan) if least else (-np.inf, np.nan)
        pick = np.fmin if least else np.maximum
        if least:
            v = np.where(there, v, np.nan)      # fmin skips NaN; all NaN gives NaN
        else:
            v = np.where(there, v, none)
    else:
        info = np.iinfo(np.int64)
        pick = np.minimum if least else np.maximum
        v = np.where(there, v, info.max if least else info.min)
    out = v[np.minimum(a, len(v) - 1)].copy()
    size = np.maximum(z1 - a, 1)
    level, width = v, 1
    while True:
        mine = (size >= width) & (size < 2 * width)
        out[mine] = pick(level[a[mine]], level[a[mine] + size[mine] - width])
        if not (size >= 2 * width).any():
            return out
        nxt = level.copy()
        nxt[:-width] = pick(level[:-width], level[width:])
        level, width = nxt, 2 * width


def _local_frames(specs: list[tuple[Frame, object]], back: int, ahead: int):
    halo = back + ahead

    def run(batches):
        import pyarrow as pa

        runs = _Runs(_G)
        table, starts = None, np.zeros(0, bool)
        done = base = 0        # rows of ``table`` already given out; rows of the partition before ``table``
        run0 = 0               # runs that began before ``table``

        def results(upto: int, total: int | None):
            nonlocal done
            n = len(starts)
            number = np.cumsum(starts) + run0
            edge = np.flatnonzero(starts)
            i = np.arange(n)
            first = np.maximum(_since_start(starts), 0)
            nxt = np.append(edge, n)
            last = nxt[np.searchsorted(edge, i, side="right")] - 1
            part = table.slice(done, upto - done)
            pos = i[done:upto] + base
            values = [f.compute(table, done, upto, first, last, kind) for f, kind in specs]
            head = number[done:upto] == 1
            open_ = head & (pos < back)
            border = pos < halo
            if total is not None:
                tail = number[done:upto] == number[-1]
                open_ = open_ | (tail & (pos >= total - ahead))
                border = border | (pos >= total - halo)
            done = upto
            return part, [*values, open_], border

        def give(item):
            part, new, border = item
            new = [*(_one(x) for x in new[:-1]), pa.array(new[-1]), pa.array(border)]
            at = 0
            for b in part.combine_chunks().to_batches():
                yield b, [x.slice(at, b.num_rows) for x in new]
                at += b.num_rows

        for b in batches:
            s = runs.starts(b)
            t = pa.Table.from_batches([b])
            table = t if table is None else pa.concat_tables([table, t])
            starts = np.concatenate([starts, s])
            # all rows whose frame and whose distance to the end of the partition are known for now
            upto = len(starts) - max(halo, 1)
            if upto - done >= 1:
                yield from give(results(upto, None))
                keep = max(done - back, 0)
                if keep:
                    run0 += int(starts[:keep].sum())
                    table, starts = table.slice(keep), starts[keep:]
                    base, done = base + keep, done - keep
        if table is not None and done < len(starts):
            yield from give(results(len(starts), base + len(starts)))

    return run


def _one(x):
    import pyarrow as pa

    return x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x


def frames(df: DataFrame, group: list[str], order: list, specs: dict[str, Frame], n_partitions: int | None = None) -> DataFrame:
    """Adds the frames under the given names; (group, order) must identify a row.

    Each partition answers its own rows. Rows whose frame crosses a border are
    answered from the edge rows, ``preceding`` + ``following`` rows on both sides
    of each border: these few are the only ones that meet in a Window. A frame may
    be wider than a partition; all of that partition's rows are then edge rows.
    """
    back = max((f.reach()[0] for f in specs.values()), default=0)
    ahead = max((f.reach()[1] for f in specs.values()), default=0)
    names = list(specs)
    kinds = [f.type_of(df) for f in specs.values()]
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = [to_arrow_type(k) for k in kinds]
    local = [f"_fr_{i}" for i in range(len(names))]
    added = [*[T.StructField(c, k) for c, k in zip(local, kinds)], T.StructField("_fr_open", T.BooleanType())]
    rows = _scan(df, group, order, _local_frames(list(zip(specs.values(), arrow)), back, ahead), added, "frames", n_partitions)
    whole = rows.filter(~F.col("_fr_open")).select(*df.columns, *[F.col(c).alias(n) for c, n in zip(local, names)])
    keys = _sort_keys([], order)
    mended = rows.filter(EDGE).select(*df.columns, "_fr_open", *[
        f.column(group, keys).cast(k).alias(n) for n, f, k in zip(names, specs.values(), kinds)])
    return whole.unionAll(mended.filter("_fr_open").drop("_fr_open"))


def _local_last(flag: str, value: str):
    def each(batches):
        import pyarrow as pa

        runs, held = _Runs(_G), None       # held: the last value of the run that goes on, as an array of one
        for b in batches:
            starts = runs.starts(b)
            head = runs.numbers(starts) == 1
            here = b.column(flag).to_numpy(zero_copy_only=False).astype(bool)
            at = np.maximum.accumulate(np.where(here, np.arange(b.num_rows), -1))
            start = _since_start(starts)
            known = at >= np.maximum(start, 0)
            carried = ~known & (start < 0) & (held is not None)
            col = b.column(value)
            pool = pa.concat_arrays([col, held]) if held is not None else col
            index = np.where(carried, b.num_rows, at)
            found = pool.take(pa.array(index, mask=~(known | carried)))
            held = found.slice(b.num_rows - 1, 1) if known[-1] or carried[-1] else None
            yield b, [found, pa.array(known | carried), pa.array(head)]

    return lambda batches: _ends(each(batches))


def last_known(df: DataFrame, group: list[str], order: list, flag: str, value: str, name: str,
               n_partitions: int | None = None) -> DataFrame:
    """Adds ``name``: ``value`` (a struct) of the last row at or before this one,
    in its group, whose ``flag`` is true; NULL if there is none. (group, order)
    must identify a row; ``flag`` is never NULL."""
    kind = df.schema[value].dataType
    added = [T.StructField("_lk_v", kind), T.StructField("_lk_known", T.BooleanType()), T.StructField(HEAD, T.BooleanType()),
             T.StructField(END, T.IntegerType())]
    rows = _scan(df, group, order, _local_last(flag, value), added, "last-known", n_partitions)
    g1, g2 = identity(df, group)
    carries, group_, held = [], None, None
    for pid, first, last in _edges(rows, [g1.alias(_G[0]), g2.alias(_G[1]), HEAD, "_lk_v", "_lk_known"]):
        goes_on = group_ == (first[_G[0]], first[_G[1]]) and held is not None
        if goes_on:
            carries.append((pid, held[0]))
        if last["_lk_known"]:
            held = (last["_lk_v"],)
        elif not (goes_on and last[HEAD]):
            held = None
        group_ = (last[_G[0]], last[_G[1]])
    found = F.col("_lk_v")
    out = rows
    if carries:
        schema = T.StructType([T.StructField("_c_pid", T.IntegerType()), T.StructField("_c_v", kind)])
        carry = df.sparkSession.createDataFrame(carries, schema)
        out = rows.join(F.broadcast(carry), F.col(PID) == F.col("_c_pid"), "left")
        found = F.when(F.col(HEAD) & ~F.col("_lk_known"), F.col("_c_v")).otherwise(found)
    return out.select(*df.columns, found.alias(name))
