"""Property tests against plain-Python references."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import nested as N
from quarry.operators.relational import not_in, quantified

vals = st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=5)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _tv_cmp(x, y, op):
    if x is None or y is None:
        return None
    return {">": x > y, ">=": x >= y, "<": x < y, "<=": x <= y}[op]


def _any(x, s, op):
    res = False
    for y in s:
        c = _tv_cmp(x, y, op)
        if c is True:
            return True
        if c is None:
            res = None
    return res


def _all(x, s, op):
    res = True
    for y in s:
        c = _tv_cmp(x, y, op)
        if c is False:
            return False
        if c is None:
            res = None
    return res


def _not_in(x, s):
    res = True
    for y in s:
        if x is None or y is None:
            res = None
        elif x == y:
            return False
    return res


@SETTINGS
@given(xs=vals, s=vals, op=st.sampled_from([">", ">=", "<", "<="]))
def test_quantified_matches_three_valued_logic(spark, xs, s, op):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x int")
    sub = spark.createDataFrame([(y,) for y in s], "y int")
    got_any = sorted(r.i for r in quantified(df, "x", sub, "y", op, "ANY").collect())
    got_all = sorted(r.i for r in quantified(df, "x", sub, "y", op, "ALL").collect())
    assert got_any == [i for i, x in enumerate(xs) if _any(x, s, op) is True]
    assert got_all == [i for i, x in enumerate(xs) if _all(x, s, op) is True]


@SETTINGS
@given(xs=vals, s=vals)
def test_not_in_matches_three_valued_logic(spark, xs, s):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x int")
    sub = spark.createDataFrame([(y,) for y in s], "y int")
    got = sorted(r.i for r in not_in(df, "x", sub, "y").collect())
    assert got == [i for i, x in enumerate(xs) if _not_in(x, s) is True]


def test_lossless_and_lossy(spark):
    w = spark.createDataFrame([(1, 10, "a"), (1, 11, "b"), (2, 10, "a")], "o int, p int, b string")
    ok = N.lossless_check(w, ["o", "p"], ["p", "b"], ["p"]).first()
    assert ok.lossless and ok.n_input == ok.n_rejoined == 3
    # splitting on an attribute that determines nothing adds spurious rows
    w2 = spark.createDataFrame([(1, 10, "a"), (2, 11, "a")], "o int, p int, b string")
    bad = N.lossless_check(w2, ["o", "b"], ["b", "p"], ["b"]).first()
    assert not bad.lossless and (bad.n_input, bad.n_rejoined) == (2, 4)


def test_restore_equals_as_of(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    restored = {r.user_id: r.value for r in queries()["restore_as_of"](spark, sf).collect() if r._action == "update"}
    past = {r.user_id: r.value for r in queries()["as_of_state"](spark, sf).collect()}
    assert restored and all(past[k] == v for k, v in restored.items())


def test_fd_violations(spark):
    df = spark.createDataFrame([("x", "A"), ("x", "B"), ("y", "A"), ("y", "A")], "k string, v string")
    assert [r.k for r in N.fd_violations(df, ["k"], ["v"]).collect()] == ["x"]
    nul = spark.createDataFrame([("x", None), ("x", "B"), ("y", None)], "k string, v string")
    assert [r.k for r in N.fd_violations(nul, ["k"], ["v"]).collect()] == ["x"]


rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5), st.integers(-9, 9)),
                   min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 6), batch=st.integers(1, 7))
def test_running_sum_property(spark, rows, parts, batch):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from quarry.operators.scan import running_sum

    df = spark.createDataFrame([(g, o, i, v) for i, (g, o, v) in enumerate(rows)],
                               "g long, o long, id long, v long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = {r.id: r.v_cum for r in running_sum(df, ["g"], ["o", "id"], ["v"], n_partitions=parts).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    w = Window.partitionBy("g").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.c for r in df.select("id", F.sum("v").over(w).alias("c")).collect()}
    assert got == want


slots_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 180)), min_size=1, max_size=40)


@SETTINGS
@given(slots=slots_st)
def test_conflict_counts_property(spark, slots):
    import datetime as dt

    from quarry.operators.overlap import conflict_counts

    base = dt.datetime(2025, 6, 2, 8)
    rows = [(i, k, base + dt.timedelta(minutes=m)) for i, (k, m) in enumerate(slots)]
    df = spark.createDataFrame(rows, "id long, k long, t timestamp_ntz")
    got = {r.id: r.n_conflicts for r in conflict_counts(df, "k", "t", "id", 30, n_partitions=3).collect()}
    want = {}
    for i, k, t in rows:
        n = sum(1 for j, k2, t2 in rows if j != i and k2 == k and abs((t2 - t).total_seconds()) < 1800)
        if n:
            want[i] = n
    assert got == want
