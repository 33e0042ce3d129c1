"""Deletes through foreign keys against a walk over a dict of rows."""

import random

import pytest

from quarry.operators import cascade as C


def walk(tables, keys, table, doomed):
    gone = {t: set() for t in tables}
    todo = [(table, k) for k in doomed if any(r[0] == k for r in tables[table])]
    while todo:
        t, k = todo.pop()
        if k in gone[t]:
            continue
        gone[t].add(k)
        for fk in keys:
            if fk.parent == t and fk.rule == C.CASCADE:
                i = int(fk.column[1:])
                todo += [(fk.child, r[0]) for r in tables[fk.child] if r[i] == k and r[0] is not None]
    block, cleared = set(), set()
    for fk in keys:
        i = int(fk.column[1:])
        for r in tables[fk.child]:
            if r[i] in gone[fk.parent] and r[i] is not None and r[0] not in gone[fk.child]:
                if fk.rule == C.RESTRICT:
                    block.add((fk.child, fk.column, str(r[0])))
                if fk.rule == C.SET_NULL:
                    cleared.add((fk.child, fk.column, r[0]))
    return {t: g for t, g in gone.items() if g}, block, cleared


@pytest.mark.parametrize("seed", range(5))
def test_against_a_walk(spark, seed):
    rng = random.Random(seed)
    names = ["a", "b", "c"]
    rows = {t: [(i, rng.choice([None, *range(30)]), rng.choice([None, 1, 1, *range(30)])) for i in range(30)] for t in names}
    keys = [C.ForeignKey(rng.choice(names), rng.choice(["c1", "c2"]), rng.choice(names),
                         rng.choice([C.CASCADE, C.CASCADE, C.CASCADE, C.RESTRICT, C.SET_NULL])) for _ in range(5)]
    keys = list({(k.child, k.column): k for k in keys}.values())
    tables = {t: (spark.createDataFrame(r, "c0 long, c1 long, c2 long"), "c0") for t, r in rows.items()}
    doomed = rng.sample(range(40), 4)
    got = C.delete_cascade(tables, keys, "a", spark.createDataFrame([(d,) for d in doomed] + [(None,)], "k long"))
    gone, block, cleared = walk(rows, keys, "a", doomed)
    found = {t: sorted(r.key for r in df.collect()) for t, df in got.gone.items()}
    assert {t: k for t, k in found.items() if k} == {t: sorted(g) for t, g in gone.items()}
    assert {tuple(r) for r in got.blockers.collect()} == block
    assert {(t, r.column, r.key) for t, df in got.cleared.items() for r in df.collect()} == cleared
    left = {t: sorted(map(str, map(tuple, df.collect()))) for t, df in C.remaining(tables, got).items()}
    for t, r in rows.items():
        want = r if block else [(k, *[None if (t, f"c{i}", k) in cleared else v for i, v in ((1, x), (2, y))])
                                for k, x, y in r if k not in gone.get(t, ())]
        assert left[t] == sorted(map(str, want))


def test_chain_and_cycle_of_one_table(spark):
    """A staff tree twelve levels deep and a cycle: rounds follow the longest chain, and the cycle ends."""
    rows = [(i, i - 1 if i else None) for i in range(13)] + [(20, 21), (21, 20)]
    t = {"emp": (spark.createDataFrame(rows, "id long, boss long"), "id")}
    fk = [C.ForeignKey("emp", "boss", "emp")]
    d = C.delete_cascade(t, fk, "emp", spark.createDataFrame([(4,)], "k long"))
    assert sorted(r.key for r in d.gone["emp"].collect()) == list(range(4, 13)) and d.rounds == 9
    d = C.delete_cascade(t, fk, "emp", spark.createDataFrame([(20,)], "k long"))
    assert sorted(r.key for r in d.gone["emp"].collect()) == [20, 21]
    d = C.delete_cascade(t, fk, "emp", spark.createDataFrame([(99,)], "k long"))
    assert d.gone["emp"].count() == 0 and C.remaining(t, d)["emp"].count() == 15


def test_children_of_a_chain_are_read_once_and_many_keys_not_broadcast(spark, monkeypatch):
    """A chain of 13 staff; each task belongs to one of them, each note to a task: tasks and notes take
    one step each, not one per level, and no join sends more keys than allowed through the driver."""
    plans = []

    def staged(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    stage = C.stage
    monkeypatch.setattr(C, "stage", staged)
    monkeypatch.setattr(C, "BROADCAST_KEYS", 4, raising=False)
    t = {"note": (spark.createDataFrame([(i, i % 26) for i in range(52)], "id long, task long"), "id"),
         "task": (spark.createDataFrame([(i, i % 13) for i in range(26)], "id long, emp long"), "id"),
         "emp": (spark.createDataFrame([(i, i - 1 if i else None) for i in range(13)], "id long, boss long"), "id")}
    fk = [C.ForeignKey("note", "task", "task"), C.ForeignKey("task", "emp", "emp"), C.ForeignKey("emp", "boss", "emp")]
    d = C.delete_cascade(t, fk, "emp", spark.createDataFrame([(4,)], "k long"))
    assert {n: df.count() for n, df in d.gone.items()} == {"emp": 9, "task": 18, "note": 36}
    assert len(plans) == 1 + 9 + 2 and d.rounds == 11
    assert "Broadcast" not in plans[-1] and "Broadcast" not in plans[-2]   # 9 and 18 keys looked for
