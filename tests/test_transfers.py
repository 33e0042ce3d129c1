"""Batches of transfers against a walk one by one."""

import random
from collections import defaultdict

import pytest

from quarry.operators.domain import transfer_sequence


def walk(accounts, transfers):
    """Statuses and balances (cents) when each batch is applied after the other."""
    bal, status = dict(accounts), {}
    by_batch = defaultdict(lambda: defaultdict(int))
    for b, src, dst, c in transfers:
        if b is not None:
            for acc, d in ((src, -c), (dst, c)):
                if acc in bal:
                    by_batch[b][acc] += d
    for b in sorted(by_batch):
        new = {a: bal[a] + d for a, d in by_batch[b].items()}
        status[b] = "ROLLED_BACK" if any(v < 0 for v in new.values()) else "COMMITTED"
        if status[b] == "COMMITTED":
            bal.update(new)
    return status, bal


@pytest.mark.parametrize("seed, parts", [(1, 2), (2, 30), (3, 5), (4, 3)])
def test_against_a_walk(spark, seed, parts):
    rng = random.Random(seed)
    accounts = [(i, rng.choice([-500, 0, 800, 3000, 10 ** 7])) for i in range(12)]
    hub = rng.choice([0, 4])
    transfers = []
    for b in range(60):
        for _ in range(rng.randrange(1, 4)):
            src = hub if rng.random() < .33 else rng.choice([*range(12), None, 99])   # one account in a third of the rows
            transfers.append((rng.choice([b, b, None]), src, rng.randrange(13), rng.randrange(0, 900)))
    acc = spark.createDataFrame([(i, c / 100, "x") for i, c in accounts], "id long, saldo double, src string")
    tr = spark.createDataFrame([(b, s, d, c / 100) for b, s, d, c in transfers], "lote long, de long, para long, valor double")
    status, balances = transfer_sequence(acc, "id", "saldo", tr, "lote", "de", "para", "valor", n_partitions=parts)
    want_status, want = walk(accounts, transfers)
    got = status.collect()
    assert {r.lote: r.batch_status for r in got} == want_status and len(got) == len(want_status)
    assert set(want_status.values()) == {"COMMITTED", "ROLLED_BACK"}
    assert {r.id: int(r.saldo * 100) for r in balances.collect()} == want
    assert balances.columns == acc.columns


def test_independent_batches_take_one_round(spark):
    """Many batches on accounts of their own, and a hub that only receives: all are decided together."""
    acc = spark.createDataFrame([(i, 1.0) for i in range(50)] + [(99, 0.0)], "id long, saldo double")
    tr = spark.createDataFrame([(i, i, 99, 2.0 if i % 5 == 0 else 0.5) for i in range(50)], "b long, s long, d long, v double")
    status, balances = transfer_sequence(acc, "id", "saldo", tr, "b", "s", "d", "v")
    rows = status.collect()
    assert {r.b for r in rows if r.batch_status == "ROLLED_BACK"} == {i for i in range(50) if i % 5 == 0}
    assert max(r["round"] for r in rows) == 1
    assert {r.id: r.saldo for r in balances.collect()}[99] == 20


def test_order_matters_and_empty_tables(spark):
    acc = spark.createDataFrame([(1, 10.0), (2, 0.0), (3, 0.0)], "id long, saldo double")
    tr = [(1, 2, 3, 5.0), (2, 1, 2, 10.0), (3, 2, 3, 5.0), (4, 1, 2, 0.01)]
    df = spark.createDataFrame(tr, "b long, s long, d long, v double")
    status, balances = transfer_sequence(acc, "id", "saldo", df, "b", "s", "d", "v")
    assert [r.batch_status for r in status.orderBy("b").collect()] == ["ROLLED_BACK", "COMMITTED", "COMMITTED", "ROLLED_BACK"]
    assert {r.id: float(r.saldo) for r in balances.collect()} == {1: 0.0, 2: 5.0, 3: 5.0}
    status, balances = transfer_sequence(acc, "id", "saldo", df.limit(0), "b", "s", "d", "v")
    assert status.count() == 0 and balances.count() == 3
