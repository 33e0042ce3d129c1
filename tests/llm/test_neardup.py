"""Groups against all pairs on small tables; sketches against their theory."""

import random

import numpy as np
import pytest

from quarry.llm import neardup as N


def brute(rows, size, percent=80):
    import re

    docs = [(i, t) for i, t in rows if i is not None]
    sets = []
    for _, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size
                    else ({tuple(w)} if w else set()))
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                i = len(sets[a] & sets[b])
                if 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                    parent[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for k, (i, _) in enumerate(docs):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((i, len(sets[k]), low[find(k)]) for k, (i, _) in enumerate(docs))


def made(seed=1, n=260):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["É", "the", "The"]
    base = [[rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 6, 40, 120]))] for _ in range(40)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            if w:
                w[rng.randrange(len(w))] = rng.choice(words)
        out.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    hot = [rng.choice(words) for _ in range(100)]
    for i in range(n, n + 120):   # a large group of near copies, all different
        w = list(hot)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(100)] = f"x{rng.randrange(10_000)}"
        out.append((i, " ".join(w)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_groups(spark, size):
    rows = made() + [(9000, None), (9001, ""), (9002, "a"), (9003, "A"), (9004, "a b"), (9005, "a b"), (9005, "a b"),
                     (9006, "z " * 30_000), (9007, "z z")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n_shingles int").repartition(4)
    got = N.near_duplicates(df, size).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in N.near_duplicates(df, 2).collect())
    assert got == [(0, None, True), (0, None, True), (1, 1, True)]
    assert N.near_duplicates(df.limit(0), 2).count() == 0


def test_sketch_estimates_and_merges():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4000, np.int64).astype(np.uint64)
    for share in (0.3, 0.6, 0.8, 0.95):
        a, b = pool[:2000], pool[int(2000 * (1 - share)):int(2000 * (2 - share))]
        j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        ra, rb, ru = N.sketch_sets([a, b, np.union1d(a, b)], 1024).astype(int)
        est = N.estimate_similarity(ra[None], rb[None], np.array([2000.]), np.array([2000.]))[0]
        assert abs(est - j) < 0.06
        assert (N.merge_sketches(ra, rb) == ru).all()
    sets = [rng.integers(0, 2**63, n, np.int64).astype(np.uint64) for n in (1, 3, 40_000, 20_000, 7)]
    alone = np.concatenate([N.sketch_sets([s]) for s in sets])
    assert (N.sketch_sets(sets) == alone).all()


def test_component_chains(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (300, 200), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in N.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, 200: 100, 300: 100}


def test_parity_bits_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2 ** 63, rng.integers(1, 400)).astype(np.uint64))
        keep = a[rng.random(len(a)) > rng.random() * 0.4]
        b = np.unique(np.concatenate([keep, rng.integers(0, 2 ** 63, rng.integers(0, 60)).astype(np.uint64)]))
        bits = sum(int(x).bit_count() for x in (N.parity_vector(a) ^ N.parity_vector(b)).view(np.uint64))
        differ = len(np.setxor1d(a, b))
        assert bits <= differ and (bits - differ) % 2 == 0
        if differ <= 60:
            assert bits >= 0.5 * differ     # few cancel: it is a sharp filter


def test_a_family_around_the_threshold(spark):
    """Copies of one text with a few to many edits each: every link of brute force, and pairs that follow the
    links instead of the square of the family."""
    import random

    rng = random.Random(6)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(140)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rng.choice([0, 1, 3, 6, 8, 9, 11, 14, 18, 22])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(3000)}"
        rows.append((i, " ".join(words)))
    made = []
    keep, N.materialise = N.materialise, lambda df, name: made.append((name, keep(df, name))) or made[-1][1]
    try:
        out = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())
    finally:
        N.materialise = keep
    assert got == sorted(brute(rows, 2))
    assert sum(t.count() for n, t in made if n == "pairs") <= 8 * len(rows)


def test_members_left_over_follow_the_family(spark):
    """The join that drops spent hubs runs once a round, and what it leaves grows with the family, not its square."""
    import random

    def left_over(n):
        rng = random.Random(8)
        base = [f"w{rng.randrange(10 ** 6)}" for _ in range(140)]
        rows = []
        for i in range(n):
            words = list(base)
            for _ in range(rng.choice([6, 8, 9, 11, 14])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
            rows.append((i, " ".join(words)))
        joins, counts = [], []

        def counted(df, name):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            anti = plan.count("Join LeftAnti")
            out = keep(df, name)
            if anti and "bucket" in df.columns:
                joins.append(anti)
                counts.append(out.count())
            return out

        keep, N.materialise = N.materialise, counted
        try:
            got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
        finally:
            N.materialise = keep
        return rows, got, joins, sum(counts)

    rows, got, joins, small = left_over(150)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, 2))
    assert joins and set(joins) == {1}
    assert 0 < small and left_over(300)[3] <= 2.6 * small
