"""Leaks against brute-force alignment of every window."""

import random

import numpy as np

from quarry.llm import decontam as D


def distance(pattern, data):
    """Least edits between the pattern and any stretch of the data."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in data:
        new = [0]
        for k, p in enumerate(pattern):
            new.append(min(row[k] + (p != c), row[k + 1] + 1, new[k] + 1))
        row = new
        best = min(best, row[-1])
    return best


def made(seed=2):
    rng = random.Random(seed)
    syll = ["ti", "on", "er", "the", "an", "re", "he", "in", "ed ", "ble ", "sh. ", "ou, "]
    text = lambda n: "".join(rng.choice(syll) for _ in range(n))
    items = [(i, text(rng.choice([11, 20, 30, 60, 90]))) for i in range(12)] + [(90, "short"), (91, None), (None, text(40))]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 60)) for _ in range(2)]
        if i % 3 == 0:
            leak = list(items[i % 12][1])
            for _ in range(rng.choice([0, 0, 2, 4, 6, 9, 14])):
                k = rng.randrange(len(leak))
                leak[k:k + 1] = rng.choice([[], [leak[k], "x"], ["q"]])
            parts.insert(1, "".join(leak).upper() if i % 2 else "".join(leak).replace(" ", "\n"))
        docs.append((i, "".join(parts)))
    return items, docs


def test_against_brute_force(spark):
    items, docs = made()
    docs += [(100, None), (101, ""), (102, "é" * 90_000 + items[4][1]), (None, items[4][1]), (103, items[4][1]), (103, items[4][1])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.item_id, r.n_windows) for r in D.find_leaks(df, bench).collect())
    index = D.WindowIndex([(i, t) for i, t in items if i is not None and t is not None])
    want = []
    for i, t in docs:
        per = {}
        data = D.folded((t or "")[-3000:])
        for w, (p, item) in enumerate(zip(index.windows, index.item_of)):
            if distance(bytes(p), bytes(data)) <= index.edits[w]:
                per[item] = per.get(item, 0) + 1
        want += [(i is None, i or 0, item, n) for item, n in per.items()]
    assert got == sorted(want) and len(want) > 15
    kept = D.drop_leaking(df, bench)
    assert kept.columns == df.columns
    leaking = {(a, b) for a, b, _, _ in got}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(
        (i is None, i or 0) for i, _ in docs if (i is None, i or 0) not in leaking)


def test_blocks_and_empty(spark, monkeypatch):
    items, docs = made(5)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, D.find_leaks(df, bench).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    assert len(list(D.benchmark_blocks(bench))) > 3
    assert sorted(map(tuple, D.find_leaks(df, bench).collect())) == whole
    assert D.find_leaks(df, bench.limit(0)).count() == 0 and D.find_leaks(df.limit(0), bench).count() == 0
    assert D.drop_leaking(df, bench.limit(0)).count() == len(docs)


def test_bound_is_positive():
    for n in range(D.MIN_ITEM, 400):
        index = D.WindowIndex([(1, "a" * n)])
        assert (index.bounds >= 1).all() and np.all(index.edits >= 1)


def test_every_excerpt_at_every_offset():
    rng = random.Random(7)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    for size in (64, 81, 106, 233, 394):
        item = letters(size)
        index = D.WindowIndex([(5, item), (6, letters(200))])
        for n in {min(D.EXCERPT, size), min(74, size), min(106, size)}:
            for at in range(size - n + 1):
                part = item[at:at + n]
                assert [i for i, *_ in index.leaks(letters(150) + part + letters(150))] == [5], (size, n, at)
                k = at % (n - 9) + 4   # three edits in one place, one elsewhere
                part = part[1:k] + "#" + part[k + 1:k + 3] + "##" + part[k + 3:]
                assert [i for i, *_ in index.leaks(letters(150) + part + letters(150))] == [5], (size, n, at)
        assert index.leaks(letters(2000)) == []


def test_short_items_are_searched_whole(spark):
    items = [(1, "What is 6 x 7?"), (2, "Name the capital of F"), (3, "forty"), (4, " ?! "), (5, "")] + [(6, "forty"), (1, "b" * 20)]
    docs = [(1, "so: WHAT IS 6 X 7! forty"), (2, "what is 6 x 8?"), (3, "name the capital of f and name the capital of f"),
            (4, "name the  capital of f"), (5, "fort"), (6, None), (7, "b" * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in D.find_leaks(df, bench).collect())
    assert got == [(1, 1, 1, 4, 18), (1, 3, 1, 19, 24), (1, 6, 1, 19, 24), (3, 2, 1, 0, 47), (7, 1, 1, 0, 50)]
    assert sorted(r.doc_id for r in D.drop_leaking(df, bench).collect()) == [2, 4, 5, 6]


def test_a_long_text_full_of_benchmark_text(monkeypatch):
    """Aligned in parts of bounded size; the result is the same as in one."""
    items, _ = made(3)
    index = D.WindowIndex([(i, t) for i, t in items if i is not None and t is not None])
    rng = random.Random(1)
    texts = [t for i, t in items if i is not None and t and len(t) > 60]
    text = " ".join(t[:k] + "x" + t[k:] for t in rng.choices(texts, k=400) for k in [rng.randrange(len(t))])
    data = D.folded(text)
    win, band = index.bands(data)
    assert len(win) > 3000
    whole = sorted(index.verify(data, win, band))
    monkeypatch.setattr(D, "AT_ONCE", 100)
    assert sorted(index.verify(data, win, band)) == whole and len(whole) > 1000
