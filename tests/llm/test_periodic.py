"""Runs of words against brute force: the Lyndon array by its definition, runs by trying every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quarry.llm import periodic as P

SF = "/root/testdata/sf0.001"


def longest_lyndon(s):
    out = []
    for i in range(len(s)):
        best = 1
        for m in range(1, len(s) - i + 1):
            w = s[i:i + m]
            if all(w < w[k:] for k in range(1, m)):
                best = m
        out.append(best)
    return out


def brute_runs(w, min_words=24, min_periods=3):
    out = set()
    for q in range(1, len(w) // min_periods + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            u = w[i:j + q]
            smaller = any(all(u[k] == u[k + d] for k in range(len(u) - d)) for d in range(1, q))
            if j > i and len(u) >= max(min_words, min_periods * q) and not smaller:
                out.add((i, len(u), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, probed):
    parts = [w for w in __import__("re").findall("[^\x20\x09-\x0D]+", text or "")]
    n = len(parts)
    h = zlib.crc32(str(doc_id).encode())
    if probed and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        parts = [parts[i] if i < a else parts[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(parts)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    best = (*top[0], 1000 * top[0][1] // top[0][2]) if top else (None,) * 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(parts) if i not in gone)), n, len(gone))


def key(r):
    return [(x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r]


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_lyndon_array_by_definition(letters):
    rng = random.Random(letters)
    for _ in range(300):
        s = [rng.randrange(letters) for _ in range(rng.randrange(1, 26))]
        assert P.lyndon_array(s) == longest_lyndon(s)
        inverse = [-x for x in s]
        assert P.lyndon_array(inverse) == longest_lyndon(inverse)


def test_runs_by_every_period():
    rng = random.Random(5)
    for _ in range(600):
        k = rng.choice([1, 2, 3, 50])
        s = [rng.randrange(k) for _ in range(rng.randrange(0, 70))]
        if rng.random() < .6:
            s += [rng.randrange(3) for _ in range(rng.randrange(1, 12))] * rng.randrange(2, 9) + s[:rng.randrange(40)]
        a = np.array(s, np.int64)
        assert P.find_runs(a) == brute_runs(s)
        if s:
            assert P.runs_of(a, 4, 3) == brute_runs(s, 4, 3)


def test_fibonacci_words_and_long_runs():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert P.find_runs(np.array(b)) == brute_runs(b)
    assert P.find_runs(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    assert P.find_runs(np.tile(np.arange(1000), 40)) == [(0, 40_000, 1000)]


@pytest.mark.parametrize("probed", [True, False])
def test_rows_against_brute_force(spark, probed):
    rng = random.Random(9)
    rows = []
    for i in range(150):
        words = [rng.choice(["a", "b", "ça", "x\x1cy", "d\xa0e"]) + str(rng.randrange(rng.choice([2, 300]))) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            words += words[:rng.randrange(1, 9)] * rng.randrange(3, 12)
        rows.append((i, rng.choice([" ", "\n", " \t\r", "\x0b"]).join(words)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "w " * 23), (204, "w " * 24), (None, "v u " * 30),
             (205, rows[3][1]), (205, rows[3][1])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n_runs int").repartition(3)
    got = [tuple(r) for r in P.periodic_runs(df, probed=probed).collect()]
    assert sorted(got, key=key) == sorted((brute_row(*r, probed) for r in rows), key=key)
    assert any(r[1] for r in got)
    assert P.periodic_runs(df.limit(0)).count() == 0


def test_query_on_given_documents(spark):
    from quarry.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = {d for d, t in docs if len(t or "") < 1500}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_baier_runs"](spark, SF).collect()}
    assert len(got) == len(docs) and len(short) > 80
    for d, t in docs:
        if d in short:   # (brute force is cubic; the query itself runs over all texts)
            assert got[d] == brute_row(d, t, True)


def test_run_rows_are_the_runs(spark):
    df = spark.createDataFrame([(1, "x " + "a b c " * 10 + "y " + "q " * 30), (2, "one two")], "doc_id long, text string")
    assert sorted(tuple(r) for r in P.run_rows(df).collect()) == [(1, 1, 30, 3), (1, 32, 30, 1)]
