"""Statistics against brute force; the vote model on made votes and labels."""

import random
import re

import pytest

from quarry.llm import quality_rules as Q

SF = "/root/testdata/sf0.01"


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, cover = {}, set()
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            cover |= {i + k for i in at for k in range(5)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics(spark):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (None, "x y"), (5, "a a a a a a"),
            (6, "é | ## b c\x0bd\x85e\n\n \nline\nline\n line"), (7, "w " * 60_000)]
    rows += [(10 + i, "".join(rng.choice(["a ", "b ", "c ", "dd\n", "É#\t"]) for _ in range(rng.randint(0, 60))))
             for i in range(200)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int")
    got = sorted(tuple(r) for r in Q.statistics(df).select("doc_id", *COLS).fillna(-1, ["doc_id"]).collect())
    assert got == sorted((-1 if i is None else i, *brute(t)) for i, t in rows)


def test_fit_finds_the_good_rules():
    rng = random.Random(4)
    counts = {}
    for _ in range(5000):
        good = rng.random() < 0.85
        votes = []
        for acc, cover in ((0.95, 0.9), (0.9, 0.6), (0.9, 0.8), (0.55, 0.9)):
            right = rng.random() < acc
            votes.append(0 if rng.random() > cover else (1 if good == right else -1))
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + 1
    m = Q.fit_votes(sorted(counts.items()), 4)
    assert abs(m.prior - 0.85) < 0.04
    assert m.log_odds(0, 1) > m.log_odds(3, 1) and m.log_odds(0, -1) < -1
    assert Q.fit_votes([], 4).prior == 0.8


def test_against_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.apply_quality_rules(docs).cache()
    assert got.count() == docs.count()
    j = got.join(labels, "doc_id").filter("n_words >= 10").collect()
    clean = [r for r in j if r.quality == 1]
    junk = [r for r in j if r.quality == 0]
    assert sum(r.kept for r in clean if not r.base_failed) >= 0.99 * sum(not r.base_failed for r in clean)
    assert sum(not r.kept for r in junk) >= 0.9 * len(junk)
    assert not [r for r in got.collect() if r.base_failed and r.kept]
    got.unpersist()


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert Q.apply_quality_rules(df).count() == 0


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = Q.statistics(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("text", ["a b c d e a b c d e", "a b c d e f a b c d e", "a " * 11])
def test_repeats(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert Q.statistics(df).first().n_repeat_words == brute(text)[4]
