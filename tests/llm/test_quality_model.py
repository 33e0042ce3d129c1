"""Held-out accuracy, and the compiled rules against the fitted ones."""

import zlib

from quarry.llm import quality_model as M

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored, model = M.score_quality(docs, labels)
    rows = scored.collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    y = {r.doc_id: r.quality for r in labels.collect()}
    test = [r for r in rows if r.held_out and r.doc_id in y]
    assert sum(r.predicted == y[r.doc_id] for r in test) >= 0.95 * len(test)
    assert 1 <= len(model.rules) <= 150
    assert all(len(r.conditions) <= M.MAX_CONDITIONS for r, _ in model.rules)


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 1), (2, "", 1), (None, "a b", 0), (3, "w " * 50_000, 1)],
                               "doc_id long, text string, quality int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = M.score_quality(df, none)[0].collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in (2, 2, 3)] + [(None, 0, 0), (1, None, 0)],
                                "doc_id long, quality int, toxic int")
    assert all(r.score >= 0.5 for r in M.score_quality(df, one)[0].collect())
    assert M.score_quality(df.limit(0), none)[0].count() == 0


def plain_features(text):
    """The statistics read one by one on a Python string."""
    import re

    t = text or ""
    space = r"[\x20\x09-\x0D]"
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, cover = {}, set()
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            cover |= {i + k for i in at for k in range(5)}
    n, chars, n_lines = max(len(w), 1), max(sum(map(len, w)), 1), max(len(lines), 1)
    symbols = "#*$%&|<>"
    return {
        "words": float(len(w)), "word_length": sum(map(len, w)) / n, "symbols": sum(t.count(c) for c in symbols) / n,
        "symbol_words": sum(all(c in symbols for c in x) for x in w) / n,
        "marks": sum(33 <= ord(c) <= 64 or 91 <= ord(c) <= 96 or 123 <= ord(c) <= 126 for c in t) / chars,
        "capitals": sum("A" <= c <= "Z" for c in t) / chars, "repeated_lines": (len(lines) - len(set(lines))) / n_lines,
        "repeated_words": len(cover) / n, "echoes": sum(a == b for a, b in zip(w, w[1:])) / n,
        "stops": len(re.findall(rf"[.!?](?={space}|\Z)", t)) / n, "line_words": len(w) / n_lines}


def plain_score(model, f):
    import math

    z = model.intercept
    for rule, weight in model.rules:
        if all(f[name] > at if above else f[name] <= at for name, above, at in rule.conditions):
            z += weight
    return 1 / (1 + math.exp(-z))


def test_scores_against_a_plain_reading_of_the_fitted_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored, model = M.score_quality(docs, labels)
    assert len(model.rules) >= 3 and all(0 < len(r.conditions) for r, _ in model.rules)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in scored.collect():
        f = plain_features(texts[r.doc_id])
        assert abs(r.score - plain_score(model, f)) < 1e-12, r.doc_id
    got = {r.doc_id: r for r in M.features(docs).collect()}
    for i, t in texts.items():
        f = plain_features(t)
        assert all(abs(got[i][n] - f[n]) < 1e-12 for n in M.FEATURES), i


def test_many_rules_do_not_multiply_the_statistics(spark):
    """The filter of the pipeline computes each statistic once per row, for 1 rule or 100, and keeps the rows that score."""
    import random

    rng = random.Random(1)
    names = list(M.FEATURES)
    def model(k):
        return M.RuleModel(0.1, tuple((M.PathRule(tuple(
            (n, rng.random() < .5, rng.random() * 9) for n in sorted(rng.sample(names, 3)))), rng.uniform(-1, 1)) for _ in range(k)))
    rows = [(i, " ".join(rng.choice(["a", "Bc.", "##", "dd dd"]) for _ in range(rng.randrange(0, 40))), "x") for i in range(60)]
    rows += [(None, None, None), (5, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string")
    calls = []
    for k in (1, 100):
        m = model(k)
        kept = M.keep_column(docs, m)
        calls.append(kept._jdf.queryExecution().optimizedPlan().toString().count("lambda"))
        assert kept.columns == docs.columns
        want = [r for r in rows if plain_score(m, plain_features(r[1])) >= 0.5]
        assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, want))
    assert calls[0] == calls[1] <= 60
