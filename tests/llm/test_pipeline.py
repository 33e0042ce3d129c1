"""The pipeline against its stages done one by one in plain Python."""

import random
import sys

import corpus_pipeline as P
from quarry.llm import decontam, neardup, secrets
from quarry.llm.common import documents

sys.path.insert(0, __file__.rsplit("/", 1)[0])
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from test_neardup import brute

    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "tokenise"]
    docs = documents(spark, SF)
    cols, before = docs.columns, docs
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == cols and after.schema == docs.schema
        a, b = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        assert set(b) <= set(a)
        gone = set(a) - set(b)
        if name == "quality":
            assert gone and sum(labels.get(i) == 1 for i in gone) <= 0.02 * len(a)
        if name == "near_dedup":
            groups = brute([(i, r.text) for i, r in a.items()], 5)
            assert set(b) == {c for _, _, c in groups}
        if name == "decontaminate":
            index = decontam.WindowIndex([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
            assert gone == {i for i, r in a.items() if index.leaks(r.text)} and gone
        if name == "secrets":
            assert not gone
            left = [secrets.base_spans(r.text, list(secrets.RUN.finditer(r.text))) for r in b.values()]
            assert not any(left) and any(r.text != a[i].text for i, r in b.items())
            assert all(r.n_chars == len(r.text) for r in b.values())
        before = after
    got = P.run(spark, SF)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in before.collect())


def test_awkward_rows(spark):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(999)}" for _ in range(80)) + "."
    rows = [(None, text, None, None, None, 1), (1, None, "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (3, text, "en", "s", 9, 1),
            (3, text, "en", "s", 9, 1), (4, text, "en", "s", 9, 1), (5, "".join(f" y{k}" for k in range(30_000)), "en", "s", 9, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    for name, stage in P.STAGES:
        for table in (df, df.limit(0)):
            out = stage(spark, table, SF)
            n = out.count()
            assert n <= table.count()
            if name != "tokenise":
                assert out.columns == table.columns
    kept = P.STAGES[1][1](spark, df, SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [
        (False, 1), (False, 2), (False, 3), (False, 3), (False, 5), (True, 0)]
    assert neardup.near_duplicates(df).count() == len(rows)
