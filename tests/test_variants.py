"""Updates of documents without a schema against the same updates of Python dicts."""

import json
import random

from pyspark.sql import functions as F

from quarry.operators import variants as V


def rand_doc(rng, depth=2):
    out = {}
    for k in rng.sample(["a", "b", "c d", "e'f"], rng.randrange(0, 4)):
        out[k] = rng.choice([1, 2.5, "x", None, True, [1, "y"], {}]) if depth == 0 or rng.random() < .6 else rand_doc(rng, depth - 1)
    return out


def change(doc, path, fn):
    """``fn`` of the old value (missing: KeyError marker) at ``path``; other values on the way block it."""
    if doc is MISSING:
        doc = {}
    if not isinstance(doc, dict):
        return doc
    k, rest = path[0], path[1:]
    old = doc.get(k, MISSING)
    new = change(old, rest, fn) if rest else fn(old)
    return {**doc, k: new}


MISSING = object()


def inc(old, by):
    if old is MISSING:
        return by
    return old + by if isinstance(old, (int, float)) and not isinstance(old, bool) else old


def unset(doc, path):
    if not isinstance(doc, dict) or path[0] not in doc:
        return doc
    if len(path) == 1:
        return {k: v for k, v in doc.items() if k != path[0]}
    return {**doc, path[0]: unset(doc[path[0]], path[1:])}


PATHS = [["a"], ["c d"], ["a", "b"], ["e'f", "c d", "a"]]


def test_updates_against_dicts(spark):
    rng = random.Random(2)
    docs = [rand_doc(rng) for _ in range(150)] + [[1, 2], "text", 3, {}]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(900, "no json {"), (901, None)]
    df = spark.createDataFrame(rows, "id long, j string").withColumn("v", V.parse(F.col("j")))
    where = F.col("id") % 3 != 0
    cols = {}
    for n, p in enumerate(PATHS):
        cols[f"set{n}"] = V.set_field(F.col("v"), p, F.lit("new"), where)
        cols[f"inc{n}"] = V.inc_field(F.col("v"), p, 2)
        cols[f"push{n}"] = V.push_field(F.col("v"), p, F.lit(7))
        cols[f"unset{n}"] = V.unset_field(F.col("v"), p)
        cols[f"has{n}"] = V.has(F.col("v"), p)
    got = df.select("id", *[(c if n.startswith("has") else F.to_json(c)).alias(n) for n, c in cols.items()]).collect()

    def there(d, p):
        for k in p:
            if not isinstance(d, dict) or k not in d:
                return False
            d = d[k]
        return True

    for r in got:
        if r.id >= 900:
            assert all(r[f"{k}{n}"] is None for k in ("set", "inc", "push", "unset") for n in range(len(PATHS)))
            continue
        d = docs[r.id]
        for n, p in enumerate(PATHS):
            assert json.loads(r[f"set{n}"]) == (change(d, p, lambda _: "new") if r.id % 3 else d)
            assert json.loads(r[f"inc{n}"]) == change(d, p, lambda o: inc(o, 2)), (d, p, r[f"inc{n}"])
            assert json.loads(r[f"push{n}"]) == change(
                d, p, lambda o: [7] if o is MISSING else o + [7] if isinstance(o, list) else o)
            assert json.loads(r[f"unset{n}"]) == unset(d, p)
            assert r[f"has{n}"] == there(d, p)


def test_shredded_documents_filter_in_the_scan(spark, tmp_path):
    rows = [(i, json.dumps({"a": i, "b": {"c": f"t{i % 5}"}} if i % 4 else {"a": "text", "z": [i]})) for i in range(200)]
    docs = spark.createDataFrame(rows, "id long, j string").select("id", V.parse(F.col("j")).alias("doc"))
    V.write_documents(docs, str(tmp_path / "docs"))
    d = V.read_documents(spark, str(tmp_path / "docs"), docs)
    hit = d.filter(V.get(F.col("doc"), ["a"], "bigint") > 190).select("id", V.get(F.col("doc"), ["b", "c"], "string").alias("c"))
    assert sorted(tuple(r) for r in hit.collect()) == [(i, f"t{i % 5}") for i in range(191, 200) if i % 4]
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,doc:struct<" in plan     # the asked paths, not whole documents
    assert "GreaterThan(doc.`" in plan                            # and the filter reaches the scan
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled", None) is None
    assert sorted(d.select("id", F.to_json("doc")).collect()) == sorted(docs.select("id", F.to_json("doc")).collect())
