"""Stream = batch for the streaming upsert and the streaming audit."""

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def test_stream_upsert_equals_batch(spark):
    from pyspark.sql import functions as F

    from quarry.operators.change import upsert
    from quarry.plans.changes_q import stock
    from quarry.plans.streams_q import D1, D2, _delivery

    got = queries()["stream_upsert"](spark, SF)
    d1, d2 = _delivery(spark, SF, True, D1, 1), _delivery(spark, SF, False, D2, 2)
    s1 = upsert(stock(spark, SF), d1, "livro_id",
                {"quantidade_disponivel": "quantidade_nova", "ultima_atualizacao": "data_entrega"}).drop("_action")
    s2 = upsert(s1, d2, "livro_id",
                {"quantidade_disponivel": "quantidade_nova", "ultima_atualizacao": "data_entrega"}).drop("_action")
    from __spark_entry__ import portable

    assert sorted(got.collect()) == sorted(portable(s2.select(*got.columns)).collect())
    assert got.filter(F.col("ultima_atualizacao") == F.lit(D2).cast("timestamp_ntz")).count() > 0


def test_stream_audit_equals_batch(spark):
    got = queries()["stream_audit"](spark, SF)
    want = queries()["audit_diff"](spark, SF)
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_upsert_stream_incremental_and_out_of_order(spark, tmp_path):
    import datetime as dt

    from quarry.streaming.upsert_stream import run_upsert_stream

    schema = "livro_id long, quantidade_nova long, data_entrega date, seq long"
    initial = spark.createDataFrame([(1, 12, dt.date(2025, 9, 1), 0), (2, 30, dt.date(2025, 9, 1), 0)],
                                    "livro_id long, quantidade_disponivel long, ultima_atualizacao date, seq long")
    src, root = str(tmp_path / "src"), str(tmp_path / "state")
    cols = {"quantidade_disponivel": "quantidade_nova", "ultima_atualizacao": "data_entrega", "seq": "seq"}
    spark.createDataFrame([(1, 8, dt.date(2025, 9, 3), 2), (6, 15, dt.date(2025, 9, 3), 2)], schema) \
        .write.mode("append").parquet(src)
    s1 = run_upsert_stream(spark, src, spark.createDataFrame([], schema).schema, initial, root, "livro_id", cols, "seq")
    assert {r.livro_id: r.quantidade_disponivel for r in s1.collect()} == {1: 8, 2: 30, 6: 15}
    # an older delivery arrives late: it must not overwrite newer values, but adds new keys
    spark.createDataFrame([(1, 99, dt.date(2025, 9, 2), 1), (7, 40, dt.date(2025, 9, 2), 1)], schema) \
        .write.mode("append").parquet(src)
    s2 = run_upsert_stream(spark, src, spark.createDataFrame([], schema).schema, initial, root, "livro_id", cols, "seq")
    assert {r.livro_id: r.quantidade_disponivel for r in s2.collect()} == {1: 8, 2: 30, 6: 15, 7: 40}
    # nothing new: same table
    s3 = run_upsert_stream(spark, src, spark.createDataFrame([], schema).schema, initial, root, "livro_id", cols, "seq")
    assert sorted(s3.collect()) == sorted(s2.collect())


def test_audit_stream_incremental(spark, tmp_path):
    from quarry.streaming.audit_stream import run_audit_stream

    schema = "id long, nome string, op string, seq long"
    src, root = str(tmp_path / "src"), str(tmp_path / "audit")
    spark.createDataFrame([(1, "A", "LOAD", 0), (2, "B", "LOAD", 0)], schema).write.mode("append").parquet(src)
    feed = spark.createDataFrame([], schema).schema
    a1 = run_audit_stream(spark, src, feed, root, "id", ["nome"], "seq", "op")
    assert a1.count() == 0
    spark.createDataFrame([(99, "Teste", "UPSERT", 1), (1, "A", "UPSERT", 1)], schema).write.mode("append").parquet(src)
    spark.createDataFrame([(99, "Teste 2", "UPSERT", 2), (2, None, "DELETE", 2)], schema) \
        .write.mode("append").parquet(src)
    a2 = run_audit_stream(spark, src, feed, root, "id", ["nome"], "seq", "op")
    got = sorted((r.id, r._op, r.old_nome, r.new_nome) for r in a2.collect())
    assert got == [(2, "DELETE", "B", None), (99, "INSERT", None, "Teste"), (99, "UPDATE", "Teste", "Teste 2")]


def test_audit_does_not_depend_on_batching(spark, tmp_path):
    import random

    from quarry.streaming.audit_stream import run_audit_stream

    schema = "id long, nome string, op string, seq long"
    feed = spark.createDataFrame([], schema).schema
    rng = random.Random(3)
    rows = [(i, f"n{i}", "LOAD", 0) for i in range(5)]
    for s in range(1, 40):
        rows.append((rng.randrange(7), rng.choice(["a", "b", None]), rng.choice(["UPSERT", "UPSERT", "DELETE"]), s))
    state, want = {}, []
    for i, nome, op, s in rows:
        old = state.get(i)
        if op == "DELETE":
            if old is not None:
                want.append((i, "DELETE", s, old[0], None))
            state.pop(i, None)
        else:
            if op == "UPSERT" and old != (nome,):
                want.append((i, "UPDATE" if old else "INSERT", s, old[0] if old else None, nome))
            state[i] = (nome,)
    for per_file, per_trigger in ((len(rows), None), (15, 1)):
        shuffled = rows[:]
        rng.shuffle(shuffled)
        src = str(tmp_path / f"src{per_file}")
        for k in range(0, len(rows), per_file):
            spark.createDataFrame(shuffled[k:k + per_file], schema).coalesce(1).write.mode("append").parquet(src)
        a = run_audit_stream(spark, src, feed, str(tmp_path / f"out{per_file}"), "id", ["nome"], "seq", "op", per_trigger)
        assert sorted(((r.id, r._op, r.seq, r.old_nome, r.new_nome) for r in a.collect()), key=str) == sorted(want, key=str)


def _feed(spark, src, rows, schema="id long, valor long, op string, seq long"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    return spark.createDataFrame([], schema).schema


def _walk(rows):
    """Audit of the changes one by one, in the order of seq."""
    state, out = {}, []
    for i, v, op, s in sorted(set(rows), key=lambda r: r[3]):
        old = state.get(i)
        if op == "DELETE":
            if old is not None:
                out.append((i, "DELETE", s, old[0], None))
            state.pop(i, None)
        else:
            if op == "UPSERT" and old != (v,):
                out.append((i, "UPDATE" if old else "INSERT", s, old[0] if old else None, v))
            state[i] = (v,)
    return sorted(out, key=str)


def _audited(df):
    return sorted(((r.id, r._op, r.seq, r.old_valor, r.new_valor) for r in df.collect()), key=str)


def test_audit_stream_restarts_from_its_checkpoint(spark, tmp_path):
    """Each call is a new query on the same checkpoint: it reads the new files only and goes on
    from the stored state; late changes correct verdicts that were given before."""
    from quarry.streaming.audit_stream import audit_log, run_audit_stream

    src, root = str(tmp_path / "src"), str(tmp_path / "audit")
    big = 2 ** 53 + 1
    deliveries = [
        [(1, 10, "LOAD", 0), (2, None, "LOAD", 0), (3, big, "LOAD", 0)],
        [(1, 11, "UPSERT", 5), (2, None, "UPSERT", 5), (3, big + 1, "UPSERT", 5), (4, 1, "UPSERT", 5)],
        [(1, 12, "UPSERT", 3), (2, 7, "UPSERT", 3), (4, None, "DELETE", 6), (3, None, "DELETE", 4)],   # 3 and 4 come late
        [(1, 11, "UPSERT", 4), (1, 11, "UPSERT", 5), (4, 9, "UPSERT", 8)],                             # a repeat, and late again
    ]
    seen = []
    for d in deliveries:
        schema = _feed(spark, src, d)
        seen += d
        got = run_audit_stream(spark, src, schema, root, "id", ["valor"], "seq", "op", late_by=10)
        assert _audited(got) == _walk(seen)
    log = spark.createDataFrame(seen, schema)
    assert _audited(got) == _audited(audit_log(log, "id", ["valor"], "seq", "op"))
    assert _audited(run_audit_stream(spark, src, schema, root, "id", ["valor"], "seq", "op", late_by=10)) == _walk(seen)


def test_audit_stream_work_follows_the_batch(spark, tmp_path):
    """A small batch after a large one touches the state of its own keys only, and writes only their rows."""
    from quarry.streaming.audit_stream import run_audit_stream

    src, root = str(tmp_path / "src"), str(tmp_path / "audit")
    schema = _feed(spark, src, [(i, i, "LOAD", 0) for i in range(300)])
    run_audit_stream(spark, src, schema, root, "id", ["valor"], "seq", "op", late_by=2)
    files = set((tmp_path / "audit" / "audit").glob("*.parquet"))
    _feed(spark, src, [(7, 70, "UPSERT", 1), (8, 80, "UPSERT", 1)])
    got = run_audit_stream(spark, src, schema, root, "id", ["valor"], "seq", "op", late_by=2)
    assert _audited(got) == [(7, "UPDATE", 1, 7, 70), (8, "UPDATE", 1, 8, 80)]
    new = [str(f) for f in set((tmp_path / "audit" / "audit").glob("*.parquet")) - files]
    assert spark.read.parquet(*new).count() == 2
    import json
    commits = sorted((tmp_path / "audit" / "_checkpoint" / "offsets").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(commits) == 2 and json.loads(commits[-1].read_text().splitlines()[-1])["logOffset"] == 1


def test_audit_stream_reports_what_comes_too_late(spark, tmp_path):
    from quarry.streaming.audit_stream import read_audit, run_audit_stream

    src, root = str(tmp_path / "src"), str(tmp_path / "audit")
    schema = _feed(spark, src, [(1, 1, "UPSERT", 1), (1, 2, "UPSERT", 10), (None, 5, "UPSERT", 1)])
    run_audit_stream(spark, src, schema, root, "id", ["valor"], "seq", "op", late_by=3)
    _feed(spark, src, [(1, 3, "UPSERT", 0), (1, 1, "UPSERT", 1), (1, 9, "UPSERT", 12), (1, 4, "UPSERT", 11)])
    got = run_audit_stream(spark, src, schema, root, "id", ["valor"], "seq", "op", late_by=3)
    assert _audited(got) == sorted([(1, "INSERT", 1, None, 1), (1, "UPDATE", 10, 1, 2), (1, "UPDATE", 11, 2, 4),
                                    (1, "UPDATE", 12, 4, 9), (None, "INSERT", 1, None, 5)], key=str)
    late = read_audit(spark, root, schema, "id", ["valor"], "seq", "op", late=True).collect()
    assert [(r.id, r.op, r.valor, r.seq) for r in late] == [(1, "UPSERT", 3, 0)]


def test_upsert_stream_compaction(spark, tmp_path):
    import datetime as dt

    from quarry.streaming.upsert_stream import compact, current_state, run_upsert_stream

    schema = "livro_id long, quantidade_nova long, data_entrega date, seq long"
    initial = spark.createDataFrame([(1, 12, dt.date(2025, 9, 1), 0)],
                                    "livro_id long, quantidade_disponivel long, ultima_atualizacao date, seq long")
    cols = {"quantidade_disponivel": "quantidade_nova", "ultima_atualizacao": "data_entrega", "seq": "seq"}
    src, root = str(tmp_path / "src"), str(tmp_path / "state")
    spark.createDataFrame([(1, 8, dt.date(2025, 9, 3), 1), (5, 3, dt.date(2025, 9, 3), 1)], schema) \
        .write.mode("append").parquet(src)
    s = run_upsert_stream(spark, src, spark.createDataFrame([], schema).schema, initial, root, "livro_id", cols, "seq")
    snap = compact(spark, initial, root, "livro_id", cols, "seq", str(tmp_path / "snapshot"))
    assert sorted(snap.collect()) == sorted(s.collect())
    assert sorted(current_state(spark, snap, str(tmp_path / "empty"), "livro_id", cols, "seq").collect()) == \
        sorted(s.collect())
