"""NULL traps, quantified comparisons, audit, bank, integrity, documents, graph."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import history as O
from quarry.operators import quality as M
from quarry.operators.domain import transfer_batch
from quarry.operators.relational import not_in, quantified


def test_not_in_with_null(spark):
    outer = spark.createDataFrame([(1,)], "x int")
    assert not_in(outer, "x", spark.createDataFrame([(2,), (None,)], "y int"), "y").count() == 0
    assert not_in(outer, "x", spark.createDataFrame([(2,)], "y int"), "y").count() == 1
    # empty set keeps every row, even a NULL key
    o2 = spark.createDataFrame([(1,), (None,)], "x int")
    assert not_in(o2, "x", spark.createDataFrame([], "y int"), "y").count() == 2
    assert not_in(o2, "x", spark.createDataFrame([(5,)], "y int"), "y").count() == 1


def _q(spark, xs, s, op, qn):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    sub = spark.createDataFrame([(v,) for v in s], "s double")
    return sorted(r.x for r in quantified(df, "x", sub, "s", op, qn).collect())


def test_quantified_rules(spark):
    assert _q(spark, [0.5, 1.5, 3.0], [1.0, 2.0], ">", "ANY") == [1.5, 3.0]
    assert _q(spark, [0.5, 1.5, 3.0], [1.0, 2.0], ">", "ALL") == [3.0]
    assert _q(spark, [0.5, 3.0], [], ">", "ANY") == []
    assert _q(spark, [0.5, 3.0], [], ">", "ALL") == [0.5, 3.0]
    # NULL in the set: ANY can still be TRUE, ALL can only be FALSE or NULL
    assert _q(spark, [0.5, 3.0], [1.0, None], ">", "ANY") == [3.0]
    assert _q(spark, [0.5, 3.0], [1.0, None], ">", "ALL") == []


def test_audit_three_rows(spark):
    schema = "id int, nome string"
    s0 = spark.createDataFrame([], schema)
    s1 = spark.createDataFrame([(99, "Teste Trigger")], schema)
    s2 = spark.createDataFrame([(99, "Teste Trigger Atualizado")], schema)
    rows = []
    for a, b in ((s0, s1), (s1, s2), (s2, s0)):
        rows += [(r._op, r.old_nome, r.new_nome) for r in O.audit_diff(a, b, "id", ["nome"]).collect()]
    assert rows == [("INSERT", None, "Teste Trigger"), ("UPDATE", "Teste Trigger", "Teste Trigger Atualizado"),
                    ("DELETE", "Teste Trigger Atualizado", None)]


def test_as_of_drops_deletes(spark):
    log = spark.createDataFrame([
        (1, dt.datetime(2024, 1, 1), 10, "INSERT", 1.0), (2, dt.datetime(2024, 1, 2), 10, "UPDATE", 2.0),
        (3, dt.datetime(2024, 1, 3), 10, "DELETE", None), (4, dt.datetime(2024, 1, 1), 20, "INSERT", 5.0)],
        "eid long, ts timestamp_ntz, k long, op string, v double")
    at = {r.k: r.v for r in O.as_of(log, "k", "ts", "eid", "op", ["v"], "2024-01-02 12:00:00").collect()}
    assert at == {10: 2.0, 20: 5.0}
    end = {r.k: r.v for r in O.as_of(log, "k", "ts", "eid", "op", ["v"], "2024-02-01 00:00:00").collect()}
    assert end == {20: 5.0}


def test_bank_transfer(spark):
    acc = spark.createDataFrame([(1, 1000.0), (2, 500.0)], "id long, saldo double")
    ok = transfer_batch(acc, "id", "saldo", spark.createDataFrame([(1, 2, 200.0)], "a long, b long, v double"),
                        "a", "b", "v")
    assert {r.id: (r.saldo, r.batch_status) for r in ok.collect()} == {1: (800.0, "COMMITTED"),
                                                                       2: (700.0, "COMMITTED")}
    bad = transfer_batch(acc, "id", "saldo", spark.createDataFrame([(1, 2, 5000.0)], "a long, b long, v double"),
                         "a", "b", "v")
    assert {r.id: (r.saldo, r.batch_status) for r in bad.collect()} == {1: (1000.0, "ROLLED_BACK"),
                                                                        2: (500.0, "ROLLED_BACK")}


def test_deferred_fk_same_batch(spark):
    teachers = spark.createDataFrame([(1,)], "professor_id int")
    batch_teachers = spark.createDataFrame([(999,)], "professor_id int")
    classes = spark.createDataFrame([(99, 999)], "turma_id int, professor_id int")
    assert M.orphans(classes, ["professor_id"], teachers, ["professor_id"]).count() == 1
    assert M.orphans(classes, ["professor_id"], teachers.unionByName(batch_teachers), ["professor_id"]).count() == 0


def test_cross_column_rule(spark):
    t = spark.createDataFrame([(1, dt.date(2026, 12, 1), dt.date(2026, 1, 1)), (2, dt.date(2026, 1, 1), None)],
                              "id int, ini date, fim date")
    v = M.violations(t, {"datas": F.col("fim") >= F.col("ini")}, ["id"]).collect()
    assert [(r.id, r.rule) for r in v] == [(1, "datas")]


def test_reject_reasons(spark):
    b = spark.createDataFrame([(1, "Tecnologia", 10.0, 1), (1, "Dup", 10.0, 1), (7, "Livro", -10.0, 2),
                               (8, "Ok", 5.0, 0)], "id int, nome string, preco double, estoque int")
    out = M.split_good_rejected(b, "id", {"P0001": F.col("preco") <= 0, "P0002": F.col("estoque") < 0}, "-20001")
    got = sorted((r.id, r.nome, tuple(r.reasons), r.status) for r in out.collect())
    assert got == [(1, "Dup", ("-20001",), "REJECTED"), (1, "Tecnologia", ("-20001",), "REJECTED"),
                   (7, "Livro", ("P0001",), "REJECTED"), (8, "Ok", (), "ACCEPTED")]


def test_documents(spark):
    from quarry.operators.documents import delete_many, inc_field, set_fields

    livros = spark.createDataFrame([(1, 120.0, "fisico", 2019), (2, 45.0, "fisico", 2015), (3, 35.5, "digital", 2021),
                                    (4, 55.0, "fisico", 1998), (5, 89.9, "digital", 2022), (6, 75.0, "digital", 2026)],
                                   "_id long, preco double, tipo string, ano int")
    assert [r._id for r in livros.filter(F.col("preco") > 100).collect()] == [1]
    d = set_fields(livros, F.col("_id") == 3, {"preco": F.lit(31.95), "em_promocao": F.lit(True)})
    d = inc_field(d, F.col("tipo") == "fisico", "preco", 5.00)
    d = delete_many(d, F.col("ano") < 2000)
    got = {r._id: (r.preco, r.em_promocao) for r in d.collect()}
    assert got == {1: (125.0, None), 2: (50.0, None), 3: (31.95, True), 5: (89.9, None), 6: (75.0, None)}


def test_graph(spark):
    from quarry.operators import graph as G

    nodes = spark.createDataFrame([
        ("A1", "Autor", "Paula Sousa", None), ("A2", "Autor", "John Marshall", None),
        ("A3", "Autor", "Aiko Tanaka", None), ("C1", "Categoria", "Tecnologia", None),
        ("C2", "Categoria", "Ficcao", None), ("L1", "Livro", "Java", 120.0), ("L2", "Livro", "SQL", 45.0),
        ("L3", "Livro", "Romance", 35.5), ("L5", "Livro", "Rust", 89.9)], "id string, label string, name string, price double")
    edges = spark.createDataFrame([
        ("A1", "L1", "ESCREVEU"), ("A1", "L2", "ESCREVEU"), ("A2", "L3", "ESCREVEU"), ("A2", "L5", "ESCREVEU"),
        ("L1", "C1", "PERTENCE_A"), ("L2", "C1", "PERTENCE_A"), ("L3", "C2", "PERTENCE_A"),
        ("L5", "C1", "PERTENCE_A")], "src string, dst string, type string")
    hop = G.one_hop(nodes, edges, "Autor", "ESCREVEU", "Livro").filter(F.col("a_name") == "John Marshall")
    assert sorted((r.b_id, r.b_price) for r in hop.collect()) == [("L3", 35.5), ("L5", 89.9)]
    shared = G.shared_neighbours(nodes, edges, "Autor", "Paula Sousa", "ESCREVEU", "PERTENCE_A").collect()
    assert [(r.autor, r.categoria_em_comum) for r in shared] == [("John Marshall", "Tecnologia")]
    left = G.delete_edges(edges, spark.createDataFrame([("A1", "L2", "ESCREVEU")], edges.schema))
    assert sorted(r.dst for r in left.filter(F.col("src") == "A1").collect()) == ["L1"]
    assert nodes.filter(F.col("id") == "L2").count() == 1


def test_restrict_and_cascade(spark):
    parents = spark.createDataFrame([(1,), (2,)], "pk int")
    kids = spark.createDataFrame([(10, 1)], "ck int, fk int")
    out = {r.pk: r.outcome for r in M.restrict_delete(parents, "pk", kids, "fk").collect()}
    assert out == {1: "BLOCKED", 2: "DELETED"}
    gone = M.cascade_delete(parents.filter(F.col("pk") == 1), "pk", [(kids, "ck", "fk")])
    assert [g.count() for g in gone] == [1, 1]


def test_outer_join_matches_native(spark):
    from quarry.operators.relational import outer_join

    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, "d")], "k int, x string")
    b = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 99)], "kk int, y int")
    for how in ("left", "right", "full"):
        got = sorted(outer_join(a, b, "k", "kk", how).collect(), key=repr)
        want = sorted(a.join(b, a.k == b.kk, how).select("k", "x", "kk", "y").collect(), key=repr)
        assert got == want, how


def test_light_stem_and_stemmed_match(spark):
    from quarry.functions.text import light_stem
    from quarry.operators.textsearch import match_all

    words = ["cabecas", "dores", "limoes", "papeis", "homens", "dor", "gas", "vezes", "animais"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.s for r in df.select(light_stem(F.col("w")).alias("s")).collect()]
    assert got == ["cabeca", "dor", "limao", "papel", "homem", "dor", "gas", "vez", "animal"]
    docs = spark.createDataFrame([(1, "Paciente relata dor de cabeca recorrente."),
                                  (2, "Relata dores e cabecas!"), (3, "Sem queixas.")], "id int, t string")
    assert sorted(r.id for r in match_all(docs, "t", ["dor", "cabeca"]).collect()) == [1]
    assert sorted(r.id for r in match_all(docs, "t", ["dores", "cabeca"], stem=True).collect()) == [1, 2]


def test_partition_upkeep(spark, tmp_path):
    import datetime as dt

    from quarry.operators import layout as N
    from quarry.sources.writers import read_partitioned, write_partitioned, year_range_partition

    rows = [(i, dt.datetime(1995 + i % 8, 1 + i % 12, 1)) for i in range(200)]
    o = spark.createDataFrame(rows, "k long, d timestamp_ntz").withColumn("p", year_range_partition("d", 1996, 2000))
    path, schema = str(tmp_path / "t"), "k bigint, d timestamp_ntz, p string"
    write_partitioned(o, path, "p", ["d", "k"])
    assert read_partitioned(spark, path, schema).count() == 200
    N.add_partition(spark.createDataFrame([(999, dt.datetime(2030, 1, 1))], "k long, d timestamp_ntz")
                    .withColumn("p", year_range_partition("d", 1996, 2000)), path, "p", ["d", "k"])
    futuro = read_partitioned(spark, path, schema).filter(F.col("p") == "futuro").count()
    gone = N.detach_partition(spark, path, "p", "futuro", str(tmp_path / "archive" / "futuro"))
    assert gone.count() == futuro and read_partitioned(spark, path, schema).filter(F.col("p") == "futuro").count() == 0
    N.drop_partitions(spark, path, "p", ["ate_1996"])
    N.merge_partitions(spark, path, "p", ["1997", "1998"], "1997_1998", schema, ["d", "k"])
    left = {r.p: r["count"] for r in read_partitioned(spark, path, schema).groupBy("p").count().collect()}
    seen = N.prune_by_date(read_partitioned(spark, path, schema), "d", "p", "1997-03-01", "1998-02-01",
                           N.partition_labels(spark, path, "p"))
    assert {r.k for r in seen.collect()} == {k for k, d in rows if dt.datetime(1997, 3, 1) <= d <= dt.datetime(1998, 2, 1)}
    assert set(left) == {"1997_1998", "1999", "2000"}
    assert sum(left.values()) + gone.count() + sum(1 for k, d in rows if d.year <= 1996) == 201


def test_nested_json_roundtrip_keeps_micros(spark, tmp_path):
    from quarry.sources.documents import SALE_DOC, read_sale_documents, write_json

    import datetime as dt

    ts = dt.datetime(2025, 8, 10, 10, 15, 0, 123456)
    doc = spark.createDataFrame([(1, 1, ts, "cartao", 165.0, [(1, 1, 1.0, 120.0), (2, 2, 1.0, 45.0)])], SALE_DOC)
    write_json(doc, str(tmp_path / "d"))
    back = read_sale_documents(spark, str(tmp_path / "d")).first()
    assert back.data_venda == ts and [i.id_livro for i in back.itens] == [1, 2]


def test_nest_is_one_document_per_key(spark):
    from quarry.operators.nested import nest, unnest

    parent = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    child = spark.createDataFrame([(1, i, float(i)) for i in range(10_001)] + [(2, 7, 5.0)] * 50, "k long, n int, q double")
    docs = nest(parent, "k", child, "k", [("n", "n"), ("q", "q")], "items")
    assert {r.k: r.n for r in docs.select("k", F.size("items").alias("n")).collect()} == {1: 10_001, 2: 50, 3: 0}
    flat = sorted((r.k, r.n, r.q) for r in unnest(docs, ["k"], "items").collect())
    assert flat == sorted((r.k, r.n, r.q) for r in child.collect())


def test_update_sees_the_old_row(spark):
    from quarry.operators.change import update
    from quarry.operators.documents import set_fields

    df = spark.createDataFrame([(10, 0), (3, 0), (None, 0)], "x int, y int")
    new = {"x": F.lit(0), "y": F.col("x") + 1}
    assert sorted(map(tuple, update(df, F.col("x") > 5, new).collect()), key=str) == [(0, 11), (3, 0), (None, 0)]
    d = set_fields(df, F.col("x") > 5, {"x": F.lit(0), "z": F.col("x")})
    assert {(r.x, r.z) for r in d.collect()} == {(0, 10), (3, None), (None, None)}


def test_defaults_leave_explicit_nulls(spark, tmp_path):
    from pyspark.sql import types as T

    from quarry.operators.layout import fill_defaults, read_with_added_column

    old = spark.createDataFrame([(1,)], "k int")
    path = str(tmp_path / "t")
    old.write.parquet(path)
    spark.createDataFrame([(2, None), (3, "X")], "k int, ativo string").write.mode("append").parquet(path)
    got = read_with_added_column(spark, path, old.schema, "ativo", T.StringType(), "'S'")
    assert {(r.k, r.ativo) for r in got.collect()} == {(1, "S"), (2, None), (3, "X")}
    filled = fill_defaults(spark.createDataFrame([(1, None)], "k int, s string"), {"s": F.lit("P"), "n": F.lit(0)})
    assert filled.first() == (1, None, 0)


def test_exact_average_above_two_to_the_53(spark):
    from quarry.functions.scalars import avg_money

    df = spark.createDataFrame([(9007199254740993, 1), (-5, 2), (5, 2), (1, 3), (None, 1)], "c long, n long")
    got = [None if r[0] is None else str(r[0]) for r in df.select(avg_money("c", "n")).collect()]
    assert got == ["90071992547409.93", "-0.03", "0.03", "0.00", None]


def test_months_between_truncates_toward_zero(spark):
    from quarry.functions.scalars import months_between_whole

    rows = [("2020-01-15", "2020-02-10", 0), ("2020-02-10", "2020-01-15", 0), ("2020-01-10", "2020-02-10", -1),
            ("2020-01-10", "2020-03-15", -2), ("2020-03-15", "2020-01-10", 2)]
    df = spark.createDataFrame(rows, "e string, s string, want int")
    assert all(r[0] == r[1] for r in df.select(months_between_whole("e", "s"), "want").collect())


def test_first_return_of_a_loan_counts(spark):
    import datetime as dt

    from quarry.operators.domain import loan_return

    day = dt.date(2025, 1, 15)
    loans = spark.createDataFrame([(1, day, None, None)], "id int, data_prevista date, data_devolucao date, multa decimal(10,2)")
    back = spark.createDataFrame([(1, day + dt.timedelta(5)), (1, day + dt.timedelta(2))], "id int, rd date")
    (r,) = loan_return(loans, back, "id", "rd").collect()
    assert r.data_devolucao == day + dt.timedelta(2) and str(r.multa) == "4.00"


def test_query_terms_agree_on_both_paths(spark):
    from quarry.operators import textsearch as Q

    df = spark.createDataFrame([(1, "The erin"), (2, "erin's red\\E book"), (3, "thing")], "doc_id int, text string")
    post = Q.postings(df, "doc_id", "text")
    for terms, want in ((["the", "erin"], {1, 2}), (["the"], set()), (["red book"], {2}), (["E"], set()), ([".*"], set())):
        assert {r.doc_id for r in Q.match_all(df, "text", terms).collect()} == want, terms
        assert {r.doc_id for r in Q.search(post, terms).collect()} == want, terms
    assert {r.doc_id for r in Q.match_all(df, "text", ["books", "reds"], stem=True).collect()} == {2}


def test_shared_neighbours_label_and_namesakes(spark):
    from quarry.operators.graph import set_property, shared_neighbours

    nodes = spark.createDataFrame([("A1", "Autor", "Ana"), ("A2", "Autor", "Ana"), ("X", "Outro", "Ana"), ("A3", "Autor", "Bia"),
                                   ("L1", "Livro", "l1"), ("L2", "Livro", "l2"), ("L3", "Livro", "l3"), ("C1", "Cat", "c1"),
                                   ("C2", "Cat", "c2")], "id string, label string, name string")
    edges = spark.createDataFrame([("A1", "L1", "W"), ("A2", "L2", "W"), ("X", "L3", "W"), ("A3", "L3", "W"), ("L1", "C1", "IN"),
                                   ("L2", "C1", "IN"), ("L3", "C2", "IN")], "src string, dst string, type string")
    got = sorted(map(tuple, shared_neighbours(nodes, edges, "Autor", "Ana", "W", "IN").collect()))
    assert got == [("Ana", "c1")]   # the namesake counts, the other label is no anchor
    named = set_property(nodes, edges.filter("src = 'A1'"), "src", {"name": F.lit("Eva")})
    assert {r.id: r.name for r in named.collect()}["A1"] == "Eva" and named.filter("name = 'Ana'").count() == 2


def test_shared_folder_is_needed_on_a_cluster():
    import pytest

    from quarry.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
