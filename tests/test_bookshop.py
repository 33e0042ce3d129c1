"""Hand-traced bookshop cases (FIXTURES section 2)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry.functions.scalars import money
from quarry.operators import change as K


@pytest.fixture()
def books(spark):
    rows = [(1, "Java", "Tecnologia", 120.00, "F", 2019), (2, "SQL", "Tecnologia", 45.00, "F", 2015),
            (3, "Romance", "Ficcao", 35.50, "D", 2021), (4, "Oriente", "Ficcao", 55.00, "F", 1998),
            (5, "Rust", "Tecnologia", 89.90, "D", 2022), (6, "Contos", "Ficcao", 29.90, "D", 2020),
            (7, "BD Essencial", "Tecnologia", 99.00, "F", 2023)]
    return spark.createDataFrame(rows, "livro_id long, titulo string, genero string, preco double, tipo string, ano int")


def _stock(spark, rows):
    return spark.createDataFrame([(k, q, dt.date(2025, 9, 1)) for k, q in rows],
                                 "livro_id long, quantidade_disponivel long, ultima_atualizacao date")


def _staging(spark, rows, day=dt.date(2025, 9, 15)):
    return spark.createDataFrame([(k, q, day) for k, q in rows], "livro_id long, quantidade_nova long, d date")


SET = {"quantidade_disponivel": "quantidade_nova", "ultima_atualizacao": "d"}


def _state(df):
    return {r["livro_id"]: r["quantidade_disponivel"] for r in df.collect()}


def test_discount_exact(books):
    got = [r[0] for r in books.orderBy("livro_id").select(
        F.round(money("preco") * F.lit(0.9).cast("decimal(2,1)"), 2)).collect()]
    assert got == [Decimal(x) for x in ("108.00", "40.50", "31.95", "49.50", "80.91", "26.91", "89.10")]


def test_filters(books):
    ids = lambda df: sorted(r.livro_id for r in df.collect())
    assert ids(books.filter(F.col("tipo") == "D")) == [3, 5, 6]
    assert ids(books.filter(F.col("preco") > 50)) == [1, 4, 5, 7]
    assert ids(books.filter((F.col("genero") == "Tecnologia") & F.col("preco").between(40, 100))) == [2, 5, 7]
    assert ids(books.filter(F.col("titulo").like("%SQL%"))) == ids(books.filter(F.col("titulo").ilike("%sql%"))) == [2]


def test_update_physical_books(books):
    new = F.round(money("preco") * F.lit(1.10).cast("decimal(3,2)"), 2).cast("double")
    out = K.update(books, F.col("tipo") == "F", {"preco": new})
    got = {r.livro_id: r.preco for r in out.collect()}
    assert got == {1: 132.00, 2: 49.50, 3: 35.50, 4: 60.50, 5: 89.90, 6: 29.90, 7: 108.90}


def test_delete_null_condition_keeps_row(spark):
    df = spark.createDataFrame([(1, 1990), (2, None), (3, 1980)], "id int, ano int")
    assert sorted(r.id for r in K.delete(df, F.col("ano") < 1985).collect()) == [1, 2]


def test_delete_old_books_none(books):
    assert K.delete(books, F.col("ano") < 1990).count() == 7


def test_delete_zero_stock_without_sales(spark):
    stock = _stock(spark, [(1, 12), (2, 30), (3, 5), (4, 0)])
    sales = spark.createDataFrame([(1,), (2,), (3,), (5,), (7,)], "livro_id long")
    out = K.delete_unless_exists(stock, "livro_id", F.col("quantidade_disponivel") == 0, sales, "livro_id")
    assert sorted(_state(out)) == [1, 2, 3]


def test_upsert_pg(spark):
    stock = _stock(spark, [(1, 12), (2, 30), (3, 5)])
    out = K.upsert(stock, _staging(spark, [(1, 8), (3, 20), (6, 15), (7, 40)]), "livro_id", SET)
    assert _state(out) == {1: 8, 2: 30, 3: 20, 6: 15, 7: 40}
    actions = {r.livro_id: r._action for r in out.collect()}
    assert actions == {1: "update", 2: "unchanged", 3: "update", 6: "insert", 7: "insert"}
    dates = {r.livro_id: r.ultima_atualizacao for r in out.collect()}
    assert dates[2] == dt.date(2025, 9, 1) and dates[6] == dt.date(2025, 9, 15)


def test_upsert_oracle_keeps_4(spark):
    stock = _stock(spark, [(1, 12), (2, 30), (3, 5), (4, 0)])
    out = K.upsert(stock, _staging(spark, [(1, 8), (3, 20), (6, 15), (7, 40)]), "livro_id", SET)
    assert _state(out) == {1: 8, 2: 30, 3: 20, 4: 0, 6: 15, 7: 40}


def test_upsert_idempotent(spark):
    stock = _stock(spark, [(1, 12), (2, 30), (3, 5)])
    src = _staging(spark, [(1, 8), (3, 20), (6, 15)])
    once = K.upsert(stock, src, "livro_id", SET).drop("_action")
    twice = K.upsert(once, src, "livro_id", SET).drop("_action")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert_duplicate_source_fails(spark):
    stock = _stock(spark, [(1, 12)])
    with pytest.raises(Exception, match="duplicate or NULL source key"):
        K.upsert(stock, _staging(spark, [(1, 8), (1, 9)]), "livro_id", SET).collect()


def test_insert_ignore(spark):
    stock = _stock(spark, [(1, 12), (2, 30)])
    src = spark.createDataFrame([(1, 999, dt.date(2025, 9, 15))], stock.schema)
    assert _state(K.insert_ignore(stock, src, "livro_id")) == {1: 12, 2: 30}


def test_guarded_upsert_inserts_absent_key(spark):
    stock = _stock(spark, [(1, 12), (2, 30)])
    out = K.upsert(stock, _staging(spark, [(5, 0), (1, 0)]), "livro_id", SET,
                   update_when=F.col("src_quantidade_nova") > 0)
    assert _state(out) == {1: 12, 2: 30, 5: 0}


def test_merge_delete_only_updated_rows(spark):
    stock = _stock(spark, [(1, 12), (2, 30)])
    out = K.upsert(stock, _staging(spark, [(5, 0), (1, 0)]), "livro_id", SET,
                   delete_when=F.col("quantidade_disponivel") == 0)
    assert _state(out) == {2: 30, 5: 0}


def test_update_case(spark):
    v = spark.createDataFrame([(1, "Cartao"), (2, "Boleto"), (3, "Pix")], "id int, forma string")
    c = F.col("forma")
    out = K.update(v, F.lit(True), {"forma": F.when(c == "Boleto", "Boleto Bancario").otherwise(c)})
    assert {r.id: r.forma for r in out.collect()}[2] == "Boleto Bancario"


def test_month_end_and_add_month(spark):
    d = spark.createDataFrame([(dt.date(2025, 8, 10),), (dt.date(2025, 8, 12),), (dt.date(2025, 9, 1),)], "d date")
    r = d.select(F.last_day("d").alias("e"), F.add_months("d", 1).alias("m")).collect()
    assert [x.e for x in r] == [dt.date(2025, 8, 31), dt.date(2025, 8, 31), dt.date(2025, 9, 30)]
    assert [x.m for x in r] == [dt.date(2025, 9, 10), dt.date(2025, 9, 12), dt.date(2025, 10, 1)]


def test_orders_procedures(spark):
    """Order total 149.70, stock value of a category, empty-month summary."""
    from quarry.operators.aggregates import month_summary, stock_value_of

    items = spark.createDataFrame([(1001, 49.90, 3)], "pedido_id long, preco double, qtd long")
    total = items.agg(F.sum(money("preco") * F.col("qtd")).alias("t")).first().t
    assert total == Decimal("149.70")
    livros = spark.createDataFrame([("Tecnologia", 99.0, 10), ("Tecnologia", 50.5, 1), ("Ficcao", 10.0, 3)],
                                   "cat string, preco double, estoque long")
    assert stock_value_of(livros, "cat", "preco", "estoque", "Tecnologia").first().stock_value == 1040.5
    assert stock_value_of(livros, "cat", "preco", "estoque", "Nada").first().stock_value is None
    orders = spark.createDataFrame([(dt.datetime(2025, 1, 5), 10.0)], "d timestamp_ntz, v double")
    r = month_summary(orders, "d", "v", 2025, 2).first()
    assert (r.n_orders, r.avg_value) == (0, 0.0)


def test_sum_to(spark):
    from quarry.functions.sqlfuncs import register_sum_to

    register_sum_to(spark)
    assert spark.sql("SELECT sum_to(5) AS s, sum_to(0) AS z").first() == (15, 0)


def test_titles_of_category_ordered(spark):
    from quarry.operators.aggregates import ordered_distinct_list

    livros = spark.createDataFrame([(1, "PL/pgSQL na Pratica"), (1, "Banco de Dados Essencial"), (2, "Romance")],
                                   "categoria_id int, titulo string")
    got = {r.categoria_id: r.titulos for r in ordered_distinct_list(livros, ["categoria_id"], "titulo", ", ",
                                                                     "titulos").collect()}
    assert got[1] == "Banco de Dados Essencial, PL/pgSQL na Pratica"


def test_volume_classes_differ_only_at_zero(spark):
    from quarry.operators.aggregates import volume_classes

    df = spark.createDataFrame([(0,), (5,), (10,), (20,), (21,)], "n int")
    got = [(r.n, r.class_if, r.class_case) for r in volume_classes(df, "n").orderBy("n").collect()]
    assert got == [(0, "BAIXO", "SEM PEDIDOS"), (5, "BAIXO", "BAIXO"), (10, "MEDIO", "MEDIO"),
                   (20, "MEDIO", "MEDIO"), (21, "ALTO", "ALTO")]


def test_scalar_count_is_zero_not_null(spark):
    from __spark_entry__ import queries

    r = queries()["scalar_subquery"](spark, "/root/testdata/sf0.001")
    assert r.filter(F.col("n_urgent").isNull()).count() == 0
    assert r.filter(F.col("n_urgent") == 0).count() > 0


def test_rowcounts(spark, books):
    got = {r._action: r.n_rows for r in K.action_counts(K.tag_update(books, F.col("tipo") == "F")).collect()}
    assert got == {"update": 4, "unchanged": 3}
    got = {r._action: r.n_rows for r in K.action_counts(K.tag_delete(books, F.col("ano") < 1990)).collect()}
    assert got == {"unchanged": 7}
