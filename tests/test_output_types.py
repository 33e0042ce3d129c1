"""The operators' own types of the columns that leave the contract as text or doubles."""

from __spark_entry__ import SQL_OUTPUT_CASTS
from quarry.plans import all_queries

SF = "/root/testdata/sf0.001"
OWN = {
    "filter_is_null": {"o_orderkey": "bigint"}, "join_left": {"o_orderkey": "bigint"}, "join_right": {"o_orderkey": "bigint"},
    "join_full": {"o_orderkey": "bigint"}, "null_nullif": {"nation_or_null": "int"}, "doc_update": {"em_promocao": "boolean"},
    "doc_update_old_values": {"tamanho_anterior": "int"},
}


def test_nullable_integers_and_booleans_keep_their_type_inside(spark):
    cast = {k: set(v) for k, v in SQL_OUTPUT_CASTS.items() if "VARCHAR" in v.values()}
    assert cast == {k: set(v) for k, v in OWN.items()}
    for key, columns in OWN.items():
        types = dict(all_queries()[key](spark, SF).dtypes)
        assert {c: types[c] for c in columns} == columns, key


def test_dates_and_money_keep_their_type_inside(spark):
    for key, columns in SQL_OUTPUT_CASTS.items():
        if key in OWN or key in ("stream_upsert",):
            continue
        types = dict(all_queries()[key](spark, SF).dtypes)
        for c, out in columns.items():
            assert types[c].startswith({"TIMESTAMP": "date", "DOUBLE": "decimal"}[out]), (key, c, types[c])
