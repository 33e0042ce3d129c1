"""Nested sale documents (header + item array) and their JSON source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.nested import nest

ITEM = T.StructType([
    T.StructField("id_livro", T.LongType()),
    T.StructField("linha", T.IntegerType()),
    T.StructField("quantidade", T.DoubleType()),
    T.StructField("preco_unit", T.DoubleType()),
])

SALE_DOC = T.StructType([
    T.StructField("_id", T.LongType()),
    T.StructField("id_cliente", T.LongType()),
    T.StructField("data_venda", T.TimestampNTZType()),
    T.StructField("forma_pagamento", T.StringType()),
    T.StructField("valor_total", T.DoubleType()),
    T.StructField("itens", T.ArrayType(ITEM)),
])


def sale_headers(orders: DataFrame) -> DataFrame:
    """The documents' own fields. o_orderpriority stands for the payment method."""
    return orders.select(F.col("o_orderkey").alias("_id"), F.col("o_custkey").alias("id_cliente"),
                         F.col("o_orderdate").alias("data_venda"),
                         F.col("o_orderpriority").alias("forma_pagamento"),
                         F.col("o_totalprice").alias("valor_total"))


def sale_documents(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders + lineitem -> one document per sale with its item array; unit
    price is extendedprice / quantity rounded to cents."""
    items = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                            F.round(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0)), 2).alias("unit"))
    docs = nest(sale_headers(orders), "_id", items, "l_orderkey",
                [("l_partkey", "id_livro"), ("l_linenumber", "linha"), ("l_quantity", "quantidade"),
                 ("unit", "preco_unit")], "itens")
    return docs.select([f.name for f in SALE_DOC.fields])


NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def write_json(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").option("timestampNTZFormat", NTZ_FORMAT).json(path)


def read_sale_documents(spark: SparkSession, path: str) -> DataFrame:
    """Nested source read with an explicit schema: fields missing in a
    document come back as NULL, no inference pass over the files."""
    return spark.read.schema(SALE_DOC).option("timestampNTZFormat", NTZ_FORMAT).json(path)
