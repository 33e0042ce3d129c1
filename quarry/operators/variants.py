"""Documents whose fields differ from one to the next (A6, B17, K11), as VARIANT.

No schema names the fields: a document is parsed once into Spark's VARIANT type,
read by path and type, and changed with the update operators of a document
store ($set, $unset, $inc, $push), all as column expressions. Stored as
shredded Parquet (``write_documents``) the common fields are columns of their
own, so that a filter on a path reads these columns and reaches the scan.

Paths are lists of field names. A field of another type than asked for reads as
NULL; a text that is no JSON gives a NULL document, which no update changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHRED = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


def parse(text: Column) -> Column:
    """JSON text as VARIANT; NULL if it is not JSON."""
    return F.try_parse_json(text)


def _json_path(path: list[str]) -> str:
    """The path grammar has no escapes: a name is quoted by the mark that it does not hold."""
    if any("'" in p and '"' in p for p in path):
        raise ValueError(f"a field name with both kinds of quotes has no path: {path}")
    return "$" + "".join(f'["{p}"]' if "'" in p else f"['{p}']" for p in path)


def get(doc: Column, path: list[str], kind: str) -> Column:
    """The field as ``kind``; NULL if it is missing, null or of another kind."""
    return F.try_variant_get(doc, _json_path(path), kind)


def has(doc: Column, path: list[str]) -> Column:
    """Whether the document has the field (a JSON null counts as there)."""
    return get(doc, path, "variant").isNotNull()


def fields(doc: Column) -> Column:
    """Sorted names of the document's fields; NULL if it is not an object."""
    return F.sort_array(F.map_keys(_object(doc)))


def _object(doc: Column) -> Column:
    return F.try_variant_get(doc, "$", "map<string,variant>")


def _kind(doc: Column) -> Column:
    return F.schema_of_variant(doc)


def _change(doc: Column, path: list[str], new: Callable[[Column], Column]) -> Column:
    """``doc`` with the field at ``path`` replaced by ``new`` of its old value
    (NULL if missing). Missing objects on the way are made; a value on the way
    that is no object is left as it is, and so is the document then."""
    name, rest = path[0], path[1:]
    inner = _object(doc)
    old = F.try_element_at(inner, F.lit(name))
    value = _change(old, rest, new) if rest else new(old)
    others = F.map_filter(inner, lambda k, _: k != F.lit(name))
    with_it = F.to_variant_object(F.map_concat(others, F.create_map(F.lit(name), value)))
    fresh = _change(F.lit(None).cast("variant"), rest, new) if rest else new(F.lit(None).cast("variant"))
    made = F.to_variant_object(F.create_map(F.lit(name), fresh))
    return F.when(doc.isNull(), made).when(inner.isNotNull(), with_it).otherwise(doc)


def _on(doc: Column, changed: Column, where: Column | None) -> Column:
    keep = doc.isNull() if where is None else doc.isNull() | ~F.coalesce(where, F.lit(False))
    return F.when(keep, doc).otherwise(changed)


def set_field(doc: Column, path: list[str], value: Column, where: Column | None = None) -> Column:
    """$set: the field takes ``value``; it and the objects around it are made if missing."""
    return _on(doc, _change(doc, path, lambda _: value.cast("variant")), where)


def inc_field(doc: Column, path: list[str], by: int, where: Column | None = None) -> Column:
    """$inc by a whole number: a missing field starts at zero, integers stay
    integers; a value that is no number is left as it is."""
    def add(old: Column) -> Column:
        kind = _kind(old)
        return (F.when(old.isNull(), F.lit(by).cast("long").cast("variant"))
                .when(kind == "BIGINT", (F.try_variant_get(old, "$", "bigint") + by).cast("variant"))
                .when(kind.startswith("DECIMAL"), (F.try_variant_get(old, "$", "decimal(32,10)") + by).cast("variant"))
                .when(kind.isin("DOUBLE", "FLOAT"), (F.try_variant_get(old, "$", "double") + by).cast("variant"))
                .otherwise(old))
    return _on(doc, _change(doc, path, add), where)


def push_field(doc: Column, path: list[str], value: Column, where: Column | None = None) -> Column:
    """$push: appends to an array; a missing field becomes one; another value is left as it is."""
    def add(old: Column) -> Column:
        items = F.try_variant_get(old, "$", "array<variant>")
        one = F.array(value.cast("variant"))
        return F.when(old.isNull(), F.to_variant_object(one)).when(
            items.isNotNull(), F.to_variant_object(F.concat(items, one))).otherwise(old)
    return _on(doc, _change(doc, path, add), where)


def unset_field(doc: Column, path: list[str], where: Column | None = None) -> Column:
    """$unset: the field goes; what is not there stays away."""
    inner = _object(doc)
    if len(path) == 1:
        gone = F.to_variant_object(F.map_filter(inner, lambda k, _: k != F.lit(path[0])))
        there = F.map_contains_key(inner, F.lit(path[0]))
    else:
        gone = _change(doc, path[:1], lambda old: unset_field(old, path[1:]))
        there = has(doc, path[:1])
    return _on(doc, F.when(inner.isNotNull() & F.coalesce(there, F.lit(False)), gone).otherwise(doc), where)


def write_documents(docs: DataFrame, path: str) -> None:
    """Parquet with shredded VARIANT columns: fields that are common get typed columns."""
    conf = docs.sparkSession.conf
    before = {k: conf.get(k, None) for k in _SHRED}
    for k, v in _SHRED.items():
        conf.set(k, v)
    try:
        docs.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def read_documents(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    return spark.read.schema(docs.schema).parquet(path)
