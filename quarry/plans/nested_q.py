"""J: nested data and normalisation; document (B17, C18, D13, K11) and
graph (C19, C20, K12) operations."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dependencies as D
from ..operators import graph as G
from ..operators import nested as N
from ..operators import variants as V
from ..operators.relational import broadcast_small
from ..session import scratch_path
from ..sources import tables
from ..sources.documents import sale_documents, sale_headers
from ..sources.writers import stage
from .registry import query

ANCHOR_SUPPLIER = "Supplier#000000007"


def _docs(spark, sf_dir):
    t = tables(spark, sf_dir)
    return sale_documents(t.orders, t.lineitem)


def _headers(spark, sf_dir):
    """The documents' own fields; no query of them needs the item arrays."""
    return sale_headers(tables(spark, sf_dir).orders)


@query("nest_items", sql="""
SELECT o.o_orderkey AS _id, COUNT(l.l_orderkey) AS n_itens,
       COALESCE(string_agg(CAST(l.l_partkey AS VARCHAR), ',' ORDER BY l.l_partkey, l.l_linenumber, l.l_quantity), '')
         AS item_keys
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey
""")
def nest_items(spark, sf_dir):
    """One sale = header + sorted item array, one document per sale."""
    d = _docs(spark, sf_dir)
    return d.select("_id", F.size("itens").cast("long").alias("n_itens"),
                    F.array_join(F.transform("itens", lambda x: x["id_livro"].cast("string")), ",").alias("item_keys"))


@query("normalize_1nf", sql="""
SELECT l_orderkey AS _id, l_partkey AS id_livro, l_linenumber AS linha, l_quantity AS quantidade FROM lineitem
""")
def normalize_1nf(spark, sf_dir):
    """Remove the repeating group: explode the item array back to rows."""
    flat = N.unnest(_docs(spark, sf_dir), ["_id"], "itens")
    return flat.select("_id", "id_livro", "linha", "quantidade")


def _wide(spark, sf_dir):
    """The un-normalised enrolment-like row: line + order + customer + nation + part."""
    t = tables(spark, sf_dir)
    l = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    p = t.part.select("p_partkey", "p_name", "p_brand")
    return (l.join(o, l.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
            .join(broadcast_small(n), F.col("c_nationkey") == n.n_nationkey)
            .join(p, F.col("l_partkey") == p.p_partkey))


WIDE_SQL = """(SELECT l.l_orderkey, l.l_partkey, l.l_quantity, o.o_custkey, c.c_name, c.c_nationkey, n.n_name,
        p.p_name, p.p_brand
 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
 JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN part p ON p.p_partkey = l.l_partkey) w"""


@query("normalize_2nf", sql=f"SELECT DISTINCT l_partkey, p_name, p_brand FROM {WIDE_SQL}")
def normalize_2nf(spark, sf_dir):
    """Attributes that depend on part of the key (the item) move to their
    own relation: distinct projection of the wide row."""
    return N.project_distinct(_wide(spark, sf_dir), ["l_partkey", "p_name", "p_brand"])


@query("normalize_3nf", sql=f"""
SELECT c_nationkey, n_name, COUNT(DISTINCT n_name) OVER (PARTITION BY c_nationkey) AS n_variants
FROM (SELECT DISTINCT c_nationkey, n_name FROM {WIDE_SQL}) x
""")
def normalize_3nf(spark, sf_dir):
    """The transitive dependency customer -> nation -> name moves to a
    nation relation; one row per determinant is asserted (n_variants = 1)."""
    rel = N.project_distinct(_wide(spark, sf_dir), ["c_nationkey", "n_name"])
    check = rel.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_variants"))
    return rel.join(check, "c_nationkey")


@query("normalize_bcnf", sql=f"""
WITH orig AS (SELECT DISTINCT l_orderkey, l_partkey, p_brand FROM {WIDE_SQL}),
     a AS (SELECT DISTINCT l_orderkey, l_partkey FROM orig),
     b AS (SELECT DISTINCT l_partkey, p_brand FROM orig),
     rj AS (SELECT DISTINCT a.l_orderkey, a.l_partkey, b.p_brand FROM a JOIN b USING (l_partkey))
SELECT (SELECT COUNT(*) FROM orig) AS n_input, (SELECT COUNT(*) FROM rj) AS n_rejoined,
       (SELECT COUNT(*) FROM (SELECT * FROM orig EXCEPT SELECT * FROM rj)) = 0
   AND (SELECT COUNT(*) FROM (SELECT * FROM rj EXCEPT SELECT * FROM orig)) = 0 AS lossless
""")
def normalize_bcnf(spark, sf_dir):
    """Decomposition into (order, item) and (item, brand) with the
    lossless-join check (re-join equals the input)."""
    w = _wide(spark, sf_dir).select("l_orderkey", "l_partkey", "p_brand")
    return N.lossless_check(w, ["l_orderkey", "l_partkey"], ["l_partkey", "p_brand"], ["l_partkey"])


WIDE_COLS = ["l_orderkey", "l_partkey", "l_quantity", "o_custkey", "c_name", "c_nationkey", "n_name", "p_name", "p_brand"]


def _distinct_counts_sql(max_size: int) -> str:
    """One row (mask, size, n) per set of at most ``max_size`` columns of the wide
    row: a bit mask and the number of distinct value combinations."""
    rows = []
    for size in range(1, max_size + 1):
        for s in combinations(range(len(WIDE_COLS)), size):
            names = ", ".join(WIDE_COLS[i] for i in s)
            rows.append(f"SELECT {sum(1 << i for i in s)} AS mask, {size} AS size, "
                        f"(SELECT COUNT(*) FROM (SELECT DISTINCT {names} FROM w)) AS n")
    return " UNION ALL ".join(rows)


# every determinant of one or two columns against every column, minimal ones kept
FD_SQL = f"""
WITH w AS MATERIALIZED (SELECT * FROM {WIDE_SQL}), c AS MATERIALIZED ({_distinct_counts_sql(3)}),
cols AS (SELECT * FROM (VALUES {", ".join(f"({1 << i}, '{c}')" for i, c in enumerate(WIDE_COLS))}) v(bit, name)),
fd AS (SELECT x.mask, x.size, a.bit, a.name FROM c x JOIN cols a ON (x.mask & a.bit) = 0
       JOIN c xa ON xa.mask = (x.mask | a.bit) AND xa.n = x.n WHERE x.size <= 2)
SELECT (SELECT string_agg(k.name, ',' ORDER BY k.name) FROM cols k WHERE (k.bit & f.mask) <> 0) AS determinant,
       f.name AS dependent
FROM fd f WHERE NOT EXISTS (SELECT 1 FROM fd g WHERE g.bit = f.bit AND g.mask <> f.mask AND (g.mask & f.mask) = g.mask)
"""


@query("fd_discover", sql=FD_SQL)
def fd_discover(spark, sf_dir):
    """All minimal dependencies of the wide row with one or two
    determining columns, found level by level."""
    found = D.discover(_wide(spark, sf_dir).select(WIDE_COLS), max_lhs=2)
    rows = [(",".join(sorted(d.lhs)), d.rhs) for d in found]
    return spark.createDataFrame(rows, "determinant string, dependent string")


@query("normalize_synthesis", sql=f"""
WITH w AS MATERIALIZED (SELECT * FROM {WIDE_SQL})
SELECT 'c_name,n_name,o_custkey' AS relation, COUNT(*) AS n_rows FROM (SELECT DISTINCT c_name, n_name, o_custkey FROM w)
UNION ALL SELECT 'c_nationkey,n_name', COUNT(*) FROM (SELECT DISTINCT c_nationkey, n_name FROM w)
UNION ALL SELECT 'l_orderkey,l_partkey,l_quantity', COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_partkey, l_quantity FROM w)
UNION ALL SELECT 'l_orderkey,o_custkey', COUNT(*) FROM (SELECT DISTINCT l_orderkey, o_custkey FROM w)
UNION ALL SELECT 'l_partkey,p_brand,p_name', COUNT(*) FROM (SELECT DISTINCT l_partkey, p_brand, p_name FROM w)
""")
def normalize_synthesis(spark, sf_dir):
    """Third normal form of the wide row from the dependencies found in
    it: the relations and their rows."""
    w = _wide(spark, sf_dir).select(WIDE_COLS)
    _, w = stage(w, "wide")   # read by the search and once per relation
    relations = D.synthesize_3nf(WIDE_COLS, D.discover(w, max_lhs=2, stored=True))
    out = [w.select(*sorted(r)).distinct().agg(F.count(F.lit(1)).alias("n_rows"))
           .select(F.lit(",".join(sorted(r))).alias("relation"), "n_rows") for r in relations]
    return reduce(DataFrame.unionByName, out)


@query("normalize_rejoin", sql=f"""
SELECT form, n AS n_input, n AS n_rejoined, true AS lossless
FROM (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM {WIDE_SQL})) x, (VALUES ('3NF'), ('BCNF')) f(form)
""")
def normalize_rejoin(spark, sf_dir):
    """The relations of both normal forms, joined again, are the wide rows."""
    w = _wide(spark, sf_dir).select(WIDE_COLS)
    _, w = stage(w, "wide")
    fds = D.discover(w, max_lhs=2, stored=True)
    forms = {"3NF": D.synthesize_3nf(WIDE_COLS, fds), "BCNF": D.decompose_bcnf(WIDE_COLS, fds)}
    made: dict = {}   # distinct rows, and relations that both forms have
    out = [D.rejoin_counts(w, r, made).withColumn("form", F.lit(f)) for f, r in forms.items()]
    return reduce(DataFrame.unionByName, out).select("form", "n_input", "n_rejoined", "lossless")


@query("fd_check", sql="""
SELECT p_name, COUNT(DISTINCT p_type) AS n_variants FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_type) > 1
""")
def fd_check(spark, sf_dir):
    """Test the functional dependency name -> type; lists violations."""
    return N.fd_violations(tables(spark, sf_dir).part, ["p_name"], ["p_type"])


@query("multivalue_child", sql="""
SELECT p_partkey, CAST(pos AS INTEGER) AS pos, word
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word,
             generate_subscripts(string_split(p_name, ' '), 1) - 1 AS pos FROM part)
""")
def multivalue_child(spark, sf_dir):
    """A multi-valued attribute (the words of the name) becomes a child
    table keyed by (parent, position)."""
    p = tables(spark, sf_dir).part
    return p.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "word"))


@query("composite_flatten", sql="""
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k FROM events
""")
def composite_flatten(spark, sf_dir):
    """A composite attribute (JSON object) flattened to columns with an
    explicit struct schema."""
    e = tables(spark, sf_dir).events
    s = F.from_json("props", "k BIGINT")
    return e.select("event_id", "user_id", s["k"].alias("prop_k"))


@query("doc_find", sql="""
SELECT o.o_orderkey AS _id, o.o_custkey AS id_cliente, o.o_totalprice AS valor_total
FROM orders o
WHERE o.o_totalprice > 400000
  AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity >= 45)
""")
def doc_find(spark, sf_dir):
    """``find({valor_total: {$gt}, 'itens.quantidade': {$gte}}, projection)``:
    ANDed field filters, one on the item array, then a projection."""
    items = tables(spark, sf_dir).lineitem.filter(F.col("l_quantity") >= 45).select("l_orderkey")
    d = _headers(spark, sf_dir).filter(F.col("valor_total") > 400000)
    # the filter on the item array is a semi join on the flat child rows
    return d.join(items, d["_id"] == items["l_orderkey"], "left_semi").select("_id", "id_cliente", "valor_total")


@query("doc_lookup_unwind", sql="""
SELECT o.o_orderkey AS _id, c.c_name AS cliente, o.o_totalprice AS valor_total, o.o_orderpriority AS forma_pagamento
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
""")
def doc_lookup_unwind(spark, sf_dir):
    """$lookup + $unwind + $project as one inner join (no array built)."""
    d = _headers(spark, sf_dir).select("_id", "id_cliente", "valor_total", "forma_pagamento")
    c = tables(spark, sf_dir).customer.select("c_custkey", F.col("c_name").alias("cliente"))
    return N.lookup_unwind(d, "id_cliente", c, "c_custkey").select("_id", "cliente", "valor_total", "forma_pagamento")


@query("doc_group_count", sql="""
SELECT o_orderpriority AS forma_pagamento, COUNT(*) AS total_vendas FROM orders GROUP BY o_orderpriority
""")
def doc_group_count(spark, sf_dir):
    """``$group`` with ``$sum: 1``."""
    d = _headers(spark, sf_dir)
    return d.groupBy("forma_pagamento").agg(F.count(F.lit(1)).alias("total_vendas"))


@query("doc_update", sql="""
SELECT p_partkey AS _id,
       CASE WHEN p_partkey = 3 AND p_type = 'PROMO' THEN 36.95 WHEN p_partkey = 3 THEN 31.95
            WHEN p_type = 'PROMO' THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) + 5.00 AS DOUBLE)
            ELSE p_retailprice END AS preco,
       CASE WHEN p_partkey = 3 THEN TRUE END AS em_promocao
FROM part WHERE NOT (p_size < 3)
""")
def doc_update(spark, sf_dir):
    """``update_one($set)`` may add a field (NULL in the other
    documents), ``update_many($inc)``, then ``delete_many``."""
    from ..operators.documents import delete_many, inc_field, set_fields

    p = tables(spark, sf_dir).part.select(F.col("p_partkey").alias("_id"), F.col("p_retailprice").alias("preco"),
                                          "p_type", "p_size")
    p = set_fields(p, F.col("_id") == 3, {"preco": F.lit(31.95), "em_promocao": F.lit(True)})
    p = inc_field(p, F.col("p_type") == "PROMO", "preco", 5.00)  # after the $set, in source order
    p = delete_many(p, F.col("p_size") < 3)
    return p.select("_id", "preco", "em_promocao")


@query("doc_update_old_values", sql="""
SELECT p_partkey AS _id, CASE WHEN p_size > 25 THEN 0 ELSE p_size END AS tamanho,
       CASE WHEN p_size > 25 THEN p_size END AS tamanho_anterior
FROM part
""")
def doc_update_old_values(spark, sf_dir):
    """A $set of two fields whose filter and second value read the first:
    both see the old document."""
    from ..operators.documents import set_fields

    p = tables(spark, sf_dir).part.select(F.col("p_partkey").alias("_id"), F.col("p_size").alias("tamanho"))
    return set_fields(p, F.col("tamanho") > 25, {"tamanho": F.lit(0), "tamanho_anterior": F.col("tamanho")})


@query("graph_one_hop", sql="""
SELECT DISTINCT 'S:' || CAST(s.s_suppkey AS VARCHAR) AS a_id, s.s_name AS a_name,
       'P:' || CAST(p.p_partkey AS VARCHAR) AS b_id, p.p_name AS b_name, p.p_retailprice AS b_price
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN part p ON p.p_partkey = l.l_partkey
""")
def graph_one_hop(spark, sf_dir):
    """MATCH (a:Supplier)-[:SUPPLIES]->(p:Part) RETURN a, p."""
    t = tables(spark, sf_dir)
    nodes, edges = G.build_graph(t.lineitem, t.supplier, t.part)
    return G.one_hop(nodes, edges, "Supplier", "SUPPLIES", "Part")


@query("graph_shared_category", sql=f"""
WITH ac AS (SELECT DISTINCT l.l_suppkey AS s, p.p_brand AS b
            FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
     anchor AS (SELECT s_suppkey FROM supplier WHERE s_name = '{ANCHOR_SUPPLIER}')
SELECT DISTINCT s2.s_name AS autor, ac2.b AS categoria_em_comum
FROM ac ac1 JOIN anchor ON ac1.s = anchor.s_suppkey
JOIN ac ac2 ON ac2.b = ac1.b AND ac2.s <> ac1.s
JOIN supplier s2 ON s2.s_suppkey = ac2.s
""")
def graph_shared_category(spark, sf_dir):
    """C20: other suppliers sharing a category with the anchor, self excluded."""
    t = tables(spark, sf_dir)
    nodes, edges = G.build_graph(t.lineitem, t.supplier, t.part)
    return G.shared_neighbours(nodes, edges, "Supplier", ANCHOR_SUPPLIER, "SUPPLIES", "IN")


@query("graph_edge_delete", sql="""
SELECT DISTINCT 'S:' || CAST(l.l_suppkey AS VARCHAR) AS src, 'P:' || CAST(l.l_partkey AS VARCHAR) AS dst, 'SUPPLIES' AS type
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
WHERE NOT (l.l_suppkey = 7 AND p.p_brand = 'Brand#4')
""")
def graph_edge_delete(spark, sf_dir):
    """Delete the SUPPLIES edges of one supplier into one category;
    nodes stay."""
    t = tables(spark, sf_dir)
    nodes, edges = G.build_graph(t.lineitem, t.supplier, t.part)
    sup = edges.filter(F.col("type") == "SUPPLIES")
    cat = edges.filter((F.col("type") == "IN") & (F.col("dst") == "B:Brand#4")).select(F.col("src").alias("p"))
    doomed = (sup.filter(F.col("src") == "S:7").join(cat, F.col("dst") == F.col("p"), "left_semi"))
    return G.delete_edges(sup, doomed)


@query("graph_property_set", sql="""
SELECT 'P:' || CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
       CASE WHEN p_brand = 'Brand#4' THEN 9.99 ELSE p_retailprice END AS price
FROM part
""")
def graph_property_set(spark, sf_dir):
    """MATCH (p:Part)-[:IN]->(c {name}) SET p.price = 9.99: a property of
    the matched nodes only."""
    t = tables(spark, sf_dir)
    nodes, edges = G.build_graph(t.lineitem, t.supplier, t.part)
    cat = edges.filter((F.col("type") == "IN") & (F.col("dst") == "B:Brand#4")).select("src")
    out = G.set_property(nodes, cat, "src", {"price": F.lit(9.99)})
    return out.filter(F.col("label") == "Part").select("id", "name", "price")


def _event_documents(spark, sf_dir):
    """(id, doc): one document per event; which fields it has, and of which
    kind ``cliente`` is, depends on the event."""
    e = tables(spark, sf_dir).events
    kind = F.col("event_type")
    seen = kind.isin("view", "click")
    of = lambda on, c: F.when(on, c)
    common = [F.col("event_id").alias("_id")]
    buy = F.to_json(F.struct(*common, F.col("user_id").alias("cliente"), F.col("value").alias("preco"),
                             F.struct((F.col("event_id") % 9).alias("dias"), F.lit("casa").alias("local")).alias("entrega")))
    look = F.to_json(F.struct(*common, F.col("user_id").alias("cliente"), F.array(kind).alias("tags"),
                              F.struct((F.col("user_id") % 4).alias("visitas")).alias("contadores")))
    rest = F.to_json(F.struct(*common, F.col("user_id").cast("string").alias("cliente"), F.lit("web").alias("origem"),
                              of(kind == "error", F.lit("falha")).alias("motivo")))
    text = F.when(kind == "purchase", buy).when(seen, look).otherwise(rest)
    return e.select(F.col("event_id").alias("id"), V.parse(text).alias("doc"))


@query("doc_variant_filter", sql="""
SELECT event_id AS id, user_id AS cliente, value AS preco, event_id % 9 AS dias FROM events
WHERE event_type = 'purchase' AND event_id % 9 >= 5 AND value > 20
""")
def doc_variant_filter(spark, sf_dir):
    """B17 on fields that only some documents have: stored shredded, the two
    paths of the filter are read as columns."""
    docs = _event_documents(spark, sf_dir)
    path = scratch_path(spark, "documents")
    V.write_documents(docs, path)
    d = V.read_documents(spark, path, docs)
    doc = F.col("doc")
    return d.filter((V.get(doc, ["entrega", "dias"], "bigint") >= 5) & (V.get(doc, ["preco"], "double") > 20)).select(
        "id", V.get(doc, ["cliente"], "bigint").alias("cliente"), V.get(doc, ["preco"], "double").alias("preco"),
        V.get(doc, ["entrega", "dias"], "bigint").alias("dias"))


@query("doc_variant_update", sql="""
SELECT event_id AS id,
       CASE event_type WHEN 'purchase' THEN CASE WHEN value < 20 THEN '_id,cliente,em_promocao,entrega,preco' ELSE '_id,cliente,entrega,preco' END
         WHEN 'view' THEN '_id,cliente,contadores,tags' WHEN 'click' THEN '_id,cliente,contadores,tags'
         WHEN 'error' THEN '_id,cliente,contadores,motivo' ELSE '_id,cliente,contadores' END AS campos,
       CAST(CASE WHEN event_type = 'purchase' AND value < 20 THEN true END AS VARCHAR) AS em_promocao,
       CAST(CASE WHEN event_type IN ('view', 'click') THEN user_id % 4 + 2 WHEN event_type = 'purchase' THEN NULL ELSE 2 END AS VARCHAR) AS visitas,
       CASE WHEN event_type IN ('view', 'click') THEN event_type || '|visto' END AS tags,
       CAST(CASE WHEN event_type = 'purchase' THEN event_id % 9 + 1 END AS VARCHAR) AS dias
FROM events
""")
def doc_variant_update(spark, sf_dir):
    """K11 without a schema: $set of a new field, $inc of a nested field that
    may be missing, $push, $unset."""
    d = _event_documents(spark, sf_dir)
    doc = F.col("doc")
    steps = [
        lambda: V.set_field(doc, ["em_promocao"], F.lit(True), V.get(doc, ["preco"], "double") < 20),
        lambda: V.inc_field(doc, ["contadores", "visitas"], 2, ~V.has(doc, ["preco"])),
        lambda: V.inc_field(doc, ["entrega", "dias"], 1, V.has(doc, ["entrega"])),
        lambda: V.push_field(doc, ["tags"], F.lit("visto"), V.has(doc, ["tags"])),
        lambda: V.unset_field(doc, ["origem"]),
    ]
    for step in steps:
        d = d.withColumn("doc", step())
    return d.select("id", F.array_join(V.fields(doc), ",").alias("campos"),
                    V.get(doc, ["em_promocao"], "boolean").cast("string").alias("em_promocao"),
                    V.get(doc, ["contadores", "visitas"], "bigint").cast("string").alias("visitas"),
                    F.array_join(V.get(doc, ["tags"], "array<string>"), "|").alias("tags"),
                    V.get(doc, ["entrega", "dias"], "bigint").cast("string").alias("dias"))
