"""Property graph as two DataFrames: ``nodes(id, label, name, price)`` and
``edges(src, dst, type)``. Pattern matches are joins on the edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def node_id(label: str, key) -> F.Column:
    return F.concat(F.lit(f"{label}:"), F.col(key).cast("string") if isinstance(key, str) else key.cast("string"))


def build_graph(lineitem: DataFrame, supplier: DataFrame, part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """supplier -SUPPLIES-> part -IN-> brand (category)."""
    sup_nodes = supplier.select(node_id("S", "s_suppkey").alias("id"), F.lit("Supplier").alias("label"),
                                F.col("s_name").alias("name"), F.lit(None).cast("double").alias("price"))
    part_nodes = part.select(node_id("P", "p_partkey").alias("id"), F.lit("Part").alias("label"),
                             F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    cat_nodes = part.select("p_brand").distinct().select(
        node_id("B", "p_brand").alias("id"), F.lit("Category").alias("label"),
        F.col("p_brand").alias("name"), F.lit(None).cast("double").alias("price"))
    nodes = sup_nodes.unionByName(part_nodes).unionByName(cat_nodes)
    supplies = lineitem.select("l_suppkey", "l_partkey").distinct().select(
        node_id("S", "l_suppkey").alias("src"), node_id("P", "l_partkey").alias("dst"),
        F.lit("SUPPLIES").alias("type"))
    belongs = part.select(node_id("P", "p_partkey").alias("src"), node_id("B", "p_brand").alias("dst"),
                          F.lit("IN").alias("type"))
    return nodes, supplies.unionByName(belongs)


def one_hop(nodes: DataFrame, edges: DataFrame, src_label: str, edge_type: str, dst_label: str) -> DataFrame:
    """MATCH (a:src_label)-[:edge_type]->(b:dst_label) RETURN a, b."""
    a = nodes.filter(F.col("label") == src_label).select(F.col("id").alias("a_id"), F.col("name").alias("a_name"))
    b = nodes.filter(F.col("label") == dst_label).select(F.col("id").alias("b_id"), F.col("name").alias("b_name"),
                                                         F.col("price").alias("b_price"))
    e = edges.filter(F.col("type") == edge_type)
    return (e.join(a, e.src == a.a_id).join(b, F.col("dst") == b.b_id)
            .select("a_id", "a_name", "b_id", "b_name", "b_price"))


def shared_neighbours(nodes: DataFrame, edges: DataFrame, label: str, anchor_name: str, first: str,
                      second: str) -> DataFrame:
    """MATCH (a1:label {name})-[:first]->()-[:second]->(c)<-[:second]-()<-[:first]-(a2)
    WHERE a1 <> a2 RETURN DISTINCT a2.name, c.name.

    Walked from the anchors: their edges, their categories (distinct pairs),
    then back to the authors. Only the anchor node itself is excluded, so a
    namesake counts; several anchors of one name each give their own pairs. A
    pair (anchor, category) is carried once, and authors are made distinct
    before the names are looked up, so no all-pairs product is formed."""
    e1 = edges.filter(F.col("type") == first).select(F.col("src").alias("author"), F.col("dst").alias("mid"))
    e2 = edges.filter(F.col("type") == second).select(F.col("src").alias("mid"), F.col("dst").alias("cat"))
    anchor = nodes.filter((F.col("label") == label) & (F.col("name") == anchor_name)).select(
        F.col("id").alias("anchor"))
    cats = (e1.join(anchor, F.col("author") == F.col("anchor")).select("anchor", "mid").distinct()
            .join(e2, "mid").select("anchor", "cat").distinct())
    back = cats.join(e2, "cat").select("anchor", "cat", "mid").join(e1, "mid")
    others = back.filter(F.col("author") != F.col("anchor")).select("author", "cat").distinct()
    names = nodes.select(F.col("id").alias("nid"), F.col("name").alias("nname"))
    out = (others.join(names, others.author == names.nid).select(F.col("nname").alias("autor"), "cat")
           .join(names, F.col("cat") == names.nid)
           .select("autor", F.col("nname").alias("categoria_em_comum")))
    return out.distinct()


def set_property(nodes: DataFrame, matched: DataFrame, id_col: str, values: dict) -> DataFrame:
    """SET n.p = v on the matched nodes; values are computed on the old node."""
    from .change import update_from

    return update_from(nodes, "id", matched, id_col, values)


def delete_edges(edges: DataFrame, doomed: DataFrame) -> DataFrame:
    """DELETE r: drop matching edges (anti join); nodes are untouched."""
    return edges.join(doomed, ["src", "dst", "type"], "left_anti")
