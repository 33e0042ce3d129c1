"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A row's key (its text: equal texts share a place) hashes to a place on a ring;
it belongs to the next virtual node clockwise. Each shard has room for its even
share of rows only; what overflows a full shard continues clockwise. With rooms
of floor or ceiling of rows / shards the counts of two shards differ by at most
one, and a row moves only when its own or a preceding shard fills otherwise.

Spark does the work per row; the driver plans on counts per arc (the stretch of
the ring that belongs to one virtual node): shards * nodes numbers, whatever
the corpus. Within an arc, rows are ordered by place, then id; the plan gives
each stretch of that order to a shard. One global range sort by (arc, place,
id) makes the order, so a text that holds a third of all rows is spread over
many tasks and, beyond a shard's room, over many shards.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, text_or_empty

RING = 1 << 32


def ring_points(n_shards: int, nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise."""
    def place(shard: int, node: int) -> int:
        return int.from_bytes(hashlib.sha256(f"shard {shard} node {node}".encode()).digest()[:4], "big")

    return sorted((place(s, v), s) for s in range(n_shards) for v in range(nodes))


def arc_of(place: Column, points: list[tuple[int, int]]) -> Column:
    """Index of the first point at or after the place (0 past the last one):
    a binary search written as a comparison tree, so it stays one expression."""
    places = [p for p, _ in points]

    def search(low: int, high: int) -> str:
        # index in [low, high] of the first point >= place, high meaning none before
        if low == high:
            return str(low % len(places))
        mid = (low + high) // 2
        return f"IF(place <= {places[mid]}L, {search(low, mid)}, {search(mid + 1, high)})"

    step = 64   # a tree per 64 points keeps each expression small
    table = F.when(place > places[-1], F.lit(0))
    for at in range(0, len(places), step):
        last = min(at + step, len(places)) - 1
        table = table.when(place <= places[last], F.expr(search(at, last)))
    return table.cast("int")


def plan_ring(counts: dict[int, int], points: list[tuple[int, int]], n_shards: int
              ) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) from the rows per arc.

    Every arc first fills its own shard's room, clockwise; then, arc by arc,
    the overflow continues clockwise to the next shards with room.
    """
    total = sum(counts.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    used = [0] * n_shards
    out, left = [], []

    def give(arc: int, first: int, n: int, shard: int) -> int:
        take = min(n, room[shard] - used[shard])
        if take:
            out.append((arc, first, first + take, shard, used[shard]))
            used[shard] += take
        return take

    for arc in sorted(counts):
        took = give(arc, 0, counts[arc], points[arc][1])
        if took < counts[arc]:
            left.append((arc, took, counts[arc] - took))
    free = sorted({i for i, (_, s) in enumerate(points) if used[s] < room[s]})
    for arc, first, n in left:
        while n:
            at = bisect.bisect_left(free, arc) % len(free)
            shard = points[free[at]][1]
            took = give(arc, first, n, shard)
            first, n = first + took, n - took
            if used[shard] == room[shard]:
                free = [i for i in free if points[i][1] != shard]
    return out


def shard_rows(docs: DataFrame, n_shards: int = 24, nodes: int = 64, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null).

    One row per input row; size is the text's UTF-8 bytes plus 8, a null text
    counting as empty; slots number the rows of a shard from 0 without gaps.
    Repeated rows are rows of their own (which copy gets which slot is open,
    the copies being equal); a null id sorts first; an empty table gives an
    empty result; other columns are not read.
    """
    spark = docs.sparkSession
    points = ring_points(n_shards, nodes)
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hash"))
    placed = rows.withColumn("place", F.col("hash").bitwiseAND(RING - 1))
    placed = placed.withColumn("arc", arc_of(F.col("place"), points))
    # the order of every arc: position in its sorted partition, written once
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(n, "arc", "place", "hash", "doc_id").sortWithinPartitions(
        "arc", "place", "hash", "doc_id")
    ordered = materialise(ordered.withColumn("id", F.monotonically_increasing_id()), "ring")
    part, at = F.shiftright("id", 33).cast("int"), F.col("id").bitwiseAND((1 << 33) - 1)
    ordered = ordered.select("*", part.alias("part"), at.alias("at"))
    # rows and first position of each arc in each sorted partition: at most
    # arcs + partitions numbers, as an arc spans neighbouring partitions
    pieces = ordered.groupBy("part", "arc").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).collect()
    counts: dict[int, int] = {}
    base = []
    for r in sorted(pieces, key=lambda r: (r["part"], r["arc"])):
        # rank in the arc = position - first position here + rows in earlier partitions
        base.append((r["part"], r["arc"], counts.get(r["arc"], 0) - r["first"]))
        counts[r["arc"]] = counts.get(r["arc"], 0) + r["n"]
    long = T.LongType()
    schema = lambda *names: T.StructType([T.StructField(x, long) for x in names])
    base_df = spark.createDataFrame(base, schema("part", "arc", "shift"))
    plan_df = spark.createDataFrame(plan_ring(counts, points, n_shards),
                                    schema("arc", "first_rank", "end_rank", "shard", "first_slot"))
    # both tables are bounded by ring size and partition count
    ranked = ordered.join(F.broadcast(base_df), ["part", "arc"]).withColumn("rank", F.col("at") + F.col("shift"))
    got = ranked.join(F.broadcast(plan_df), "arc").filter(
        (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
    return got.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
                      (F.col("rank") - F.col("first_rank") + F.col("first_slot")).alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
