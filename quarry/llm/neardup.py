"""Near-duplicate groups by SetSketch registers.

A document's set of word shingles is sketched into registers: register i is
the exponentially spaced, truncated minimum of independent exponential draws of
the set's members, K_i = floor(1 - log_b(min)). Two sets' registers agree with
a probability close to their Jaccard similarity; sketches of parts merge by
their maximum. Bands of registers are buckets. Pairs that share a bucket are
estimated by the joint likelihood of their register comparisons, and those that
could reach the threshold are confirmed on the full sets.

Exactness and skew:

* Equal sets become one node first (their documents are linked anyway), so a
  group of copies costs one row.
* Within a bucket no pair list is made. In each round every bucket names up to
  2, 128, 8192, ... hubs of each of its 2, 128, 8192, ... largest components, and members
  of smaller components are compared with the hubs of larger ones. A member
  drops out of the pairing as soon as it is linked, so a large group of near
  copies costs a few comparisons per member. A bucket is done when its members
  are in one component or every pair across components has been compared, so no
  candidate link is lost.
* From the second round on, shingles that no other open node holds bound what a
  pair can share: with p and q private ones of n and m, the intersection is at
  most min(n - p, m - q) and the union at least max(n + q, m + p). Pairs that
  cannot be linked by that, or by their sizes, are not compared, and a node that
  can be linked with none leaves. The near copies of a text with a tenth of
  their shingles changed each are thus not held against each other.
* Every set has a parity vector (``parity_vector``): two sets differ in at least
  as many members as their vectors differ in bits. A pair of a bucket whose bits
  tell that it is out of reach is never made, whatever band it shares; of sets of
  a few hundred shingles nearly only pairs close to the threshold are left.
* Tables between rounds are written to the shared folder.

With ``BANDS`` = 32 bands of ``ROWS`` = 5 registers, a pair at similarity 0.8
shares no band with a probability of 2e-6, at 0.85 of 7e-9.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, worker_store

BANDS, ROWS = 32, 5
BASE = 1.02               # spacing of the register values
SHIFT = 256               # keeps the registers of tiny sets above zero
CHUNK = 16_384            # shingles sketched at once (fits a core's cache)
PARITY_WORDS = 8          # 64-bit words of a set's parity vector
KNOWN_WORDS = 500_000     # bound of each worker's word-hash table
LIKELIHOOD_SLACK = 14.0   # log-likelihood lost at the threshold before a pair is dropped

_U = np.uint64


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    A-Z is lower-cased; words are runs of bytes that are not ASCII space. A
    text of fewer words is one shingle; one without words has none.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(known.__getitem__, words), _U, len(words))
    n = min(size, len(h))
    acc = np.full(len(h) - n + 1, n, _U)
    for k in range(n):
        acc = _mix(acc * _U(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k])
    return np.unique(acc)


def _families(m: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_607)
    return rng.integers(0, 2**63, m, np.int64).astype(_U) * _U(2) + _U(1), rng.integers(0, 2**63, m, np.int64).astype(_U)


def sketch_sets(sets: list[np.ndarray], m: int = BANDS * ROWS) -> np.ndarray:
    """Registers (uint16) of non-empty sets, one row each."""
    out = np.empty((len(sets), m), np.uint16)
    mult, add = _families(m)
    at = 0
    while at < len(sets):
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= CHUNK):
            total += len(sets[end])
            end += 1
        lows = np.full((end - at, m), np.iinfo(_U).max, _U)
        if end == at + 1:   # a long set goes through in pieces
            for lo in range(0, total, CHUNK):
                x = sets[at][lo:lo + CHUNK]
                for i in range(m):
                    lows[0, i] = min(lows[0, i], (x * mult[i] + add[i]).min())
        else:
            x = np.concatenate(sets[at:end])
            starts = np.cumsum([0] + [len(s) for s in sets[at:end - 1]])
            buf = np.empty_like(x)
            for i in range(m):
                np.multiply(x, mult[i], out=buf)
                np.add(buf, add[i], out=buf)
                lows[:, i] = np.minimum.reduceat(buf, starts)
        draws = -np.log1p(-(lows.astype(np.float64) + 0.5) / 2.0**64 * (1 - 1e-16))
        k = np.floor(1 - np.log(draws) / np.log(BASE)) + SHIFT
        out[at:end] = np.clip(k, 0, 65535)
        at = end
    return out


def parity_vector(members: np.ndarray) -> np.ndarray:
    """One bit per slot: whether an odd number of members falls into it. Of two
    sets' vectors the bits that differ are at most the members that differ."""
    slots = 64 * PARITY_WORDS
    odd = np.bincount((members >> _U(7)).astype(np.int64) & (slots - 1), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def merge_sketches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def _spacing(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def joint_likelihood(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
                     grid: np.ndarray) -> np.ndarray:
    """Log-likelihood of each pair's register comparisons at each similarity of
    the grid (pairs x grid); impossible similarities get minus infinity."""
    m = regs_a.shape[1]
    above = (regs_a > regs_b).sum(1)[:, None]
    below = (regs_a < regs_b).sum(1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.minimum(grid[None, :], np.minimum(u / v, v / u))
    p_above = _spacing(np.maximum(u - v * j, 0))
    p_below = _spacing(np.maximum(v - u * j, 0))
    tiny = 1e-12
    logs = (above * np.log(np.maximum(p_above, tiny)) + below * np.log(np.maximum(p_below, tiny))
            + (m - above - below) * np.log(np.maximum(1 - p_above - p_below, tiny)))
    return np.where(grid[None, :] <= np.minimum(u / v, v / u) + 1e-9, logs, -np.inf)


def estimate_similarity(regs_a, regs_b, n_a, n_b) -> np.ndarray:
    grid = np.linspace(0, 1, 201)
    return grid[np.argmax(joint_likelihood(regs_a, regs_b, n_a, n_b, grid), 1)]


def could_reach(regs_a, regs_b, n_a, n_b, threshold: float) -> np.ndarray:
    """Whether some similarity at or above the threshold is nearly as likely as
    the best one: a loss over LIKELIHOOD_SLACK is a deviation beyond five
    standard errors."""
    grid = np.unique(np.append(np.linspace(0, 1, 101), threshold))
    logs = joint_likelihood(regs_a, regs_b, n_a, n_b, grid)
    return logs[:, grid >= threshold].max(1) >= logs.max(1) - LIKELIHOOD_SLACK


def _known_words() -> WordHashes:
    store = worker_store("neardup")
    if "word-hashes" not in store:
        store["word-hashes"] = WordHashes()
    return store["word-hashes"]


def _batches_of(batch, rows: int = 256):
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def sketch_documents(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, registers, parity) per row; digest (128 bits
    of the set), registers and parity vector are null for an empty set. Row-wise,
    no shuffle."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = _known_words()
        for big in batches:
            for b in _batches_of(big):
                sets = [shingle_set(v.as_py(), size, known) for v in b.column(1)]
                full = [i for i, s in enumerate(sets) if len(s)]
                regs = sketch_sets([sets[i] for i in full])
                digests: list = [None] * len(sets)
                packed: list = [None] * len(sets)
                parity: list = [None] * len(sets)
                for row, i in enumerate(full):
                    parity[i] = parity_vector(sets[i])
                    digests[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    packed[i] = regs[row].astype(">u2").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(packed, pa.binary()), pa.array(parity, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "digest", "registers", "parity"])

    src = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    return src.mapInArrow(run, "doc_id long, n_shingles long, digest binary, registers binary, parity array<long>")


def _bucket_rows(nodes: DataFrame) -> DataFrame:
    """(bucket, nid, n): one row per node and band."""
    width = 2 * ROWS
    keys = [F.xxhash64(F.lit(band), F.substring("registers", 1 + band * width, width)) for band in range(BANDS)]
    return nodes.select("nid", F.col("n_shingles").alias("n"), F.explode(F.array(*keys)).alias("bucket"))


def _sets_of(docs: DataFrame, nodes: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(nid, members) of the given nodes, from the text of each node's first
    document; of documents that share an id the right one is told by digest."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = _known_words()
        for big in batches:
            for b in _batches_of(big):
                nids, sets = [], []
                for nid, digest, text in zip(b.column(0), b.column(1), b.column(2)):
                    s = shingle_set(text.as_py(), size, known)
                    if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == digest.as_py():
                        nids.append(nid.as_py())
                        sets.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["nid", "members"])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("rep"), F.col(f"`{text_col}`").alias("text"))
    return (texts.join(nodes.select("rep", "nid", "digest"), "rep").select("nid", "digest", "text")
            .mapInArrow(run, "nid long, members array<long>"))


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (nid, hub) whose registers leave the threshold within reach."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            regs = [np.frombuffer(b"".join(b.column(c).to_pylist()), ">u2").reshape(b.num_rows, -1).astype(np.int32)
                    for c in (4, 5)]
            n_a, n_b = (b.column(c).to_numpy().astype(float) for c in (2, 3))
            keep = could_reach(*regs, n_a, n_b, threshold)
            yield pa.RecordBatch.from_arrays(
                [b.column(c).filter(pa.array(keep)) for c in range(4)], ["nid", "hub", "n", "hub_n"])

    a = nodes.select("nid", F.col("n_shingles").alias("n"), F.col("registers").alias("regs"))
    h = nodes.select(F.col("nid").alias("hub"), F.col("n_shingles").alias("hub_n"), F.col("registers").alias("hub_regs"))
    rows = pairs.join(a, "nid").join(h, "hub")
    return rows.select("nid", "hub", "n", "hub_n", "regs", "hub_regs").mapInArrow(
        run, "nid long, hub long, n long, hub_n long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node that has an edge (a, b) to a smaller one:
    root is the smallest node reachable. Alternating large-star and small-star
    steps; a node's neighbours are never gathered, only their minimum. Done
    when the edges form stars."""

    def star(u: DataFrame, small: bool) -> DataFrame:
        """u: (u, v). Large: the larger neighbours of u, small: all of v (which
        are smaller) and u itself, point to the least of u and its v."""
        low = u.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        j = u.join(low, "u")
        if small:
            out = j.select(F.col("v").alias("a"), F.col("low").alias("b")).union(low.select("u", "low"))
        else:
            out = j.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("low").alias("b"))
        return out.filter(F.col("a") != F.col("b"))

    def are_stars(e: DataFrame) -> bool:
        """No node points to two, and none that points is pointed to."""
        ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")),
                       F.struct(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
        per = e.select(F.inline(ends)).groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
        return per.filter((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0))).isEmpty()

    down = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = materialise(down.distinct(), name)
    while not are_stars(e):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        large = star(both, False)   # points down: from larger to smaller
        e = materialise(star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), True).distinct(), name)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _hubs(members: DataFrame, width: int) -> DataFrame:
    """(bucket, hub, hub_root, hub_n, hub_p, rank, used_up): up to ``width``
    members of each of a bucket's ``width`` largest components (rank 1 the
    largest), those with the least share of private shingles first, as most can
    be linked with them; used_up when the largest has no other members. Spark
    limits both windows within each task before it shuffles, so a hot bucket
    sends a few rows per task."""
    sizes = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("k"))
    by_size = Window.partitionBy("bucket").orderBy(F.col("k").desc(), "root")
    top = sizes.withColumn("rank", F.row_number().over(by_size)).filter(F.col("rank") <= width)
    largest = top.filter("rank = 1").select("bucket", (F.col("k") <= width).alias("used_up"))
    first = Window.partitionBy("bucket", "root").orderBy(F.col("p") / F.col("n"), F.xxhash64("nid"), "nid")
    some = members.withColumn("i", F.row_number().over(first)).filter(F.col("i") <= width)
    return some.join(top, ["bucket", "root"]).join(largest, "bucket").select(
        "bucket", F.col("nid").alias("hub"), F.col("root").alias("hub_root"), F.col("n").alias("hub_n"),
        F.col("p").alias("hub_p"), "rank", "used_up")


def _within_reach(n, p, other_n, other_p, percent: int):
    """Whether two sets can be linked, judged by their sizes and by how many of
    their shingles no other open node holds: these are in the union and not in
    the intersection."""
    common = F.least(n - p, other_n - other_p)
    union = F.greatest(n + other_p, other_n + p)
    return F.lit(100) * common >= F.lit(percent) * union


def _differ_little(n, parity, other_n, other_parity, percent: int):
    """Whether the bits in which the parity vectors differ leave the sets within
    reach: with D members that differ of S in all, 100 * |A & B| >= percent *
    |A | B| means (100 - percent) * S >= (100 + percent) * D."""
    bits = sum((F.bit_count(F.get(parity, i).bitwiseXOR(F.get(other_parity, i))) for i in range(PARITY_WORDS)), F.lit(0))
    return F.lit(100 - percent) * (n + other_n) >= F.lit(100 + percent) * bits


def _with_private(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows with ``p``, how many of the node's shingles no other node of
    the table holds; without the nodes for which these rule out any link."""
    alive = sets.join(members.select("nid").distinct(), "nid").select("nid", F.explode("members").alias("shingle"))
    private = alive.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("nid").alias("nid")).filter("c = 1")
    counted = private.groupBy("nid").agg(F.count(F.lit(1)).alias("p"))
    found = members.drop("p").join(counted, "nid", "left").withColumn("p", F.coalesce("p", F.lit(0).cast("long")))
    return found.filter(F.lit(100) * (F.col("n") - F.col("p")) >= F.lit(percent) * F.col("n"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per input row.

    Documents are linked when 100 * |A & B| >= percent * |A | B| for their sets
    of ``size``-word shingles; component_id is the smallest doc_id reachable.
    Rows without words are linked with nothing. A row with a null id is linked
    with nothing and kept (component_id null). Rows sharing an id are one
    document: the groups of all its texts count. An empty table gives an empty
    result; other columns are not read.
    """
    sketched = materialise(sketch_documents(docs, size, id_col, text_col), "sketches")
    usable = sketched.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    # nodes: distinct sets, numbered once and for all when written
    nodes = materialise(
        usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
                                     F.first("registers").alias("registers"), F.first("parity").alias("parity"))
        .withColumn("nid", F.monotonically_increasing_id()), "nodes")
    rows = _bucket_rows(nodes)
    shared = rows.groupBy("bucket").agg(F.min("nid").alias("lo"), F.max("nid").alias("hi")).filter("lo < hi")
    members = materialise(rows.join(shared.select("bucket"), "bucket"), "buckets")
    in_play = nodes.join(members.select("nid").distinct(), "nid")
    vectors = materialise(in_play.select("nid", "parity"), "vectors")
    hub_vectors = vectors.select(F.col("nid").alias("hub"), F.col("parity").alias("hub_parity"))
    sets = materialise(_sets_of(docs, in_play, size, id_col, text_col), "sets")

    comp = None     # (node, root), nodes with a link only
    tested = None   # pairs already compared
    width = 2
    while True:
        if comp is None:
            m = members.withColumns({"root": F.col("nid"), "p": F.lit(0).cast("long")})
            if m.isEmpty():
                break
        else:
            # (written once: what is open is told from it and then taken from it, and the join that drops spent
            # hubs was run for each)
            m = materialise(members.join(comp.withColumnRenamed("node", "nid"), "nid", "left")
                            .withColumn("root", F.coalesce("root", "nid")), "unspent")
            # buckets with members in two components or more
            open_ = m.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
            m = materialise(m.join(open_.select("bucket"), "bucket").withColumn("p", F.lit(0).cast("long")), "open-buckets")
            if m.isEmpty():
                break
            m = materialise(_with_private(m, sets, percent), "open-buckets")
            width *= 64
        hubs = materialise(_hubs(m, width), "hubs")
        ranks = hubs.select("bucket", F.col("hub_root").alias("root"), "rank").distinct()
        ranked = m.join(ranks, ["bucket", "root"], "left").select(
            "bucket", "nid", "n", "p", F.coalesce("rank", F.lit(width + 1)).alias("own_rank"))
        # the vectors are only here, where they are compared: not in the rows that are dealt out again and again
        met = ranked.join(vectors, "nid").join(hubs.join(hub_vectors, "hub"), "bucket").filter(
            (F.col("own_rank") > F.col("rank"))
            & _within_reach(F.col("n"), F.col("p"), F.col("hub_n"), F.col("hub_p"), percent)
            & _differ_little(F.col("n"), F.col("parity"), F.col("hub_n"), F.col("hub_parity"), percent))
        pairs = met.select("nid", "hub").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["nid", "hub"], "left_anti")
        pairs = materialise(pairs, "pairs")
        likely = _likely(pairs, nodes, percent / 100)
        both = (likely.join(sets, "nid")
                .join(sets.select(F.col("nid").alias("hub"), F.col("members").alias("hub_members")), "hub"))
        common = F.size(F.array_intersect("members", "hub_members"))
        links = both.withColumn("common", common.cast("long")).filter(
            F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("n") + F.col("hub_n") - F.col("common")))
        edges = links.select(F.col("nid").alias("a"), F.col("hub").alias("b"))
        if comp is not None:
            edges = edges.union(comp.select(F.col("node"), F.col("root")))
        comp = components(edges)
        # hubs of the largest component have met all members of others; where it
        # is used up, so are the smaller ones that were named, and their pairs
        spent = hubs.filter((F.col("rank") == 1) | F.col("used_up")).select("bucket", F.col("hub").alias("nid"))
        members = m.select("bucket", "nid", "n").join(spent, ["bucket", "nid"], "left_anti")
        tested = pairs if tested is None else tested.union(pairs)

    found = nodes.select("digest", "nid", "rep")
    if comp is not None:
        found = found.join(comp.withColumnRenamed("node", "nid"), "nid", "left").withColumn(
            "root", F.coalesce("root", "nid"))
        least = found.groupBy("root").agg(F.min("rep").alias("least"))
        found = found.join(least, "root").select("digest", F.col("least").alias("rep"))
    out = sketched.select("doc_id", "n_shingles", "digest").join(
        found.select("digest", F.col("rep").alias("group")), "digest", "left")
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id"))
    return out.select("doc_id", "n_shingles", group.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
