"""Normal forms from dependencies found in the data.

``discover`` finds the minimal functional dependencies of a table level by
level: X -> A holds when the partition of the rows by X is not refined by A, that
is when both have the same error e = rows - classes (to which classes of one row,
the stripped ones, add nothing). Sets are pruned as soon as a smaller one decides
them. Most candidates are refuted first: some classes of X, all rows of each, are
looked at in one aggregate per level, and two values of A in one class refute
X -> A for good. What is left, mostly true, is settled on all rows: one count of the
classes of X and one of X with all that it may determine, each dependent alone only
where these differ. The driver sees a few numbers per candidate set; how many there
are depends on the number of columns, not of rows.

The rest works on column names alone: closure, candidate keys, minimal cover,
third-normal-form synthesis, Boyce-Codd decomposition and the chase that tells
whether a decomposition is lossless. ``rejoin_counts`` holds it against the data.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import prod
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.writers import stage

SETS_PER_PASS = 4    # candidate sets counted in one pass over the rows
LEAST_CLASSES = 4096 # classes of a set looked at to refute, at least
REFUTE_SHARE = 256   # of more classes, one in so many at least


class FD(NamedTuple):
    """``lhs`` determines ``rhs``."""
    lhs: frozenset[str]
    rhs: str

    def __str__(self) -> str:
        return f"{','.join(sorted(self.lhs))} -> {self.rhs}"


def _class_of(cols: list[str]) -> list[Column]:
    """128 bits that tell the rows' values in ``cols`` apart, NULL included."""
    parts = [x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def partition_errors(rows: DataFrame, sets: list[frozenset[str]]) -> dict[frozenset[str], int]:
    """e(X) = rows - classes of every set of columns. Each row gives one class
    number per set; they are counted within tasks first, so that a class with a
    third of the rows costs one partial count per task."""
    out: dict[frozenset[str], int] = {}
    for lo in range(0, len(sets), SETS_PER_PASS):
        part = sets[lo:lo + SETS_PER_PASS]
        named = []
        for i, s in enumerate(part):
            a, b = _class_of(sorted(s))
            named.append(F.struct(F.lit(i).alias("set"), a.alias("a"), b.alias("b")))
        classes = rows.select(F.inline(F.array(*named))).groupBy("set", "a", "b").agg(F.count(F.lit(1)).alias("n"))
        stripped = classes.groupBy("set").agg(F.sum(F.col("n") - 1).alias("e"))
        found = {r["set"]: r["e"] for r in stripped.collect()}
        out.update({s: found.get(i, 0) for i, s in enumerate(part)})
    return out


def discover(df: DataFrame, cols: list[str] | None = None, max_lhs: int = 2, stored: bool = False) -> list[FD]:
    """All minimal dependencies X -> A with at most ``max_lhs`` columns in X
    (the empty X included: a constant column). NULL is a value like any other; a
    table of at most one row has every column constant. Dependencies are
    those of the rows given: data can refute a rule, not prove it. The rows are
    written once, unless ``stored`` says that reading ``df`` again costs no more than that."""
    cols = list(cols or df.columns)
    rows = df.select(*[F.col(f"`{c}`") for c in cols])
    if not stored:
        _, rows = stage(rows, "fd-rows")
    # distinct values only roughly: they tell how many classes to look at, not what holds
    one = rows.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)]).first()
    n, values = one["n"], {c: one[f"c{i}"] + 1 for i, c in enumerate(cols)}
    errors = {frozenset(): max(n - 1, 0)}
    found: list[FD] = []
    level = [frozenset()]
    for size in range(max_lhs + 1):
        # columns that a smaller set decides already need no test
        tests = {x: [a for a in cols if a not in x and not _decided(found, x, a)] for x in level}
        refuted = _refuted(rows, [x for x in level if tests[x]], cols, values, n)
        open_ = {x: [a for a in t if (x, a) not in refuted] for x, t in tests.items()}
        # all dependents of a set at once, then each where they do not all hold
        for apart in (False, True):
            groups = [(x, g) for x, t in open_.items() for g in ([[a] for a in t] if apart else [t] if t else [])]
            wanted = {s for x, g in groups for s in (x, x.union(g))} - set(errors)
            errors |= partition_errors(rows, sorted(wanted, key=sorted))
            held = [(x, g) for x, g in groups if errors[x.union(g)] == errors[x]]
            found += [FD(x, a) for x, g in held for a in g]
            open_ = {x: t for x, t in open_.items() if len(t) > 1 and (x, t) not in held}
        # the next sets: none of whose columns is decided by the others
        free = {x | {a} for x in level for a in cols if a not in x}
        level = sorted((x for x in free if not any(_decided(found, x - {a}, a) for a in x)), key=sorted)
        if not level:
            break
    return sorted(found, key=lambda d: (len(d.lhs), sorted(d.lhs), d.rhs))


def _refuted(rows: DataFrame, sets: list[frozenset[str]], cols: list[str], values: dict[str, int], n: int) -> set[tuple[frozenset[str], str]]:
    """(X, A) of which the rows of some classes of X show that X -> A fails. The
    classes are picked by their hash, so each is seen with all its rows: every class
    of a set with few, one in ``REFUTE_SHARE`` of a set with many, as the columns'
    distinct ``values`` and the ``n`` rows let expect. A pair that is not returned may
    hold or fail."""
    if not sets:
        return set()
    # every value hashed once; the classes from these hashes
    hashed = rows.select(*[F.xxhash64(F.lit(seed), F.col(f"`{c}`").isNull(), F.col(f"`{c}`")).alias(f"{v}{j}")
                           for j, c in enumerate(cols) for v, seed in (("v", 3), ("w", 4))])
    picked = []
    for i, x in enumerate(sets):
        at = [cols.index(c) for c in sorted(x)]
        a, b = (F.xxhash64(F.lit(seed), *[F.col(f"{v}{j}") for j in at]) for v, seed in (("v", 1), ("w", 2)))
        about = min(n, prod(values[c] for c in x))
        share = max(1, min(about // LEAST_CLASSES, REFUTE_SHARE))
        picked.append(F.when(F.pmod(a, F.lit(share)) == 0, F.struct(F.lit(i).alias("set"), a.alias("a"), b.alias("b"))))
    seen = hashed.select(*[f"v{j}" for j in range(len(cols))], F.inline(F.array(*picked))).filter(F.col("set").isNotNull())
    ends = [x for j in range(len(cols)) for x in (F.min(f"v{j}").alias(f"lo{j}"), F.max(f"v{j}").alias(f"hi{j}"))]
    per = seen.groupBy("set", "a", "b").agg(*ends)
    two = per.groupBy("set").agg(*[F.max(F.col(f"lo{j}") != F.col(f"hi{j}")).alias(f"two{j}") for j in range(len(cols))])
    return {(sets[r["set"]], c) for r in two.collect() for j, c in enumerate(cols) if r[f"two{j}"]}


def _decided(found: list[FD], x: frozenset[str], a: str) -> bool:
    return any(d.rhs == a and d.lhs <= x for d in found)


def closure(x: frozenset[str] | set[str], fds: list[FD]) -> frozenset[str]:
    """All columns that ``x`` determines."""
    out, grown = set(x), True
    while grown:
        more = {d.rhs for d in fds if d.lhs <= out} - out
        out |= more
        grown = bool(more)
    return frozenset(out)


def candidate_keys(cols: list[str], fds: list[FD]) -> list[frozenset[str]]:
    """All minimal sets that determine every column: the columns that nothing
    determines are in each key, the others are added level by level."""
    whole = frozenset(cols)
    always = whole - {d.rhs for d in fds}
    rest = sorted(whole - always)
    keys: list[frozenset[str]] = []
    for size in range(len(rest) + 1):
        for extra in combinations(rest, size):
            x = always | set(extra)
            if not any(k <= x for k in keys) and closure(x, fds) == whole:
                keys.append(x)
    return keys


def minimal_cover(fds: list[FD]) -> list[FD]:
    """Equivalent dependencies without superfluous columns or members; which of
    several covers is fixed by the order of names."""
    cover = []
    for d in sorted(set(fds), key=str):
        lhs = d.lhs
        for c in sorted(d.lhs):
            if d.rhs in closure(lhs - {c}, fds):
                lhs = lhs - {c}
        cover.append(FD(lhs, d.rhs))
    cover = sorted(set(cover), key=lambda d: (-len(d.lhs), str(d)))
    for d in list(cover):
        others = [o for o in cover if o != d]
        if d.rhs in closure(d.lhs, others):
            cover = others
    return sorted(cover, key=str)


def synthesize_3nf(cols: list[str], fds: list[FD]) -> list[frozenset[str]]:
    """Relations in third normal form, lossless and keeping every dependency:
    one per determinant of a minimal cover (determinants that determine each
    other share one), one with a key if none has it."""
    cover = minimal_cover(fds)
    groups: list[tuple[frozenset[str], set[str]]] = []
    for lhs in sorted({d.lhs for d in cover}, key=sorted):
        members = set(lhs) | {d.rhs for d in cover if d.lhs == lhs}
        for first, cols_ in groups:
            if lhs <= closure(first, fds) and first <= closure(lhs, fds):
                cols_ |= members
                break
        else:
            groups.append((lhs, members))
    relations = [frozenset(m) for _, m in groups]
    keys = candidate_keys(cols, fds)
    if not any(k <= r for k in keys for r in relations):
        relations.append(min(keys, key=lambda k: (len(k), sorted(k))))
    kept = [r for r in relations if not any(r < o for o in relations)]
    return sorted(set(kept), key=lambda r: (len(r), sorted(r)))


def decompose_bcnf(cols: list[str], fds: list[FD]) -> list[frozenset[str]]:
    """Relations in Boyce-Codd normal form, lossless: a relation is split as
    long as some of its columns determine others of it without being a key of it."""
    done, todo = [], [frozenset(cols)]
    while todo:
        r = todo.pop()
        split = _violation(r, fds)
        if split is None:
            done.append(r)
        else:
            todo += [split, r - (closure(_lhs_of(r, fds), fds) & r) | _lhs_of(r, fds)]
    kept = [r for r in done if not any(r < o for o in done)]
    return sorted(set(kept), key=lambda r: (len(r), sorted(r)))


def _lhs_of(r: frozenset[str], fds: list[FD]) -> frozenset[str]:
    """The determinant, fewest columns first, by which ``r`` is split; empty if none."""
    for size in range(1, len(r)):
        for x in combinations(sorted(r), size):
            inside = closure(frozenset(x), fds) & r
            if len(inside) > size and inside != r:
                return frozenset(x)
    return frozenset()


def _violation(r: frozenset[str], fds: list[FD]) -> frozenset[str] | None:
    lhs = _lhs_of(r, fds)
    return closure(lhs, fds) & r if lhs else None


def is_lossless(cols: list[str], relations: list[frozenset[str]], fds: list[FD]) -> bool:
    """The chase: one row per relation, known symbols where it has the column;
    dependencies make symbols equal until a row is known throughout or nothing changes."""
    rows = [{c: "known" if c in r else f"{c}{i}" for c in cols} for i, r in enumerate(relations)]
    changed = True
    while changed:
        changed = False
        for d in fds:
            same: dict[tuple, list[dict]] = {}
            for row in rows:
                same.setdefault(tuple(row[c] for c in sorted(d.lhs)), []).append(row)
            for group in same.values():
                symbols = {row[d.rhs] for row in group}
                if len(symbols) > 1:
                    to = "known" if "known" in symbols else min(symbols)
                    for row in rows:
                        if row[d.rhs] in symbols:
                            row[d.rhs] = to
                    changed = True
    return any(all(v == "known" for v in row.values()) for row in rows)


def project(df: DataFrame, relations: list[frozenset[str]]) -> list[DataFrame]:
    """The relations of a decomposition: distinct projections, each written once."""
    return [stage(df.select(*sorted(r)).distinct(), "relation")[1] for r in relations]


def rejoin(parts: list[DataFrame]) -> DataFrame:
    """Natural join of relations, the widest first, then each that shares columns
    with what is joined; NULL equals NULL."""
    left = sorted(parts, key=lambda p: -len(p.columns))
    out, left = left[0], left[1:]
    while left:
        nxt = max(left, key=lambda p: len(set(p.columns) & set(out.columns)))
        left = [p for p in left if p is not nxt]
        shared = [c for c in nxt.columns if c in out.columns]
        if not shared:
            raise ValueError(f"{nxt.columns} shares no column with the rest")
        other = nxt.select(*[F.col(c).alias(f"_rj_{c}" if c in shared else c) for c in nxt.columns])
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_rj_{c}")) for c in shared])
        out = out.join(other, on).drop(*[f"_rj_{c}" for c in shared])
    return out


def rejoin_counts(df: DataFrame, relations: list[frozenset[str]], made: dict[frozenset[str], DataFrame] | None = None) -> DataFrame:
    """One row: distinct rows of ``df`` (n_input), rows of the re-join of its
    projections (n_rejoined), and whether they are the same rows (lossless).
    The re-join holds every input row, so equal counts mean equal rows. ``made``
    keeps the distinct rows and the projections for further calls with the same ``df``."""
    from .relational import with_scalars

    made = {} if made is None else made
    cols = sorted(df.columns)
    if frozenset(cols) not in made:
        made[frozenset(cols)] = stage(df.select(*cols).distinct(), "fd-input")[1]
    whole = made[frozenset(cols)]
    new = [r for r in relations if r not in made]
    made.update(zip(new, project(whole, new)))
    n = whole.agg(F.count(F.lit(1)).alias("n_input"))
    m = rejoin([made[r] for r in relations]).agg(F.count(F.lit(1)).alias("n_rejoined"))
    return with_scalars(n, m).withColumn("lossless", F.col("n_input") == F.col("n_rejoined"))
