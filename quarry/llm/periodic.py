"""Periodic runs of words by Baier's suffix grouping.

A run is a maximal stretch of words with smallest period q, at least
``max(MIN_WORDS, MIN_PERIODS * q)`` words long. Per text:

* words whose window of ``GRAM`` words stands only once in the text lie in no
  run (a run repeats each of its windows one period away), so stretches of
  repeated windows are cut out first and handled one by one;
* phase one of the suffix sorter (``lyndon_array``) refines groups of suffixes
  from the highest to the lowest. Each suffix of a group is handed to the nearest
  suffix before it that stands in a lower group; that one's context grows by the
  group's. When all groups are done, the context of a suffix is its longest Lyndon
  prefix. It is done under the order of the words and under the inverse order;
* in a run of three periods, one of the two orders has two Lyndon roots side by
  side, both one period long. Such pairs are extended to both sides by their
  longest common extensions (LCE); what is long enough is a run.

Spark deals out the documents; a text is handled by one task in time that grows
with its length (nearly) linearly.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

MIN_WORDS = 24
MIN_PERIODS = 3
GRAM = 8   # words; at most MIN_WORDS // MIN_PERIODS, so that every window of a run recurs in it

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, n_words long, n_dropped long")


def words(data: bytes) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes (the six separators are never
    part of a longer character)."""
    return data.split()


def word_ids(parts: list[bytes]) -> np.ndarray:
    """Numbers by first appearance: equal words, equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in parts), np.int64, len(parts))


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position, by
    refining suffix groups (phase one of the suffix sorter)."""
    n = len(symbols)
    alphabet = sorted(set(symbols))
    place = {s: g for g, s in enumerate(alphabet)}
    group = [place[s] for s in symbols]
    members: list[list[int]] = [[] for _ in alphabet]
    for i, g in enumerate(group):
        members[g].append(i)
    size = len(alphabet)
    context = [1] * size                     # length of the prefix that a group's suffixes share
    lower = list(range(-1, size - 1))        # neighbours in the order of groups
    higher = list(range(1, size + 1))
    length = [1] * n
    left = list(range(n + 1))                # left[i + 1] == i + 1 while suffix i waits; else a way to the left
    now = size - 1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]
        for i in own:
            left[i + 1] = i
        taken: dict[int, int] = {}
        for i in own:
            j = i
            while left[j] != j:              # nearest suffix of a lower group; paths are halved on the way
                left[j] = left[left[j]]
                j = left[j]
            if j:
                taken[j - 1] = taken.get(j - 1, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for j, times in taken.items():
            moves.setdefault((times, group[j]), []).append(j)
        # right above the old group; the oftener extended were put there before and stand higher
        for times, old in sorted(moves, reverse=True):
            new, moved = len(members), moves[times, old]
            members.append(moved)
            context.append(context[old] + times * context[now])
            lower.append(old)
            higher.append(higher[old])
            lower_of = higher[old]
            if lower_of < len(lower):
                lower[lower_of] = new
            higher[old] = new
            for j in moved:
                group[j], length[j] = new, context[new]
        members[now] = []
        now = lower[now]
    return length


def _common(a: np.ndarray, i: int, j: int) -> int:
    """LCE: number of equal symbols from i and j > i on."""
    n, total, step = len(a), 0, 16
    while j + total < n:
        x, y = a[i + total:i + total + step], a[j + total:j + total + step]
        same = x[:len(y)] == y
        if not same.all():
            return total + int(np.argmin(same))
        total += len(y)
        step *= 2
    return total


def runs_of(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, by start and period;
    ``min_periods`` is at least 3 (two roots side by side are looked for)."""
    found, n, back = set(), len(ids), ids[::-1]
    for order in (ids, -ids):
        root = np.array(lyndon_array(order.tolist()), np.int64)
        at = np.flatnonzero(np.arange(n) + root < n)
        at = at[root[at + root[at]] == root[at]]
        until: dict[int, int] = {}           # period -> end of the last run found with it
        for i in at.tolist():
            p = int(root[i])
            if i + 2 * p <= until.get(p, 0):
                continue
            ahead = _common(ids, i, i + p)
            if ahead < p:
                continue
            behind = _common(back, n - i - p, n - i)
            start, length = i - behind, behind + p + ahead
            until[p] = start + length
            if length >= max(min_words, min_periods * p):
                found.add((start, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the stretches that can hold a run: windows of GRAM words
    that stand twice or more (a hash taken for another only adds a stretch)."""
    n = len(ids) - GRAM + 1
    if len(ids) < MIN_WORDS:
        return []
    h = np.zeros(n, np.uint64)
    mixed = _mix(ids.astype(np.uint64) + np.uint64(1))
    for k in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + mixed[k:k + n]
    order = np.argsort(h, kind="stable")
    twin = h[order[1:]] == h[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][twin]] = True
    again[order[:-1][twin]] = True
    edge = np.flatnonzero(np.diff(np.concatenate([[False], again, [False]])))
    return [(s, e + GRAM - 1) for s, e in edge.reshape(-1, 2).tolist() if e + GRAM - 1 - s >= MIN_WORDS]


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text, by start and period."""
    return [(s + start, length, p) for s, e in stretches(ids) for start, length, p in runs_of(ids[s:e])]


def probe(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p): from word a on, a probed text repeats its words a .. a + p - 1;
    None for a text that is left as it is (nine in ten, and a null id)."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or n == 0 or h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def collapse(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of the words stay: all but those of a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, p in runs:
        edge[start + p] += 1
        edge[start + length] -= 1
    return np.cumsum(edge)[:n] == 0


def _row(doc_id, data: bytes, probed: bool) -> tuple:
    parts = words(data)
    n = len(parts)
    cut = probe(doc_id, n) if probed else None
    if cut is not None:
        a, p = cut
        parts = parts[:a] + (parts[a:a + p] * (-(-(n - a) // p)))[:n - a]
    runs = find_runs(word_ids(parts))
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    if runs:
        stay = collapse(n, runs)
        kept = [w for w, s in zip(parts, stay.tolist()) if s]
    else:
        kept = parts
    listing = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    best = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest(), n, n - len(kept))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", probed: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_runs, the run with the greatest
    length / period (start, length, period, exponent_milli; ties: smallest start,
    then period; null without a run), digests of the list of runs and of the words
    left when each run keeps its first period only, n_words, n_dropped.

    ``probed`` first rewrites one text in ten into a periodic one (``probe``).
    A null text counts as empty and has no words; repeated rows give repeated
    results; a null id is kept (and never probed); an empty table gives an empty
    result; other columns are not read. No shuffle: a text is the unit of work.
    """
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("data"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64()] * 2
        for b in batches:
            rows = [_row(i.as_py(), t.as_py(), probed) for i, t in zip(b.column(0), b.column(1))]
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return src.mapInArrow(run, SCHEMA)


def run_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, period) of every run: one row per run."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("data"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = [(i.as_py(), *r) for i, t in zip(b.column(0), b.column(1)) for r in find_runs(word_ids(words(t.as_py())))]
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "period"])

    return src.mapInArrow(run, "doc_id long, start long, length long, period long")
