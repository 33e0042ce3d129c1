"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into windows of ``WINDOW`` bytes, every ``STRIDE``
bytes, and of ``SEED`` bytes, every ``SEED_STRIDE`` bytes (a shorter item is one
window). So every excerpt of an item of ``SEED + SEED_STRIDE - 1`` bytes or more
(``EXCERPT``), wherever it starts, holds a window. A window and a stretch of a document
within ``e`` edits share at least ``length - q + 1 - q * e`` q-grams, all of
them on diagonals (document position less window position) that differ by at
most e. Shared q-grams are counted per window in diagonal bands of width 2e
that overlap by e, so some band holds them all; bands that reach the bound are
verified by alignment within the band. The filter loses no window. Items of
fewer than ``MIN_ITEM`` bytes are searched whole and byte for byte.

Texts are compared byte by byte with ASCII letters lower-cased and every other
ASCII byte but letters and digits as a space, so offsets stay those of the text.

The benchmark is a stated query set: it goes through the driver and to the
tasks in blocks of at most ``BLOCK_BYTES`` of text (or one longer item), each
block against all documents, so a benchmark of n blocks costs n scans of the
texts: one for a benchmark of up to a million characters. No shuffle, no join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_store

Q = 8
WINDOW, STRIDE = 80, 40
SEED, SEED_STRIDE = 56, 8
EXCERPT = SEED + SEED_STRIDE - 1   # an excerpt as long as this holds a window
EDIT_SHARE = 0.075            # edits allowed per byte of a window
MIN_ITEM = 24                 # a shorter item must be there whole, without edits
BLOCK_BYTES = 1 << 20
FILTER_BITS = 20
AT_ONCE = 4096                # regions aligned at once (bounds the memory of a text full of benchmark text)

_U = np.uint64
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                  for c in range(256)], np.uint8)


def folded(text: str) -> np.ndarray:
    return _FOLD[np.frombuffer(text.encode("utf-8"), np.uint8)]


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """The q-grams of all positions, up to eight bytes to a number."""
    n = len(data) - q + 1
    if n <= 0:
        return np.empty(0, _U)
    wide = data.astype(_U)
    out = np.zeros(n, _U)
    for k in range(q):
        out = (out << _U(8)) | wide[k:k + n]
    return out


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * _U(0x9E3779B97F4A7C15)) >> _U(64 - FILTER_BITS)


class WindowIndex:
    """Windows of a block of items and where each q-gram occurs in them."""

    def __init__(self, items: list[tuple[int, str]]):
        self.windows, self.item_of, codes = [], [], []
        short: dict[int, dict[bytes, list[int]]] = {}
        for item, text in items:
            data = folded(text)
            if len(data) < MIN_ITEM:
                if data.tobytes().strip():
                    short.setdefault(len(data), {}).setdefault(data.tobytes(), []).append(item)
                continue
            at = grams(data)
            for size, stride in ((WINDOW, STRIDE), (SEED, SEED_STRIDE)):
                if size < WINDOW and len(data) <= size:
                    continue   # one window, as it is
                starts = list(range(0, max(len(data) - size, 0) + 1, stride))
                if starts[-1] + size < len(data):
                    starts.append(len(data) - size)
                for s in starts:
                    self.windows.append(data[s:s + size])
                    self.item_of.append(item)
                    codes.append(at[s:s + len(self.windows[-1]) - Q + 1])
        # short items by length: the codes of their first q-grams, and the items
        self.short = [(n, np.unique(np.concatenate([grams(np.frombuffer(t, np.uint8)[:Q], min(n, Q)) for t in texts])), texts)
                      for n, texts in sorted(short.items())]
        self.sizes = np.array([len(w) for w in self.windows], np.int64)
        self.edits = np.maximum((self.sizes * EDIT_SHARE).astype(np.int64), 1)
        self.bounds = self.sizes - Q + 1 - Q * self.edits
        # (least hits, longest stretch) of the windows up to each length
        kinds = [self.sizes > SEED, (self.sizes <= SEED) & (self.sizes > SEED // 2), self.sizes <= SEED // 2]
        self.needs = [(int(self.bounds[k].min()), int((self.sizes + self.edits)[k].max())) for k in kinds if k.any()]
        counts = [len(c) for c in codes]
        owner = np.repeat(np.arange(len(codes), dtype=np.int32), counts)
        offset = np.concatenate([np.arange(n, dtype=np.int32) for n in counts]) if codes else np.empty(0, np.int32)
        flat = np.concatenate(codes) if codes else np.empty(0, _U)
        order = np.argsort(flat, kind="stable")
        self.owner, self.offset = owner[order], offset[order]
        self.codes, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[_slot(self.codes)] = True

    def bands(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, band) pairs that reach their bound; band k covers the
        diagonals from k * e to (k + 2) * e."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        codes = grams(data)
        if not len(codes) or not len(self.codes):
            return none
        pos = np.flatnonzero(self.table[_slot(codes)])
        at = np.searchsorted(self.codes, codes[pos])
        at[at == len(self.codes)] = 0
        true = self.codes[at] == codes[pos]
        pos, at = pos[true], at[true]
        # a stretch that reaches a bound has this many hits within its length
        near = np.zeros(len(pos) + 1, np.int64)
        for least, reach in self.needs:
            ends = np.searchsorted(pos, pos + reach, "right")
            start = np.flatnonzero(ends - np.arange(len(pos)) >= least)
            near += np.bincount(start, minlength=len(pos) + 1) - np.bincount(ends[start], minlength=len(pos) + 1)
        near = np.cumsum(near[:-1]) > 0
        pos, at = pos[near], at[near]
        if not len(pos):
            return none
        n = self.count[at]
        flat = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        win = self.owner[flat].astype(np.int64)
        diag = np.repeat(pos, n) - self.offset[flat]
        band = diag // self.edits[win]
        # a diagonal lies in two bands
        span = len(data) + 2 * WINDOW + 4
        keys = np.concatenate([win * span + band + WINDOW + 2, win * span + band + WINDOW + 1])
        keys, hits = np.unique(keys, return_counts=True)
        win = keys // span
        good = hits >= self.bounds[win]
        return win[good], keys[good] % span - WINDOW - 2

    def verify(self, data: np.ndarray, win: np.ndarray, band: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, start, end) of the bands whose region holds the window
        within its edits. Alignment of the whole window against any stretch of
        the region, up to ``AT_ONCE`` candidates of one window length at once."""
        out = []
        sizes = self.sizes[win]
        picks = [(size, part) for size in np.unique(sizes) for whole in [np.flatnonzero(sizes == size)]
                 for part in np.split(whole, range(AT_ONCE, len(whole), AT_ONCE))]
        for size, pick in picks:
            e = int(max(int(size * EDIT_SHARE), 1))
            length = int(size) + 3 * e + 1
            lo = band[pick] * e
            where = lo[:, None] + np.arange(length)[None, :]
            inside = (where >= 0) & (where < len(data))
            region = np.where(inside, data[np.clip(where, 0, len(data) - 1)].astype(np.int16), -1)
            pattern = np.stack([self.windows[w] for w in win[pick]]).astype(np.int16)
            steps = np.arange(length + 1, dtype=np.int32)
            row = np.zeros((len(pick), length + 1), np.int32)
            for k in range(int(size)):
                step = np.empty_like(row)
                step[:, 0] = k + 1
                step[:, 1:] = np.minimum(row[:, :-1] + (region != pattern[:, k:k + 1]), row[:, 1:] + 1)
                row = np.minimum.accumulate(step - steps, 1) + steps
            best = row.argmin(1)
            for i in np.flatnonzero(row[np.arange(len(pick)), best] <= e):
                end = int(min(max(lo[i] + best[i], 0), len(data)))
                out.append((int(win[pick[i]]), max(0, end - int(size)), end))
        return out

    def whole(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first start, last end) of the short items that the data holds."""
        found: dict[tuple, list] = {}
        raw = data.tobytes() if self.short else b""
        for n, codes, texts in self.short:
            here = grams(data, min(n, Q))
            for at in np.flatnonzero(np.isin(here, codes)).tolist():
                text = raw[at:at + n]
                if text in texts:
                    found.setdefault((n, text), [at, at])[1] = at + n
        return [(item, start, end) for n, codes, texts in self.short for text, ids in texts.items()
                if (n, text) in found for item in ids for start, end in [found[n, text]]]

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, windows found, start, end) per leaked item, by item."""
        data = folded(text or "")
        win, band = self.bands(data)
        found: dict[int, list] = {}
        for w, start, end in self.verify(data, win, band):
            found.setdefault(self.item_of[w], []).append((w, start, end))
        for k, (item, start, end) in enumerate(self.whole(data)):
            found.setdefault(item, []).append((-1 - k, start, end))
        return [(item, len({w for w, _, _ in hits}), min(s for _, s, _ in hits), max(e for _, _, e in hits))
                for item, hits in sorted(found.items())]


def _index(items: list[tuple[int, str]]) -> WindowIndex:
    """The index of a block, built once per worker (the latest block stays)."""
    store = worker_store("decontam")
    key = hashlib.sha256(repr(items).encode()).hexdigest()
    if store.get("window-index", ("",))[0] != key:
        store["window-index"] = (key, WindowIndex(items))
    return store["window-index"][1]


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"
                     ) -> Iterator[list[tuple[int, str]]]:
    """Blocks of items with a text and an id, repeated rows once per block."""
    block, size = {}, 0
    rows = benchmark.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).dropna()
    for item, text in rows.toLocalIterator():
        if size and size + len(text.encode()) > BLOCK_BYTES:
            yield sorted(block)
            block, size = {}, 0
        block[(item, text)] = None
        size += len(text.encode())
    if block:
        yield sorted(block)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_windows, start, end: one row per document row and
    leaked item; n_windows of the item's windows were found, the first starting
    near and the last ending at byte ``start`` and ``end``.

    Documents without a leak give no row; null or empty texts have none;
    repeated rows repeat; a null doc_id stays null; items without an id or a
    text, or without any letter or digit, are no queries; empty tables give an
    empty result; other columns are not read.
    """
    src = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    schema = "doc_id long, item_id long, n_windows long, start long, end long"
    out = None
    for items in benchmark_blocks(benchmark):

        def run(batches: Iterator, items=items) -> Iterator:
            import pyarrow as pa

            index = _index(items)
            for b in batches:
                rows = [(i.as_py(), *leak) for i, t in zip(b.column(0), b.column(1)) for leak in index.leaks(t.as_py())]
                cols = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 ["doc_id", "item_id", "n_windows", "start", "end"])

        part = src.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows without any leak, all columns as they are. Row by row, so null
    ids and repeated rows need no special care; a null text has no leak."""
    for items in benchmark_blocks(benchmark):
        docs = docs.filter(~_leak_flag(items)(F.col(f"`{text_col}`")))
    return docs


def _leak_flag(items: list[tuple[int, str]]):
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("boolean")
    def leaks(texts):
        import pandas as pd

        index = _index(items)
        return pd.Series([bool(index.leaks(t)) if isinstance(t, str) else False for t in texts], dtype=bool)

    return leaks
