"""Fill-in-middle transformation with a learned rank index over token ends.

A text is cut into tokens (white space and the word after it; white space at
the end of a text is a token of its own). The cut after k tokens needs the
offset of the k-th boundary:

* ``fit`` covers all boundary offsets of a text by line segments, each within
  ``ERROR`` of every offset it covers: a segment grows while some slope through
  its first point still meets all of them (a cone that only narrows);
* ``RankIndex.cut`` predicts an offset from its segment's line and adds the
  residual that was stored for it (one byte each), which makes it exact.

The index of a text is eight to ten times smaller than its offsets as 64-bit
numbers, can be written as a table (``build_index``) and gives any cut without
another pass over the text. ``fill_in_middle`` fits it and takes both cuts from it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

ERROR = 100            # largest distance of an offset from its line; residuals fit in one byte
BLOCK = 512            # offsets looked at in one step while a segment grows
SEED = 42
PLAIN_BELOW, SPM_BELOW = 50, 80   # percent: transformed at all; of these in SPM order
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
          "restored_sha256 string, n_segments int")


def boundaries(data: bytes) -> np.ndarray:
    """Byte offsets at which the tokens of UTF-8 bytes end, 0 first. (The six
    separators \\x20 and \\x09-\\x0D are never part of a longer character.)"""
    if not data:
        return np.zeros(1, np.int64)
    octets = np.frombuffer(data, np.uint8)
    space = (octets == 0x20) | ((octets >= 0x09) & (octets <= 0x0D))
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.concatenate([[0], ends, [len(data)]])


@dataclass
class RankIndex:
    """Segments (first rank, first offset, slope) and one residual per rank."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @property
    def size(self) -> int:
        """Number of tokens."""
        return len(self.residual) - 1

    def cut(self, rank: int) -> int:
        """Offset after ``rank`` tokens: predicted by the segment's line, then
        made exact by the stored residual."""
        s = int(np.searchsorted(self.first, rank, side="right")) - 1
        return int(_predict(self.base[s], self.slope[s], rank - self.first[s])) + int(self.residual[rank])


def _predict(base, slope, steps):
    return base + np.rint(slope * steps).astype(np.int64)


def fit(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """Segments over ascending offsets, each within ``error`` (at most 126) of
    all that it covers, taken as long as one line allows."""
    n = len(offsets)
    first, base, slope = [], [], []
    residual = np.zeros(n, np.int8)
    start = 0
    while start < n:
        origin, low, high, end = offsets[start], -np.inf, np.inf, start + 1
        while end < n:
            stop = min(end + BLOCK, n)
            steps = np.arange(end - start, stop - start)
            rise = offsets[end:stop] - origin
            lows = np.maximum.accumulate(np.maximum((rise - error) / steps, low))
            highs = np.minimum.accumulate(np.minimum((rise + error) / steps, high))
            narrow = lows > highs
            fits = int(np.argmax(narrow)) if narrow.any() else stop - end
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            end += fits
            if end < stop:
                break
        line = 0.0 if end == start + 1 else float((low + high) / 2)
        guess = _predict(origin, line, np.arange(end - start))
        residual[start:end] = offsets[start:end] - guess   # rounding adds at most one to the error
        first.append(start)
        base.append(origin)
        slope.append(line)
        start = end
    return RankIndex(np.array(first, np.int64), np.array(base, np.int64), np.array(slope), residual)


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document, the same at every run."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k:4 * k + 4], "big") for k in range(4))


def form_of(data: bytes, h3: int, h4: int) -> str:
    """plain, spm or psm."""
    if not data or h3 % 100 >= PLAIN_BELOW or any(m.encode() in data for m in (PREFIX, SUFFIX, MIDDLE)):
        return "plain"
    return "spm" if h4 % 100 < SPM_BELOW else "psm"


def assemble(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if form == "psm":
        return b"".join((p, prefix, s, suffix, m, middle))
    if form == "spm":
        return b"".join((s, suffix, p, prefix, m, middle))
    return prefix + middle + suffix


def restore(form: str, output: bytes) -> bytes:
    """The text again, from output and form alone: a transformed text holds none
    of the marks, so each mark's first place is its own."""
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if form == "plain":
        return output
    outer, inner = (p, s) if form == "psm" else (s, p)
    one, rest = output[len(outer):].split(inner, 1)
    two, middle = rest.split(m, 1)
    return one + middle + two if form == "psm" else two + middle + one


def transform(doc_id: int | None, data: bytes) -> tuple[RankIndex, str, int, int, bytes]:
    """(index, form, first cut, second cut, output) of one text; cuts in bytes."""
    index = fit(boundaries(data))
    n = index.size
    h1, h2, h3, h4 = draws(doc_id)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    form, lo, hi = form_of(data, h3, h4), index.cut(a), index.cut(b)
    return index, form, lo, hi, assemble(form, data[:lo], data[lo:hi], data[hi:])


def _points(data: bytes) -> int:
    return len(data.decode("utf-8", "surrogatepass"))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("data"))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_output: bool = False) -> DataFrame:
    """One row per input row: doc_id, n (tokens), form, prefix_chars, middle_chars
    (code points; null if plain), output_sha256, restored_sha256, n_segments of the
    index; with ``with_output`` the output itself.

    A null text counts as empty: no token, form plain. A null id draws like an
    empty one; repeated rows give equal results; an empty table gives an empty
    result; other columns are not read. No shuffle: a text is the unit of work.
    """
    schema = SCHEMA + (", output string" if with_output else "")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
        kinds += [pa.string()] if with_output else []
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0), batch.column(1)):
                doc_id, data = i.as_py(), t.as_py()
                index, form, lo, hi, output = transform(doc_id, data)
                plain = form == "plain"
                rows.append((doc_id, index.size, form, None if plain else _points(data[:lo]),
                             None if plain else _points(data[lo:hi]), hashlib.sha256(output).hexdigest(),
                             hashlib.sha256(restore(form, output)).hexdigest(), len(index.first),
                             *([output.decode("utf-8")] if with_output else [])))
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    names = [c.split()[0] for c in schema.split(", ")]
    return _source(docs, id_col, text_col).mapInArrow(run, schema)


INDEX_SCHEMA = "doc_id long, first array<long>, base array<long>, slope array<double>, residual binary"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rank index of every text as a table (``INDEX_SCHEMA``): one row per
    input row, cases as in ``fill_in_middle``. ``read_index`` makes a row an index."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary()]
        for batch in batches:
            cols = [[], [], [], [], []]
            for i, t in zip(batch.column(0), batch.column(1)):
                x = fit(boundaries(t.as_py()))
                for c, v in zip(cols, (i.as_py(), x.first, x.base, x.slope, x.residual.tobytes())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
    return _source(docs, id_col, text_col).mapInArrow(run, INDEX_SCHEMA)


def read_index(row) -> RankIndex:
    return RankIndex(np.array(row["first"], np.int64), np.array(row["base"], np.int64), np.array(row["slope"]),
                     np.frombuffer(row["residual"], np.int8))
