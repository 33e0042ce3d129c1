"""Secret scan: fixed patterns plus a randomness test battery.

Base patterns (assignments, access keys, long hex runs) are found as they are.
The battery adds strings that look drawn at random from an encoding's
alphabet. Runs of encoding characters are cut around base spans and at inner
``=`` (a ``KEY=value`` gives its value), and each part is read whole and cut at
``/`` and ``+``, at ``-`` and ``_``, and at all four (a path gives its names).
Every reading of 20 or more characters that mixes character classes is a
candidate; the smallest alphabet that holds it is its encoding. Accepted
readings that overlap become one span.
Three tests ask whether the token could be uniform random symbols:

* chi-squared of the symbol counts (gamma-matched mean and variance),
* runs above and below the alphabet's middle,
* lag-one serial correlation of the symbol values,

combined by Fisher's method to one p-value; a token below ``UNLIKE`` is not
random. Short tokens give these tests little power against names and
identifiers, so what passes is held against plain writing by two directed forms of
the same tests: the evidence of a token (``_evidence``) adds, per symbol, how much
likelier the uniform alphabet makes it than plain writing does (rare letters and
digits), and, per neighbour pair, the same for a change of character class (runs
of upper case, lower case and digits). Divided by the root of the length it is
about normal; for plain writing its mean falls with the length, so that a short
candidate meets a wide null and a long one a sharp null.

The null are all plain words of the corpus, joined and cut into pieces as long as
the lower edge of each length class, in lower case for candidates of one letter
case and with a capital each for those of both, and the pieces of a fixed
reference text, so that a corpus without plain writing has a null as well. A cell
(letter case and length class) gets a normal tail fitted to each of the two,
widened by ``WIDER``, and the larger p-value counts. So a p-value can be as small
as the evidence makes it: whether a key is found does
not depend on how many pieces or other candidates there are, but for the
Benjamini-Hochberg step-up at rate ``FDR`` over all candidates of the corpus.
Both need only counts per cell and score bin, summed on Spark: a table of at most
``CELLS * BINS * 2`` rows whatever the corpus.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_HINTS = ("passw", "secret", "token", "api")   # every assignment holds one of these in lower case
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
PART = re.compile(r"[^=]+(?:=+\Z)?")   # between inner "="; padding stays
CUTS, CUT_ALL = (re.compile("[+/]"), re.compile("[_-]")), re.compile("[+/_-]")

MIN_RANDOM = 20
LENGTH_EDGES = (16, 20, 24, 32, 48, 80)   # lower edges of the length classes
BINS, BIN_WIDTH, BEST = 96, 0.25, 16.0    # bins of the evidence per root of length, the best first; the last is open
FDR = 0.01
UNLIKE = 1e-3                             # least combined p-value of the three tests
WIDER = 1.15                              # of the fitted tail
LONGEST_WORD = 40                         # letters of a plain word; what is longer is no writing
NULL_SIZES = tuple(e for e in LENGTH_EDGES if e >= MIN_RANDOM)   # no candidate is shorter
CHUNK = 1 << 16                           # symbols scored at a time
# bytes outside of runs become spaces
_BREAKS = bytes(c if chr(c).isascii() and (chr(c).isalnum() or chr(c) in "+/_=-") else 32 for c in range(256))

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# encodings, smallest alphabet first
ENCODINGS = (
    ("dec", _DIGITS), ("hex", _DIGITS + "abcdef"), ("hexu", _DIGITS + "ABCDEF"), ("lower", _LOWER),
    ("base32", _UPPER + "234567"), ("base36", _DIGITS + _LOWER), ("base36u", _DIGITS + _UPPER),
    ("base62", _DIGITS + _UPPER + _LOWER), ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
)
_SETS = [frozenset(a) for _, a in ENCODINGS]
_TABLES = [np.array([max(a.find(chr(c)), 0) for c in range(128)], np.int32) for _, a in ENCODINGS]
MIXED = 7                                 # encodings from here on have both letter cases
CELLS = 2 * len(LENGTH_EDGES)
NULL_CODES = (5, 8)                       # base36 and base64


def infer_encoding(token: str) -> int | None:
    """Index of the smallest alphabet that holds the token (padding aside)."""
    chars = set(token.rstrip("="))
    return next((k for k, s in enumerate(_SETS) if chars <= s), None)


_ERFC = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368,
         -1.26551223)


def _normal_sf(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution, to a relative 1.2e-7 (Chebyshev
    fit of erfc, Numerical Recipes 6.2)."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + x / 2)
    fit = np.zeros_like(t)
    for c in _ERFC:
        fit = fit * t + c
    tail = t * np.exp(fit - x * x) / 2
    return np.where(z < 0, 1 - tail, tail)


def battery(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Combined p-value of uniform randomness of each token. ``symbols`` holds
    the values 0..k-1 of all tokens one after the other."""
    if not len(starts):
        return np.empty(0)
    m = len(starts)
    counts = np.bincount(np.repeat(np.arange(m), sizes) * k + symbols, minlength=m * k).reshape(m, k)
    high = symbols >= (k + 1) // 2
    first = np.zeros(len(symbols), bool)
    first[starts] = True
    change = np.concatenate([[False], high[1:] != high[:-1]]) & ~first
    follow = np.where(np.append(first[1:], True), 0, np.append(symbols[1:], 0))
    total = lambda x: np.add.reduceat(x.astype(np.int64), starts)
    return _combined(k, sizes, np.einsum("ij,ij->i", counts, counts), total(change) + 1, total(high), total(symbols),
                     total(symbols * symbols), total(symbols * follow), symbols[starts] + symbols[starts + sizes - 1])


def _combined(k, sizes, squares, runs, up, sums, sums2, lagged, ends) -> np.ndarray:
    """The three tests of tokens given by whole numbers: sums of squared symbol
    counts, runs, symbols in the upper half, sums of symbols, of their squares
    and of products of neighbours, first plus last symbol."""
    n = sizes.astype(float)
    chi = squares * k / n - n
    mean, var = k - 1.0, 2 * (k - 1) * (1 - 1 / n)
    shape, scale = mean * mean / var, var / mean
    # Wilson-Hilferty cube root of a gamma variate
    z1 = ((np.maximum(chi, 0) / (shape * scale)) ** (1 / 3) - (1 - 1 / (9 * shape))) * 3 * np.sqrt(shape)
    p1 = _normal_sf(z1)

    pairs = 2 * up * (n - up)
    mu = pairs / n + 1
    sd = np.sqrt(np.maximum(pairs * (pairs - n) / (n * n * np.maximum(n - 1, 1)), 0))
    one_sided = sd == 0   # (almost) all symbols in one half: as unlikely as that is
    z2 = np.where(one_sided, 0.0, (runs - mu) / np.where(one_sided, 1, sd))
    p2 = np.where(one_sided, np.exp2(1 - np.minimum(n, 1000)), 2 * _normal_sf(np.abs(z2)))

    s = sums.astype(float)
    spread = (n * sums2 - s * s) / n
    cov = (n * n * lagged - n * s * (2 * s - ends) + (n - 1) * s * s) / (n * n)
    r = np.where(spread > 0, cov / np.where(spread > 0, spread, 1), 1.0)
    p3 = 2 * _normal_sf(np.abs((r + 1 / n) * np.sqrt(n)))

    logs = -np.log(np.maximum(np.stack([p1, p2, p3]), 1e-300)).sum(0)
    return np.exp(-logs) * (1 + logs + logs * logs / 2)   # chi-squared, 6 degrees


# fixed values of the plain model: shares of digits and other characters, of
# capitals among letters, and of class changes between neighbours
PLAIN_DIGITS, PLAIN_OTHERS, PLAIN_CAPITALS = 0.06, 0.03, 1 / 6
PLAIN_CHANGE = {False: 0.10, True: 0.30}  # one letter case, both
SCALE = 1000                              # evidence is summed in whole thousandths


def _letter_shares() -> np.ndarray:
    """Share of each letter in the reference text, a tenth of it even."""
    from .licenses import SENTENCES

    text = " ".join(form for forms in SENTENCES.values() for form in forms).lower()
    n = np.array([text.count(c) for c in _LOWER], float)
    return 0.9 * n / n.sum() + 0.1 / 26


def _class_of(chars: str) -> np.ndarray:
    return np.array([0 if c in _LOWER else 1 if c in _UPPER else 2 if c in _DIGITS else 3 for c in chars])


def _weights(code: int) -> np.ndarray:
    """weights[previous byte, byte] of an encoding's characters, in thousandths
    (previous 0: the first character)."""
    alphabet = ENCODINGS[code][1]
    k, both, shares = len(alphabet), code >= MIXED, _letter_shares()
    out = np.zeros((128, 128), np.int64)
    kinds = _class_of(alphabet)
    q = 1 - ((np.bincount(kinds, minlength=4) / k) ** 2).sum()
    change = PLAIN_CHANGE[both]
    differ, same = np.log(max(q, 1e-9) / change), np.log((1 - q) / (1 - change))
    codes = np.array([ord(c) for c in alphabet])
    for c, kind in zip(alphabet, kinds):
        if kind < 2:
            plain = (1 - PLAIN_DIGITS - PLAIN_OTHERS) * shares[_LOWER.index(c.lower())]
            if both:
                plain *= PLAIN_CAPITALS if kind else 1 - PLAIN_CAPITALS
        else:
            plain = PLAIN_DIGITS / 10 if kind == 2 else PLAIN_OTHERS / 2
        symbol = np.log(1 / k / plain)
        out[0, ord(c)] = round(SCALE * symbol)
        out[codes, ord(c)] = np.round(SCALE * (symbol + np.where(kinds == kind, same, differ)))
    return out


_CHANGES = [None] * len(ENCODINGS)


def _table(code: int) -> np.ndarray:
    if _CHANGES[code] is None:
        _CHANGES[code] = _weights(code)
    return _CHANGES[code]


def _evidence(raw: bytes, sizes: np.ndarray, code: int) -> np.ndarray:
    """Bin of each token's evidence per root of its length (small: random);
    ``raw`` holds the tokens one after the other."""
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    x = np.frombuffer(raw, np.uint8)
    before = np.concatenate([[0], x[:-1]])
    before[at] = 0
    sums = np.add.reduceat(_table(code)[before, x], at)
    return _bins(sums / SCALE / np.sqrt(sizes))


def _bins(value: np.ndarray) -> np.ndarray:
    return np.clip((BEST - value) / BIN_WIDTH, 0, BINS - 1).astype(np.int32)


def _scores(tokens: list[str], codes: list[int]) -> np.ndarray:
    """Bin of each token under its encoding; the last for those that the three
    tests refuse, and for numbers, which are random to no one."""
    bins = np.full(len(tokens), BINS - 1, np.int32)
    codes_a = np.array(codes)
    for k in set(codes) - {0}:
        at = np.flatnonzero(codes_a == k)
        table = _TABLES[k]
        raw = [tokens[i].rstrip("=") for i in at]
        sizes = np.array([len(t) for t in raw])
        whole = "".join(raw).encode("ascii")
        symbols = table[np.frombuffer(whole, np.uint8)].astype(np.int64)
        p = battery(symbols, np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes, len(ENCODINGS[k][1]))
        bins[at] = np.where(p >= UNLIKE, _evidence(whole, sizes, k), BINS - 1)
    return bins


def _length_class(n: int) -> int:
    return int(np.searchsorted(LENGTH_EDGES, n, "right")) - 1


def _cell(n: int, code: int) -> int:
    """Length class, those of encodings with both letter cases after the others."""
    return _length_class(n) + (len(LENGTH_EDGES) if code >= MIXED else 0)


def base_spans(text: str, runs: list[re.Match]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, by start, then kind. Access
    keys and hex runs of the asked lengths always lie inside a ``RUN``."""
    spans = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    for run in runs:
        at, token = run.start(), run.group()
        if "AKIA" in token:
            spans += [(at + m.start(), at + m.end(), 1) for m in ACCESS.finditer(token)
                      if m.end() - m.start() >= MIN_ACCESS]
        spans += [(at + m.start(), at + m.end(), 2) for m in HEX.finditer(token)
                  if m.end() - m.start() >= MIN_HEX]
    return sorted(spans)


def _readings(token: str) -> list[tuple[int, int, int]]:
    """(start, end, encoding) of the mixed parts of a run without base spans."""
    out = []
    for m in PART.finditer(token):
        if m.end() - m.start() < MIN_RANDOM:
            continue
        part = m.group()
        cuts = [c for c in CUTS if c.search(part)]
        if len(cuts) == 2:
            cuts.append(CUT_ALL)
        places = {(0, len(part))}
        for c in cuts:
            at = 0
            for x in (*c.finditer(part), None):
                places.add((at, x.start() if x else len(part)))
                at = x.end() if x else at
        for start, end in sorted(places):
            t = part[start:end]
            if len(t.rstrip("=")) < MIN_RANDOM:
                continue
            k = infer_encoding(t)
            if k is None or (not any(c.isdigit() for c in t) and t[1:].islower() | t.isupper()):
                continue
            out.append((m.start() + start, m.start() + end, k))
    return out


def _candidates(runs: list[re.Match], spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, encoding) of the mixed tokens outside the base spans."""
    out, i = [], 0
    taken = _union(spans)
    for m in runs:
        start, end, token = m.start(), m.end(), m.group()
        if end - start < MIN_RANDOM:
            continue
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        at, j = start, i
        while j < len(taken) and taken[j][0] < end:
            out += [(at + s, at + e, k) for s, e, k in _readings(token[at - start:max(taken[j][0], at) - start])]
            at = taken[j][1]
            j += 1
        if at < end:
            out += [(at + s, at + e, k) for s, e, k in _readings(token[at - start:])]
    return out


def _union(spans: list[tuple]) -> list[tuple[int, int]]:
    """Spans that overlap become one, by start."""
    out = []
    for s, e, *_ in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _plain(text: str) -> bytes:
    """The plain words of a text (whole runs of encoding characters that are
    letters of one case, a capital first allowed, ``LONGEST_WORD`` at most),
    joined, a capital each."""
    return b"".join([w.capitalize() for w in text.encode("utf-8", "replace").translate(_BREAKS).split()
                     if len(w) <= LONGEST_WORD and w.isalpha() and ((w[1:] or w).islower() or w.isupper())])


class _Null:
    """Counts of plain pieces per cell and bin, scored some at a time."""

    def __init__(self):
        self.counts = np.zeros((CELLS, BINS), np.int64)
        self.pieces = {size: [] for size in NULL_SIZES}
        self.waiting = 0

    def add(self, plain: bytes) -> None:
        for size, kept in self.pieces.items():
            kept.append(plain[:len(plain) // size * size])
        self.waiting += len(plain)
        if self.waiting >= CHUNK:
            self.score()

    def score(self) -> None:
        for size, kept in self.pieces.items():
            text = b"".join(kept)
            kept.clear()
            step = CHUNK // size * size
            for at in range(0, len(text), step):
                part = text[at:at + step]
                sizes = np.full(len(part) // size, size)
                for code, written in zip(NULL_CODES, (part.lower(), part)):
                    self.counts[_cell(size, code)] += np.bincount(_evidence(written, sizes, code), minlength=BINS)
        self.waiting = 0


def reference_counts() -> np.ndarray:
    """Counts per cell and bin of a fixed English text, cut at every letter: the sentences of public licences."""
    from .licenses import SENTENCES

    plain = _plain(" ".join(form for forms in SENTENCES.values() for form in forms))
    null = _Null()
    for size in NULL_SIZES:
        null.pieces[size] = [plain[i:i + size] for i in range(len(plain) - size + 1)]
    null.score()
    return null.counts


def score_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(is_null, cell, bin, n): how many plain pieces and candidates of all
    texts fall into each cell and bin. Summed within each task first."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found = np.zeros((CELLS, BINS), np.int64)
        plain = _Null()
        for b in batches:
            tokens, codes = [], []
            for value in b.column(0):
                text = value.as_py() or ""
                plain.add(_plain(text))
                runs = list(RUN.finditer(text))
                if runs:
                    for start, end, k in _candidates(runs, base_spans(text, runs)):
                        tokens.append(text[start:end])
                        codes.append(k)
            if tokens:
                cells = [_cell(len(t), k) for t, k in zip(tokens, codes)]
                np.add.at(found, (cells, _scores(tokens, codes)), 1)
        plain.score()
        sums = np.stack([found, plain.counts])
        null, cells, bins = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(null == 1), pa.array(cells, pa.int32()), pa.array(bins, pa.int32()),
             pa.array(sums[null, cells, bins], pa.int64())], ["is_null", "cell", "bin", "n"])

    parts = (docs.select(F.col(f"`{text_col}`").alias("text"))
             .mapInArrow(run, "is_null boolean, cell int, bin int, n long"))
    return parts.groupBy("is_null", "cell", "bin").agg(F.sum("n").alias("n"))


def _tails(null: np.ndarray) -> np.ndarray:
    """p-value of each bin of each cell: the normal tail fitted to the cell's
    null pieces by their median and their best sixth (one standard deviation
    below it), which a few odd texts do not move; 0 without pieces."""
    bins = np.arange(null.shape[1])
    n = null.sum(1)
    share = np.cumsum(null, 1) / np.maximum(n, 1)[:, None]
    middle = (share < 0.5).sum(1)
    spread = np.maximum(middle - (share < 0.159).sum(1), 2.0)
    z = (middle[:, None] - 0.5 - bins) / (WIDER * spread)[:, None]
    return np.where(n[:, None] > 0, _normal_sf(z), 0.0)


def cutoffs(counts: list[tuple[bool, int, int, int]], fdr: float = FDR, cells: int = len(LENGTH_EDGES),
            reference: np.ndarray | None = None) -> list[int]:
    """Largest accepted bin per cell (-1: none) by Benjamini-Hochberg. A bin's
    p-value is the larger of the tails of the corpus' own pieces and of the
    reference's; a cell without any pieces accepts nothing."""
    null = np.zeros((cells, BINS))
    cand = np.zeros((cells, BINS))
    for is_null, c, b, n in counts:
        (null if is_null else cand)[c, b] += n
    other = np.zeros_like(null) if reference is None else reference.astype(float)
    p = np.maximum(_tails(null), _tails(other))
    p[(null.sum(1) + other.sum(1)) == 0] = 1.0
    p[:, -1] = 1.0     # the last bin holds what the tests refuse
    total = cand.sum()
    order = np.argsort(p, axis=None, kind="stable")
    seen = np.cumsum(cand.ravel()[order])
    levels = p.ravel()[order]
    # ties share one step: count all candidates with a p-value this small
    last = np.append(levels[1:] != levels[:-1], True)
    good = last & (levels * max(total, 1) <= fdr * np.maximum(seen, 1e-9)) & (seen > 0)
    limit = levels[np.flatnonzero(good)[-1]] if good.any() else -1.0
    return [int(np.count_nonzero(row <= limit)) - 1 for row in p]


def fit_cutoffs(docs: DataFrame, text_col: str = "text", fdr: float = FDR) -> list[int]:
    """One pass over all texts; the driver gets the bounded table of counts and
    adds those of the reference text."""
    rows = score_counts(docs, text_col).collect()
    return cutoffs([(r.is_null, r.cell, r.bin, r.n) for r in rows], fdr, CELLS, reference_counts())


def find_spans(texts: list[str], limits: list[int]) -> list[list[tuple[int, int, int]]]:
    """All spans (start, end, kind) of each text, by start, then kind."""
    found, tokens, codes, where = [], [], [], []
    for t in texts:
        runs = list(RUN.finditer(t))
        spans = base_spans(t, runs)
        for start, end, k in _candidates(runs, spans):
            tokens.append(t[start:end])
            codes.append(k)
            where.append((len(found), start, end))
        found.append(spans)
    random: dict[int, list] = {}
    for (i, start, end), k, b in zip(where, codes, _scores(tokens, codes) if tokens else ()):
        if b <= limits[_cell(end - start, k)]:
            random.setdefault(i, []).append((start, end))
    for i, spans in random.items():
        found[i] += [(s, e, 3) for s, e in _union(spans)]
    return [sorted(s) for s in found]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_random long")


def scan_secrets(docs: DataFrame, limits: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every whole text, one result row per input row.

    A null or empty text has no spans (base_sha256 is that of an empty string);
    repeated rows repeat their result, a null id stays null, an empty table
    gives an empty result, other columns are not read. Row-wise, no shuffle.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            spans = find_spans([v.as_py() or "" for v in b.column(1)], limits)
            counts = [[sum(k == kind for _, _, k in s) for s in spans] for kind in range(4)]
            sha = [hashlib.sha256(_joined([x for x in s if x[2] < 3]).encode()).hexdigest() for s in spans]
            cols = [b.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(sha, pa.string()),
                    pa.array([_joined(s) for s in spans], pa.string()), pa.array(counts[3], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                cols, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    src = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    return src.mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, limits: list[int], text_col: str = "text") -> DataFrame:
    """All rows and columns, with every span of the text replaced by
    ``[kind]`` (overlapping spans become one, named by the first). A null text
    stays null."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def masked(texts):
        import pandas as pd

        values = [t if isinstance(t, str) else None for t in texts]
        out = []
        for t, spans in zip(values, find_spans([t or "" for t in values], limits)):
            if not spans:
                out.append(t)
                continue
            parts, at = [], 0
            for start, end, kind in spans:
                if start >= at:
                    parts += [t[at:start], f"[{KINDS[kind]}]"]
                at = max(at, end)
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, masked(F.col(f"`{text_col}`")))
