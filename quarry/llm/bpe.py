"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece the BPE encoding has exactly one last token. That
token t (ending at i) is the one whose predecessor -- the stored last token of
the prefix ending at i - len(t) -- forms a valid pair with it: the merges of
the two tokens' joined bytes give back just these two tokens. One left-to-right
pass stores the last token of each prefix; walking back from the end gives the
encoding. Appending bytes extends the table and never changes stored entries;
an edit only invalidates the entries from the edit on.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame

from .common import worker_store

CACHED_PIECES = 200_000   # bound of each generation of a worker's known pieces
CACHED_PAIRS = 400_000    # ... and of its pair table
CACHED_PIECE_CHARS = 64   # longer pieces are encoded afresh each time
CHUNK_CHARS = 1 << 20     # texts whose new pieces are encoded together, in order

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """Read a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PrefixEncoder:
    """Encodes and decodes by the ranks of a byte-level BPE vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.no_rank = max(self.bytes_of, default=0) + 2
        self.split = regex.compile(pattern).findall
        self.longest = max(map(len, ranks), default=1)
        # every ending of a token: the token it is itself, or -1; looking back
        # from a prefix's end stops at the first that is not here
        self.ending = dict.fromkeys((t[k:] for t in ranks for k in range(len(t))), -1) | ranks
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}   # the generation before; pieces seen again move up

    def merge(self, data: bytes, until: int = 1) -> list[bytes]:
        """Merge a short byte string by rank, leftmost first, until at most
        ``until`` parts are left or nothing merges."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte
        and for a token that the merges of its own bytes do not reach."""
        if token not in self.made_of:
            parts = self.merge(self.bytes_of[token], 2)
            whole = len(parts) == 2 and self.ranks.get(parts[0] + parts[1]) == token
            self.made_of[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if whole else None
        return self.made_of[token]

    def reachable(self, token: int) -> bool:
        """Whether the merges of the token's own bytes end in the token."""
        return len(self.bytes_of[token]) == 1 or self.halves(token) is not None

    def valid_pair(self, a: int, b: int) -> bool:
        """Whether the merges of the joined bytes end in these two tokens: no
        merge across the border comes before the merges on either side. The
        merges next to the border are undone from the last to the first; a
        merge across must not outrank the one undone before. Of equal ranks
        the left one goes first."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.reachable(b) and self._no_merge_across(a, b)
        return known

    def _no_merge_across(self, left: int, right: int) -> bool:
        ranks, bytes_of = self.ranks, self.bytes_of
        limit = self.no_rank
        while True:
            across = ranks.get(bytes_of[left] + bytes_of[right])
            if across is not None and across < limit:
                return False
            from_left, from_right = self.halves(left), self.halves(right)
            if from_left is None and from_right is None:
                return True
            if from_right is None or (from_left is not None and left > right):
                limit, left = left, from_left[1]
            else:
                limit, right = right + 1, from_right[0]

    def extend(self, data: bytes, last: list[int], upto: int | None = None) -> list[int]:
        """Fill ``last`` (one entry per prefix already known) up to all of
        ``data``, or its first ``upto`` bytes."""
        ending, longest, pairs = self.ending.get, self.longest, self.pairs
        for end in range(len(last) + 1, (len(data) if upto is None else upto) + 1):
            found = []
            for start in range(end - 1, max(-1, end - 1 - longest), -1):
                t = ending(data[start:end])
                if t is None:
                    break
                if t >= 0:
                    found.append((start, t))
            while found:
                start, t = found.pop()
                if start == 0:
                    if self.reachable(t):
                        break
                else:
                    before = last[start - 1]
                    fits = pairs.get((before, t))
                    if self.valid_pair(before, t) if fits is None else fits:
                        break
            else:
                raise ValueError("the vocabulary does not cover this byte")
            last.append(t)
        return last

    def walk_back(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            t = last[end - 1]
            out.append(t)
            end -= len(self.bytes_of[t])
        out.reverse()
        return out

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8")
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.walk_back(self.extend(data, []))

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known yet, in byte order: a piece
        shares the stored prefixes of the one before it and only appends the rest."""
        if len(self.pieces) > CACHED_PIECES:
            self.older, self.pieces = self.pieces, {}
        known, older = self.pieces, self.older
        fresh = []
        for p in pieces.difference(known):
            ids = older.get(p)
            if ids is not None:
                known[p] = ids
            elif len(p) <= CACHED_PIECE_CHARS:
                fresh.append(p.encode("utf-8"))
        fresh.sort()
        before, last, ranks = b"", [], self.ranks
        for data in fresh:
            whole = ranks.get(data)
            if whole is not None:
                known[data.decode("utf-8")] = [whole]
                continue
            shared = 0
            for a, b in zip(before, data):
                if a != b:
                    break
                shared += 1
            del last[shared:]
            known[data.decode("utf-8")] = self.walk_back(self.extend(data, last))
            before = data

    def join(self, pieces: list[str]) -> list[int]:
        """Token ids of a text's pieces, those not known encoded on the way."""
        known = self.pieces
        try:
            return list(chain.from_iterable(map(known.__getitem__, pieces)))
        except KeyError:
            return [t for p in pieces for t in known.get(p) or self.encode_piece(p)]

    def encode(self, text: str) -> list[int]:
        """Token ids of ``text``; each match of the split pattern separately."""
        pieces = self.split(text)
        self.learn(set(pieces))
        return self.join(pieces)

    def encode_all(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """Token ids of each text; new pieces of some texts are learnt together."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self.split(text))
            size += len(text)
            if size >= CHUNK_CHARS:
                yield from self._joined(held)
                held, size = [], 0
        yield from self._joined(held)

    def _joined(self, held: list[list[str]]) -> Iterator[list[int]]:
        self.learn(set(chain.from_iterable(held)))
        for pieces in held:
            yield self.join(pieces)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTable:
    """The stored last tokens of one piece, for appends and edits."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact append: stored prefixes keep their last tokens."""
        self.data += more
        self.encoder.extend(self.data, self.last)

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace bytes [start, end). Prefixes up to ``start`` are kept, and
        the recomputation returns to the old table as soon as the states after
        the edit agree over a whole token length; returns the bytes redone."""
        old, tail, shift = self.last, self.data[end:], start + len(new) - end
        self.data = self.data[:start] + new + tail
        self.last = old[:start]
        agree, done = 0, 0
        while len(self.last) < len(self.data):
            at = len(self.last)
            self.encoder.extend(self.data, self.last, at + 1)
            done += 1
            before = at - shift
            same = at >= start + len(new) and old[before] == self.last[at]
            agree = agree + 1 if same else 0
            if agree >= self.encoder.longest:
                self.last += old[before + 1:]
                break
        return done

    def ids(self) -> list[int]:
        whole = self.encoder.ranks.get(self.data)
        return [whole] if whole is not None else self.encoder.walk_back(self.last)


def _encoder(ranks_key: str, lines: bytes, pattern: str) -> PrefixEncoder:
    store = worker_store("bpe")
    key = ("bpe", ranks_key, pattern)
    if key not in store:
        ranks = {base64.b64decode(a): int(b)
                 for a, b in (line.split() for line in lines.splitlines() if line.strip())}
        store[key] = PrefixEncoder(ranks, pattern)
    return store[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every whole text, decode the ids again, and return per row:
    doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space),
    decoded_sha256 (of the decoded bytes) and, on request, the ids.

    A null or empty text has no tokens. Rows keep their number: repeated rows
    give repeated results, a null id stays null, and an empty table gives an
    empty result. Other columns of the input are not read.

    The rank file is read on the driver (a vocabulary: its size does not depend
    on the corpus) and shipped with the tasks; no shuffle is needed.
    """
    with open(ranks_path, "rb") as f:
        lines = f.read()
    ranks_key = hashlib.sha256(lines).hexdigest()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = _encoder(ranks_key, lines, pattern)
        decimal = [str(i) for i in range(max(enc.bytes_of, default=0) + 1)]
        for b in batches:
            n, ids_sha, dec_sha, all_ids = [], [], [], []
            for ids in enc.encode_all(value.as_py() or "" for value in b.column(1)):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                dec_sha.append(hashlib.sha256(enc.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                    pa.array(dec_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    src = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"`{text_col}` AS text")
    return src.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
