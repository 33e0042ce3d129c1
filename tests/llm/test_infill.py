"""Cuts of the rank index, forms and round trips against the token pattern itself."""

import hashlib
import random
import re

import numpy as np
import pytest

from quarry.llm import infill as P

TOKEN = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_row(doc_id, text):
    text = text or ""
    toks = TOKEN.findall(text)
    n = len(toks)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(toks[:a]), "".join(toks[a:b]), "".join(toks[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        form, out = "plain", text
    elif h4 % 100 < 80:
        form, out = "spm", f"<S>{suf}<P>{pre}<M>{mid}"
    else:
        form, out = "psm", f"<P>{pre}<S>{suf}<M>{mid}"
    plain = form == "plain"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc_id, n, form, None if plain else len(pre), None if plain else len(mid), sha(out), sha(text)


def made(rng, t):
    if t % 10 == 0:
        return " ".join("x" * int(rng.paretovariate(.6) % 9000) for _ in range(700))
    return "".join(rng.choice(" \t\n\x0babéü€😀\x1c\xa0<>PSM") for _ in range(rng.randrange(0, 90)))


def test_boundaries_and_every_cut():
    rng = random.Random(1)
    for t in range(400):
        text = made(rng, t)
        want = [0]
        for tok in TOKEN.findall(text):
            want.append(want[-1] + len(tok.encode()))
        offsets = P.boundaries(text.encode())
        assert offsets.tolist() == want
        index = P.fit(offsets)
        assert index.size == len(want) - 1
        assert [index.cut(k) for k in range(len(want))] == want


@pytest.mark.parametrize("error", [1, 5, 100, 126])
def test_segments_are_within_the_error_and_maximal(error):
    rng = np.random.default_rng(error)
    offsets = np.concatenate([[0], np.cumsum(rng.integers(1, 30, 5000)), 200_000 + np.cumsum(rng.integers(1, 3, 5000))])
    x = P.fit(offsets, error)
    assert np.abs(x.residual.astype(int)).max() <= error + 1
    assert len(x.first) < len(offsets) / max(3, error)
    ends = [*x.first[1:].tolist(), len(offsets)]
    for s, e in zip(x.first.tolist(), ends):   # one more offset would leave no slope
        if e < len(offsets):
            k, y = np.arange(1, e - s + 1), offsets[s + 1:e + 1] - offsets[s]
            assert ((y - error) / k).max() > ((y + error) / k).min()


def test_round_trip_of_both_forms():
    rng = random.Random(3)
    for t in range(500):
        text = made(rng, t).replace("<P>", "").replace("<S>", "").replace("<M>", "")
        if any(m in text for m in ("<P>", "<S>", "<M>")):
            continue
        data = text.encode()
        a, b = sorted(rng.choice(P.boundaries(data)) for _ in "ab")
        for form in ("psm", "spm", "plain"):
            assert P.restore(form, P.assemble(form, data[:a], data[a:b], data[b:])) == data
    assert P.restore("psm", b"<P><P<S><S<M><M") == b"<P<M<S"


def test_rows_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, made(rng, i)) for i in range(300)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a <P> b"), (None, "null id here"), (904, rows[7][1]), (904, rows[7][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, form string").repartition(3)
    cols = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    got = sorted(map(tuple, P.fill_in_middle(df).select(cols).collect()), key=str)
    assert got == sorted((brute_row(*r) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    with_text = P.fill_in_middle(df, with_output=True).collect()
    assert all(hashlib.sha256(r.output.encode()).hexdigest() == r.output_sha256 for r in with_text)
    assert P.fill_in_middle(df.limit(0)).count() == 0


def test_index_as_a_table(spark):
    rows = [(1, "one two  three\n"), (2, None), (3, "x" * 5000 + " y" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in P.build_index(df).collect():
        offsets = P.boundaries((dict(rows)[r.doc_id] or "").encode()).tolist()
        index = P.read_index(r)
        assert [index.cut(k) for k in range(index.size + 1)] == offsets
