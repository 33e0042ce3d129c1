"""Prefix encoder against the tiktoken library, exact round trips and edits."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers as P
from quarry.llm.bpe import PrefixEncoder, PrefixTable, encode_documents, load_ranks

RANKS = load_ranks(P.path("byte_bpe_50k.tiktoken"))
ENC = PrefixEncoder(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text(alphabet="ab AB01 \n\t'streo!", max_size=200)))
def test_same_ids_as_library(text):
    import tiktoken

    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    ids = ENC.encode(text)
    assert ids == ref.encode_ordinary(text)
    assert ENC.decode(ids) == text.encode()


def test_long_pieces(reference):
    rng = random.Random(5)
    for text in (" " * 3000, "a" * 5000, "=" * 999, "".join(rng.choice("abcdefghij") for _ in range(20000)),
                 "\n" * 700 + "x", "é" * 500, "0123456789" * 300):
        assert ENC.encode(text) == reference.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcdetion", max_size=60), st.integers(0, 60), st.integers(0, 10),
       st.text(alphabet="abcdetion", max_size=6))
def test_append_and_edit_are_exact(text, at, gone, new):
    t = PrefixTable(ENC, text[:10].encode())
    t.append(text[10:].encode())
    assert t.last == ENC.extend(text.encode(), [])
    at = min(at, len(text))
    t.edit(at, min(len(text), at + gone), new.encode())
    want = text[:at] + new + text[min(len(text), at + gone):]
    assert t.last == ENC.extend(want.encode(), []) and t.data == want.encode()


def test_edit_far_from_the_end_redoes_little():
    data = b"information and retrieval " * 400
    t = PrefixTable(ENC, data)
    assert t.edit(100, 103, b"xyz") < 500
    assert t.last == ENC.extend(data[:100] + b"xyz" + data[103:], [])


def test_documents(spark, reference):
    rows = [(1, "Hello there, world's end", "en"), (1, "Hello there, world's end", "en"), (2, None, "x"),
            (3, "", "y"), (None, "naïve ß 漢字", None), (4, "x" * 50000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_documents(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True).collect()
    assert len(got) == len(rows)
    for (i, text, _), r in zip(rows, got):
        ids = reference.encode_ordinary(text or "")
        assert (r.doc_id, r.n_tokens, list(r.ids)) == (i, len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert encode_documents(df.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_small_generations_and_chunks(reference, monkeypatch):
    """Pieces learnt in order, forgotten and learnt again give the ids of the library."""
    from quarry.llm import bpe

    monkeypatch.setattr(bpe, "CACHED_PIECES", 40)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 300)
    rng = random.Random(6)
    syllables = ["ther", "e", "on", "and", "ing", "é", "ß", "x" * 70, "1", " "]
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(rng.randrange(0, 60))) for _ in range(120)]
    enc = PrefixEncoder(RANKS, P.PATTERN)
    assert list(enc.encode_all(texts)) == [reference.encode_ordinary(t) for t in texts]
    assert [enc.encode(t) for t in texts] == [reference.encode_ordinary(t) for t in texts]
    assert list(enc.encode_all([])) == []


def test_edit_copies_no_prefix():
    """An edit early in a long piece is redone without copying the prefix for every byte."""
    import time

    data = b"abcdetion" * 40_000
    t = PrefixTable(ENC, data)
    began = time.process_time()
    t.edit(5, 6, b"zz")
    assert time.process_time() - began < 5 and t.last == ENC.extend(data[:5] + b"zz" + data[6:], [])
