"""Base spans by the plain patterns, and the battery on planted strings."""

import base64
import hashlib
import random
import re

import numpy as np

from quarry.llm import secrets as S

PLAIN = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                               re.I | re.A), 2, 12),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile(r"[0-9a-f]+"), 0, 16))


def brute(text):
    found = []
    for k, (kind, pat, g, least) in enumerate(PLAIN):
        found += [(m.start(), k, kind, m.end()) for m in pat.finditer(text) if len(m.group(g)) >= least]
    return [f"{kind}:{s}:{e}" for s, _, kind, e in sorted(found)]


def docs(n=400, seed=3):
    rng = random.Random(seed)
    syll = ["ti", "on", "er", "the", "an", "re", "he", "in", "ed", "ble", "sh", "ou"]
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.choice([1, 2, 3, 4, 8, 10])))
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(0, 120))]
        if i % 5 == 0:
            w.append(rng.choice(["password", "API_KEY", "apikey", "Token"]) + rng.choice(["=", ": ", "\": \""])
                     + "".join(rng.choice("ABCxyz019_") for _ in range(rng.randint(8, 20))))
        if i % 7 == 0:
            w.append("AKIA" + "".join(rng.choice("ABCDEFGH0123") for _ in range(rng.randint(10, 18))))
        if i % 6 == 0:
            w.append("".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(10, 40))) + "ñ")
        if i % 9 == 0:
            w.append(base64.b64encode(rng.randbytes(30)).decode())
        rng.shuffle(w)
        out.append((i, " ".join(w)))
    return out


def test_base_spans_and_battery(spark):
    rows = docs() + [(900, None), (901, ""), (902, "token=secret=abcdefghijklmnop"), (902, "toKen=x"),
                     (None, "password = 'abcdefghijklmnop'"), (903, "x" * 100_000 + " tokſn=aaaaaaaaaaaaaa")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    limits = S.fit_cutoffs(df)
    got = S.scan_secrets(df, limits).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.spans): r for r in got}
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(hashlib.sha256(",".join(brute(t or "")).encode()).hexdigest())
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append(r.base_sha256)
    assert {k: sorted(v) for k, v in want.items()} == {k: sorted(v) for k, v in have.items()}
    planted = [r for r in got if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 9 == 0]
    assert sum("random:" in r.spans for r in planted) >= 0.6 * len(planted)
    assert not any("random:" in r.spans for r in got if r.doc_id is not None and r.doc_id % 9 and r.doc_id < 900)
    assert by


def test_combined_p_is_uniform_for_random_tokens():
    rng = random.Random(1)
    for name, alphabet in (S.ENCODINGS[1], S.ENCODINGS[7]):
        toks = ["".join(rng.choice(alphabet) for _ in range(64)) for _ in range(2000)]
        vals = {c: i for i, c in enumerate(alphabet)}
        import numpy as np

        sym = np.array([vals[c] for t in toks for c in t])
        sizes = np.full(2000, 64)
        p = S.battery(sym, np.arange(2000) * 64, sizes, len(alphabet))
        assert abs((p < 0.5).mean() - 0.5) < 0.06 and (p < 0.01).mean() < 0.03, name


def test_step_up():
    assert S.cutoffs([]) == [-1] * len(S.LENGTH_EDGES)
    assert S.cutoffs([(False, 2, 0, 5)]) == [-1] * len(S.LENGTH_EDGES)
    limits = S.cutoffs([(True, 3, 30, 10_000), (False, 3, 1, 20), (False, 3, 40, 100)])
    assert 1 <= limits[3] < 30


def test_redaction_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a password=abcdefghijkl z", "en"), (2, None, "x"), (3, "", None)],
                               "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in S.redact(df, [-1] * 6).collect()}
    assert got[1].text == "a [assign] z" and got[1].spans == "en"
    assert got[2].text is None and got[3].text == ""
    assert S.scan_secrets(df.limit(0), [-1] * 6).count() == 0


def test_parts_of_runs_are_found():
    """Planted as KEY=value, in a path, and beside base spans."""
    rng = random.Random(4)
    limits = [S.BINS] * S.CELLS   # every candidate counts
    for n in (20, 24, 40, 64):
        for name, alphabet in S.ENCODINGS[7:]:
            t = "a1B" + "".join(rng.choice(alphabet) for _ in range(n - 4)) + "Z"
            if any(len(h.group()) >= S.MIN_HEX for h in S.HEX.finditer(t)):
                continue
            for before, after in (("auth=", ""), ("AWS_SECRET_ACCESS_KEY=", ""), ("a=b=", "="), ("/v1/keys_x/", ""),
                                  ("/v1/keys-x+y/", "?q"), ("auth=", "/AKIA" + "A" * 20), ("0123456789abcdef=", "")):
                text = f"x {before}{t}{after} y"
                at = len(before) + 2
                spans = [s for s in S.find_spans([text], limits)[0] if s[2] == 3]
                assert any(s <= at and at + n <= e for s, e, _ in spans), (name, text, spans)
    # what is cut away is not part of the span, and overlapping readings are one
    token = "Zx8kQ2mN7vB4tR9pL3sW6yH1"
    assert S.find_spans([f"auth={token}"], limits) == [[(5, 29, 3)]]
    assert S.find_spans([f"/v1/keys_x/{token}"], limits) == [[(9, 35, 3)]]   # x/ by its own reading
    assert S.find_spans([f"{token}/{token}"], limits) == [[(0, 49, 3)]]
    assert S.find_spans(["plain/words_and=more-plain-words-of-any-length"], limits) == [[]]


def _keys(rng, code, n, count):
    return ["".join(rng.choice(S.ENCODINGS[code][1]) for _ in range(n)) for _ in range(count)]


def test_verdict_does_not_vanish_with_corpus_size(spark):
    """Keys drawn at random, in one short text, in few and in many texts, with
    and without plain words of 16 letters, with and without any plain words."""
    rng = random.Random(8)
    keys = _keys(rng, 7, 64, 20) + _keys(rng, 7, 24, 20)
    plain = [(i, " ".join(rng.choice(["the", "cat", "sat", "Upon", "a", "mat", "before", "dawn"]) for _ in range(90)))
             for i in range(300)]
    for others in ([], plain[:3], plain, [(1, "0 1 2; 3")], [(1, "an internationalization of institutionalisation")]):
        df = spark.createDataFrame([*others, *[(900 + i, f"key={k}") for i, k in enumerate(keys)]], "doc_id long, text string")
        got = S.scan_secrets(df, S.fit_cutoffs(df)).filter("doc_id >= 900").collect()
        assert sum(r.spans == f"random:4:{4 + len(keys[r.doc_id - 900])}" for r in got) >= 0.95 * len(keys), len(others)


WORDS = ("get set value index table name user count list map string buffer reader writer factory request response handler "
         "manager session context service element attribute collection iterator parser token stream file path config option "
         "error message event listener adapter provider builder query result column row schema table format document").split()


def _identifier(rng):
    t = rng.choice(WORDS)
    while len(t) < rng.randrange(20, 45):
        t += rng.choice(WORDS).capitalize()
    return t + rng.choice(["", "2", "V1", "64", "Impl"])


def _found(keys, others, reference):
    texts = [f"auth={k} and" for k in keys] + [f"call {t} now" for t in others]
    tokens, codes = [], []
    for t in texts:
        runs = list(S.RUN.finditer(t))
        for a, b, k in S._candidates(runs, S.base_spans(t, runs)):
            tokens.append(t[a:b])
            codes.append(k)
    counts = [(False, S._cell(len(t), k), int(b), 1) for t, k, b in zip(tokens, codes, S._scores(tokens, codes))]
    counts += [(True, int(c), int(b), int(reference[c, b])) for c, b in zip(*np.nonzero(reference))]
    spans = S.find_spans(texts, S.cutoffs(counts, cells=S.CELLS))
    hit = [any(k == 3 for _, _, k in s) for s in spans]
    return sum(hit[:len(keys)]), sum(hit[len(keys):])


def test_recall_by_length_and_false_rate():
    """Keys drawn at random, never chosen by score: many in a corpus, and two among 300 identifiers."""
    rng, reference = random.Random(12), S.reference_counts()
    false = shown = 0
    for code in (7, 8, 5, 2, 4):     # base62, base64, base36, upper hex, base32
        for n in (20, 24, 28, 32, 40, 64):
            keys = _keys(rng, code, n, 60)
            hits, wrong = _found(keys, [_identifier(rng) for _ in range(20)], reference)
            assert hits >= (0.9 if n < 32 else 0.95) * 60, (code, n, hits)
            false, shown = false + wrong, shown + 20
            alone = 0
            for i in range(0, 20, 2):
                two, wrong = _found(keys[i:i + 2], [_identifier(rng) for _ in range(300)], reference)
                alone, false, shown = alone + two, false + wrong, shown + 300
            assert alone >= (16 if n == 20 else 18), (code, n, alone)
    assert false <= 0.001 * shown


def test_numbers_and_patterned_strings_are_not_random():
    reference = S.reference_counts()
    rng = random.Random(2)
    plain = ["12345678901234567890123", "2024011512345678901234", "abcdefghijklmnop0123456789", "AAAAAAAAAABBBBBBBBBB111",
             "report20240115123456789012", "0123456789ABCDEF0123456789ABCDEF", "aaaaaaaaaaaaaaaaaaaaaaaaa1", "Xx1Xx1Xx1Xx1Xx1Xx1Xx1Xx1"]
    assert _found(_keys(rng, 7, 32, 3), plain, reference) == (3, 0)


def test_tail_of_the_null_is_calibrated():
    """Of plain pieces of another text, at most about the stated share lies beyond a fitted tail."""
    rng, reference = random.Random(3), S.reference_counts()
    p = S._tails(reference.astype(float))
    text = "".join(_identifier(rng) for _ in range(6000)).encode()
    text = bytes(c for c in text if chr(c).isalpha())
    for size in S.NULL_SIZES[:3]:
        sizes = np.full(len(text) // size, size)
        raw = text[:len(sizes) * size]
        for code, written in zip(S.NULL_CODES, (raw.lower(), raw)):
            got = p[S._cell(size, code)][S._evidence(written, sizes, code)]
            for level in (1e-2, 1e-3, 1e-4):
                assert (got <= level).mean() <= 2 * level + 5 / len(sizes), (size, code, level, (got <= level).mean())


def test_null_is_all_plain_words():
    assert S._plain("The cat's ÉTÉ sat I a x1 wiFi DAWN a-b café=") == b"TheCatSTSatIADawnCaf"
    plain = S._plain("the quick brown fox jumps over the lazy dog " * 4000)
    null, want = S._Null(), np.zeros((S.CELLS, S.BINS), int)
    null.add(plain)
    for size in S.NULL_SIZES:
        pieces = [plain[i:i + size] for i in range(0, len(plain) - size + 1, size)]
        for code, written in ((5, [p.lower() for p in pieces]), (8, pieces)):
            for w in written:
                want[S._cell(size, code), S._evidence(w, np.array([size]), code)[0]] += 1
    null.score()
    assert (null.counts == want).all() and S.reference_counts().sum(1)[[1, 2, 3, 4, 5, 7, 8, 9, 10, 11]].min() > 1000


def test_normal_tail():
    from math import erfc, sqrt

    z = np.linspace(-6, 12, 999)
    assert np.allclose(S._normal_sf(z), [erfc(v / sqrt(2)) / 2 for v in z], rtol=2e-7, atol=0)
