"""Portuguese stems: published samples, and a plain reading of the rules on made words."""

import random
import re

from pyspark.sql import functions as F

from quarry.functions import stemming as S

# sample words and stems published with the algorithm
SAMPLES = """boa boa boainain boainain boas boas bôas bôas boassu boassu boataria boat boate boat boates boat boatos boat
bob bob boba bob bobagem bobag bobagens bobagens bobalhões bobalhõ bobear bob bobeira bobeir bobinho bobinh bobinhos bobinh
bobo bob bobs bobs boca boc bocadas boc bocadinho bocadinh bocado boc bocaiúva bocaiúv boçal boçal bocarra bocarr bocas boc
bode bod bodoque bodoqu body body boeing boeing boem boem boemia boem boêmio boêmi bogotá bogot boi boi bóia bói boiando boi
quiabo quiab quicaram quic quickly quickly quieto quiet quietos quiet quilate quilat quilates quilat quilinhos quilinh
quilo quil quilombo quilomb quilométricas quilométr quilométricos quilométr quilômetro quilômetr quilômetros quilômetr
quilos quil quimioterapia quimioterap quimioterápicos quimioteráp quimono quimon quincas quinc quinhão quinhã
quinhentos quinhent quinn quinn quino quin quinta quint quintal quintal quintana quintan quintanilha quintanilh
quintão quintã quintessência quintessent quintino quintin quinto quint quintos quint quintuplicou quintuplic quinze quinz
quinzena quinzen quiosque quiosqu""".split()


def plain(word):
    """The rules read one by one on a Python string."""
    w = word.replace("ã", "a~").replace("õ", "o~")
    v = set(S.VOWELS)

    def after_vc(start):
        for i in range(start + 1, len(w)):
            if w[i] not in v and w[i - 1] in v:
                return i + 1
        return len(w)

    p1 = after_vc(0)
    p2 = after_vc(p1)
    pv = len(w)
    if len(w) > 1:
        if w[1] not in v:
            pv = next((i + 1 for i in range(2, len(w)) if w[i] in v), len(w))
        elif w[0] in v:
            pv = next((i + 1 for i in range(2, len(w)) if w[i] not in v), len(w))
        else:
            pv = min(3, len(w))

    def longest(t, names, lo=0):
        found = [x for x in names if t.endswith(x) and len(t) - len(x) >= lo]
        return max(found, key=len) if found else None

    def standard():
        x = longest(w, S._STANDARD)
        if x is None:
            return None
        b = w[:len(w) - len(x)]
        n = len(b)
        drop = lambda t, names: t[:len(t) - len(y)] if (y := longest(t, names)) and len(t) - len(y) >= p2 else t
        if x in S.IRA:
            return b + "ir" if n >= pv and b.endswith("e") else None
        if x == "amente":
            if n < p1:
                return None
            y = longest(b, ["iv", "os", "ic", "ad"])
            if y is None or n - 2 < p2:
                return b
            return drop(b[:-2], ["at"]) if y == "iv" else b[:-2]
        if n < p2:
            return None
        for names, new in ((S.TO_LOG, "log"), (S.TO_U, "u"), (S.TO_ENTE, "ente")):
            if x in names:
                return b + new
        names = {"mente": ["ante", "avel", "ível"]}.get(x) or (["abil", "ic", "iv"] if x in S.IDADE else ["at"] if x in S.IVO else [])
        return drop(b, names) if names else b

    out = standard()
    if out is None:
        x = longest(w, S.VERB, pv)
        out = w[:len(w) - len(x)] if x else None
    if out is not None:
        if out.endswith("ci") and len(out) - 1 >= pv:
            out = out[:-1]
    else:
        x = longest(w, S.RESIDUAL)
        out = w[:len(w) - len(x)] if x and len(w) - len(x) >= pv else w
    if out[-1:] in ("e", "é", "ê") and out:
        if len(out) - 1 >= pv:
            out = out[:-1]
            if out[-2:] in ("gu", "ci") and len(out) - 1 >= pv:
                out = out[:-1]
    elif out.endswith("ç"):
        out = out[:-1] + "c"
    return out.replace("a~", "ã").replace("o~", "õ")


def stems(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    return [r.s for r in df.select(S.portuguese_stem(F.col("w")).alias("s")).collect()]


def test_published_samples(spark):
    words, want = SAMPLES[::2], SAMPLES[1::2]
    assert dict(zip(words, stems(spark, words))) == dict(zip(words, want))


def test_rules_on_made_words(spark):
    rng = random.Random(5)
    heads = ["", "a", "qu", "nacion", "signific", "ag", "rápid", "possibil", "at", "compreens", "ç", "gu", "c", "ativ", "lev", "mãe", "õ", "x"]
    tails = ["", *S._STANDARD, *S.VERB, *S.RESIDUAL, "e", "ê", "ativamente", "icidade", "abilidade", "antemente", "eiras", "ção", "guê", "cie", "aç"]
    tails = [t.replace("a~", "ã").replace("o~", "õ") for t in tails]
    words = [rng.choice(heads) + rng.choice(heads) + rng.choice(["", "", "e", "at", "iv"]) + rng.choice(tails) for _ in range(3000)]
    words = sorted({w for w in words if w})
    got = dict(zip(words, stems(spark, words)))
    assert {w: s for w, s in got.items() if s != plain(w)} == {}
    assert stems(spark, [None, ""]) == [None, ""]


def test_plan_is_without_python(spark):
    df = spark.createDataFrame([("casas",)], "w string").select(S.portuguese_stem(F.col("w")))
    assert not re.search("Python|Arrow", df._jdf.queryExecution().executedPlan().toString())
