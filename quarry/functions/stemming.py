"""Portuguese stemming after the published Snowball rules, as Spark column
expressions (no Python UDF).

The suffix lists are fixed values of the published algorithm. ã and õ are
written a~ and o~ on the way, as there. Regions start after p1 (R1), p2 (R2) and
pv (RV) letters; a suffix is in a region when it starts at or after that place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

VOWELS = "aeiouáéíóúâêô"

# fixed values: suffixes by what is done with them
DELETE_R2 = ("eza ezas ico ica icos icas ismo ismos ável ível ista istas oso osa osos osas amento amentos imento imentos "
             "adora ador aça~o adoras adores aço~es ante antes ância").split()
TO_LOG, TO_U, TO_ENTE = "logia logias".split(), "uça~o uço~es".split(), "ência ências".split()
IDADE, IVO, IRA = "idade idades".split(), "iva ivo ivas ivos".split(), "ira iras".split()
VERB = ("ada ida ia aria eria iria ará ara erá era irá ava asse esse isse aste este iste ei arei erei irei am iam ariam "
        "eriam iriam aram eram iram avam em arem erem irem assem essem issem ado ido ando endo indo ara~o era~o ira~o ar er "
        "ir as adas idas ias arias erias irias arás aras erás eras irás avas es ardes erdes irdes ares eres ires asses "
        "esses isses astes estes istes is ais eis íeis aríeis eríeis iríeis áreis areis éreis ereis íreis ireis ásseis "
        "ésseis ísseis áveis ados idos ámos amos íamos aríamos eríamos iríamos áramos éramos íramos ávamos emos aremos "
        "eremos iremos ássemos êssemos íssemos imos armos ermos irmos eu iu ou ira iras").split()
RESIDUAL = "os a i o á í ó".split()

_STANDARD = [*DELETE_R2, *TO_LOG, *TO_U, *TO_ENTE, "amente", "mente", *IDADE, *IVO, *IRA]
_AFTER_VC = f"^.*?[{VOWELS}][^{VOWELS}](.*)$"
_RV = f"^(?:.[^{VOWELS}][^{VOWELS}]*[{VOWELS}]|[{VOWELS}][{VOWELS}]+[^{VOWELS}]|[^{VOWELS}][{VOWELS}].)(.*)$"


def ending(suffixes: list[str]) -> str:
    """Pattern of the longest of the suffixes that ends a word."""
    return "(" + "|".join(sorted(suffixes, key=lambda s: (-len(s), s))) + ")$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cut(w: Column, suffix: Column) -> Column:
    return F.left(w, F.length(w) - F.length(suffix))


def _drop(w: Column, pattern: str, region: Column) -> Column:
    """``w`` without its longest ending of the pattern, if that is in the region."""
    return _let(F.regexp_extract(w, pattern, 1), lambda x: F.when(
        (x != "") & (F.length(w) - F.length(x) >= region), _cut(w, x)).otherwise(w))


def _standard(s: Column) -> Column:
    """Step 1; NULL if it does not apply."""
    w, p1, p2, pv = s["w"], s["p1"], s["p2"], s["pv"]

    def act(x: Column) -> Column:
        base = _cut(w, x)

        def on(b: Column) -> Column:
            n = F.length(b)
            adverb = _let(F.regexp_extract(b, "(iv|os|ic|ad)$", 1), lambda y: F.when(
                (y == "") | (n - 2 < p2), b).when(y == "iv", _drop(_cut(b, y), "(at)$", p2)).otherwise(_cut(b, y)))
            in_r2 = n >= p2
            return (F.when(x.isin(*DELETE_R2) & in_r2, b)
                    .when(x.isin(*TO_LOG) & in_r2, F.concat(b, F.lit("log")))
                    .when(x.isin(*TO_U) & in_r2, F.concat(b, F.lit("u")))
                    .when(x.isin(*TO_ENTE) & in_r2, F.concat(b, F.lit("ente")))
                    .when((x == "amente") & (n >= p1), adverb)
                    .when((x == "mente") & in_r2, _drop(b, "(ante|avel|ível)$", p2))
                    .when(x.isin(*IDADE) & in_r2, _drop(b, "(abil|ic|iv)$", p2))
                    .when(x.isin(*IVO) & in_r2, _drop(b, "(at)$", p2))
                    .when(x.isin(*IRA) & (n >= pv) & b.endswith("e"), F.concat(b, F.lit("ir"))))

        return F.when(x != "", _let(base, on))

    return _let(F.regexp_extract(w, ending(_STANDARD), 1), act)


def _verb(s: Column) -> Column:
    """Step 2: the longest verb ending within RV goes; NULL if there is none."""
    w = s["w"]
    rest = F.substring(w, s["pv"] + 1, F.length(w))
    return _let(F.regexp_extract(rest, ending(VERB), 1), lambda x: F.when(x != "", _cut(w, x)))


def _final(w: Column, pv: Column) -> Column:
    """Step 5."""
    def after(x: Column) -> Column:
        cut = _cut(w, x)
        soft = (cut.endswith("gu") | cut.endswith("ci")) & (F.length(cut) - 1 >= pv)
        return F.when((x != "") & (F.length(cut) >= pv), F.when(soft, F.left(cut, F.length(cut) - 1)).otherwise(cut)
                      ).when((x == "") & w.endswith("ç"), F.concat(F.left(w, F.length(w) - 1), F.lit("c"))).otherwise(w)
    return _let(F.regexp_extract(w, "(e|é|ê)$", 1), after)


def portuguese_stem(term: Column) -> Column:
    """Stem of a lower-case word; NULL stays NULL, a word without endings stays as it is."""
    word = F.replace(F.replace(term, F.lit("ã"), F.lit("a~")), F.lit("õ"), F.lit("o~"))

    def regions(w: Column) -> Column:
        r1 = F.regexp_extract(w, _AFTER_VC, 1)
        r2 = F.regexp_extract(r1, _AFTER_VC, 1)
        n = F.length(w)
        return F.struct(w.alias("w"), (n - F.length(r1)).alias("p1"), (n - F.length(r2)).alias("p2"),
                        (n - F.length(F.regexp_extract(w, _RV, 1))).alias("pv"))

    def steps(s: Column) -> Column:
        pv = s["pv"]

        def rest(changed: Column) -> Column:
            third = F.when(changed.endswith("ci") & (F.length(changed) - 1 >= pv), F.left(changed, F.length(changed) - 1)).otherwise(changed)
            return F.when(changed.isNotNull(), third).otherwise(_drop(s["w"], ending(RESIDUAL), pv))

        last = _let(_let(F.coalesce(_standard(s), _verb(s)), rest), lambda w: _final(w, pv))
        return F.replace(F.replace(last, F.lit("a~"), F.lit("ã")), F.lit("o~"), F.lit("õ"))

    return F.when(term.isNotNull(), _let(_let(word, regions), steps))


def portuguese_stem_sql(table: str, term: str) -> str:
    """SELECT of (term, stem) over the words of ``table``: the same rules step by step."""
    def in_(x: str, names: list[str]) -> str:
        return f"{x} IN ({', '.join(repr(n) for n in names)})"

    def cut(w: str, x: str) -> str:
        return f"left({w}, length({w}) - length({x}))"

    return f"""
WITH words AS (SELECT DISTINCT {term} AS term, replace(replace({term}, 'ã', 'a~'), 'õ', 'o~') AS w FROM {table}),
r1 AS (SELECT *, regexp_extract(w, '{_AFTER_VC}', 1) AS r1, regexp_extract(w, '{_RV}', 1) AS rv FROM words),
r AS (SELECT term, w, length(w) - length(r1) AS p1, length(w) - length(regexp_extract(r1, '{_AFTER_VC}', 1)) AS p2,
             length(w) - length(rv) AS pv, rv FROM r1),
a AS (SELECT *, regexp_extract(w, '{ending(_STANDARD)}', 1) AS x, regexp_extract(rv, '{ending(VERB)}', 1) AS v FROM r),
b AS (SELECT *, {cut('w', 'x')} AS b, length(w) - length(x) >= p2 AS in2 FROM a),
c AS (SELECT *, regexp_extract(b, CASE WHEN x = 'amente' THEN '(iv|os|ic|ad)$' WHEN x = 'mente' THEN '(ante|avel|ível)$'
                                       WHEN {in_('x', IDADE)} THEN '(abil|ic|iv)$' ELSE '(at)$' END, 1) AS y FROM b),
d AS (SELECT *, CASE WHEN y <> '' AND length(b) - length(y) >= p2 THEN {cut('b', 'y')} ELSE b END AS bcut FROM c),
s1 AS (SELECT *, CASE
    WHEN x = '' THEN NULL
    WHEN {in_('x', DELETE_R2)} THEN CASE WHEN in2 THEN b END
    WHEN {in_('x', TO_LOG)} THEN CASE WHEN in2 THEN b || 'log' END
    WHEN {in_('x', TO_U)} THEN CASE WHEN in2 THEN b || 'u' END
    WHEN {in_('x', TO_ENTE)} THEN CASE WHEN in2 THEN b || 'ente' END
    WHEN x = 'amente' THEN CASE WHEN length(b) >= p1 THEN
      CASE WHEN y = 'iv' AND bcut <> b AND bcut LIKE '%at' AND length(bcut) - 2 >= p2 THEN left(bcut, length(bcut) - 2) ELSE bcut END END
    WHEN {in_('x', IRA)} THEN CASE WHEN length(b) >= pv AND b LIKE '%e' THEN b || 'ir' END
    WHEN in2 THEN bcut END AS one FROM d),
s2 AS (SELECT *, COALESCE(one, CASE WHEN v <> '' THEN {cut('w', 'v')} END) AS two FROM s1),
s3 AS (SELECT *, regexp_extract(w, '{ending(RESIDUAL)}', 1) AS z FROM s2),
s4 AS (SELECT *, CASE WHEN two IS NOT NULL THEN CASE WHEN two LIKE '%ci' AND length(two) - 1 >= pv THEN left(two, length(two) - 1) ELSE two END
    WHEN z <> '' AND length(w) - length(z) >= pv THEN {cut('w', 'z')} ELSE w END AS four FROM s3),
s5 AS (SELECT *, CASE WHEN regexp_matches(four, '(e|é|ê)$') AND length(four) - 1 >= pv THEN left(four, length(four) - 1) END AS cut5 FROM s4),
s6 AS (SELECT term, CASE WHEN cut5 IS NOT NULL THEN
      CASE WHEN (cut5 LIKE '%gu' OR cut5 LIKE '%ci') AND length(cut5) - 1 >= pv THEN left(cut5, length(cut5) - 1) ELSE cut5 END
    WHEN four LIKE '%ç' THEN left(four, length(four) - 1) || 'c' ELSE four END AS s FROM s5)
SELECT term, replace(replace(s, 'a~', 'ã'), 'o~', 'õ') AS stem FROM s6"""
