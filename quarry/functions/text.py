"""Tokenising for text search, as Spark column expressions (no Python UDF).

A token is a maximal run of Unicode letters, lower-cased. The stop-word list
and the light suffix rules are fixed values, given here in full.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: stop words removed before matching and indexing
# (English, French, German, Spanish and Portuguese function words)
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or",
    "that", "the", "this", "to", "was", "with",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "en", "que", "qui", "est",
    "der", "die", "das", "und", "ist", "ein", "eine", "zu", "den", "mit",
    "el", "los", "las", "y", "es", "por", "con", "para", "una", "del",
    "o", "os", "e", "do", "da", "dos", "um", "uma", "com", "se", "na", "no",
)

# fixed values: light suffix rules (approximate Portuguese plural stripping);
# the first rule whose suffix matches is applied, and only to words longer than 3
SUFFIX_RULES = (("oes", "ao"), ("aes", "ao"), ("ais", "al"), ("eis", "el"), ("ois", "ol"),
                ("res", "r"), ("zes", "z"), ("ns", "m"), ("s", ""))

TOKEN_SPLIT = r"[^\p{L}]+"


def tokens(text: str | Column) -> Column:
    """Array of lower-case letter runs of the whole text (empty runs dropped)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), TOKEN_SPLIT), lambda x: x != "")


def without_stop_words(arr: Column) -> Column:
    return F.array_except(arr, F.array(*[F.lit(w) for w in STOP_WORDS]))


def light_stem(term: Column) -> Column:
    """Approximate stemming by suffix rules (Spark has no Portuguese stemmer)."""
    out = None
    for suf, rep in SUFFIX_RULES:
        cut = F.concat(term.substr(F.lit(1), F.length(term) - len(suf)), F.lit(rep))
        out = (F.when(term.endswith(suf), cut) if out is None else out.when(term.endswith(suf), cut))
    return F.when(F.length(term) > 3, out.otherwise(term)).otherwise(term)


def stop_words_sql() -> str:
    return ", ".join(f"'{w}'" for w in STOP_WORDS)


def letter_runs(text: str) -> list[str]:
    """The tokens of a query string (the same runs as ``tokens``)."""
    return "".join(c if c.isalpha() else " " for c in text).split()


def stem_word(word: str) -> str:
    """``light_stem`` of one query word."""
    if len(word) > 3:
        for suffix, new in SUFFIX_RULES:
            if word.endswith(suffix):
                return word[:len(word) - len(suffix)] + new
    return word


def stem_sql(term: str) -> str:
    """``light_stem`` as a SQL expression."""
    cases = " ".join(f"WHEN {term} LIKE '%{s}' THEN left({term}, length({term}) - {len(s)}) || '{r}'"
                     for s, r in SUFFIX_RULES)
    return f"CASE WHEN length({term}) <= 3 THEN {term} {cases} ELSE {term} END"
