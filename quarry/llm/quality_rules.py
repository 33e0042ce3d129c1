"""Quality rules as weak supervision.

Each rule votes good (+1), bad (-1) or abstains (0) on the statistics of a
text. Nobody says which rule to trust: expectation-maximisation over the
counts of vote patterns estimates each rule's chances of a good, bad or no vote
given a good and given a bad text, and the share of good texts. A document is
kept when its posterior probability of being good is one half or more.

Only DataFrame functions run on the executors. What the driver sees is one row
per distinct vote pattern: at most 3 ** len(RULES), whatever the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_or_empty

SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"
STOP = r"[.!?](?=[\x20\x09-\x0D]|$)"   # ends a sentence
WINDOW = 5

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
         "n_stops", "n_echoes", "n_marks", "n_symbol_words")


@dataclass(frozen=True)
class Rule:
    """good / bad are conditions on the columns of STATS; else abstain."""
    name: str
    good: str
    bad: str


# A rule speaks only where its statistic is telling: most rules know one way a
# text can be bad and abstain otherwise; few vote for good.
RULES = (
    Rule("length", "false", "n_words < 3"),
    Rule("word_length", "false", "n_words > 0 AND word_chars NOT BETWEEN 2 * n_words AND 14 * n_words"),
    Rule("symbols", "n_words >= 10 AND 1000 * n_symbols <= n_words", "20 * n_symbols > n_words"),
    Rule("symbol_words", "false", "20 * n_symbol_words > n_words"),
    Rule("marks", "false", "n_words >= 20 AND 4 * n_marks > word_chars"),
    Rule("repeats", "false", "5 * n_repeat_words > n_words"),
    Rule("lines", "n_lines >= 3 AND n_dup_lines = 0", "2 * n_dup_lines > n_lines"),
    Rule("capitals", "false", "10 * n_upper > 3 * word_chars"),
    Rule("sentences", "n_stops >= 1 AND n_words BETWEEN 2 * n_stops AND 25 * n_stops",
         "n_words > 60 * n_stops AND n_words >= 30"),
    Rule("echoes", "false", "5 * n_echoes > n_words"),
)


def _kept_length(text: Column, drop: str) -> Column:
    return F.length(F.translate(text, drop, ""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and STATS (long) of every whole text, one row per input row."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return add_statistics(src, "text", ["doc_id"])


def add_statistics(docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    """The columns of ``carry`` and STATS (long), one row per input row."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # 1. words and lines as columns of their own, so that they are made once
    base = docs.select(*carry, text_or_empty(text_col).alias("text"))
    arrays = base.select(
        *carry, "text",
        F.array_remove(F.split("text", SPACE, -1), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, _SPACES, "") != "").alias("lines"))
    hashed = arrays.select(*carry, "text", "words", "lines",
                           F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    at = lambda i, k: F.get("hashes", i + k)
    windows = hashed.select(
        "*", F.when(F.size("hashes") >= WINDOW,
                    F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW),
                                lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"))
    # 2. start positions of the windows that occur twice or more. Most texts
    #    have none, which the distinct count tells at once.
    pairs = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = windows.select(
        "*", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), pairs).alias("sorted"))
    repeated = F.filter("sorted", lambda x, j: (x.h == F.get("sorted", j - 1).h) | (x.h == F.get("sorted", j + 1).h))
    starts = sorted_.select(
        "*", F.sort_array(F.transform(repeated, lambda x: x.i)).alias("starts"))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a.n + F.least(F.lit(WINDOW), p - a.last)).alias("n"), p.alias("last")),
        lambda a: a.n)
    text = F.col("text")
    n_chars = F.length(text)
    echoes = F.size(F.filter("hashes", lambda h, i: h == F.get("hashes", i - 1)))
    out = starts.select(
        *carry, F.size("words").alias("n_words"), _kept_length(text, _SPACES).alias("word_chars"),
        (n_chars - _kept_length(text, SYMBOLS)).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"), F.size("lines").alias("n_lines"),
        (n_chars - _kept_length(text, letters)).alias("n_upper"),
        F.regexp_count(text, F.lit(STOP)).alias("n_stops"), echoes.alias("n_echoes"),
        (n_chars - _kept_length(text, MARKS)).alias("n_marks"),
        F.size(F.filter("words", lambda w: F.translate(w, SYMBOLS, "") == "")).alias("n_symbol_words"))
    return out.select(*carry, *[F.col(c).cast("long").alias(c) for c in STATS])


def vote(rule: Rule) -> Column:
    """1, -1 or 0 (a null statistic abstains)."""
    return (F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0)).cast("int")


@dataclass(frozen=True)
class VoteModel:
    """prior: share of good texts; like[rule][class][vote + 1], class 1 good.
    An abstention says nothing either way."""
    prior: float
    like: tuple

    def log_odds(self, rule: int, value: int) -> float:
        bad, good = self.like[rule]
        if value == 0:
            return 0.0
        return math.log(good[value + 1] / bad[value + 1])


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 200) -> VoteModel:
    """EM over (pattern, count). Starts from rules that are rarely bad-mouthing
    a good text, and from four good texts in five; one pseudo-text per vote smooths
    the estimates. No pattern at all leaves the start values."""
    like = [[[0.3, 0.5, 0.2], [0.02, 0.5, 0.48]] for _ in range(n_rules)]
    prior = 0.8
    for _ in range(rounds):
        if not patterns:
            break
        total = [1.0, 1.0]
        sums = [[[1.0, 1.0, 1.0], [1.0, 1.0, 1.0]] for _ in range(n_rules)]
        for votes, n in patterns:
            logs = [math.log(1 - prior), math.log(prior)]
            for r, v in enumerate(votes):
                if v:
                    logs[0] += math.log(like[r][0][v + 1])
                    logs[1] += math.log(like[r][1][v + 1])
            good = 1 / (1 + math.exp(min(700.0, logs[0] - logs[1])))
            for c, w in ((0, n * (1 - good)), (1, n * good)):
                total[c] += w
                for r, v in enumerate(votes):
                    sums[r][c][v + 1] += w
        moved = abs(total[1] / sum(total) - prior)
        prior = total[1] / sum(total)
        like = [[[x / sum(s) for x in s] for s in by_class] for by_class in sums]
        if moved < 1e-9:
            break
    return VoteModel(prior, tuple(tuple(tuple(c) for c in r) for r in like))


def posterior(model: VoteModel, votes: list[Column]) -> Column:
    """Probability of a good text as a column over the votes."""
    logit = F.lit(math.log(model.prior / (1 - model.prior)))
    for r, v in enumerate(votes):
        logit = logit + (F.when(v == -1, model.log_odds(r, -1)).when(v == 1, model.log_odds(r, 1))
                         .otherwise(0.0))
    return 1 / (1 + F.exp(-logit))


def apply_quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Statistics, hard failure, posterior and verdict of every whole text.

    One row per input row (repeated rows repeat); a null text counts as empty
    and, like any text under ten words, fails the base rule; an empty table
    gives an empty result; other columns are not read. The statistics are
    written once to the shared folder (a few numbers per document); counting
    the vote patterns and giving the verdicts both read them from there.
    """
    stats = materialise(statistics(docs, id_col, text_col), "quality-stats")
    names = [f"vote_{r.name}" for r in rules]
    voted = stats.select("*", *[vote(r).alias(n) for r, n in zip(rules, names)])
    counts = voted.groupBy(*names).count().collect()   # at most 3 ** rules rows
    patterns = sorted((tuple(int(row[n]) for n in names), int(row["count"])) for row in counts)
    model = fit_votes(patterns, len(rules))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    p = posterior(model, [F.col(n) for n in names])
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (p >= 0.5)).alias("kept"), p.alias("p_good"), *names)
