"""Quality classifier: a sparse ensemble of rules.

A small random forest is grown on statistics of the labelled texts. Every path
from a root to a node, up to ``MAX_CONDITIONS`` conditions, is a conjunctive
rule; logistic regression with a lasso penalty over the rules' 0/1 values keeps
a few and weighs them. The surviving rules become one Spark column expression.

The statistics are those of the texts alone: no label, language, source or id
enters a score. Forest and regression are fitted by Spark over all labelled
training rows (no sample, no collected rows); the driver sees trees and weights.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .quality_rules import statistics

TREES, DEPTH, MAX_CONDITIONS = 12, 4, 3
LASSO = 0.001
SEED = 7

_W, _C, _L = "greatest(n_words, 1)", "greatest(word_chars, 1)", "greatest(n_lines, 1)"
FEATURES: dict[str, str] = {
    "words": "CAST(n_words AS DOUBLE)",
    "word_length": f"word_chars / {_W}",
    "symbols": f"n_symbols / {_W}",
    "symbol_words": f"n_symbol_words / {_W}",
    "marks": f"n_marks / {_C}",
    "capitals": f"n_upper / {_C}",
    "repeated_lines": f"n_dup_lines / {_L}",
    "repeated_words": f"n_repeat_words / {_W}",
    "echoes": f"n_echoes / {_W}",
    "stops": f"n_stops / {_W}",
    "line_words": f"n_words / {_L}",
}


@dataclass(frozen=True)
class PathRule:
    """All conditions (feature, above?, threshold) hold: feature > threshold
    where above, else feature <= threshold."""
    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, at in self.conditions:
            c = F.col(name)
            out = out & ((c > F.lit(at)) if above else (c <= F.lit(at)))
        return out

    def __str__(self) -> str:
        return " AND ".join(f"{n} {'>' if a else '<='} {t:.6g}" for n, a, t in self.conditions)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[PathRule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 over the feature columns."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and FEATURES (double) of every whole text; a null text counts as
    empty."""
    s = statistics(docs, id_col, text_col)
    return s.select("doc_id", *[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()])


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _path_rules(trees, names: list[str]) -> list[PathRule]:
    """Rules of all paths, simplified: the tightest bound per feature and side."""
    found = {}

    def walk(node, bounds: dict) -> None:
        if bounds:
            rule = PathRule(tuple((n, a, t) for (n, a), t in sorted(bounds.items())))
            found.setdefault(rule, None)
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        name, at = names[split.featureIndex()], float(split.threshold())
        for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
            old = bounds.get((name, above))
            new = at if old is None else (max(old, at) if above else min(old, at))
            grown = bounds | {(name, above): new}
            if len(grown) <= MAX_CONDITIONS:
                walk(child, grown)

    for tree in trees:
        walk(tree._java_obj.rootNode(), {})
    return sorted(found, key=str)


def fit_rules(train: DataFrame, label_col: str = "label") -> RuleModel:
    """Fit on the feature columns and a 0/1 label. Without rows of both labels
    there is nothing to tell apart: the score is then (ones + 1) / (rows + 2)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    names = list(FEATURES)
    by_label = {r[label_col]: r["count"] for r in train.groupBy(label_col).count().collect()}
    ones, zeros = by_label.get(1, 0), by_label.get(0, 0)
    flat = RuleModel(math.log((ones + 1) / (zeros + 1)), ())
    if not ones or not zeros:
        return flat
    x = VectorAssembler(inputCols=names, outputCol="features").transform(train).select("features", label_col)
    forest = RandomForestClassifier(featuresCol="features", labelCol=label_col, numTrees=TREES, maxDepth=DEPTH,
                                    seed=SEED, featureSubsetStrategy="onethird").fit(x)
    rules = _path_rules(forest.trees, names)
    if not rules:
        return flat
    fired = train.select(label_col, *[r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    z = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="fired").transform(fired)
    lasso = LogisticRegression(featuresCol="fired", labelCol=label_col, elasticNetParam=1.0, regParam=LASSO,
                               standardization=False, maxIter=100).fit(z.select("fired", label_col))
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-9))


def train_rows(feats: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """Labelled rows that are not held out. An id with several labels counts
    once, as 1 only if all agree; null labels and ids are left out."""
    y = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label_col).cast("int").alias("label"))
    return feats.filter(~held_out()).join(y, "doc_id")


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
                  ) -> tuple[DataFrame, RuleModel]:
    """(doc_id, held_out, score, predicted) of every row, and the model.

    One row per input row; repeated rows repeat; empty texts are scored like
    any other; an empty table gives an empty result. Features (a few numbers
    per document) are written once and serve training and scoring.
    """
    feats = materialise(features(docs, id_col, text_col), "quality-features")
    model = fit_rules(materialise(train_rows(feats, labels), "quality-train"))
    scored = feats.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), model


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> RuleModel:
    """The model alone: features of the labelled training rows only."""
    known = labels.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__labelled")).distinct()
    rows = docs.join(known, F.col(f"`{id_col}`") == F.col("__labelled"), "left_semi")
    return fit_rules(materialise(train_rows(features(rows, id_col, text_col), labels), "quality-train"))


def keep_column(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores at or above the threshold, all columns and
    rows as they are otherwise."""
    columns = docs.columns
    from .quality_rules import add_statistics

    stats = add_statistics(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"),
                                       F.col(f"`{text_col}`").alias("__text")), "__text", ["__row"])
    # a generator's outputs are never written out again in the conditions above it, so each
    # statistic is computed once per row, however many rules ask for it
    values = F.struct(*[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()])
    feats = stats.select("__row", F.inline(F.array(values)))
    return feats.filter(model.score() >= threshold).select("__row.*")
