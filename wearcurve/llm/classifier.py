"""Quality classifier: a sparse ensemble of rules over statistics of whole texts.

Each path from the root of a small tree to one of its nodes is a conjunction of thresholds on statistics. All paths of a
forest fitted on labelled rows become rules; a logistic regression with a lasso penalty gives most of them no weight. The
rest is compiled into one column expression, so scoring is one projection over the statistics, without model objects.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.work import WORD, sample_by_hash, stage, without, words
from wearcurve.models.trees import node_table

#: Labelled rows the ensemble is fitted on: those of the smallest hash of their key.
FIT_ROWS = 30_000
TREES, DEPTH, LEAF = 24, 4, 10
#: Penalties tried, strongest first, on the part of the labelled rows that fitted no weights.
PENALTIES = (0.01, 0.003, 0.001)
THRESHOLD = 0.3
FOLDS = 5

_COUNTS = {
    "symbols": r"[#*$%&|<>{}=_\[\]\\^~@+]",
    "bars": r"\|",
    "upper": r"\p{Lu}",
    "digits": r"[0-9]",
    "points": r"[.!?]",
    "commas": r"[,;:]",
    "loud": r"[!?]",
    "other": r"[^\x00-\x7F]",
}


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with a struct ``stats`` of doubles over the whole text; a null text counts as empty."""
    docs = without(docs, "stats")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rest = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row") if rest else F.lit(1).alias("row")
    seen = docs.select(
        row,
        words(t).alias("words"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.char_length(t).alias("chars"),
        *[F.regexp_count(t, F.lit(pattern)).alias(name) for name, pattern in _COUNTS.items()],
    )
    lower = F.transform("words", lambda w: F.lower(w))
    counted = seen.select(
        "row",
        "chars",
        *_COUNTS,
        F.size("words").alias("n_words"),
        F.size(F.array_distinct(lower)).alias("n_distinct"),
        F.size(F.filter("words", lambda w: F.char_length(w) <= 3)).alias("n_short"),
        F.size(F.filter("words", lambda w: F.char_length(w) > 12)).alias("n_long"),
        F.size(F.filter("words", lambda w: ~w.rlike(r"\p{L}"))).alias("n_letterless"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("lines")).alias("n_distinct_lines"),
    )

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)).cast("double")

    stats = F.struct(
        F.col("n_words").cast("double").alias("n_words"),
        share("word_chars", "n_words").alias("word_length"),
        share("n_distinct", "n_words").alias("distinct_share"),
        share("n_short", "n_words").alias("short_share"),
        share("n_long", "n_words").alias("long_share"),
        share("n_letterless", "n_words").alias("letterless_share"),
        share("n_words", "n_lines").alias("line_words"),
        share("n_distinct_lines", "n_lines").alias("distinct_line_share"),
        *[share(name, "chars").alias(f"{name}_share") for name in _COUNTS],
    )
    return counted.select(*(["row.*"] if rest else []), stats.alias("stats"))


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        x = F.col(f"stats.{self.feature}")
        return x > self.threshold if self.above else x <= self.threshold


Rule = tuple[Literal, ...]


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules and the log odds without any."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 from the column ``stats``."""
        odds = F.lit(self.intercept)
        for rule, weight in self.rules:
            odds = odds + F.when(_holds(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def _holds(rule: Rule) -> Column:
    out = rule[0].column()
    for literal in rule[1:]:
        out = out & literal.column()
    return out


def paths(nodes: DataFrame, names: Sequence[str]) -> list[Rule]:
    """Conjunctions on the way to every node of bounded trees, each once, in a fixed order; the roots have none.

    Of several thresholds on one side of a statistic only the narrowest stays. A split's two first rules say the same,
    so a tree's first right branch is left out.
    """
    found: dict[Rule, None] = {}
    by_tree: dict[int, dict[int, tuple]] = {}
    for tree, node, left, right, feature, threshold in nodes.select(
        "tree", "node", "left", "right", "feature", "threshold"
    ).collect():  # at most TREES * 2 ** (DEPTH + 1) rows
        by_tree.setdefault(tree, {})[node] = (left, right, feature, threshold)
    for _, tree in sorted(by_tree.items()):
        todo: list[tuple[int, dict]] = [(0, {})]
        while todo:
            node, sides = todo.pop()
            rule = tuple(Literal(f, above, x) for (f, above), x in sorted(sides.items()))
            if rule and not (len(rule) == 1 and rule[0].above):
                found.setdefault(rule)
            left, right, feature, threshold = tree[node]
            if left is not None:
                low, high = (names[feature], False), (names[feature], True)
                todo.append((right, sides | {high: max(threshold, sides.get(high, threshold))}))
                todo.append((left, sides | {low: min(threshold, sides.get(low, threshold))}))
    return list(found)


def _fold(key: str, parts: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.col(f"`{key}`")), F.lit(parts))


def fit(labelled: DataFrame, *, key: str = "doc_id", label: str = "label", fit_rows: int = FIT_ROWS) -> Ensemble:
    """The ensemble for rows with ``stats`` and a 0/1 label, on at most ``fit_rows`` of them, those of the smallest hash.

    Two thirds fit the trees and the weights, one third chooses the penalty; ties go to the stronger one. Rows without a
    label teach nothing. Without both labels there are no rules, and every row scores the share of label 1 (0.5 without
    any row).
    """
    known = labelled.filter(F.col(label).isNotNull()).select(key, F.col(label).cast("double").alias("label"), "stats")
    # Rows that agree in key and label are ordered by their statistics, so reruns take the same ones.
    flat = known.select(key, "label", F.to_json("stats").alias("told"), "stats")
    sampled = sample_by_hash(flat, fit_rows, key, "label", "told").drop("told")
    rows = stage(sampled.withColumn("judge", F.coalesce(_fold(key, 3, 13) == 0, F.lit(False))), "labelled")
    total, ones = rows.agg(F.count("label"), F.sum("label")).first()
    inner = rows.filter("NOT judge").agg(F.min("label"), F.max("label")).first()
    if not total or inner[0] == inner[1]:
        return Ensemble(_log_odds(ones / total if total else 0.5), ())
    names = rows.schema["stats"].dataType.names
    vector = array_to_vector(F.array(*[F.col(f"stats.{n}") for n in names]))
    grown = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAF,
        featureSubsetStrategy="onethird", seed=17,
    ).fit(rows.filter("NOT judge").select("label", vector.alias("x")))
    rules = paths(node_table(grown), names)
    if not rules:
        return Ensemble(_log_odds(ones / total), ())
    marks = F.array(*[_holds(r).cast("double") for r in rules])
    matrix = stage(rows.select("judge", "label", marks.alias("marks")), "rules")
    train, judged = matrix.filter("NOT judge").select("label", array_to_vector("marks").alias("x")), matrix.filter("judge")
    best = None
    for penalty in PENALTIES:
        model = LogisticRegression(
            featuresCol="x", labelCol="label", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=50
        ).fit(train)
        found = Ensemble(float(model.intercept), tuple((r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w))
        # Log loss of the labels on rows that fitted nothing. From the weights, as a fitted model's own column takes its
        # training summary to the tasks, and that the session, which cannot always be sent.
        weighed = F.zip_with("marks", F.lit([float(w) for w in model.coefficients.toArray()]), lambda mark, w: mark * w)
        odds = F.aggregate(weighed, F.lit(float(model.intercept)), lambda total, x: total + x)
        p = F.greatest(F.least(1 / (1 + F.exp(-odds)), F.lit(1 - 1e-9)), F.lit(1e-9))
        chosen = F.when(F.col("label") > 0, p).otherwise(1 - p)
        loss = judged.agg(F.avg(-F.log(chosen))).first()[0]
        if best is None or (loss is not None and loss < best[0]):
            best = (loss if loss is not None else float("inf"), found)
    return best[1]


def _log_odds(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return math.log(share / (1 - share))


def held_out(key: str = "doc_id") -> Column:
    """Whether a row's label may not be learned: the CRC-32 of the decimal key is divisible by five. False without key."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % FOLDS == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    ``labels`` has ``doc_id`` and ``quality`` (1: good). Only rows that are not held out teach; scores depend on the text
    alone. Null and empty texts have statistics of zero and score like any text with these; repeated rows score alike,
    and of several labels of a document the lowest counts; null keys are never labelled. Statistics are written once.
    """
    stats = stage(statistics(docs.select("doc_id", "text")), "statistics").withColumn("held_out", held_out())
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    found = fit(stats.filter("NOT held_out").join(known, "doc_id"), fit_rows=fit_rows)
    scored = stats.select("doc_id", "held_out", found.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
