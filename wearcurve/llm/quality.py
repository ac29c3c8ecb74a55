"""Quality rules: fixed base rules, then a decision list learned from labelled documents.

Sequential covering: a rule is grown literal by literal on one part of the labelled rows, the literal with the best
information gain first, and pruned from its end on the other part. Rows it covers leave, and the next rule is grown,
until a rule is no longer precise. Every count comes from a histogram of binned statistics that Spark makes; the driver
sees some thousand counts a step. Thresholds end halfway between the values they part, and the list becomes one
ordered conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.llm.work import WORD, sample_by_hash, stage, without, words

MIN_WORDS = 50
SYMBOLS = r"[#*$%&|<>]"
#: Labelled rows a list is fitted on: those of the smallest hash of their key.
FIT_ROWS = 50_000
#: Thresholds tried for each statistic.
BINS = 31
MAX_RULES = 8
MAX_LITERALS = 4
#: Share of bad rows among those a rule covers, on the rows it was pruned on, and how many bad ones at least.
MIN_PRECISION = 0.95
MIN_COVERED = 10

FEATURES = (
    "n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share",
)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with counts over the whole text (null: none) and ``base_failed``.

    ``n_repeat_words`` counts words that lie in a three-word window found twice or more; windows are told apart by
    64-bit hashes, which are sorted with their places.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counts = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_upper",
        "n_digits", "n_marks", "base_failed",
    )
    rest = without(docs, text, *counts).columns
    row = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row") if rest else F.lit(1).alias("row")
    d = docs.select(
        row,
        words(t).alias("words"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.char_length(t).cast("long").alias("n_chars"),
        F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count(t, F.lit("[!?]")).cast("long").alias("n_marks"),
    )
    three = F.transform(
        "words", lambda w, i: F.xxhash64(w, F.get(F.col("words"), i + 1), F.get(F.col("words"), i + 2))
    )
    d = d.withColumn("windows", F.slice(three, 1, F.greatest(F.size("words") - 2, F.lit(0))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn(
        "places",
        F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    twice = F.filter(
        "places",
        lambda p, j: p["h"].eqNullSafe(F.get(F.col("places"), j - 1)["h"])
        | p["h"].eqNullSafe(F.get(F.col("places"), j + 1)["h"]),
    )
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda p: p["i"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
    )["n"]
    d = d.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_chars",
        F.size("lines").cast("long").alias("n_lines"),
        "n_upper",
        "n_digits",
        "n_marks",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.select(*(["row.*"] if rest else []), *d.columns[1:], failed.alias("base_failed"))


def _feature(name: str) -> Column:
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "n_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "n_chars"),
        "digit_share": share("n_digits", "n_chars"),
        "mark_share": share("n_marks", "n_chars"),
    }[name]


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        x = _feature(self.feature)
        return x > self.threshold if self.above else x <= self.threshold


Rule = tuple[Literal, ...]


def _all(columns: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def learn(stats: DataFrame, bad: str, key: str = "doc_id", fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Ordered rules for bad rows, from ``stats`` with the boolean column ``bad``; base failures are left out.

    At most ``fit_rows`` rows are used, those of the smallest hash of ``key``. Without bad rows, or without a precise
    rule, the list is empty.
    """
    hashed = F.xxhash64(F.lit(5), F.col(key))
    known = stats.filter(~F.col("base_failed") & F.col(bad).isNotNull())
    sample = sample_by_hash(known, fit_rows, key, *[c for c in stats.columns if c != key])
    rows = stage(
        sample.select(F.col(bad).alias("bad"), (F.pmod(hashed, F.lit(3)) < 2).alias("grow"), *[_feature(f).alias(f) for f in FEATURES]),
        "labelled",
    )
    cuts = [k / (BINS + 1) for k in range(1, BINS + 1)]
    found = rows.agg(*[F.percentile_approx(F.when(F.col("bad"), F.col(f)), cuts).alias(f"b_{f}") for f in FEATURES],
                     *[F.percentile_approx(f, cuts).alias(f"a_{f}") for f in FEATURES]).first()
    thresholds = {f: sorted({*(found[f"b_{f}"] or []), *(found[f"a_{f}"] or [])}) for f in FEATURES}

    def bin_of(f: str) -> Column:
        """Number of thresholds below the value."""
        if not thresholds[f]:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(t) for t in thresholds[f]]), lambda t: t < F.col(f)))

    binned = stage(rows.select("bad", "grow", *[bin_of(f).cast("short").alias(f) for f in FEATURES]), "binned")

    def holds(literal: tuple[int, bool, int]) -> Column:
        f, above, k = literal
        return F.col(FEATURES[f]) > k if above else F.col(FEATURES[f]) <= k

    def covers(rule) -> Column:
        return _all([holds(x) for x in rule])

    def histogram(rows: DataFrame) -> dict[tuple[int, int], list[int]]:
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).alias("k")) for i, f in enumerate(FEATURES)]))
        counts = rows.select("bad", each.alias("x")).groupBy("x.f", "x.k").agg(F.count_if("bad"), F.count_if(~F.col("bad")))
        return {(f, k): [p, n] for f, k, p, n in counts.collect()}

    rules, left = [], binned
    while len(rules) < MAX_RULES:
        grown: list[tuple[int, bool, int]] = []
        while len(grown) < MAX_LITERALS:
            best = _best_literal(histogram(left.filter("grow").filter(covers(grown))), thresholds)
            if best is None:
                break
            grown.append(best)
        if not grown:
            break
        prefixes = range(1, len(grown) + 1)
        tried = left.filter("NOT grow").agg(
            *[F.count_if(covers(grown[:k]) & F.col("bad")) for k in prefixes],
            *[F.count_if(covers(grown[:k]) & ~F.col("bad")) for k in prefixes],
        ).first()
        scored = [(tried[k - 1], tried[len(grown) + k - 1], k) for k in prefixes]
        p, n, k = max(scored, key=lambda x: ((x[0] - x[1]) / max(1, x[0] + x[1]), -x[2]))
        if p < MIN_COVERED or p < MIN_PRECISION * (p + n):
            break
        rules.append(tuple(grown[:k]))
        left = left.filter(~covers(grown[:k]))
    found = [tuple(Literal(FEATURES[f], above, float(thresholds[FEATURES[f]][k])) for f, above, k in r) for r in rules]
    return _centred(found, rows)


def _centred(rules: list[Rule], rows: DataFrame) -> list[Rule]:
    """The same split of ``rows``, with each threshold halfway between the values on its sides."""
    literals = sorted({x for rule in rules for x in rule}, key=lambda x: (x.feature, x.threshold, x.above))
    if not literals:
        return rules
    sides = [
        side
        for x in literals
        for side in (
            F.max(F.when(F.col(x.feature) <= x.threshold, F.col(x.feature))),
            F.min(F.when(F.col(x.feature) > x.threshold, F.col(x.feature))),
        )
    ]
    seen = rows.agg(*[side.alias(f"side{i}") for i, side in enumerate(sides)]).first()
    middle = {}
    for i, x in enumerate(literals):
        low, high = seen[2 * i], seen[2 * i + 1]
        middle[x] = x if low is None or high is None else Literal(x.feature, x.above, (low + high) / 2)
    return [tuple(middle[x] for x in rule) for rule in rules]


def _best_literal(counts: dict, thresholds: dict[str, list[float]]) -> tuple[int, bool, int] | None:
    """Feature, direction and threshold of the largest gain; None if no literal separates the rows further."""
    total = [sum(c[i] for (f, _), c in counts.items() if f == 0) for i in (0, 1)]
    if not total[0] or not total[1]:
        return None
    before, best = math.log2(total[0] / sum(total)), (1e-9, None)
    for f, name in enumerate(FEATURES):
        low = [0, 0]
        for k in range(len(thresholds[name])):
            low = [a + b for a, b in zip(low, counts.get((f, k), (0, 0)))]
            for above, (p, n) in ((False, low), (True, [a - b for a, b in zip(total, low)])):
                if p:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > best[0]:
                        best = (gain, (f, above, k))
    return best[1]


def verdict(rules: Sequence[Rule]) -> Column:
    """Whether a row with its statistics is kept: the first rule that covers it rejects it."""
    out = F.when(F.col("base_failed"), False)
    for rule in rules:
        out = out.when(_all([x.column() for x in rule]), False)
    return out.otherwise(True)


def assess(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id``, statistics and ``kept`` of every document.

    ``labels`` has ``doc_id`` and ``quality`` (0: bad); null labels teach nothing, and of several labels of a document
    the lowest counts. Null and empty texts have no words and fail the base rules. Repeated rows are judged alike.
    """
    stats = stage(statistics(docs.select("doc_id", "text")), "statistics")
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    rules = learn(stats.join(known, "doc_id"), "bad", fit_rows=fit_rows)
    return stats.withColumn("kept", verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents that the base rules and the learned list keep, with their columns.

    Documents are written once with their statistics; fitting reads the statistics alone.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = stage(statistics(docs.select(whole.alias("document"), "text")), "statistics")
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    counts = judged.select(F.col("document.doc_id").alias("doc_id"), *judged.columns[1:])
    rules = learn(counts.join(known, "doc_id"), "bad", fit_rows=fit_rows)
    return judged.filter(verdict(rules)).select("document.*")
