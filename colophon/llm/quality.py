"""Quality rules whose cutoffs are chosen on labelled documents with a bound on false rejection.

Every rule is a measure of a document and rejects it above a cutoff. A cutoff is a hypothesis:
"this rule rejects at least ``risk / number of rules`` of the good documents of this stratum". The
labelled good documents of the stratum are the holdout; the exact binomial tail of the number of
them that the cutoff rejects is the p-value. Hypotheses with a p-value of at most
``confidence error / number of hypotheses`` (Bonferroni over strata, rules and cutoffs) are refuted,
and of the refuted ones the strictest cutoff is taken. So with probability ``1 - delta`` all
rules together reject at most ``risk`` of the good documents in every stratum at once. A stratum
with too few labels gets no cutoff and loses nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from colophon.llm.columns import SEPARATORS, count_of, narrow, total, whole, words_of
from colophon.session import Scratch

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Rule -> its measure over the counts below, and the cutoffs that are tried.
RULES = {
    "symbols": ("n_symbols / n_words", [0.02, 0.05, 0.1, 0.2, 0.4, 0.8]),
    "dup_lines": ("n_dup_lines / n_lines", [0.05, 0.1, 0.2, 0.3, 0.5, 0.7]),
    "repeats": ("n_repeat_words / n_words", [0.01, 0.02, 0.05, 0.08, 0.12, 0.16]),
    "capitals": ("n_capitals / word_chars", [0.05, 0.1, 0.2, 0.3, 0.5, 0.7]),
}
# Strata by number of words: as many as there are bounds, whatever the corpus.
STRATA = [100, 400, 1600]


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row's whole text.

    A null or empty text has no words and no lines. Repeated rows give repeated results.
    """
    words = narrow(docs, "doc_id", "text").select(
        "doc_id", whole().alias("text"), words_of(whole()).alias("words"))
    at = F.col("words")
    last = F.size("words") - WINDOW
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))
    hashed = words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SEPARATORS, "")).cast("long").alias("word_chars"),
        count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        count_of(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_capitals"),
        lines.alias("lines"),
        F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
            *(F.get(at, i + k) for k in range(WINDOW))))).alias("windows"))
    # Positions are only sorted for texts in which some window comes twice.
    paired = hashed.select(
        "*", F.when(F.size("windows") > F.size(F.array_distinct("windows")), F.sort_array(
            F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("pairs"))
    pairs = F.col("pairs")
    twice = paired.withColumn("places", F.sort_array(F.transform(F.filter(
        pairs, lambda p, j: (p["h"] == F.get(pairs, j + 1)["h"]) | (
            (j > 0) & (p["h"] == F.get(pairs, j - 1)["h"]))), lambda p: p["i"])))
    places = F.col("places")
    return twice.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_capitals",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(total(F.transform(places, lambda p, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))),
            F.lit(0)).alias("n_repeat_words"))


def base_failed() -> Column:
    """The fixed rules: fewer than ten words, or more than a fifth of the words in repeats."""
    return (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def stratum() -> Column:
    return F.expr(" + ".join(f"cast(n_words >= {n} as int)" for n in STRATA))


def _rate(rule: str) -> Column:
    """A measure as a number; without words or lines it is 0."""
    over, under = RULES[rule][0].split(" / ")
    return F.coalesce(F.try_divide(F.col(over).cast("double"), F.col(under).cast("double")), F.lit(0.0))


def _log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series, raised by ten steps for small x (error below 1e-12)."""
    up = x + 10.0
    series = (up + 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up) - 1 / (
        360 * up * up * up) + 1 / (1260 * up * up * up * up * up)
    return series - sum((F.log(x + float(k)) for k in range(2, 11)), F.log(x + 1.0))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of X ~ Binomial(n, p): the exact sum, from the term of k down to that of 0.

    Each term is got from the one above it, so nothing underflows before it is negligible.
    """
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * math.log(
        p) + (n - k) * math.log1p(-p)
    odds = (1 - p) / p
    steps = F.when(k > 0, F.sequence(k.cast("long"), F.lit(1), F.lit(-1))).otherwise(
        F.array().cast("array<bigint>"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(a, i):
        term = a["term"] * i * odds / (n - i + 1)
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    return F.least(F.lit(1.0), F.exp(top) * F.aggregate(steps, start, step, lambda a: a["sum"]))


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The strictest proven cutoff per ``(stratum, rule)``; none where no cutoff is proven.

    ``labels`` needs ``doc_id`` and ``quality`` (1: good). A document that is labelled twice counts
    once, and only if no label calls it bad; null labels are not counted. At most
    ``(len(STRATA) + 1) * len(RULES)`` rows.
    """
    hypotheses = (len(STRATA) + 1) * sum(len(grid) for _, grid in RULES.values())
    good = (labels.select("doc_id", "quality").filter("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1"))
    # How many cutoffs of the grid a value exceeds says all about it.
    exceeded = F.array(*(F.struct(F.lit(rule).alias("rule"), sum(
        ((_rate(rule) > c).cast("int") for c in grid), F.lit(0)).alias("exceeds"))
        for rule, (_, grid) in RULES.items()))
    counted = (measured.filter(~base_failed()).join(good.select("doc_id"), "doc_id", "left_semi")
               .select(stratum().alias("stratum"), F.explode(exceeded).alias("x"))
               .groupBy("stratum", "x.rule", "x.exceeds").agg(F.count(F.lit(1)).alias("n")))
    grid = F.explode(F.array(*(F.struct(
        F.lit(rule).alias("rule"), F.lit(i).alias("place"), F.lit(c).alias("cutoff"))
        for rule, (_, values) in RULES.items() for i, c in enumerate(values)))).alias("g")
    tested = (counted.select("stratum", "rule", "exceeds", "n", grid)
              .filter("rule = g.rule")
              .groupBy("stratum", "rule", "g.place", "g.cutoff")
              .agg(F.sum("n").cast("double").alias("n"),
                   F.sum(F.when(F.col("exceeds") > F.col("g.place"), F.col("n")).otherwise(0))
                   .cast("double").alias("k")))
    limit = risk / len(RULES)
    proven = tested.filter((F.col("k") < limit * F.col("n")) & (
        binomial_tail(F.col("k"), F.col("n"), limit) <= delta / hypotheses))
    return proven.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(measured: DataFrame, chosen: dict[tuple[int, str], float]) -> DataFrame:
    """Adds ``base_failed``, ``rejected_by`` (the rule names in order) and ``kept``."""
    def rejected(rule):
        own = [F.when((stratum() == s) & (_rate(rule) > cutoff), F.lit(rule))
               for (s, r), cutoff in sorted(chosen.items()) if r == rule]
        return F.coalesce(*own, F.lit(None).cast("string"))

    over = F.array_compact(F.array(*(rejected(rule) for rule in RULES)))
    return measured.withColumns({"base_failed": base_failed(), "rejected_by": over}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Judge every row of ``docs`` (``doc_id``, ``text``) by rules calibrated on ``labels``.

    The measures are written once to the shared folder, as calibration and verdicts both read them.
    Empty tables give empty results; extra columns are ignored.
    """
    measured = Scratch(docs.sparkSession, "quality").table(measures(docs), "measures")
    # At most a cutoff per stratum and rule.
    chosen = {(r["stratum"], r["rule"]): r["cutoff"] for r in cutoffs(measured, labels, risk, delta).collect()}
    return judge(measured, chosen)
