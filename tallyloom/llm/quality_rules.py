"""Quality rules as weak supervision: votes, accuracies by expectation-maximisation, one posterior."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import pick, stored

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
#: ASCII punctuation that running prose seldom needs.
MARKS = "#*$%&|<>!?@[\\]^_`{}~+=/"
WINDOW = 8
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Each rule: a ratio of two statistics, and the bounds from which on it votes "bad" and "good".
#: Between the bounds, and where the divisor is 0, a rule abstains.
RULES = {
    "length": ("n_words", None, (20, 50)),
    "symbols": ("n_symbols", "n_words", (0.20, 0.05)),
    "symbol_words": ("n_symbol_words", "n_words", (0.30, 0.10)),
    "bare_words": ("n_bare_words", "n_words", (0.30, 0.10)),
    "marks": ("n_marks", "word_chars", (0.10, 0.04)),
    "same_lines": ("n_dup_lines", "n_lines", (0.30, 0.10)),
    "repeats": ("n_repeat_words", "n_words", (0.25, 0.10)),
    "echoes": ("n_echoes", "n_words", (0.20, 0.05)),
    "capitals": ("n_capitals", "word_chars", (0.40, 0.20)),
    "long_words": ("word_chars", "n_words", (14.0, 10.0)),
    "variety": ("n_distinct", "n_words", (0.02, 0.10)),
}


def _outside(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts over each whole text; null counts as empty and has no words.

    Besides the columns of the base rules there are the lines with words, capitals, distinct words
    and echoes (words equal to the one before). A repeated window is found by its 64-bit hash within
    its own text; only texts that have one sort their windows.
    """
    spaces = f"[{SPACES[0]}\\x09-\\x0D]+"
    rows = pick(docs, key, text).withColumn(text, F.coalesce(text, F.lit("")))
    inner = F.expr(f"trim(BOTH '{' '}\\t\\n\\u000b\\f\\r' FROM `{text}`)")
    rows = rows.withColumn("_inner", inner).withColumn("words", F.when(F.col("_inner") == "", F.array().cast("array<string>")).otherwise(F.split("_inner", spaces)))
    lines = F.filter(F.split(F.col(text), "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.select(
        key,
        "words",
        F.size("words").cast("long").alias("n_words"),
        (F.length(text) - _outside(F.col(text), SPACES)).cast("long").alias("word_chars"),
        _outside(F.col(text), SYMBOLS).cast("long").alias("n_symbols"),
        _outside(F.col(text), CAPITALS).cast("long").alias("n_capitals"),
        _outside(F.col(text), MARKS).cast("long").alias("n_marks"),
        lines.alias("lines"),
    )
    windows = F.when(F.size("words") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    rows = rows.select(
        key,
        *("n_words", "word_chars", "n_symbols", "n_capitals", "n_marks"),
        F.size(F.filter("words", lambda w: w.rlike("[#*$%&|<>]"))).cast("long").alias("n_symbol_words"),
        F.size(F.filter("words", lambda w: ~w.rlike("[0-9A-Za-z]|[^\\x00-\\x7F]"))).cast("long").alias("n_bare_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.filter("words", lambda w, i: w == F.get("words", i - 1))).cast("long").alias("n_echoes"),
        windows.alias("windows"),
    )
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("pairs", F.when(repeated, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i: (x["h"] == F.get("pairs", i + 1)["h"]) | (x["h"] == F.get("pairs", i - 1)["h"])
    places = F.sort_array(F.transform(F.filter("pairs", lambda x, i: F.coalesce(same(x, i), x["h"] == F.get("pairs", i + 1)["h"], x["h"] == F.get("pairs", i - 1)["h"], F.lit(False))), lambda x: x["i"]))
    rows = rows.withColumn("places", places)
    steps = F.transform("places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("places", i + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0), lambda total, x: total + x)
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return rows.select(key, *STATISTICS, "n_lines", "n_capitals", "n_marks", "n_symbol_words", "n_bare_words", "n_distinct", "n_echoes")


def vote(rule: str) -> Column:
    """1 for good, -1 for bad, 0 for abstaining."""
    top, below, (bad, good) = RULES[rule]
    value = F.col(top) if below is None else F.when(F.col(below) > 0, F.col(top) / F.col(below))
    is_bad, is_good = (value >= bad, value <= good) if bad > good else (value < bad, value >= good)
    return F.when(is_bad, -1).when(is_good, 1).otherwise(0)


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[float, list[tuple[float, float]]]:
    """The share of good documents, and each rule's share of right votes among (good, bad) ones.

    ``patterns`` are vote patterns with their counts, at most three to the power of the number of rules. Expectation:
    the chance of "good" of each pattern; maximisation: shares by these chances, smoothed by one
    vote. Abstentions say nothing. It starts from rules that are right four times of five, so "good" stays what most rules call good.
    """
    rules = len(patterns[0][0]) if patterns else len(RULES)
    prior, right = 0.8, [(0.8, 0.8)] * rules
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        chances = [posterior(votes, prior, right) for votes, _ in patterns]
        before, prior = prior, (sum(p * n for p, (_, n) in zip(chances, patterns, strict=True)) + 1) / (total + 2)
        right = []
        for j in range(rules):
            good = bad = good_all = bad_all = 0.0
            for p, (votes, n) in zip(chances, patterns, strict=True):
                if votes[j]:
                    good_all += p * n
                    bad_all += (1 - p) * n
                    good += p * n * (votes[j] > 0)
                    bad += (1 - p) * n * (votes[j] < 0)
            right.append(((good + 0.8) / (good_all + 1), (bad + 0.8) / (bad_all + 1)))
        if abs(prior - before) < 1e-9:
            break
    return prior, right


def posterior(votes: tuple[int, ...], prior: float, right: list[tuple[float, float]]) -> float:
    odds = math.log(prior / (1 - prior)) + sum(weight(v, *own) for v, own in zip(votes, right, strict=True))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def weight(vote: int, good: float, bad: float) -> float:
    """What a vote adds to the log odds of "good"."""
    return 0.0 if vote == 0 else math.log(good / (1 - bad)) if vote > 0 else math.log((1 - good) / bad)


def quality_rules(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics of every document, the base verdict, and the posterior chance that it is good.

    Rules vote on all documents; the vote patterns are counted by Spark and only their counts, at
    most three to the power of the number of rules, come to the driver, where the accuracies are estimated. ``kept`` is
    false where the base rules fail (fewer than 20 words, or over 30 % of the words in repeated
    windows), else whether ``quality`` is at least 0.5. Null and empty texts have no words and fail.
    Every row gives one row, repeated ones too; an empty table gives none. One pass over the texts.
    """
    rows = stored(text_statistics(docs, key, text))
    votes = [vote(rule).alias(rule) for rule in RULES]
    patterns = rows.select(*votes).groupBy(*RULES).count().collect()
    prior, right = fit([(tuple(r[:-1]), r[-1]) for r in patterns])
    odds = F.lit(math.log(prior / (1 - prior)))
    for rule, own in zip(RULES, right, strict=True):
        odds = odds + F.when(vote(rule) > 0, F.lit(weight(1, *own))).when(vote(rule) < 0, F.lit(weight(-1, *own))).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return (
        rows.withColumn("base_failed", failed)
        .withColumn("quality", 1 / (1 + F.exp(-odds)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
        .select(key, *STATISTICS, "base_failed", "kept", "quality")
    )
