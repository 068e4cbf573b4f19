"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Frequent words of four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "it", "for", "was",
    "le", "la", "les", "de", "des", "et", "en", "un", "une", "que",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "ein",
    "el", "los", "las", "y", "se", "del", "por", "con", "una", "para",
)


class Rule(NamedTuple):
    """Keep a text while ``low <= numerator / denominator <= high``; either bound may be None."""
    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.01, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one boolean column. Ratios are compared as products, so nothing is divided."""
    verdict = F.lit(True)
    for rule in rules:
        top, below = F.col(rule.numerator), F.col(rule.denominator)
        if rule.low is not None:
            verdict = verdict & (top >= F.lit(rule.low) * below)
        if rule.high is not None:
            verdict = verdict & (top <= F.lit(rule.high) * below)
    return verdict


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 50,
            max_repeat_percent: int = 50) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), counts of its text and the verdict.

    Everything is a projection over the scan: no shuffle, no user function, work linear in the text
    but for one sort of its three-word windows. A null text and an empty text have no words and
    fail ``min_words``. Repeated rows give repeated results; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select("doc_id", text.alias("text"), words.alias("words"), lines.alias("lines"))

    n = F.size("words")
    places = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
    windows = F.array_sort(F.transform(places, lambda i: F.struct(
        F.array_join(F.slice("words", i, 3), " ").alias("w"), i.alias("i"))))
    spread = base.select(
        "doc_id", "text", "lines", n.cast("bigint").alias("n_words"),
        F.size(F.filter("words", lambda w: w.isin(*STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        windows.alias("sorted"))
    # In sorted order a window found twice stands beside its equal.
    repeated = F.array_sort(F.transform(F.filter(
        F.zip_with(
            F.col("sorted"),
            F.zip_with(F.concat(F.array(F.lit(None)), F.transform("sorted", lambda x: x["w"])),
                       F.slice(F.transform("sorted", lambda x: x["w"]), 2, F.greatest(F.size("sorted"), F.lit(1))),
                       lambda before, after: F.struct(before.alias("b"), after.alias("a"))),
            lambda x, near: F.struct(
                x["i"].alias("i"),
                (x["w"].eqNullSafe(near["b"]) | x["w"].eqNullSafe(near["a"])).alias("twice"))),
        lambda x: x["i"].isNotNull() & x["twice"]), lambda x: x["i"]))
    marked = spread.select("doc_id", "text", "lines", "n_words", "n_stop_words", repeated.alias("at"))
    # A word counts once: window starts closer than three words share some.
    covered = F.when(F.size("at") == 0, F.lit(0)).otherwise(
        F.lit(3) + F.aggregate(
            F.zip_with(F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))), F.col("at"),
                       lambda b, a: F.least(F.coalesce(b - a, F.lit(0)), F.lit(3))),
            F.lit(0), lambda total, x: total + x))
    counted = marked.select(
        "doc_id", "n_words",
        F.char_length(F.regexp_replace("text", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"),
        "n_stop_words", F.size("lines").cast("bigint").alias("n_lines"))
    failed = (F.col("n_words") < min_words) | \
        (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return counted.withColumn("base_failed", failed) \
        .withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
