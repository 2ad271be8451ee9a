"""Quality rules: a threshold table compiled into one projection, in DataFrame operations only.

A row of ``RULES`` names a ratio and the range a kept document must lie in. ``measured`` adds the base counts,
``verdict`` folds the table into one boolean column; nothing is shuffled and no user function runs.

Defined results: null or empty text has no words and fails; a text without lines or words has ratio 0; rows are
judged one by one, so repeated rows get equal results; other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.llm.batches import text_or_empty

SPACE = r"[\x20\x09-\x0D]+"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as", "was", "on", "by", "this", "be", "are",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine",
    "le", "la", "les", "de", "et", "un", "une", "du", "que", "qui", "en", "pour", "dans", "par", "sur", "au", "avec",
    "el", "los", "las", "y", "se", "una", "con", "para", "su", "no", "al", "lo", "como", "del",
)

#: ratio, smallest and largest value of a kept document
RULES: tuple[tuple[str, float, float], ...] = (
    ("words", 50, float("inf")),
    ("chars_per_word", 2.5, 12.0),
    ("symbols_per_word", 0.0, 0.1),
    ("stop_words_per_word", 0.05, 1.0),
    ("repeated_lines", 0.0, 0.4),
    ("repeated_words", 0.0, 0.5),
)


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def ratios() -> dict[str, Column]:
    return {
        "words": F.col("n_words").cast("double"),
        "chars_per_word": _ratio("word_chars", "n_words"),
        "symbols_per_word": _ratio("n_symbols", "n_words"),
        "stop_words_per_word": _ratio("n_stop_words", "n_words"),
        "repeated_lines": _ratio("n_dup_lines", "n_lines"),
        "repeated_words": _ratio("n_repeat_words", "n_words"),
    }


def measured(docs: DataFrame) -> DataFrame:
    """doc_id with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words and n_repeat_words (long)."""
    text = docs.select("doc_id", text_or_empty().alias("text"))
    split = text.select(
        "doc_id",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).alias("n_symbols"))
    # A window is known by its hash; windows of a text that are equal have equal words.
    windows = split.withColumn("windows", F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2))))
    placed = windows.withColumn("placed", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twice = F.filter("placed", lambda w, i: (w["h"] == F.get("placed", i - 1)["h"]) | (w["h"] == F.get("placed", i + 1)["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))))
    stop = F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS)))
    return placed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        stop.cast("long").alias("n_stop_words"),
        F.when(F.col("placed").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"))


def verdict(rules: tuple[tuple[str, float, float], ...] = RULES) -> Column:
    """All rules of the table as one condition on the columns of ``measured``."""
    value = ratios()
    return reduce(lambda a, b: a & b, (value[name].between(low, high) for name, low, high in rules), F.lit(True))


def quality(docs: DataFrame, rules: tuple[tuple[str, float, float], ...] = RULES) -> DataFrame:
    """The measures with base_failed, and kept: not failed and within every rule."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (measured(docs).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))
