"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import replace_columns

SPACE = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WORD = r"[^\x20\x09-\x0D]"
LETTER = r"\p{L}"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it with as was on be by this are from or an at",
    "der die das und ist von den mit zu ein eine für auf nicht sich des dem im als",
    "le la les de des et un une du en est que qui dans pour par sur pas au avec",
    "el los las y una es por con para se del al lo su no como",
)


class Rule(NamedTuple):
    """Bounds of a metric of ``metrics()``, both inclusive; None does not bind."""

    metric: str
    least: float | None
    most: float | None


BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50
RULES = (
    Rule("mean_word_chars", 1.5, 20.0),
    Rule("symbols_per_word", None, 0.2),
    Rule("stop_word_ratio", 0.03, None),
    Rule("letter_word_ratio", 0.6, None),
    Rule("dup_line_ratio", None, 0.5),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_letter_words")


def metrics() -> dict[str, Column]:
    def per(count: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(count) / F.col(of)).otherwise(F.lit(0.0))

    return {
        "n_words": F.col("n_words"),
        "repeat_word_ratio": per("n_repeat_words", "n_words"),
        "mean_word_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "stop_word_ratio": per("n_stop_words", "n_words"),
        "letter_word_ratio": per("n_letter_words", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
    }


def passes(rules: Sequence[Rule]) -> Column:
    """The threshold table as one boolean expression over the counts."""
    known = metrics()
    parts = [known[rule.metric] >= rule.least for rule in rules if rule.least is not None]
    parts += [known[rule.metric] <= rule.most for rule in rules if rule.most is not None]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def quality_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts that the rules look at, all long. Existing columns of these names are replaced.

    Words are runs without ASCII white space; lines are split at line feeds and count if they have a
    word. Null and empty texts count as no words; counts and ratios are then 0. Work per text is
    n log n in its words, so very long texts are no special case.
    """
    kept = replace_columns(df, *COUNTS)
    names = [F.col(f"`{name}`") for name in kept.columns]
    # Stop words count in lower case, capitalised or in capitals; looking up three spellings spares
    # changing the case of every word.
    listed = [word for line in STOP_WORDS for word in line.split()]
    stop_words = sorted({form for word in listed for form in (word, word.capitalize(), word.upper())})
    lines = F.filter(F.split(F.col("__text"), "\n"), lambda line: line.rlike(WORD))
    step = kept.withColumn("__text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    step = step.withColumn("__words", F.array_remove(F.split("__text", f"{SPACE}+"), ""))
    step = step.withColumn("__lines", lines)
    gram = lambda i: F.xxhash64(
        F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)
    )
    none = F.array().cast("array<bigint>")
    many = F.size("__words") >= 3
    step = step.withColumn(
        "__grams", F.when(many, F.transform(F.sequence(F.lit(0), F.size("__words") - 3), gram)).otherwise(none)
    )
    # Most texts have no window twice, which a sort of plain numbers shows.
    step = step.withColumn("__sorted", F.sort_array("__grams"))
    any_twice = F.size(F.array_distinct("__sorted")) < F.size("__grams")
    pairs = F.transform("__grams", lambda g, i: F.struct(g.alias("gram"), i.alias("at")))
    step = step.withColumn(
        "__pairs", F.when(any_twice, F.sort_array(pairs)).otherwise(F.array().cast("array<struct<gram:bigint,at:int>>"))
    )
    equal_at = lambda x, i: F.coalesce(F.get("__pairs", i)["gram"] == x["gram"], F.lit(False))
    starts = F.transform(
        F.filter("__pairs", lambda x, i: equal_at(x, i - 1) | equal_at(x, i + 1)), lambda x: x["at"]
    )
    step = step.withColumn("__starts", F.sort_array(starts))
    # A window covers three words, fewer if the next one begins before its end.
    covered = F.transform(
        "__starts", lambda at, i: F.coalesce(F.least(F.lit(3), F.get("__starts", i + 1) - at), F.lit(3)).cast("bigint")
    )
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": F.regexp_count("__text", F.lit(SYMBOL)),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, b: a + b),
        "n_stop_words": F.size(F.filter("__words", lambda word: word.isin(stop_words))),
        "n_letter_words": F.size(F.filter("__words", lambda word: word.rlike(LETTER))),
    }
    return step.select(*names, *[value.cast("bigint").alias(name) for name, value in counts.items()])


def apply_rules(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``quality_counts`` with ``base_failed`` and ``kept``; no row is dropped.

    Under 50 words, so also a null or empty text, fail the base rules. Rows do not look at each other:
    equal rows get equal verdicts and an empty table stays empty.
    """
    counted = quality_counts(replace_columns(df, "base_failed", "kept"), text)
    base = (F.col("n_words") >= BASE_WORDS) & (
        100 * F.col("n_repeat_words") <= BASE_REPEAT_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", ~base).withColumn("kept", base & passes(rules))
