"""Quality rules: a table of thresholds compiled into one projection.

A rule is a name, a ratio or length made of Spark columns, and the least and most value a
document may have. ``apply_rules`` measures every text and compares it with every rule in
the same pass over the table: no shuffle, no Python, no user function. Words are the runs
of characters other than blank and \\t \\n \\v \\f \\r.

Defined cases: a null text counts as empty and has no words; an empty text fails the rules
on length; a ratio with nothing below the line is 0; repeated rows are judged each alone;
columns other than the text are passed on untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import BLANKS

SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by at this are or from an not "
    "de la le les et des en un une du que est pour qui dans par sur au pas avec "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
    "el los y se del las por con no su para lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """The measure must lie within [least, most]; None leaves that side open."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Production thresholds. A clean page of prose in the four languages is far from each.
RULES = (
    Rule("mean_word", "mean_word_chars", 1.5, 20.0),
    Rule("symbols", "symbol_ratio", None, 0.30),
    Rule("stop_words", "stop_ratio", 0.02, None),
    Rule("dup_lines", "dup_line_ratio", None, 0.50),
)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def measures(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` with the lengths and counts that the rules use.

    ``window`` is a power of two. Windows are told apart by 64-bit hashes; within one text
    of a million windows two different ones agree with a chance of 3 in 10**8.

    The steps are projections one above the other, so that each list is made once; Spark
    keeps them in one stage without an exchange.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(whole, "[\\x20\\x09-\\x0D]+"), "")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    placed = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    again = F.filter(
        F.transform(
            "_placed",
            lambda x, k: F.when(
                (F.get("_placed", k - 1)["h"] == x["h"]) | (F.get("_placed", k + 1)["h"] == x["h"]), x["i"]
            ),
        ),
        lambda i: i.isNotNull(),
    )
    covered = F.aggregate(
        F.transform(
            "_again",
            lambda i, k: F.least(
                F.lit(window), F.coalesce(F.get("_again", k + 1) - i, F.lit(window))
            ),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    counted = (
        docs.withColumns({"_words": words, "_lines": lines, "_text": whole})
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.translate("_text", BLANKS, "")).cast("long"),
                "n_symbols": (
                    F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))
                ).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_stop_words": F.size(
                    F.filter("_words", lambda w: w.isin(STOP_WORDS))
                ).cast("long"),
                "_windows": F.transform("_words", lambda w: F.xxhash64(w)),
            }
        )
        .drop("_words", "_lines", "_text")
    )
    # A window's hash is made of the hashes of its halves: three steps reach eight words.
    span = 1
    while span < window:
        halves = F.zip_with(
            "_windows", F.slice("_windows", span + 1, F.size("_windows")), lambda a, b: F.xxhash64(a, b)
        )
        counted = counted.withColumn("_windows", halves)
        span *= 2
    whole_windows = F.slice("_windows", 1, F.greatest(F.col("n_words").cast("int") - (window - 1), F.lit(0)))
    return (
        counted.withColumn("_windows", whole_windows)
        .withColumn("_placed", placed)
        .drop("_windows")
        .withColumn("_again", F.array_sort(again))
        .drop("_placed")
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("_again")
        .withColumns(
            {
                "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
                "symbol_ratio": _ratio(F.col("n_symbols"), F.col("word_chars")),
                # One word more on both sides, so that a few words without any are no evidence.
                "stop_ratio": (F.col("n_stop_words") + 1) / (F.col("n_words") + 1),
                "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
            }
        )
    )


def compile_rules(rules=RULES) -> dict[str, Column]:
    """One boolean column for each rule, true where the rule holds."""
    out = {}
    for rule in rules:
        value, holds = F.col(rule.measure), F.lit(True)
        if rule.least is not None:
            holds = holds & (value >= rule.least)
        if rule.most is not None:
            holds = holds & (value <= rule.most)
        out[rule.name] = holds
    return out


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words",
    "mean_word_chars", "symbol_ratio", "stop_ratio", "dup_line_ratio",
)


def apply_rules(
    docs: DataFrame, rules=RULES, text: str = "text", min_words: int = 20, max_repeat_percent: int = 30
) -> DataFrame:
    """``docs`` with a struct ``quality``: all measures, ``base_failed``, ``failed`` (names of
    the rules broken) and ``kept``. Only this column's name is taken."""
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_raw")
    )
    found = measures(named, "_raw")
    base = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    broken = F.filter(
        F.array(*[F.when(~holds, F.lit(name)) for name, holds in compile_rules(rules).items()]),
        lambda x: x.isNotNull(),
    )
    # The optimiser moves a caller's filter below projections and writes out each step's
    # expression wherever it is used, which doubles with every step. It leaves a filter above
    # a column that is made row by row.
    by_row = F.monotonically_increasing_id() >= 0
    judged = found.withColumns({"base_failed": base, "failed": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0) & by_row
    )
    return judged.select(
        "_row.*", F.struct(*MEASURES, "base_failed", "failed", "kept").alias("quality")
    )


def passing(docs: DataFrame, rules=RULES, text: str = "text", **base) -> DataFrame:
    """The rows of ``docs`` that are kept, as they are."""
    judged = apply_rules(docs, rules, text, **base)
    return judged.filter("quality.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
