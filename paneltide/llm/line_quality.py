"""Quality rules, line first: rules judge each line, failing lines go, and a
document that loses too much of its text goes with them.

DataFrame functions only; one pass over the text without a shuffle.

Defined cases: a null or wordless text has zero counts and fails the base rule;
repeated rows are judged alike, each on its own; ``doc_id`` may be null; other
columns are ignored (``judge``) or passed through (``clean``); an empty table
gives an empty result.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import ASCII_SPACE, ASCII_WORD, fresh

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class LineRules:
    """Parameters of the rules."""
    min_words: int = 50                 # base rule
    max_repeat_percent: int = 50        # base rule
    line_end: str = "[.!?:;,…\"'”’»)\\]}*_-]\\z"
    max_symbol_share: float = 0.05      # symbols among the characters of a line
    max_separators: int = 2             # navigation: '|', bullets, chevrons
    separators: str = "[|•›»·]"
    max_shouts: int = 2                 # '!!' in a line
    boilerplate: str = ("cookie|privacy policy|terms of (use|service)|javascript|click here|"
                        "(sign|log) in|subscribe to|all rights reserved|lorem ipsum|powered by|"
                        "share this|read more")
    max_lost_share: float = 0.3         # of the words' characters


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _line_passes(line: Column, r: LineRules) -> Column:
    """A blank line passes; others must end like prose and be neither symbols,
    navigation, shouting nor boilerplate."""
    t = F.trim(line)
    symbols = _count(t, SYMBOLS + "+")
    prose = (t.rlike(r.line_end) & (symbols <= F.length(t) * r.max_symbol_share)
             & (_count(t, r.separators) <= r.max_separators)
             & (_count(t, "!!") <= 2 * r.max_shouts)
             & ~F.lower(t).rlike(r.boilerplate))
    return (F.length(F.regexp_replace(line, ASCII_SPACE + "+", "")) == 0) | prose


def _repeat_words(windows: Column) -> tuple[Column, Column, Column]:
    """Words inside 3-word windows that occur twice or more in the text."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = F.filter(F.col("_pairs"), lambda s, i: (s["h"] == F.get(F.col("_pairs"), i - 1)["h"])
                    | (s["h"] == F.get(F.col("_pairs"), i + 1)["h"]))
    at = F.array_sort(F.transform(same, lambda s: s["i"]))
    gaps = F.transform(F.col("_at"), lambda x, k: F.coalesce(
        F.least(F.lit(3), F.get(F.col("_at"), k + 1) - x), F.lit(3)))
    return pairs, at, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)


def _measured(docs: DataFrame, columns: list[Column], text: Column, r: LineRules) -> DataFrame:
    text = F.coalesce(text, F.lit(""))
    df = docs.select(*columns, text.alias("_text"))
    df = df.select("*", F.filter(F.split("_text", ASCII_SPACE + "+"), lambda w: w != "").alias("_words"),
                   F.split("_text", "\n").alias("_lines"))
    df = df.select("*", F.size("_words").cast("long").alias("_n"),
                   F.when(F.size("_words") >= 3, F.slice(F.transform(
                       "_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
                       1, F.greatest(F.size("_words") - 2, F.lit(1))))
                   .otherwise(F.array().cast("array<bigint>")).alias("_windows"),
                   F.filter("_lines", lambda line: line.rlike(ASCII_WORD)).alias("_full"),
                   F.filter("_lines", lambda line: _line_passes(line, r)).alias("_kept"))
    df = df.withColumn("_repeats", F.size("_windows") > F.size(F.array_distinct("_windows")))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs, at, total = _repeat_words(F.col("_windows"))
    df = df.withColumn("_pairs", F.when(F.col("_repeats"), pairs).otherwise(nothing))
    df = df.withColumn("_at", at)
    chars = F.length(F.regexp_replace("_text", ASCII_SPACE + "+", ""))
    df = df.withColumn("_n_repeat", total).withColumn("_chars", chars.cast("long"))
    df = df.withColumn("_cleaned", F.array_join("_kept", "\n"))
    lost = F.col("_chars") - F.length(F.regexp_replace("_cleaned", ASCII_SPACE + "+", ""))
    df = df.withColumn("_lost", lost.cast("long")).withColumn(
        "_failed", (F.col("_n") < r.min_words)
        | (F.col("_n_repeat") * 100 > F.col("_n") * r.max_repeat_percent))
    return df.withColumn("_ok", ~F.col("_failed") & (F.col("_lost") <= F.col("_chars") * r.max_lost_share))


def judge(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: the base counts, how much the line rules remove,
    the cleaned text and the verdict."""
    m = _measured(docs, [F.col(id_col).alias("doc_id")], F.col(text_col), rules)
    return m.select("doc_id", F.col("_n").alias("n_words"), F.col("_chars").alias("word_chars"),
                    _count(F.col("_text"), SYMBOLS + "+").cast("long").alias("n_symbols"),
                    (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
                    F.col("_n_repeat").alias("n_repeat_words"), F.col("_failed").alias("base_failed"),
                    (F.size("_lines") - F.size("_kept")).cast("long").alias("lines_removed"),
                    F.col("_lost").alias("chars_removed"), F.col("_cleaned").alias("cleaned"),
                    F.col("_ok").alias("kept"))


def clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with failing lines removed from ``text`` (and
    ``n_chars``, where present, counted anew); all columns of ``docs`` stay."""
    row = fresh(docs, "row")
    m = _measured(docs, [F.struct(*(docs[c] for c in docs.columns)).alias(row)], F.col("text"), rules)
    # a generator, not a filter: a filter on the verdict would be pushed down and every
    # measure computed once more for it
    passed = F.when(F.col("_ok"), F.array("_cleaned")).otherwise(F.array().cast("array<string>"))
    m = m.select(row, F.explode(passed).alias("_cleaned"))
    new = {"text": F.col("_cleaned"), "n_chars": F.char_length("_cleaned").cast("long")}
    return m.select(*(new[c].alias(c) if c in new else F.col(row)[c].alias(c) for c in docs.columns))
