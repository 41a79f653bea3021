"""Quality rules, line first, in DataFrame functions only.

Each line of a text is judged by itself; failing lines go, and a document that
loses too much of its text that way is rejected. Beside the line rules stand two
whole-text rules (too few words, too many repeated windows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.llm.runtime import WHITE, let

# Phrases that mark a line as boilerplate (matched in lower case).
BOILERPLATE = (
    "all rights reserved",
    "licensed under the",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "javascript is disabled",
    "enable javascript",
    "subscribe to our newsletter",
)
# Phrases of which a navigation line is made.
NAVIGATION = ("home", "login", "log in", "sign in", "sign up", "register", "menu", "next", "previous", "back to top")


@dataclass(frozen=True)
class Rules:
    """Thresholds. Shares are of the words of a line, or of a text."""

    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    long_line_words: int = 8        # a line this long must hold sentence punctuation
    nav_separators: int = 3         # a line with so many separators between words ...
    nav_share: float = 0.2          # ... at one per five words or more is navigation
    max_symbol_share: float = 0.5   # symbols per word of a line
    max_lost_share: float = 0.5     # words lost with failed lines


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{WHITE}]+"), "")


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def repeated_window_words(words: Column, window: int) -> Column:
    """How many words lie in a ``window``-word run that occurs twice or more.

    Windows are compared by XXH64 first; a text without two equal hashes ends
    there. In the others the windows themselves are sorted, equal neighbours
    marked, and the words they cover summed from the sorted positions.
    """
    at = F.sequence(F.lit(1), F.size(words) - window + 1)

    def covered(sorted_windows: Column) -> Column:
        n = F.size(sorted_windows)
        same = F.filter(
            F.transform(sorted_windows, lambda e, i: F.when(
                ((i > 0) & (F.get(sorted_windows, i - 1)["w"] == e["w"]))
                | ((i < n - 1) & (F.get(sorted_windows, i + 1)["w"] == e["w"])), e["p"])),
            lambda p: p.isNotNull())
        return let(F.array_sort(same), lambda ps: F.aggregate(
            F.transform(ps, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(ps, i + 1) - p, F.lit(window)))),
            F.lit(0), lambda a, b: a + b))

    hashes = F.transform(at, lambda i: F.xxhash64(F.slice(words, i, window)))
    exact = let(F.array_sort(F.transform(
        at, lambda i: F.struct(F.concat_ws(" ", F.slice(words, i, window)).alias("w"), i.alias("p")))), covered)
    return (F.when(F.size(words) < window + 1, 0)
            .otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(exact)))
            .cast("long"))


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether the punctuation, navigation or boilerplate rule removes a line that holds a word."""
    n = F.size(words_of(line))
    low = F.lower(line)
    seps = F.size(F.regexp_extract_all(line, F.lit("[|»›·]"), F.lit(0)))
    symbols = F.size(F.regexp_extract_all(line, F.lit("[#*$%&<>]"), F.lit(0)))
    boiler = F.lit(False)
    for phrase in BOILERPLATE:
        boiler = boiler | F.contains(low, F.lit(phrase))
    return (let(n, lambda k: ((k >= rules.long_line_words) & ~line.rlike("[.!?…。！？]"))
                | (symbols > k * rules.max_symbol_share)
                | ((seps >= rules.nav_separators) & (seps >= k * rules.nav_share)))
            | F.trim(low).isin(*NAVIGATION) | boiler)


def with_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: Rules = Rules()) -> DataFrame:
    """One row per document: counts, verdicts, ``clean_text`` (lines that pass, in order).

    Null text counts as empty: no words, ``base_failed``. An empty table gives an
    empty result. Repeated rows are judged each by itself; columns other than the
    two named are not read, whatever they are called. Texts are taken whole.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    text = F.coalesce(F.col("text"), F.lit(""))

    def counted(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_window_words(words, rules.window).alias("n_repeat_words"))

    def by_line(lines: Column) -> Column:
        good = F.filter(lines, lambda x: ~line_fails(x, rules))
        return F.struct(
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.array_join(good, "\n").alias("clean_text"))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{WHITE}]"))
    counts = base.select("doc_id", let(words_of(F.col("text")), counted).alias("c"), let(lines, by_line).alias("l"),
                         F.size(F.regexp_extract_all(text, F.lit("[#*$%&|<>]"), F.lit(0))).cast("long").alias("n_symbols"))
    kept = n_words_of(F.col("clean_text"))
    failed = ((F.col("n_words") < rules.min_words)
              | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    return (counts.select("doc_id", "c.n_words", "c.word_chars", "n_symbols", "l.n_dup_lines", "c.n_repeat_words",
                          "l.clean_text")
            .withColumn("n_kept_words", kept)
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (F.col("n_words") - F.col("n_kept_words") <= rules.max_lost_share * F.col("n_words"))))
