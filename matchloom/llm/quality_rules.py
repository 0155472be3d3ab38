"""Line-first cleaning with document rules, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import bind, count_of, has_word, text_or_empty, without_space, words

SYMBOLS = "#*$%&|<>"
# a line that says one of these is boilerplate
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "lorem ipsum",
    "subscribe to our newsletter",
    "sign in to continue",
    "click here",
)
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
LEAST_KEPT = 0.5  # of a document's words
MAX_LINE_SYMBOLS = 0.3  # symbols to words
MAX_LINE_SHOUTS = 0.3  # exclamation and question marks to words
MIN_SEPARATORS = 3  # of a navigation line, and a tenth of its words at least


LINE_SYMBOLS = "#*$%&<>"
SHOUTS = "!?"
SEPARATORS = "|»•·"


def says_boilerplate(text: Column) -> Column:
    lower = F.lower(text)
    found = F.lit(False)
    for phrase in BOILERPLATE:
        found = found | F.contains(lower, F.lit(phrase))
    return found


def line_fails(line: Column) -> Column:
    """Whether a line breaks a punctuation, navigation or boilerplate rule; a line without a word breaks none.

    Punctuation: many symbols, or many exclamation and question marks, for its words. Navigation: separators
    such as ``|`` stand between its words, a tenth of them at least. Boilerplate: a fixed phrase.
    """
    n = count_of(F.trim(line), " ") + 1
    separators = count_of(line, SEPARATORS)
    punctuation = (count_of(line, LINE_SYMBOLS) > MAX_LINE_SYMBOLS * n) | (
        count_of(line, SHOUTS) > F.greatest(F.lit(3), MAX_LINE_SHOUTS * n)
    )
    navigation = (separators >= MIN_SEPARATORS) & (separators * 10 >= n)
    return has_word(line) & (punctuation | navigation | says_boilerplate(line))


def may_fail(text: Column) -> Column:
    """False only if no line of the text can fail."""
    marks = (count_of(text, LINE_SYMBOLS) > 0) | (count_of(text, SHOUTS) > 3) | (count_of(text, SEPARATORS) >= MIN_SEPARATORS)
    return marks | says_boilerplate(text)


def _line_words(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.size(words(x)))


def repeated_window_words(windows: str) -> Column:
    """Words covered by windows (an array of their hashes, by start) that occur twice or more."""
    at = F.sort_array(F.transform(F.col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(sorted_windows: Column) -> Column:
        n = F.size(sorted_windows)
        return F.sort_array(
            F.filter(
                F.transform(
                    sorted_windows,
                    lambda x, k: F.when(
                        F.coalesce((F.get(sorted_windows, k - 1)["h"] == x["h"]), F.lit(False))
                        | F.coalesce((k + 1 < n) & (F.get(sorted_windows, k + 1)["h"] == x["h"]), F.lit(False)),
                        x["i"],
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        )

    covered = bind(
        bind(at, starts),
        lambda s: F.aggregate(
            s,
            F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
            lambda a, x: F.struct(
                (x + WINDOW).alias("end"), (a["n"] + WINDOW - F.greatest(F.lit(0), a["end"] - x)).alias("n")
            ),
            lambda a: a["n"],
        ),
    )
    several = F.size(F.array_distinct(F.col(windows))) < F.size(F.col(windows))
    return F.when(several, covered).otherwise(F.lit(0)).cast("long")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Judge every document by its lines, and say what is left of its text.

    One row per input row, with all columns of ``docs`` in the struct ``row`` (so that none can clash), then
    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``n_removed_lines``, ``kept_words``, ``cleaned_text`` and ``kept``. A null or empty text has no word, fails
    the base rules and is not kept. No shuffle: documents are judged one by one, so repeated rows, ties and hot
    sources do not matter. A document is kept if it passes the base rules and its lines that pass the line
    rules hold half of its words at least.
    """
    text = text_or_empty()
    first = docs.select(F.struct("*").alias("row"), text.alias("t"))
    split = first.select("row", "t", F.split("t", "\n").alias("lines"), words(F.col("t")).alias("w"))
    n = F.size("w")
    hashes = bind(
        F.col("w"),
        lambda w: F.when(
            F.size(w) >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW))),
        ).otherwise(F.array().cast("array<long>")),
    )
    judged = split.select(
        "row",
        "t",
        n.cast("long").alias("n_words"),
        hashes.alias("windows"),
        F.filter("lines", has_word).alias("full"),
        F.when(may_fail(F.col("t")), F.filter("lines", lambda x: ~line_fails(x))).otherwise(F.col("lines")).alias("good"),
        F.size("lines").alias("n_lines"),
    )
    counted = judged.select(
        "row",
        "n_words",
        F.length(without_space(F.col("t"))).cast("long").alias("word_chars"),
        count_of(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        repeated_window_words("windows").alias("n_repeat_words"),
        (F.col("n_lines") - F.size("good")).cast("long").alias("n_removed_lines"),
        F.when(F.col("n_lines") == F.size("good"), F.col("n_words")).otherwise(_line_words(F.col("good"))).alias("kept_words"),
        F.when(F.col("n_lines") == F.size("good"), F.col("t")).otherwise(F.array_join("good", "\n")).alias("cleaned_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("kept_words") >= LEAST_KEPT * F.col("n_words"))
    )


def clean_documents(docs: DataFrame) -> DataFrame:
    """The kept documents, their text without the lines that failed; other columns as they are."""
    judged = quality_rules(docs).where("kept")
    values = {"text": F.col("cleaned_text"), "n_chars": F.length("cleaned_text").cast("long")}
    return judged.select([values.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
