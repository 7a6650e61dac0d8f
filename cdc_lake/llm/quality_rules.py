"""Quality rules, lines first.

Every line is held against punctuation, navigation and boilerplate rules; lines that break
one are removed, and a document that loses too much of its text is rejected. Everything is
built-in column functions on one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE_RUN, let, total

#: Fixed limits of the base rules.
LEAST_WORDS = 50
MOST_REPEATED = 0.5
WINDOW = 3
_SYMBOL = r"[#*$%&|<>]"

#: A document stays if the removed lines hold at most this share of its word characters.
MOST_LOST = 0.5
#: A line that does not end a sentence and has fewer words is a heading, a label or a button.
FRAGMENT_WORDS = 6
#: A line with a larger share of symbols among its characters is markup, a table or a menu.
MOST_SYMBOLS = 0.08
#: A line of so many characters, all of its letters capitals, is shouted.
SHOUTED_CHARS = 16
#: A longer line is prose, whatever phrase it holds.
BOILERPLATE_WORDS = 30
BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookies?|privacy policy|terms of (use|service)|javascript|lorem ipsum|sign (in|up)"
    r"|log ?in|subscribe|click here|read more|share this|licensed under|copyright|powered by|skip to content)\b|©"
)
_ENDS = r"[.!?…:;][\"'”’»)\]]*[\x20\x09-\x0D]*$"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_RUN), "")


def word_chars(text: Column) -> Column:
    return (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long")


def fewer_words(text: Column, limit: int) -> Column:
    """Whether a text has fewer words than ``limit``; reads no further than that."""
    return text.rlike(r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){0,%d}+$" % (limit - 1))


def repeated_words(words: Column, grams: Column) -> Column:
    """Words inside windows (``grams``, by first word) that occur twice or more.

    Windows are only sorted where the distinct ones are fewer. Cost n log n in the words.
    """

    def covered(ordered: Column) -> Column:
        again = F.filter(ordered, lambda x, i: F.coalesce(F.when(i > 0, F.get(ordered, i - 1)["g"] == x["g"]), F.lit(False))
                         | F.coalesce(F.get(ordered, i + 1)["g"] == x["g"], F.lit(False)))
        places = F.flatten(F.transform(again, lambda x: F.array(*[x["i"] + k for k in range(WINDOW)])))
        return F.size(F.array_distinct(places)).cast("long")

    ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(ordered, covered)).otherwise(F.lit(0).cast("long"))


def line_reason(line: Column) -> Column:
    """The rule that a line with words breaks, or null."""
    return (
        F.when(F.regexp_count(line, F.lit(_SYMBOL)) > MOST_SYMBOLS * word_chars(line), "navigation")
        .when(~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}") & (F.length(line) >= SHOUTED_CHARS), "shouting")
        .when(fewer_words(line, FRAGMENT_WORDS) & ~line.rlike(_ENDS), "punctuation")
        .when(fewer_words(line, BOILERPLATE_WORDS) & line.rlike(BOILERPLATE), "boilerplate")
    )


def quality_rules(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``keep`` columns, the base counts, the verdicts and ``clean_text``.

    ``clean_text`` holds the lines that break no rule, a repeated line only once. ``kept`` is
    false if a base rule fails or more than ``MOST_LOST`` of the word characters are removed.
    A null text has no words: all counts 0, ``base_failed``, not kept, ``clean_text`` empty.
    Ties cannot occur; repeated rows stay; other columns of ``docs`` are not read.
    """
    rows = docs.select(*[docs[name] for name in keep], F.coalesce(docs[text], F.lit("")).alias("_text"))
    rows = rows.select("*", words_of(F.col("_text")).alias("_words"), F.split("_text", "\n", -1).alias("_all_lines"))
    grams = F.transform(
        F.slice("_words", 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))),
        lambda word, i: F.concat_ws(" ", word, *[F.get("_words", i + k) for k in range(1, WINDOW)]),
    )
    rows = rows.select(
        *keep, "_text", "_words", grams.alias("_grams"), F.filter("_all_lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines")
    )
    rows = rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        word_chars(F.col("_text")).alias("word_chars"),
        F.regexp_count("_text", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words"), F.col("_grams")).alias("n_repeat_words"),
        F.filter(F.array_distinct("_lines"), lambda line: line_reason(line).isNull()).alias("_good"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    rows = rows.select("*", total(F.transform("_good", word_chars)).alias("good_chars"))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("word_chars") - F.col("good_chars") <= MOST_LOST * F.col("word_chars"))).alias("kept"),
        "n_lines", "good_chars", F.array_join("_good", "\n").alias("clean_text"),
    )
