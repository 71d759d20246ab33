"""Quality rules, line by line first: failing lines go, then documents that lose too much.

Words are runs of anything but ASCII white space. A line of a text fails if it ends without
punctuation, reads like a navigation bar, is thick with symbols or exclamation marks, or is
a short line of site boilerplate. A document is rejected by its base counts, or if the
failing lines hold more than ``MOST_LOST`` percent of its words.

Only DataFrame functions are used, and only within a row: nothing is shuffled. Null text
counts as empty: it has no words, fails the base rules and is rejected. Rows are independent,
so repeated rows and very long texts need no care; work per text grows as n log n.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEWEST_WORDS = 50
MOST_REPEATED = 50
MOST_LOST = 50
# ASCII white space, and the characters counted as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
# What may close a line, what marks a sentence's end inside it, characters that are rare in
# running text, and phrases of site furniture.
LINE_ENDS = ".!?:;…\"'”’»)]"
SENTENCE_ENDS = (". ", "! ", "? ")
THICK = r"[#*$%&<>@^~=_\\]"
FURNITURE = (
    r"(cookies?|privacy policy|terms of (use|service)|all rights reserved|click here|"
    r"sign (in|up)|log ?in|subscribe|newsletter|javascript|share this|read more)"
)
SHORT_LINE = 15
# Bits of a window's start in its key: a string has less than 2^30 words.
START_BITS = 30


def _spaced(text: Column) -> Column:
    """The text with every ASCII white space as a blank, none at its ends."""
    return F.trim(F.translate(text, SPACES, " " * len(SPACES)))


def _words(spaced: Column) -> Column:
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " +"))


def _without(text: Column, part: str) -> Column:
    return F.replace(text, F.lit(part), F.lit(""))


def line_passes(spaced: Column, n_words: Column, letters: Column) -> Column:
    """Whether a line is text: given in blanks, with its numbers of words and of other
    characters than blanks.
    """
    ends = F.right(spaced, F.lit(1)).isin(*LINE_ENDS)
    for mark in SENTENCE_ENDS:
        ends = ends | F.contains(spaced, F.lit(mark))
    bars = F.length(spaced) - F.length(_without(spaced, "|"))
    shouts = F.length(spaced) - F.length(_without(spaced, "!"))
    thick = F.regexp_count(spaced, F.lit(THICK)) * 10 > letters
    furniture = (n_words <= SHORT_LINE) & F.lower(spaced).rlike(FURNITURE)
    return ends & ~(bars * 5 >= n_words) & ~(shouts * 3 > n_words) & ~thick & ~furniture


def _judged_lines(text: Column) -> Column:
    """Every line as ``line``, ``n`` words, ``letters`` and ``ok``; lines without words are ok."""

    def blank(line: Column) -> Column:
        return F.struct(line.alias("line"), _spaced(line).alias("spaced"))

    def count(x: Column) -> Column:
        spaced = x["spaced"]
        n, letters = F.size(_words(spaced)), F.length(_without(spaced, " "))
        return F.struct(x["line"], spaced, n.alias("n"), letters.alias("letters"))

    def judge(x: Column) -> Column:
        ok = (x["n"] == 0) | line_passes(x["spaced"], x["n"], x["letters"])
        return F.struct(x["line"], x["n"], x["letters"], ok.alias("ok"))

    return F.transform(F.transform(F.transform(F.split(text, "\n"), blank), count), judge)


def _keys(words: Column) -> Column:
    """A long for each three-word window, rising: hash of the window, then its start.

    Plain longs sort many times faster than texts.
    """

    def key(n: Column) -> Column:
        mark = F.xxhash64(F.get(words, n), F.get(words, n + 1), F.get(words, n + 2))
        return F.shiftleft(mark, START_BITS) + n

    return F.sort_array(F.transform(_starts(words), key))


def _starts(words: Column) -> Column:
    some = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3))
    return F.coalesce(some, F.array().cast("array<int>"))


def _beside_equal(
    items: Column, of: Callable[[Column], Column], start: Callable[[Column], Column]
) -> Column:
    """Starts of those sorted items that have the same value as a neighbour."""

    def picked(item: Column, n: Column) -> Column:
        again = (of(item) == of(F.get(items, n - 1))) | (of(item) == of(F.get(items, n + 1)))
        return F.when(F.coalesce(again, F.lit(False)), start(item))

    return F.array_compact(F.transform(items, picked))


def _windows(words: Column, keys: Column) -> Column:
    """The windows whose hash occurs again, sorted by their text."""

    def window(n: Column) -> Column:
        text = F.concat_ws(" ", F.get(words, n), F.get(words, n + 1), F.get(words, n + 2))
        return F.struct(text.alias("text"), n.alias("n"))

    below = F.lit((1 << START_BITS) - 1)
    starts = _beside_equal(
        keys,
        lambda key: F.shiftright(key, START_BITS),
        lambda key: key.bitwiseAND(below).cast("int"),
    )
    return F.sort_array(F.transform(starts, window))


def _repeated_starts(windows: Column) -> Column:
    """Starts of the windows that occur more than once, rising."""
    return F.sort_array(
        _beside_equal(windows, lambda window: window["text"], lambda window: window["n"])
    )


def _covered(starts: Column) -> Column:
    """Words in three-word windows with these rising starts."""
    begin = F.struct(F.lit(0).alias("words"), F.lit(-3).alias("last"))

    def add(so_far: Column, start: Column) -> Column:
        new = F.least(F.lit(3), start - so_far["last"])
        return F.struct((so_far["words"] + new).alias("words"), start.alias("last"))

    return F.aggregate(starts, begin, add, lambda done: done["words"])


def judge_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the column ``quality``: the counts, the verdict ``kept`` and the ``cleaned`` text.

    Columns of the input stay as they are, whatever their names, but for one named
    ``quality``, which is replaced, and names that begin with ``_quality``, which are reserved.
    """
    # Every step is a plain column of its own, as the optimizer copies the parts of a struct to
    # all places that use them, and they would be computed there again.
    whole = F.coalesce(F.col(text), F.lit(""))
    words, lines = F.col("_quality_words"), F.col("_quality_lines")
    found, counted = F.col("_quality_found"), "_quality_"
    steps = docs.withColumns(
        {
            "_quality_words": _words(_spaced(whole)),
            "_quality_lines": _judged_lines(whole),
        }
    )
    for step in (_keys(words), _windows(words, found), _repeated_starts(found)):
        steps = steps.withColumn("_quality_found", step)
    worded = F.transform(F.filter(lines, lambda x: x["n"] > 0), lambda x: x["line"])
    lost = F.aggregate(
        lines, F.lit(0), lambda total, x: total + F.when(x["ok"], 0).otherwise(x["n"])
    )
    cleaned = F.transform(F.filter(lines, lambda x: x["ok"]), lambda x: x["line"])
    results = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.aggregate(lines, F.lit(0), lambda n, x: n + x["letters"]).cast("long"),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_quality_worded") - F.size(F.array_distinct("_quality_worded"))).cast(
            "long"
        ),
        "n_repeat_words": _covered(found).cast("long"),
        "n_lost_words": lost.cast("long"),
        "cleaned": F.array_join(cleaned, "\n"),
    }
    steps = steps.withColumn("_quality_worded", worded)
    steps = steps.withColumns({counted + name: value for name, value in results.items()})
    n = F.col("_quality_n_words")
    failed = (n < FEWEST_WORDS) | (F.col("_quality_n_repeat_words") * 100 > n * MOST_REPEATED)
    steps = steps.withColumn("_quality_failed", failed)
    kept = ~F.col("_quality_failed") & (F.col("_quality_n_lost_words") * 100 <= n * MOST_LOST)
    quality = F.struct(
        *(F.col(counted + name).alias(name) for name in results),
        F.col("_quality_failed").alias("base_failed"),
        kept.alias("kept"),
    )
    own = [name for name in docs.columns if name != "quality"]
    # Exploded from an array of one, as a filter on the result would otherwise be pushed below
    # the steps, with all of them written out in it.
    one = F.explode(F.array(quality)).alias("quality")
    return steps.select(*(F.col(f"`{name}`") for name in own), one)
