"""Quality rules: how far a document's characters and words diverge from those
of its language. DataFrame expressions only.

The references are the character classes and the common words of all documents
of a language. A document is compared by the Jensen-Shannon distance (base 2,
so from 0 to 1), and only where it is long enough for a histogram to mean
something. What a text without one common word can reach depends on the share
of these words in the language, and a short text is away from its language by
chance alone; the cut of the word distance lies between the two.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanwork.functions.joins import bounded_broadcast
from gleanwork.session import settle

_BLANKS = " \t\n\x0b\x0c\r"
_BLANK = r"[\x20\x09-\x0D]"
_SYMBOL = r"[#*$%&|<>]"

#: Character classes with a pattern. Blanks, bytes beyond one per character (a
#: measure of the letters beyond ASCII) and all other characters are classes too.
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "symbol": _SYMBOL, "mark": "[.,;:!?]"}

#: Runs of characters that no pattern of ``CLASSES`` has. Two ranges, as Java is
#: slow with a class of many single characters.
_UNCLASSED = r"[^\x21-\x60\x7C]+"


@dataclass(frozen=True)
class Limits:
    """Production thresholds. Common words are the most frequent ones of at
    most ``common_word_chars`` characters, which are mostly function words.
    ``word_distance_share`` is where the cut lies between the distance that
    chance explains (0) and the largest of the language (1). A script without
    blanks has few words, so characters are enough for a reference of classes."""

    common_words: int = 30
    common_word_chars: int = 4
    class_distance: float = 0.30
    class_least_chars: int = 200
    word_distance: float = 0.33
    word_distance_share: float = 0.55
    word_least_words: int = 100
    reference_least_words: int = 2_000
    reference_least_chars: int = 10_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"{_BLANK}+")
    )


def _in_classes(text: Column) -> Column:
    """How many characters each of ``CLASSES`` has, as an array. Only the few
    characters of such a class are looked at once for each."""

    def counts(some: Column) -> Column:
        rest = [F.length(F.regexp_replace(some, f"{p}+", "")) for p in CLASSES.values()]
        return F.array(*[(F.length(some) - n).cast("long") for n in rest])

    return _let(F.regexp_replace(text, _UNCLASSED, ""), counts)


def _counted(text: Column, words: Column, in_classes: Column) -> dict[str, Column]:
    """Code points, those in words, and those of each class."""
    chars = F.length(text).cast("long")
    found = {"n_chars": chars, "word_chars": F.length(F.array_join(words, "")).cast("long")}
    found |= {f"c_{name}": F.get(in_classes, F.lit(i)) for i, name in enumerate(CLASSES)}
    found["c_wide"] = F.octet_length(text) - chars
    return found


def _classes() -> Column:
    """Shares of the classes; they add up to 1."""
    own = [F.col(f"c_{name}") for name in CLASSES]
    blank = F.col("n_chars") - F.col("word_chars")
    rest = F.greatest(F.lit(0), F.col("word_chars") - sum(own[1:], own[0]))
    parts = F.array(*own, blank, F.col("c_wide"), rest)
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda acc, c: acc + c)
    return _let(total, lambda t: F.transform(parts, lambda c: c / t))


def _repeated_words(words: Column) -> Column:
    """Words inside runs of 8 words that occur twice or more."""
    places = lambda w: F.sequence(F.lit(1), F.size(w) - 7)

    def joined(h: Column, step: int) -> Column:
        """Hashes of twice as long runs from those of runs of ``step`` words."""
        n = F.size(h) - step
        return F.zip_with(F.slice(h, 1, n), F.slice(h, 1 + step, n), lambda x, y: F.xxhash64(x, y))

    def hashes(w: Column) -> Column:
        """A hash of the 8 words from each place, every word hashed once."""
        one = F.transform(w, lambda x: F.xxhash64(x))
        four = _let(_let(one, lambda h: joined(h, 1)), lambda h: joined(h, 2))
        return _let(four, lambda h: joined(h, 4))

    def exact(w: Column) -> Column:
        runs = F.sort_array(
            F.transform(
                places(w),
                lambda i: F.struct(F.array_join(F.slice(w, i, 8), " ").alias("run"), i.alias("at")),
            )
        )

        def covered(s: Column) -> Column:
            again = F.filter(
                s,
                lambda x, k: F.coalesce(F.get(s, k - 1)["run"] == x["run"], F.lit(False))
                | F.coalesce(F.get(s, k + 1)["run"] == x["run"], F.lit(False)),
            )
            return F.aggregate(
                F.sort_array(F.transform(again, lambda x: x["at"])),
                F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                lambda acc, at: F.struct(
                    (acc["n"] + 8 - F.greatest(F.lit(0), acc["end"] - at)).alias("n"),
                    (at + 8).alias("end"),
                ),
                lambda acc: acc["n"],
            )

        return _let(runs, covered)

    # Equal runs have equal hashes, so most documents need no more than that.
    seldom = _let(
        words,
        lambda w: F.when(F.size(w) < 8, F.lit(0)).otherwise(
            _let(
                hashes(w),
                lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                    exact(w)
                ),
            )
        ),
    )
    return seldom.cast("long")


def base_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as the struct ``row`` with the base columns, the
    counts of the character classes and the array ``words``."""
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row",
        text.alias("_text"),
        words_of(text).alias("words"),
        _in_classes(text).alias("_in_classes"),
    )
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "row",
        "words",
        F.size("words").cast("long").alias("n_words"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias(
            "n_dup_lines"
        ),
        _repeated_words(F.col("words")).alias("n_repeat_words"),
        *[
            c.alias(n)
            for n, c in _counted(F.col("_text"), F.col("words"), F.col("_in_classes")).items()
        ],
    )
    return rows.withColumns(
        {
            "n_symbols": F.col("c_symbol"),
            "base_failed": (F.col("n_words") < 20)
            | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        }
    )


def references(docs: DataFrame, limits: Limits, text_col: str, lang_col: str) -> DataFrame:
    """``<lang, classes, common, shares, largest>`` per language with enough
    words or characters: shares of the character classes, the most common words
    that hold a letter, their shares, and the word distance of a text without
    any of them. The last three are null with too few words or where none is
    short; the classes are not. Counted over all documents; one row per language."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = docs.select(
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        text.alias("text"),
        words_of(text).alias("words"),
        _in_classes(text).alias("in_classes"),
    )
    counted = _counted(F.col("text"), F.col("words"), F.col("in_classes"))
    sums = settle(
        held.select("lang", F.size("words").alias("total"), *[c.alias(n) for n, c in counted.items()])
        .groupBy("lang")
        .agg(*[F.sum(n).alias(n) for n in ("total", *counted)])
    )
    classes = sums.select("lang", _classes().alias("classes"))
    short = F.filter("words", lambda w: F.length(w) <= limits.common_word_chars)
    counts = (
        held.select("lang", F.explode(short).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    enough_words = F.col("total") >= limits.reference_least_words
    enough_chars = F.col("n_chars") >= limits.reference_least_chars
    totals = sums.filter(enough_words | enough_chars).select("lang", "total")
    # The cut is taken in every task before the rows of a language meet.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (
        counts.filter(F.col("word").rlike(r"\p{L}"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limits.common_words)
    )
    common = top.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top")  # common_words rows
    )
    found = (
        totals.join(classes, "lang")
        .join(common, "lang", "left")
        .withColumn("top", F.when(enough_words, F.col("top")))
        .select(
            "lang",
            "classes",
            F.col("top.word").alias("common"),
            F.transform("top.n", lambda n: n / F.col("total")).alias("shares"),
        )
        .withColumn(
            "largest",
            F.when(
                F.col("common").isNotNull(),
                _distance(
                    _with_rest(F.transform("shares", lambda _: F.lit(0.0))), _with_rest(F.col("shares"))
                ),
            ),
        )
    )
    return settle(found)


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""

    def side(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda x, y: side(x, y) + side(y, x))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def _with_rest(shares: Column) -> Column:
    rest = 1 - F.aggregate(shares, F.lit(0.0), lambda acc, x: acc + x)
    return F.concat(shares, F.array(F.greatest(F.lit(0.0), rest)))


def quality(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    limits: Limits = Limits(),
) -> DataFrame:
    """Every input row as ``row`` with the base columns, ``class_distance``,
    ``word_distance`` and ``kept``.

    A null text is empty and fails the base rules. A null language is a
    language of its own. Distances are null where the document or its
    language's reference is too short, and null never rejects. Repeated rows
    appear each, empty tables give no rows.
    """
    known = references(docs, limits, text_col, lang_col)
    rows = base_rules(docs, text_col).withColumn(
        "lang", F.coalesce(F.col(f"row.`{lang_col}`"), F.lit(""))
    )
    # One row per language, tens of numbers each.
    joined = rows.join(bounded_broadcast(known), "lang", "left")
    hits = F.filter("words", lambda w: F.array_contains("common", w))
    line = F.concat(F.lit(" "), F.array_join(hits, "  "), F.lit(" "))

    def share(line: Column, word: Column) -> Column:
        """Share of the words between blanks in ``line`` that equal ``word``."""
        less = F.octet_length(F.replace(line, F.concat(F.lit(" "), word, F.lit(" ")), F.lit("")))
        return (F.octet_length(line) - less) / (F.octet_length(word) + 2) / F.col("n_words")

    found = _let(line, lambda x: F.transform("common", lambda c: share(x, c)))
    measured = joined.withColumns(
        {
            "class_distance": F.when(
                (F.col("n_chars") >= limits.class_least_chars) & F.col("classes").isNotNull(),
                _let(_classes(), lambda p: _distance(p, F.col("classes"))),
            ),
            "word_distance": F.when(
                (F.col("n_words") >= limits.word_least_words) & F.col("common").isNotNull(),
                _let(found, lambda p: _distance(_with_rest(p), _with_rest(F.col("shares")))),
            ),
        }
    )
    # The mean of the squared distance of a text of the language itself.
    chance = F.size("common") / (8 * math.log(2) * F.greatest(F.lit(1), F.col("n_words")))
    room = F.greatest(F.lit(0.0), F.pow("largest", F.lit(2)) - chance)
    far = F.pow("word_distance", F.lit(2)) > chance + limits.word_distance_share**2 * room
    diverges = (
        F.coalesce(F.col("class_distance") > limits.class_distance, F.lit(False))
        | F.coalesce(F.col("word_distance") > limits.word_distance, F.lit(False))
        | F.coalesce(far, F.lit(False))
    )
    return measured.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "class_distance",
        "word_distance",
        (~F.col("base_failed") & ~diverges).alias("kept"),
    )
