"""Token expressions. All of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Runs of word characters, or runs of characters that are neither word
# characters nor white space. Unicode classes are spelled out because \w and
# \s are ASCII-only in Java.
WORD_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\x09-\x0D\x1C-\x20\x{85}\p{Z}]+"
NUMBER_PATTERN = r"^-?\p{Nd}+$"
SENTENCE_END = r"([.!?])[\x09-\x0D\x20]+"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Some entries are two words run together; ranking depends on the list as it
# is, so "those" or "least" are not stopped.
STOP_WORDS = """
a the an and or but about above after along amid among
as at by for from in into like minus near of off on
onto out over past per plus since till to under until up
via vs with that can cannot could may might must
need ought shall should will would have had has having be
is am are was were being been get gets got gotten
getting seem seeming seems seemed
enough both all yourthose this these
their some our no neither my
its hisher every either each any another
just mere such merelyright not
only sheer even especially namely more
most lessleast so too pretty quite
rather somewhat sufficientlysame different
when why where how what who whom which
whether whose if anybody anyone anyplace
anything anytimeanywhere everybody everyday
everyone everyplace everythingeverywhere whatever
whenever whereever whichever whoever whomeverhe
him his her she it they them theirs
you your yours me mine I we us much and/or
""".split()
# ----------------------------------------------------------------------------

_SENTENCE_MARK = "\u0001"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space (T-1)."""
    marked = F.regexp_replace(text, SENTENCE_END, "$1" + _SENTENCE_MARK)
    return F.split(marked, _SENTENCE_MARK)


def word_tokens(text: Column) -> Column:
    """Array of word and punctuation tokens (T-2)."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def not_stopped(token: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """False for stop words in any case and for single punctuation marks (T-3)."""
    return ~F.lower(token).isin([*stop_words, *PUNCTUATION])


def not_number(token: Column) -> Column:
    """False for runs of digits, with or without a leading minus (T-4)."""
    return ~token.rlike(NUMBER_PATTERN)


def content_tokens(
    text: Column, stop_words: Iterable[str] = STOP_WORDS, lowercase: bool = False
) -> Column:
    """Tokens left after the stop and number filters, in text order."""
    words = list(stop_words)
    kept = F.filter(word_tokens(text), lambda t: not_stopped(t, words) & not_number(t))
    return F.transform(kept, F.lower) if lowercase else kept


def token_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of an array of tokens.

    A document is one row, so its counts need no shuffle: sort the tokens and
    measure the runs of equal ones.
    """

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        ends = F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == n) | (F.get(ordered, i - 1) != F.get(ordered, i)),
        )
        return let(
            ends,
            lambda e: F.transform(
                e,
                lambda end, j: F.struct(
                    F.get(ordered, end - 1).alias("term"),
                    (end - F.coalesce(F.get(e, j - 1), F.lit(0))).cast("bigint").alias("tf"),
                ),
            ),
        )

    return let(
        F.sort_array(tokens),
        lambda ordered: F.when(F.size(ordered) > 0, runs(ordered)).otherwise(
            F.array().cast("array<struct<term:string,tf:bigint>>")
        ),
    )


def starts_with_letter(term: Column) -> Column:
    """True for terms of the letter part of the vocabulary (T-7)."""
    return term.rlike(r"^\p{L}")


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 where the denominator is 0 (T-15)."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))
