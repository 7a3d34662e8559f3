"""Text columns: words, sentences, scripts, white space, spans. Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let

#: A word: letters, digits and underscores, with hyphens and apostrophes inside.
WORD = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_’'-]*[\p{L}\p{N}_])?"
#: A run of word characters, and a run of anything else.
RUN = r"[\p{L}\p{N}_]+"
PIECE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
#: Where a sentence ends: after a stop, before a capital, underscore, bracket or quote.
SENTENCE_GAP = r"(?<=[.!?])\s+(?=[A-Z_\[\"'])"
#: How a finished line or sentence ends.
TERMINAL = r"[.!?…][\]\)\}\"'_*]*\s*$"
CYRILLIC, LATIN = "[А-Яа-яЁё]", "[A-Za-z]"


def newlines(text: Column) -> Column:
    """CRLF and CR as LF."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\s+", " "))


def fold(text: Column) -> Column:
    """Collapsed, trimmed and lower-cased: the key of lemmas and target evidence."""
    return F.lower(collapse(text))


def word_count(text: Column) -> Column:
    """Words, with hyphens and apostrophes inside."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def run_count(text: Column) -> Column:
    """Bare runs of word characters: "well-known" is two."""
    return F.regexp_count(text, F.lit(RUN)).cast("long")


def count_of(text: Column, literal: str) -> Column:
    """How often a literal occurs (not overlapping)."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / len(literal)).cast("long")


def letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{L}", "")).cast("long")


def script_share(text: Column, script: str = CYRILLIC, alphabet: str = "[A-Za-zА-Яа-яЁё]") -> Column:
    """Share of a script among the letters of an alphabet (both character classes); 0 without any."""
    count = lambda letters: F.length(F.regexp_replace(text, f"[^{letters}]+", ""))  # noqa: E731  (no string for each letter)
    return let(lambda n: F.when(n > 0, count(script) / n).otherwise(F.lit(0.0)), count(alphabet))


def protected_stripped(text: Column) -> Column:
    """Text without ``[...]`` and ``_..._`` spans."""
    bare = ~F.contains(text, F.lit("[")) & ~F.contains(text, F.lit("_"))
    return F.when(bare, text).otherwise(F.regexp_replace(text, r"\[[^\[\]]*\]|_[^_]*_", " "))


def sentences(text: Column) -> Column:
    """Array of raw sentence parts."""
    return F.split(newlines(text), SENTENCE_GAP)


def smart_join(parts: Column) -> Column:
    """Parts joined by spaces, none before closing or after opening punctuation."""
    joined = F.regexp_replace(F.array_join(F.filter(F.transform(parts, strip), lambda p: p != ""), " "), r"\s+([,.;:!?)\]])", "$1")
    return F.regexp_replace(joined, r"([(\[])\s+", "$1")


def wrap_join(lines: Column) -> Column:
    """Hard-wrapped lines as one text: a soft hyphen joins, a hyphen before a lower-case letter stays and joins."""

    def add(out: Column, line: Column) -> Column:
        x = strip(line)
        return (
            F.when(x == "", out)
            .when(out == "", x)
            .when(out.endswith("­"), F.concat(F.substring(out, F.lit(1), F.length(out) - 1), x))
            .when(out.endswith("-") & x.rlike("^[a-z]"), F.concat(out, x))
            .otherwise(F.concat(out, F.lit(" "), x))
        )

    return F.aggregate(lines, F.lit(""), add)


def ngrams(text: Column, n: int) -> Column:
    """Array of the character n-grams of a text; the text itself if it is shorter, none if it is empty."""

    def cut(x: Column) -> Column:
        length = F.length(x)
        return (
            F.when(length >= n, F.transform(F.sequence(F.lit(1), F.greatest(length - n + 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(n))))
            .when(length > 0, F.array(x))
            .otherwise(F.array().cast("array<string>"))
        )

    return let(cut, text)
