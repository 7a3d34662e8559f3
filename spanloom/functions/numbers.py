"""Numeric literals of a text as arrays of normalised values, and what spelled numbers license."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let

#: The three grammars of numerals.
#: A literal that touches no word character: sign, digits, one separator with digits, a denominator.
LITERAL = r"(?U)(?<!\w)([+-]?\d+(?:[.,'’]\d+)?(?:/\d+)?)(?!\w)"
#: Fractions, mixed fractions, grouped thousands and integers, with an English ordinal ending.
EXPLICIT = (
    r"(?iU)(?<!\d)(\d+\s*-\s*\d+\s*/\s*\d+(?:st|nd|rd|th)?|\d+\s*/\s*\d+(?:st|nd|rd|th)?"
    r"|\d{1,3}(?:(?:,\d{3})|(?:[\s  ]\d{3}))+(?:st|nd|rd|th)?|\d+(?:st|nd|rd|th)?)(?!\d)"
)
#: Integers, fractions, mixed fractions and groups parted by spaces.
WHOLE = r"(?U)(?<!\w)(?:\d+-\d+/\d+|\d+/\d+|\d{1,3}(?:[\s\u00a0\u202f]\d{3})+|\d+)(?!\w)"
#: The English number words.
NUMBER_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16,
    "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50,
    "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90,
}


def _value(word: Column) -> Column:
    """A number word's value, null for other words."""
    at = F.array_position(F.array(*[F.lit(w) for w in NUMBER_WORDS]), word)
    return F.get(F.array(*[F.lit(v) for v in NUMBER_WORDS.values()]), (at - 1).cast("int"))


def _plain(part: Column) -> Column:
    """One side of a fraction: no leading zeros, no trailing zeros after the point."""
    sign = F.regexp_extract(part, "^[+-]", 0)
    body = F.regexp_replace(part, "^[+-]", "")
    whole = F.regexp_replace(F.substring_index(body, ".", 1), "^0+(?=.)", "")
    rest = F.when(F.contains(body, F.lit(".")), F.regexp_replace(F.regexp_replace(body, r"^[^.]*\.", ""), "0+$", "")).otherwise("")
    return F.concat(sign, F.when(whole == "", "0").otherwise(whole), F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""))


def normalised(literal: Column) -> Column:
    x = F.translate(literal, "’',", "...")
    left, right = F.substring_index(x, "/", 1), F.regexp_replace(x, "^[^/]*/", "")
    return F.when(F.contains(x, F.lit("/")), F.concat(_plain(left), F.lit("/"), _plain(right))).otherwise(_plain(x))


def literals(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(LITERAL), F.lit(1)), normalised)


def explicit(text: Column) -> Column:
    """Values of the explicit grammar, in order, without spaces, commas and ordinal endings."""
    found = F.regexp_extract_all(text, F.lit(EXPLICIT.replace("(?iU)", r"(?iU)(?=\d)")), F.lit(1))  # every alternative begins with a digit
    return F.transform(found, lambda x: F.regexp_replace(F.regexp_replace(F.lower(x), "(?:st|nd|rd|th)$", ""), r"[\s,  ]", ""))


def integers(text: Column) -> Column:
    """Word runs that are all digits."""
    return F.filter(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda x: x.rlike("^[0-9]+$"))


def licensed(text: Column) -> Column:
    """Distinct values that number words license: tens join a following unit ("twenty one" is 21), each unit counts itself."""

    def values(own: Column) -> Column:
        total = F.transform(own, lambda v, i: F.when((v >= 20) & (F.get(own, i + 1) < 10), v + F.get(own, i + 1)).otherwise(v))
        return F.array_distinct(F.transform(F.filter(total, lambda v: v.isNotNull()), lambda v: v.cast("string")))

    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))
    return let(lambda names: let(values, F.transform(names, lambda w: _value(w))), words)


def spelled(text: Column, most: int = 90) -> Column:
    """The value of every number word up to ``most``, once for each occurrence as a whole word."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    known = [w for w, v in NUMBER_WORDS.items() if v <= most]
    return F.transform(F.filter(words, lambda w: w.isin(*known)), lambda w: _value(w).cast("string"))


def whole(text: Column) -> Column:
    """Integers, fractions and groups of three digits that touch no word character, without spaces."""
    return F.transform(F.regexp_extract_all(text, F.lit(WHOLE), F.lit(0)), lambda x: F.regexp_replace(x, "[\\s\u00a0\u202f]", ""))
