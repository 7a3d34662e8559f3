"""The suffix stripper of Porter (1980), for English words."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the published algorithm: suffixes of steps 2, 3 and 4.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent",
    "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(stem: str) -> str:
    """c and v for each letter; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(stem):
        out += "v" if ch in "aeiou" or (ch == "y" and i and out[-1] == "c") else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _cvc(stem: str) -> bool:
    return _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _double(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _swap(word: str, table: dict[str, str]) -> str:
    for suffix in sorted((s for s in table if word.endswith(s)), key=len, reverse=True)[:1]:
        stem = word[: -len(suffix)]
        return stem + table[suffix] if _measure(stem) > 0 else word
    return word


@lru_cache(1 << 16)
def stem(word: str) -> str:
    if len(word) < 3:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        cut = next((word[: -len(s)] for s in ("ed", "ing") if word.endswith(s) and "v" in _shape(word[: -len(s)])), None)
        if cut is not None:
            if cut.endswith(("at", "bl", "iz")):
                word = cut + "e"
            elif _double(cut) and cut[-1] not in "lsz":
                word = cut[:-1]
            elif _measure(cut) == 1 and _cvc(cut):
                word = cut + "e"
            else:
                word = cut
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(_swap(word, STEP2), STEP3)
    suffix = max((s for s in STEP4 if word.endswith(s)), key=len, default="")
    if suffix:
        left = word[: -len(suffix)]
        if _measure(left) > 1 and (suffix != "ion" or left.endswith(("s", "t"))):
            word = left
    if word.endswith("e"):
        left = word[:-1]
        if _measure(left) > 1 or (_measure(left) == 1 and not _cvc(left)):
            word = left
    if _measure(word) > 1 and _double(word) and word[-1] == "l":
        word = word[:-1]
    return word


def stems(words: Column) -> Column:
    """Stem of a column of lower-case words."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda w: None if w is None else stem(w))

    return F.pandas_udf(run, "string")(words)
