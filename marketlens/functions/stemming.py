"""Stemming of English words by Porter's algorithm (1980), for which there is no built-in."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The suffixes of steps 2, 3 and 4 with what stands for them, as published.
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(stem: str) -> str:
    """Consonants as c and vowels as v; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(stem):
        out += "v" if ch in "aeiou" or (ch == "y" and i and out[-1] == "c") else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_end(stem: str) -> bool:
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _double(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def stem(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters, and others than a to z, stay."""
    if len(word) < 3 or not re.fullmatch("[a-z]+", word):
        return word
    # plurals
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past and progressive
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        cut = next((word[: -len(e)] for e in ("ed", "ing") if word.endswith(e) and "v" in _shape(word[: -len(e)])), None)
        if cut is not None:
            if cut.endswith(("at", "bl", "iz")):
                word = cut + "e"
            elif _double(cut) and cut[-1] not in "lsz":
                word = cut[:-1]
            else:
                word = cut + "e" if _measure(cut) == 1 and _short_end(cut) else cut
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for table in (_STEP2, _STEP3):
        # of the suffixes that fit the longest decides
        for suffix, put in sorted(table, key=lambda x: -len(x[0])):
            if word.endswith(suffix):
                head = word[: -len(suffix)]
                word = head + put if _measure(head) > 0 else word
                break
    for suffix in sorted(_STEP4, key=len, reverse=True):
        if word.endswith(suffix):
            head = word[: -len(suffix)]
            if _measure(head) > 1 and (suffix != "ion" or head.endswith(("s", "t"))):
                word = head
            break
    if word.endswith("e"):
        head = word[:-1]
        if _measure(head) > 1 or (_measure(head) == 1 and not _short_end(head)):
            word = head
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stemmed(c: Column) -> Column:
    """Stems of words; apply it to distinct words, not to every occurrence."""
    return F.pandas_udf(_stems, "string")(c)


def _stems(words: pd.Series) -> pd.Series:
    return words.map(stem, na_action="ignore")
