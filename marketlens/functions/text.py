"""Text cleaning as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "we", "will", "with", "you")


def squeeze(c: Column) -> Column:
    """Without outer blanks, inner runs of blanks as one."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def dedupe_list(c: Column, sep: str = ",") -> Column:
    """A list in one string without repeats and outer blanks, in order of first appearance."""
    return F.array_join(F.array_distinct(F.transform(F.split(c, sep), lambda x: F.trim(x))), sep)


def weighted_document(parts: list[tuple[Column, int]]) -> Column:
    """Fields joined to one document, each repeated by its weight; null fields add nothing."""
    return F.trim(F.concat(*[F.repeat(F.concat(F.lit(" "), F.coalesce(c, F.lit(""))), n) for c, n in parts]))


def ascii_only(c: Column, put: str = "") -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", put)


def html_text(c: Column) -> Column:
    """Text of markup: tags become blanks, the common entities their characters."""
    for entity, char in (("&nbsp;", " "), ("&bull;", " "), ("&#44;", ","), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return squeeze(F.regexp_replace(c, "<[^>]*>", " "))


def letters_digits(c: Column) -> Column:
    """Anything but Latin letters, digits and blanks as a blank, squeezed."""
    return squeeze(F.regexp_replace(c, "[^A-Za-z0-9 ]", " "))


def tokens(c: Column) -> Column:
    """Lower-case words."""
    return F.filter(F.split(F.lower(letters_digits(c)), " "), lambda x: x != "")


def without_stop_words(words: Column) -> Column:
    return F.filter(words, lambda x: ~x.isin(*STOP_WORDS) & ~x.rlike("^[0-9]+$"))


def ngrams(words: Column, n: int) -> Column:
    """Phrases of n neighbouring words; fewer words give none."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def longest_only(phrases: Column) -> Column:
    """Phrases that no other of the list contains."""
    return F.filter(phrases, lambda x: ~F.exists(phrases, lambda y: (y != x) & F.contains(y, x)))


def numbers(c: Column) -> Column:
    """The decimal numbers in a range text."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"[0-9]+(?:\.[0-9]+)?"), F.lit(0)), lambda x: x.try_cast("double"))


def split_units(c: Column) -> Column:
    """A blank between a number and the word glued to it."""
    return F.regexp_replace(c, "([0-9])([A-Za-z])", "$1 $2")


def without_units(c: Column) -> Column:
    """Without words that are a number with a unit."""
    return squeeze(F.regexp_replace(c, r"\b[0-9]+[a-z]+\b", " "))


def without_version(c: Column) -> Column:
    """``c 2.0`` as ``c``; digits alone as null."""
    bare = F.regexp_replace(F.trim(c), r"\s+v?[0-9]+(\.[0-9]+)*$", "")
    return F.when(~bare.rlike("^[0-9 .]*$"), bare)


def decoded_twice(c: Column) -> Column:
    """Percent-decoded twice; text that is no valid encoding stays as it was."""
    once = F.coalesce(F.try_url_decode(c), c)
    return F.coalesce(F.try_url_decode(once), once)


def parameter(url: Column, name: str) -> Column:
    """A parameter of a query string, '' where it is absent."""
    return F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)


def agent_family(c: Column, table: list[tuple[str, str]], other: str = "other") -> Column:
    """The first family of an ordered table of patterns that a user agent matches."""
    out = F.lit(other)
    for pattern, name in reversed(table):
        out = F.when(c.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def prose_list(items: Column) -> Column:
    """``a, b and c``."""
    n = F.size(items)
    return F.when(n <= 1, F.array_join(items, ", ")).otherwise(F.concat(F.array_join(F.slice(items, 1, n - 1), ", "), F.lit(" and "), F.element_at(items, -1)))


def overlap_ratio(a: Column, b: Column, over: Column) -> Column:
    """Distinct words of both over the distinct words of one, to four places; null where that has none."""
    return F.round(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_distinct(over))), 4)


def replaced(c: Column, phrases: Sequence[tuple[str, str]], parts: Sequence[tuple[str, str]] = ()) -> Column:
    """Whole-word phrases replaced in their order, then strings wherever they stand: both lists are short and ordered."""
    for old, new in phrases:
        c = F.regexp_replace(c, rf"\b{old}\b", new)
    for old, new in parts:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def first_word(c: Column, words: Sequence[str]) -> Column:
    """The first of a list of words that stands in a text as a whole word; null if none does."""
    out = F.lit(None).cast("string")
    for w in reversed(words):
        out = F.when(c.rlike(rf"\b{w}\b"), F.lit(w)).otherwise(out)
    return out
