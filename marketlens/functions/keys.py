"""Normal forms of keys as the feeds write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_ENTITY = ("", "0", "none", "null")  # fixed values: texts that mean no candidate
NO_KEY = (0, -1)  # fixed values: numbers that mean no key
BLANKS = " \t\n\r\f\v\u00a0\u200b"


def stripped(c: Column) -> Column:
    """``c`` without outer blanks of any kind."""
    return F.trim(c, F.lit(BLANKS))


def entity_id(c: Column) -> Column:
    """A candidate id without case and outer blanks; null where it means no candidate."""
    key = F.lower(stripped(c))
    return F.when(key.isin(*NO_ENTITY), F.lit(None)).otherwise(key)


def whole_key(c: Column) -> Column:
    """A key that is a whole number, from text (``' 0042'``, ``'42.0'``) or a number; null where it is none, 0 or -1."""
    text = stripped(c.cast("string"))
    number = F.when(text.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.regexp_replace(text, r"\.0*$", "").try_cast("bigint"))
    return F.when(~number.isin(*NO_KEY), number)


def portable_hash(c: Column, seed: int = 0) -> Column:
    """60 bits of the MD5 of a key and a seed: a hash that other engines have too."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", c.cast("string"), F.lit(seed))), 1, 15), 16, 10).cast("bigint")
