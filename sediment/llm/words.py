"""Words, lower case and row identity as Column expressions, shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space between words, and what separates words of letters and digits, as patterns.
SPACES = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole(text: Column) -> Column:
    """The text; a null is an empty one."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Texts of one byte a character take the faster `lower`."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def split_words(text: Column, gap: str) -> Column:
    """The pieces between gaps, in order; a null or empty text has none."""
    return F.array_remove(F.split(whole(text), gap, -1), "")


def text_key(text: Column) -> Column:
    """Tells apart rows of one id that hold different texts; null and empty differ too."""
    return F.xxhash64(F.coalesce(F.octet_length(text), F.lit(-1)), text)
