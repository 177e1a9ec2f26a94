"""Whitespace and letter case of categorical text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points counted as white space (the Unicode White_Space
# property and the four ASCII separators).
WHITE_SPACE_CODES = (
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288,
)
WHITE_SPACE = "".join(map(chr, WHITE_SPACE_CODES))


def _plain(code: Column) -> Column:
    """A printable ASCII character other than the space, by its code."""
    return code.between(33, 126)


def strip(value: Column) -> Column:
    """Drop white space of any kind at both ends.

    Most values have none. They are recognised by their first and last character,
    which costs a fraction of searching the long list of white space.
    """
    bare = _plain(F.ascii(value)) & _plain(F.ascii(F.substring(value, -1, 1)))
    return F.when(bare, value).otherwise(F.btrim(value, F.lit(WHITE_SPACE)))


def title_case(value: Column) -> Column:
    """Capitalise every run of letters and lower the rest.

    ``initcap`` knows only spaces as word limits. A marked space is put before
    each letter that follows another non-letter, and taken out again. Single
    plain words, the usual case, need neither.
    """
    word = F.concat(F.upper(F.substring(value, 1, 1)), F.lower(F.substring(value, 2, 1 << 30)))
    marked = F.regexp_replace(value, r"([^\p{L} ])(?=\p{L})", "$1\u0001 ")
    phrase = F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))
    return F.when(value.rlike("^[A-Za-z]*$"), word).otherwise(phrase)
