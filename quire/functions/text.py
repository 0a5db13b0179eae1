"""Text expressions that Spark has not built in. White space is that of Unicode, as everywhere here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a character class of Java and RE2 alike.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Characters of the Hebrew block, and its vowel signs.
HEBREW = r"[\x{590}-\x{5ff}]"
NIKUD = r"[\x{5b0}-\x{5bd}\x{5bf}\x{5c1}\x{5c2}]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def strip_of(c: Column, chars: str) -> Column:
    """Without any of ``chars`` at both ends."""
    own = "[" + "".join(f"\\x{{{ord(x):x}}}" for x in chars) + "]"
    return F.regexp_replace(c, f"^{own}+|{own}+$", "")


def is_blank(c: Column) -> Column:
    return ~F.coalesce(c, F.lit("")).rlike(f"[^{SPACE[1:]}")


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, one after the other."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def stem(filename: Column) -> Column:
    """File name without its last suffix; a name that only starts with a point keeps it."""
    return F.regexp_replace(filename, r"(?<=[^/])\.[^./]*$", "")


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)
