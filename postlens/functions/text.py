"""Text clean-up, keys and small helpers, all as built-in column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.fixed_values import NEW_MARK

# What counts as white space at the ends of a value: Unicode spaces and controls, without the no-break ones.
WHITESPACE = "".join(
    chr(c)
    for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x205F, 0x3000)
    if c != 0x2007
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def lower_trim(c: Column | str) -> Column:
    return F.lower(strip(c))


def upper_trim(c: Column | str) -> Column:
    return F.upper(strip(c))


_MARK = "\ue000 "  # private-use character and a space: makes `initcap` start a word there


def initcap_trim(c: Column | str) -> Column:
    """Upper-case the first letter after every word boundary; `initcap` alone only looks at spaces."""
    inner_start = r"([^\p{L}\p{M}\p{Nd}_ ])(?=[\p{L}\p{M}\p{Nd}_])"
    marked = F.regexp_replace(lower_trim(c), inner_start, f"$1{_MARK}")
    sharp_s, held = F.lit("ß"), F.lit("\ue001")  # has no single upper-case letter: stays as it is
    capital = F.replace(F.initcap(F.replace(marked, sharp_s, held)), held, sharp_s)
    return F.replace(capital, F.lit(_MARK), F.lit(""))


def strip_commas(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(","), F.lit(""))


def normal_location(c: Column | str) -> Column:
    without_mark = F.replace(F.lower(col(c)), F.lit(NEW_MARK), F.lit(""))
    return strip(F.replace(without_mark, F.lit("&"), F.lit("-")))


def surrogate_key(*parts: Column | str) -> Column:
    """Upper-case hex MD5 of the parts joined by a pipe; NULL when any part is NULL."""
    columns = [col(p) for p in parts]
    joined = reduce(lambda a, b: F.concat(a, F.lit("|"), b), columns)
    return F.upper(F.md5(joined.cast("binary")))


def packed_key(c: Column | str) -> Column:
    """A text as bytes that shuffle in half the space if it is upper-case hex, as surrogate keys are; `unpacked_key` undoes it."""
    halved = F.unhex(col(c))
    return F.when(F.hex(halved) == col(c), F.concat(F.lit(b"\x01"), halved)).otherwise(F.concat(F.lit(b"\x00"), col(c).cast("binary")))


def unpacked_key(c: Column | str) -> Column:
    rest = F.substring(col(c), 2, 2**31 - 1)
    return F.when(F.substring(col(c), 1, 1) == F.lit(b"\x01"), F.hex(rest)).otherwise(rest.cast("string"))


def logo_key(url: Column | str) -> Column:
    return F.md5(col(url).cast("binary"))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL instead of the empty string when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def filled(c: Column | str, default: str) -> Column:
    """The value, or `default` when it is NULL or empty."""
    return F.when(col(c) != "", col(c)).otherwise(F.lit(default))


def hex_text(c: Column | str) -> Column:
    return F.lower(F.hex(col(c)))


def preview(c: Column | str, chars: int = 500) -> Column:
    """One-line preview: white space collapsed, cut at `chars` with dots."""
    line = strip(F.regexp_replace(col(c), r"(?U)\s+", " "))
    cut = F.concat(F.substring(line, 1, chars), F.lit("..."))
    return F.when(col(c).isNull(), F.lit("<None>")).when(F.length(line) > chars, cut).otherwise(line)


@lru_cache(maxsize=1)
def _accent_pairs() -> tuple[str, str]:
    """Accented letters and their base letters, from the Unicode decompositions."""
    accented, base = [], []
    for point in range(0xC0, min(0xFFFF, sys.maxunicode)):
        letter = chr(point)
        parts = unicodedata.normalize("NFD", letter)
        if len(parts) > 1 and len(parts[0]) == 1 and all(unicodedata.category(p) == "Mn" for p in parts[1:]):
            accented.append(letter)
            base.append(parts[0])
    return "".join(accented), "".join(base)


def fold_accents(c: Column | str) -> Column:
    """Lower-case without combining marks; letters that do not decompose (such as đ) stay."""
    accented, base = _accent_pairs()
    return F.regexp_replace(F.translate(F.lower(col(c)), accented, base), r"\p{Mn}", "")


def any_of(text: Column, terms: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])
