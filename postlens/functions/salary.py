"""Salary text -> bounds in VND, mean, band and sort values.

The `*_million` columns hold whole VND (their names are kept for users); text amounts are in millions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.functions.text import any_of, col, first_group, fold_accents

RANGE = r"^\s*(\d+)\s*-\s*(\d+)"
FROM = r"từ\s*(\d+)"
UP_TO = r"(?:upto|tới)\s*(\d+)"
#: What a text must hold for a pattern to match; looking for it costs little beside the pattern.
_ASKED = {RANGE: ("-",), FROM: ("từ",), UP_TO: ("upto", "tới")}


def _bound(text: Column | str, alternatives: list[tuple[str, int]], usd_rate: int) -> Column:
    """First alternative whose pattern matches, in VND; a blank or negotiable text matches none."""
    low = F.lower(col(text))
    unit = F.when(F.contains(low, F.lit("usd")), F.lit(usd_rate)).otherwise(F.lit(fv.MILLION)).cast("bigint")
    found = [F.when(any_of(low, _ASKED[pattern]), first_group(low, pattern, group)) for pattern, group in alternatives]
    amount = F.coalesce(*found).try_cast("int")
    return amount.cast("bigint") * unit


def min_salary(text: Column | str, usd_rate: int = fv.USD_TO_VND) -> Column:
    return _bound(text, [(RANGE, 1), (FROM, 1)], usd_rate)


def max_salary(text: Column | str, usd_rate: int = fv.USD_TO_VND) -> Column:
    return _bound(text, [(RANGE, 2), (UP_TO, 1)], usd_rate)


def salary_value(low: Column | str, high: Column | str) -> Column:
    low, high = col(low).cast("double"), col(high).cast("double")
    both = F.round((low + high) / 2, 1)  # NULL as soon as one bound is missing
    return F.coalesce(both, low, high)


def band_names() -> list[str]:
    width = fv.BAND_WIDTH_VND // fv.MILLION
    inner = [f"{i * width}-{(i + 1) * width}M VND" for i in range(1, fv.BAND_COUNT)]
    return [f"Below {width}M VND", *inner, f"Above {fv.BAND_COUNT * width}M VND"]


def salary_bench(value: Column | str) -> Column:
    value = col(value)
    names = band_names()
    band = F.when(value < fv.BAND_WIDTH_VND, names[0])
    for i, name in enumerate(names[1:-1], start=2):
        band = band.when(value < i * fv.BAND_WIDTH_VND, name)
    return band.when(value.isNotNull(), names[-1]).otherwise(fv.UNSPECIFIED_BAND)


def salary_band_label(low: Column | str, high: Column | str) -> Column:
    """Free-form `lo-hiM VND` label of whole-number bounds; with only an upper bound that bound stays in VND."""
    low, high = col(low).cast("bigint"), col(high).cast("bigint")
    millions = lambda c: F.floor(c / fv.MILLION).cast("string")
    start = F.when(low.isNotNull(), millions(low)).otherwise(
        millions(F.greatest(high - fv.BAND_WIDTH_VND, F.lit(0)))
    )
    end = (
        F.when(low.isNull(), high.cast("string"))
        .when(high.isNull(), millions(low + fv.BAND_WIDTH_VND))
        .otherwise(millions(high))
    )
    unspecified = low.isNull() & high.isNull()
    return F.when(unspecified, fv.UNSPECIFIED_BAND).otherwise(F.concat(start, F.lit("-"), end, F.lit("M VND")))


def number_value(c: Column | str) -> Column:
    """Number out of a number or a number-like text ("12,5"); NULL for anything else."""
    text = F.replace(F.trim(col(c).cast("string")), F.lit(","), F.lit("."))
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def salary_from_text(c: Column | str, usd_to_million: float = fv.TEXT_USD_TO_MILLION) -> Column:
    """Largest number named in a salary text, in millions; NULL when negotiable or without a number."""
    text = fold_accents(c)
    found = F.regexp_extract_all(text, F.lit(r"(\d+(?:[,.]\d+)?)"), F.lit(1))
    top = F.array_max(F.transform(found, lambda n: F.replace(n, F.lit(","), F.lit(".")).cast("double")))
    dollars = F.contains(text, F.lit("usd")) | F.contains(text, F.lit("$"))
    value = F.when(dollars, top * F.lit(usd_to_million)).otherwise(top)
    return F.when(~any_of(text, fv.NEGOTIABLE_FOLDED), value)


def salary_sort_value(
    high: Column | str, mean: Column | str, text: Column | str, unit: str = "as_stored"
) -> Column:
    """Best salary known for a posting, -1 when none is.

    `as_stored` compares the columns (VND) with the text (millions) as they are; `vnd` scales the text first.
    """
    from_text = salary_from_text(text)
    if unit == "vnd":
        from_text = from_text * fv.MILLION
    return F.coalesce(F.greatest(number_value(high), number_value(mean), from_text), F.lit(-1.0))
