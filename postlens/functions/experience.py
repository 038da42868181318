"""Years of experience: out of free text, as a number, as a band and as a level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.functions.text import col, first_group

#: Forms tried in this order, as (extraction, what is appended).
_FLAGS = r"(?iU)"
_FORMS = (
    (r"(\d+\s*(?:-|–|đến|to)\s*\d+\+?)\s*(?:năm|years?)", ""),
    (r"(\d+\s*\+)\s*(?:năm|years?)", ""),
    (r"(?:dưới|below|less than)\s*(\d+)\s*(?:năm|years?)", "-"),
    (r"(?:tối thiểu|ít nhất|trên|at least|minimum)\s*(\d+)\s*(?:năm|years?)", "+"),
    (r"(\d+)\s*(?:năm|years?)", ""),
)
#: Fixed value: a form that is recognised, though nothing is extracted from it.
_CUT_SHORT = r"\d+\s*\+\s*yea"


def extract_experience(text: Column | str) -> Column:
    """The first form found in the text; each pattern runs once. A `n+ yea` that is no `year` gives NULL."""
    text = col(text)
    found = [F.concat(first_group(text, _FLAGS + pattern), F.lit(suffix)) for pattern, suffix in _FORMS]
    later = F.when(text.rlike(_FLAGS + _CUT_SHORT), F.lit(None)).otherwise(F.coalesce(*found[2:], F.lit(fv.UNKNOWN)))
    return F.coalesce(*found[:2], later)


def years_normalized(text: Column | str) -> Column:
    """`n` and `n+` -> n, `n-` -> half of n, `a-b` -> their mean, anything else NULL."""
    text = F.regexp_replace(F.lower(col(text)), "[–—]", "-")
    low = first_group(text, r"^([0-9]+)").try_cast("double")
    high = first_group(text, r"^[0-9]+-([0-9]+)").try_cast("double")
    return (
        F.when(text.rlike(r"^[0-9]+\+?$"), low)
        .when(text.rlike(r"^[0-9]+-$"), low / 2)
        .when(text.rlike(r"^[0-9]+-[0-9]+\+?$"), (low + high) / 2)
    )


def _step(years: Column, which: int) -> Column:
    result = F.when(years.isNull(), fv.UNKNOWN)
    for step in fv.EXPERIENCE_STEPS:
        result = result.when(years < step[0], step[which])
    return result.otherwise(fv.EXPERIENCE_TOP[which - 1])


def years_band(years: Column | str) -> Column:
    return _step(col(years), 1)


def years_level(years: Column | str) -> Column:
    return _step(col(years), 2)
