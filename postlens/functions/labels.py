"""Education, work model and work arrangement labels with their dimension attributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.functions.salary import band_names
from postlens.functions.text import any_of, col, strip


def misread(word: str) -> str:
    """The word as it looks when its UTF-8 bytes were read as Windows-1252, in lower case."""
    chars = []
    for byte in word.encode("utf-8"):
        try:
            chars.append(bytes([byte]).decode("cp1252"))
        except UnicodeDecodeError:
            chars.append(chr(byte))
    return "".join(chars).lower()


def _spellings(words: tuple[str, ...]) -> list[str]:
    return list(dict.fromkeys([*words, *(misread(w) for w in words)]))


def education_level(text: Column | str) -> Column:
    """Lowest level named in the text."""
    low = F.lower(col(text))
    first, *rest = fv.EDUCATION_WORDS
    result = F.when(any_of(low, first[1]), first[0])
    for level, words in rest:
        result = result.when(any_of(low, words), level)
    return result.otherwise(fv.UNKNOWN)


def _label(text: Column | str, words: tuple) -> Column:
    low = F.lower(strip(text))
    first, *rest = words
    result = F.when(low.isin(_spellings(first[1])), first[0])
    for name, spellings in rest:
        result = result.when(low.isin(_spellings(spellings)), name)
    return result.otherwise(strip(text))


def work_model(text: Column | str) -> Column:
    return _label(text, fv.WORK_MODEL_WORDS)


def work_arrangement(text: Column | str) -> Column:
    return _label(text, fv.WORK_ARRANGEMENT_WORDS)


def names_other_places(location: Column | str) -> Column:
    low = F.lower(col(location))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in _spellings((fv.OTHER_PLACES,))])


def _case(c: Column, values: dict, default: Column | None = None) -> Column:
    """CASE c WHEN key THEN value, with a NULL or `default` otherwise."""
    pairs = iter(values.items())
    key, value = next(pairs)
    result = F.when(c == key, F.lit(value))
    for key, value in pairs:
        result = result.when(c == key, F.lit(value))
    return result if default is None else result.otherwise(default)


def education_order(level: Column | str) -> Column:
    order = {name: i for i, (name, _) in enumerate(fv.EDUCATION_WORDS, start=1)}
    return _case(col(level), {**order, fv.UNKNOWN: 99}, F.lit(98))


def work_model_group(model: Column | str) -> Column:
    return _case(col(model), {m: g for m, (g, _) in fv.WORK_MODEL_GROUPS.items()}, F.lit("Other"))


def work_model_order(model: Column | str) -> Column:
    return _case(col(model), {m: o for m, (_, o) in fv.WORK_MODEL_GROUPS.items()}, F.lit(99))


def band_order(band: Column | str) -> Column:
    order = {name: i for i, name in enumerate(band_names(), start=1)}
    return _case(col(band), {**order, fv.UNSPECIFIED_BAND: 99}, F.lit(98))


def band_lower(band: Column | str) -> Column:
    return _case(col(band), {name: i * fv.BAND_WIDTH_VND for i, name in enumerate(band_names())}).cast("bigint")


def band_upper(band: Column | str) -> Column:
    closed = band_names()[:-1]
    return _case(col(band), {n: (i + 1) * fv.BAND_WIDTH_VND for i, n in enumerate(closed)}).cast("bigint")
