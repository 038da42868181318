"""Pages as nested elements: a start tag's element ends at its own end tag, whatever stands inside.

A page is read once into arrays, in document order: pieces of text, and elements with the range of pieces and elements
they hold. What is wanted is declared as `Read` values and cut out in the same pass, so Spark ships the wanted texts,
not the tree. Reading costs the same for each character, with thousands of unclosed tags as well: every element is
opened and closed once, and a mark that never ends is looked for once.

* An end tag closes the innermost open element of its name and all that is open inside; one without such an element
  is ignored.
* An element without an end tag ends with the element around it. One whose end tag may be left out (`p`, `li`, ..) ends
  at the next start tag of its name, so unclosed ones do not hold each other's text.
* Scripts, styles, templates and comments hold no text; without an end mark they are read like any other tag.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without content, elements whose end tag may be left out, elements without text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
OPTIONAL_END = frozenset("p li dt dd tr td th option".split())
UNSEEN = frozenset("script style template".split())
#: Entities that are decoded, in this order.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))

_LONGEST_ENTITY = max(len(entity) for entity, _ in ENTITIES)
_NAME = re.compile(r"/?([a-zA-Z!][^\s<>/]*)")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_BLANK = re.compile(r"[ \t\n\x0b\f\r]+")


class Step(NamedTuple):
    """The first element of these tags inside the one reached so far, or behind it (`after`).

    `marks` is a class, or several in the order of the page; `having` an attribute it must have; `says` its whole text;
    `holds` a text in it, if it has no element inside.
    """

    tags: tuple[str, ...] = ()
    marks: str | None = None
    having: str | None = None
    says: str | None = None
    holds: str | None = None
    after: bool = False


class Read(NamedTuple):
    """What to read at the end of some steps: the text, an `attribute` (up to `until`), or the texts of `each` element.

    `open_ended` tells whether elements behind which no end tag of these names comes any more are among the latter.
    """

    steps: tuple[Step, ...]
    attribute: str | None = None
    until: str | None = None
    each: tuple[str, ...] = ()
    joined: str = ", "
    open_ended: bool = True


def readable(text: str) -> str:
    """Text with frequent entities decoded and white space collapsed."""
    for entity, character in ENTITIES:
        text = text.replace(entity, character)
    return _BLANK.sub(" ", text).strip(" ")


class Page:
    """Elements of a page by number: `tags`, `heads` (the inside of the start tag), `first` and `last` piece, `ends`
    (the first element behind)."""

    def __init__(self, html: str):
        self.pieces: list[str] = []
        self.tags: list[str] = []
        self.heads: list[str] = []
        self.first: list[int] = []
        self.last: list[int] = []
        self.ends: list[int] = []
        self._last_end: dict[str, int] = {}  # of a name, the elements before its last end tag
        self._unclosed: list[int] = []
        self._written: list[int] | None = None  # characters that are not blank in the pieces before each
        self._parse(html)
        self._end_optional()
        self._filled = [i for i, piece in enumerate(self.pieces) if _BLANK.sub("", piece)]

    def _parse(self, html: str) -> None:
        lower = html.lower() if len(html.lower()) == len(html) else html
        open_elements: list[int] = []
        open_of: dict[str, list[int]] = {}
        endless: set[str] = set()  # marks that do not occur any more
        at, size, text_from = 0, len(html), 0

        def find(mark: str, start: int) -> int:
            if mark in endless:
                return -1
            found = lower.find(mark, start)
            if found < 0:
                endless.add(mark)
            return found

        def close(number: int, unclosed: bool) -> None:
            self.last[number], self.ends[number] = len(self.pieces), len(self.tags)
            if unclosed:
                self._unclosed.append(number)

        while True:
            at = find("<", at)
            if at < 0:
                break
            begin, comment = at, lower.startswith("<!--", at)
            stop = find("-->", at + 4) + 3 if comment else 0
            name = _NAME.match(html, at + 1) if stop < 3 else None
            if stop < 3:
                stop = find(">", at + 1) + 1 if name else 0
                if not stop:
                    at += 1
                    continue
            self.pieces.append(html[text_from:begin])
            at = text_from = stop
            if name is None:
                continue
            tag = name[1].lower()
            if html[begin + 1] == "/":
                self._last_end[tag] = len(self.tags)
                if open_of.get(tag):
                    target = open_of[tag][-1]
                    while open_elements:
                        number = open_elements.pop()
                        open_of[self.tags[number]].pop()
                        close(number, number != target)
                        if number == target:
                            break
                continue
            if tag in UNSEEN:
                end = find(f"</{tag}", stop)
                over = find(">", end) + 1 if end >= 0 else 0
                if over:
                    at = text_from = over
                    continue
            number = len(self.tags)
            self.tags.append(tag)
            self.heads.append(html[name.end() : stop - 1])
            self.first.append(len(self.pieces))
            self.last.append(len(self.pieces))
            self.ends.append(number + 1)
            if tag not in VOID and tag[0] != "!" and html[stop - 2] != "/":
                open_elements.append(number)
                open_of.setdefault(tag, []).append(number)
        self.pieces.append(html[text_from:size])
        while open_elements:
            close(open_elements.pop(), True)

    def _end_optional(self) -> None:
        places: dict[str, list[int]] = {}
        for number, tag in enumerate(self.tags):
            if tag in OPTIONAL_END:
                places.setdefault(tag, []).append(number)
        for number in self._unclosed:
            same = places.get(self.tags[number], [])
            at = bisect_right(same, number)
            if at < len(same) and same[at] < self.ends[number]:
                self.ends[number], self.last[number] = same[at], self.first[same[at]]

    def text(self, number: int | None = None) -> str:
        """Text of an element, or of the page; a tag parts words."""
        filled = self._filled
        if number is not None:
            filled = filled[bisect_left(filled, self.first[number]) : bisect_left(filled, self.last[number])]
        return readable(" ".join([self.pieces[i] for i in filled]))

    def attribute(self, number: int, name: str) -> str | None:
        if name not in self.heads[number].lower():
            return None
        for key, *values in _ATTRIBUTE.findall(self.heads[number]):
            if key.lower() == name:
                return next((v for v in values if v), "")
        return None

    def _marked(self, number: int, marks: str) -> bool:
        held = self.attribute(number, "class")
        return held is not None and (" ".join(held.split()) == marks if " " in marks else marks in held.split())

    def _says(self, number: int, text: str) -> bool:
        """Whether this is the element's text; one with far more characters is not put together for that."""
        if self._written is None:
            self._written = [0, *accumulate(len(p) - sum(map(len, _BLANK.findall(p))) for p in self.pieces)]
        written = self._written[self.last[number]] - self._written[self.first[number]]
        return written <= _LONGEST_ENTITY * len(text) and self.text(number) == text

    def matches(self, step: Step, start: int, stop: int) -> Iterator[int]:
        for number in range(start, stop):
            if step.tags and self.tags[number] not in step.tags:
                continue
            if step.marks and not self._marked(number, step.marks):
                continue
            if step.having and self.attribute(number, step.having) is None:
                continue
            if step.says is not None and not self._says(number, step.says):
                continue
            if step.holds is not None and (self.ends[number] > number + 1 or step.holds not in self.text(number)):
                continue
            yield number

    def follow(self, steps: Sequence[Step], inside: int | None = None) -> int | None:
        """The element that the steps lead to."""
        start, stop, number = (0, len(self.tags), None) if inside is None else (inside + 1, self.ends[inside], inside)
        last = stop
        for step in steps:
            if step.after and number is not None:
                start, stop = self.ends[number], last
            number = next(self.matches(step, start, stop), None)
            if number is None:
                return None
            start, stop = number + 1, self.ends[number]
        return number

    def read(self, wanted: Sequence[Read], inside: int | None = None) -> str | None:
        """The first of these that is there and not blank."""
        for one in wanted:
            number = self.follow(one.steps, inside)
            if number is None and one.steps:
                continue
            if one.each:
                start, stop = (0, len(self.tags)) if number is None else (number + 1, self.ends[number])
                ended = stop if one.open_ended else max((self._last_end.get(tag, 0) for tag in one.each), default=0)
                texts = [self.text(n) for n in self.matches(Step(one.each), start, min(stop, ended))]
                found = one.joined.join(t for t in texts if t)
            elif one.attribute:
                found = readable(self.attribute(number, one.attribute) or "")
                found = found.split(one.until)[0] if one.until else found
            else:
                found = self.text(number)
            if found:
                return found
        return None


Fields = dict[str, Sequence[Read]]


def read_fields(pages: DataFrame, fields: Fields, keep: Sequence[str], html: str = "html") -> DataFrame:
    """The kept columns and a text for each field of every page, NULL where it is missing or blank; a NULL page has none."""
    return _read(pages, fields, keep, html, lambda page: [(page, None)])


def read_blocks(pages: DataFrame, block: Step, fields: Fields, keep: Sequence[str], html: str = "html") -> DataFrame:
    """One row per element that matches `block`, with its `position` among them, from 0, and its fields."""
    return _read(pages, fields, keep, html, lambda page: [(page, n) for n in page.matches(block, 0, len(page.tags))], ("position",))


def _read(pages: DataFrame, fields: Fields, keep: Sequence[str], html: str, blocks, extra: tuple[str, ...] = ()) -> DataFrame:
    rows = pages.select(*keep, F.col(html).cast("string").alias("_html"))
    schema = pages.select(*keep).schema
    for name in extra:
        schema = schema.add(name, "integer")
    for name in fields:
        schema = schema.add(name, "string")

    def read(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                row, position, found = [], [], []
                for i, text in enumerate(part["_html"].to_pylist()):
                    for k, (page, inside) in enumerate(blocks(Page(text or ""))):
                        row.append(i)
                        position.append(k)
                        found.append([page.read(wanted, inside) for wanted in fields.values()])
                held = [part[c].take(pa.array(row, pa.int64())) for c in keep]
                columns = zip(*found) if found else [()] * len(fields)
                more = [pa.array(position, pa.int32())] if extra else []
                yield pa.RecordBatch.from_arrays([*held, *more, *[pa.array(list(c), pa.string()) for c in columns]], names=[*keep, *extra, *fields])

    return rows.mapInArrow(read, schema)
