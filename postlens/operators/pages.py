"""Web pages as table rows: listing urls, page text, cards, sections and challenge detection.

Urls and signs are column expressions; texts, cards and fields are read out of nested elements (`elements`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.functions.text import any_of, col, first_group
from postlens.operators.elements import ENTITIES, Fields, Read, Step, read_blocks, read_fields

# ---- listing urls --------------------------------------------------------------------------


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _encode(c: Column) -> Column:
    """Form encoding with `~` left as it is and `*` encoded."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def page_url(url: Column | str, page: Column) -> Column:
    """The url with its `page` parameter replaced by `page`, moved to the end of the query."""
    url = col(url)
    base = F.regexp_extract(url, r"^([^?#]*)", 1)
    parameters = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    fragment = F.regexp_extract(url, r"(#.+)$", 1)
    name = lambda p: _decode(F.substring_index(p, "=", 1))
    value = lambda p: _decode(F.regexp_extract(p, r"^[^=]*=(.*)$", 1))
    others = F.filter(parameters, lambda p: (p != "") & (name(p) != "page"))
    encoded = F.transform(others, lambda p: F.concat(_encode(name(p)), F.lit("="), _encode(value(p))))
    query = F.array_join(F.array_append(encoded, F.concat(F.lit("page="), page.cast("string"))), "&")
    return F.concat(base, F.lit("?"), query, fragment)


def listing_pages(listings: DataFrame, total: str, max_pages: int | None = None, url: str = "url") -> DataFrame:
    """One row per page 1..total (at most `max_pages`, at least one) with its url."""
    last = F.col(total) if max_pages is None else F.least(F.col(total), F.lit(max_pages))
    pages = listings.withColumn("page", F.explode(F.sequence(F.lit(1), F.greatest(last, F.lit(1)).cast("int"))))
    return pages.withColumn("page_url", page_url(url, F.col("page")))


def total_pages(text: Column | str) -> Column:
    """Number after the slash in "1 / 1.200 trang", 1 when there is none."""
    digits = F.replace(first_group(col(text), fv.TOTAL_PAGES_PATTERN), F.lit("."), F.lit(""))
    return F.coalesce(digits.try_cast("int"), F.lit(1))


def canonical_url(url: Column | str, suffix: str) -> Column:
    """The url without its tracking suffix."""
    return F.substring_index(col(url), suffix, 1)


def is_challenge(title: Column | str, body: Column | str, signs: tuple[str, ...]) -> Column:
    """True when a bot-protection phrase stands in the title or the body."""
    shown = lambda c: F.lower(F.coalesce(col(c), F.lit("")))
    return any_of(shown(title), signs) | any_of(shown(body), signs)


# ---- reading pages -------------------------------------------------------------------------

_UNSEEN = r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>|<!--.*?-->"
_TAG = r"(?s)</?[a-zA-Z!][^>]*>"


def plain_text(html: Column) -> Column:
    """Text of a piece of HTML: tags become spaces, frequent entities are decoded, white space is collapsed."""
    text = F.regexp_replace(html, _TAG, " ")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def shown(html: Column | str) -> Column:
    """A page without scripts, styles and comments; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(col(html), F.lit("")), _UNSEEN, " ")


#: Where a board's pagination bar begins and ends, and one numbered entry of it.
PAGINATION = (
    r"(?is)pagination-search-jobs.*?ipagination[^>]*>(.*?)</nav>",
    r'(?is)<div class="page(?: current)?"[^>]*>(.*?)</div>',
)


def last_page(html: Column | str, bar: str = PAGINATION[0], entry: str = PAGINATION[1]) -> Column:
    """Largest number among the entries of the pagination bar, 1 without one."""
    entries = F.regexp_extract_all(F.regexp_extract(shown(html), bar, 1), F.lit(entry), F.lit(1))
    numbers = F.transform(entries, lambda e: plain_text(e).try_cast("int"))
    return F.greatest(F.coalesce(F.array_max(numbers), F.lit(1)), F.lit(1))


def page_text(pages: DataFrame, key: str = "page_id", open_ended: bool = True) -> DataFrame:
    """Title, body text and text of paragraphs and list items of every page, and the last page its pagination names.

    An item inside another one is part of its text and stands for itself as well. Without `open_ended` paragraphs and
    items are left out behind which none is ended any more.
    """
    fields: Fields = {
        "title": (Read((Step(("title",)),)),),
        "body": (Read(()),),
        "paragraphs": (Read((), each=("p", "li"), joined=" ", open_ended=open_ended),),
    }
    bar = last_page("html").alias("last_page")
    return read_fields(pages.select(key, "html", bar), fields, [key, "last_page"]).select(
        key, "title", F.coalesce("body", F.lit("")).alias("body"), "paragraphs", "last_page"
    )


# ---- cards of a listing and fields of a posting --------------------------------------------

_COMPANY_A = Step(("div",), "imy-3 d-flex align-items-center")
#: Where a card begins, and each field on it (the first filled one counts).
CARDS_A = (
    Step(("div",), "ipy-2"),
    {
        "title": (Read((Step(("h3",), having="data-url"),)),),
        "url": (Read((Step(("h3",), having="data-url"),), "data-url", "?"),),
        "company": (Read((_COMPANY_A, Step(("span",)))),),
        "logo": (Read((_COMPANY_A, Step(("img",))), "data-src"),),
        "mode": (Read((Step(("div",), "text-rich-grey flex-shrink-0"),)),),
        "location": (Read((Step(("div",), "text-rich-grey text-truncate text-nowrap stretched-link position-relative"),), "title"),),
        "tags": (Read((Step(("div",), "imt-4 imb-3 d-flex igap-1"),), each=("a",)),),
    },
)
CARDS_B = (
    Step(("div",), "job-item-search-result"),
    {
        "title": (Read((Step(("h3",)),)),),
        "company": (Read((Step(("a",), "company"),)),),
        "logo": (Read((Step(("img",)),), "src"), Read((Step(("img",)),), "data-src")),
        "url": (Read((Step(("a",)),), "href", "?"),),
        "location": (Read((Step(("label",), "address"),)),),
        "salary": (Read((Step(("label",), "title-salary"),)), Read((Step(("label",), "salary"),))),
        "experience": (Read((Step(("label",), "exp"),)),),
    },
)


def _behind(tags: tuple[str, ...], says: str, content: tuple[str, ...]) -> tuple[Read, ...]:
    """The text of what follows a heading or label."""
    return (Read((Step(tags, says=says), Step(content, after=True))),)


_SECTION_A = Step(("div",), "imy-5 paragraph")
#: The fields of a posting's page by their headings or labels.
DETAIL_A = {
    "job_cat": (Read((Step(("div",), says="Job Expertise:"), Step(("div",), after=True)), each=("a",)),),
    "descriptions": (Read((_SECTION_A,)),),
    "requirements": (Read((_SECTION_A, _SECTION_A._replace(after=True))),),
}
DETAIL_B = {
    "job_cat": (Read((Step(("div",), holds="Chuyên môn:"), Step(("div",), after=True)), each=("a",)),),
    "descriptions": _behind(("h2", "h3"), "Mô tả công việc", ("div",)),
    "requirements": _behind(("h2", "h3"), "Yêu cầu ứng viên", ("div",)),
    "education": _behind(("div", "strong"), "Học vấn", ("div", "span")),
    "type_of_work": _behind(("div", "strong"), "Hình thức làm việc", ("div", "span")),
}


def listing_cards(pages: DataFrame, cards: tuple[Step, Fields] = CARDS_A, key: str = "page_id") -> DataFrame:
    """One row per card that has a title: the page, its position among the cards and its fields."""
    block, fields = cards
    return read_blocks(pages, block, fields, [key]).filter("title IS NOT NULL")


def detail_fields(pages: DataFrame, fields: Fields = DETAIL_A, key: str = "page_id") -> DataFrame:
    """The fields that a posting's page shows, NULL where it has none."""
    return read_fields(pages, fields, [key])
