"""Web pages and logo pictures."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.catalog.registry import query, table
from postlens.operators import assets, pages

PAGE_URL = """concat(regexp_extract(url, '^([^?#]*)', 1), '?', array_to_string(list_concat(
    [CASE WHEN p LIKE '%=%' THEN p ELSE p || '=' END FOR p IN string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&')
     IF p <> '' AND split_part(p, '=', 1) <> 'page'], ['page=' || {page}]), '&'), regexp_extract(url, '(#.+)$', 1))"""


@query("page_url_rewrite", f"SELECT page_id, {PAGE_URL.format(page='9')} AS page_url FROM pages")
def page_url_rewrite(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", pages.page_url("url", F.lit(9)).alias("page_url"))


@query(
    "page_sequence",
    f"""SELECT page_id, page::INTEGER AS page, {PAGE_URL.format(page='page')} AS page_url
        FROM (SELECT *, unnest(range(1, greatest(least(page_id % 8, 5), 1) + 1)) AS page FROM pages)""",
)
def page_sequence(spark, sf_dir):
    listings = table(spark, sf_dir, "pages").withColumn("total", F.col("page_id") % 8)
    return pages.listing_pages(listings, "total", 5).select("page_id", "page", "page_url")


@query(
    "url_canonical",
    """SELECT page_id, string_split(url || '?lab_feature=' || page_id::VARCHAR, '?lab_feature=')[1] AS canonical,
       coalesce(try_cast(replace(regexp_extract('1 / ' || page_id::VARCHAR || '.000 trang', '/\\s*([\\d.]+)\\s*trang', 1), '.', '')
         AS INTEGER), 1) AS total FROM pages""",
)
def url_canonical(spark, sf_dir):
    tracked = F.concat("url", F.lit(fv.TRACKING_SUFFIX_A), F.col("page_id").cast("string"))
    shown = F.concat(F.lit("1 / "), F.col("page_id").cast("string"), F.lit(".000 trang"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        pages.canonical_url(tracked, fv.TRACKING_SUFFIX_A).alias("canonical"),
        pages.total_pages(shown).alias("total"),
    )


def _text_sql(html: str) -> str:
    text = f"regexp_replace({html}, '</?[a-zA-Z!][^>]*>', ' ', 'g')"
    for entity, character in (("nbsp", "' '"), ("lt", "'<'"), ("gt", "'>'"), ("quot", "chr(34)"), ("#39", "chr(39)"), ("amp", "'&'")):
        text = f"replace({text}, '&{entity};', {character})"
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


SEEN_SQL = r"""(SELECT page_id, html, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'),
    '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g') AS seen FROM pages)"""
TITLE_SQL = _text_sql(r"regexp_extract(seen, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")


@query(
    "page_sections",
    rf"""SELECT page_id, nullif({TITLE_SQL}, '') AS title, {_text_sql('seen')} AS body,
        array_to_string(list_filter([{_text_sql('x')} FOR x IN regexp_extract_all(seen,
          '(?is)<(?:p|li)\b[^>]*>(.*?)</(?:p|li)\s*>', 1)], lambda t: t <> ''), ' ') AS paragraphs
        FROM {SEEN_SQL}""",
)
def page_sections(spark, sf_dir):
    return pages.page_text(table(spark, sf_dir, "pages", spread=("page_id",)), open_ended=False).drop("last_page")


@query(
    "page_paragraphs",
    rf"""SELECT page_id, array_to_string(list_filter([{_text_sql('x')} FOR x IN regexp_extract_all(seen,
          '(?is)<(?:p|li)\b[^>]*>(.*?)(?:</(?:p|li|article)\s*>)', 1)], lambda t: t <> ''), ' ') AS paragraphs
        FROM {SEEN_SQL}""",
)
def page_paragraphs(spark, sf_dir):
    """Also the last paragraphs of articles in which their end tag is missing."""
    return pages.page_text(table(spark, sf_dir, "pages", spread=("page_id",))).select("page_id", "paragraphs")


# The pages' own navigation stands for a pagination bar: its entries are links, and two more are added here.
BAR, ENTRY = r"(?is)<nav[^>]*>(.*?)</nav>", r"(?is)<li[^>]*>(.*?)</li>"


@query(
    "last_page",
    r"""SELECT page_id, greatest(coalesce(list_max([try_cast(regexp_replace(x, '<[^>]*>', '', 'g') AS INTEGER) FOR x IN
          regexp_extract_all(regexp_extract(numbered, '(?is)<nav[^>]*>(.*?)</nav>', 1), '(?is)<li[^>]*>(.*?)</li>', 1)]), 1), 1) AS last_page
        FROM (SELECT page_id, replace(html, '</ul></nav>', concat('<li>', (page_id % 9)::VARCHAR, '</li><li>next</li></ul></nav>')) AS numbered
              FROM pages)""",
)
def last_page(spark, sf_dir):
    more = F.concat(F.lit("<li>"), (F.col("page_id") % 9).cast("string"), F.lit("</li><li>next</li></ul></nav>"))
    numbered = F.replace("html", F.lit("</ul></nav>"), more)
    return table(spark, sf_dir, "pages").select("page_id", pages.last_page(numbered, BAR, ENTRY).alias("last_page"))


# A board's markup is planted behind the navigation of each page; what it says follows from the page's number and url.
CARD = """concat('<div class="ipy-2 wide"><h3 data-url="', url, '?lab_feature=1"><a>Engineer <b>', cast(page_id AS varchar(20)),
  '</b></a></h3><div class="imy-3 d-flex align-items-center"><div><img data-src="/l', cast(page_id AS varchar(20)), '.png"></div>',
  '<span>Co<span> of</span> ', cast(page_id % 7 AS varchar(20)), '</span></div><div class="text-rich-grey flex-shrink-0">',
  '<div>At</div>office</div><div class="text-rich-grey text-truncate text-nowrap stretched-link position-relative" title="Place ',
  cast(page_id % 5 AS varchar(20)), '"></div><div class="imt-4 imb-3 d-flex igap-1"><div><a>SQL</a></div><a> </a><a>T',
  cast(page_id % 3 AS varchar(20)), '</a></div></div>')"""
CARDS = f"""concat({CARD}, '<div class="ipy-2"><h3>ad</h3></div>', CASE WHEN page_id % 2 = 0 THEN {CARD} ELSE '<div class="ipy-20"></div>' END)"""
DETAIL = """concat('<div><div> Job Expertise: </div><div><div><a>Data</a></div><a>E', cast(page_id % 4 AS varchar(20)), '</a></div></div>',
  '<div class="imy-5 paragraph"><p>Job</p><div>Build <i>tables</i> ', cast(page_id AS varchar(20)), '</div><ul><li>a<ul><li>b</li></ul>tail</li></ul>',
  '</div><p>between</p><div class="imy-5 paragraph">x &amp; y<br><div><div>Need</div> Spark ', cast(page_id % 9 AS varchar(20)), '</div>!</div>')"""


def _planted(spark, sf_dir, markup):
    planted = F.replace("html", F.lit("</nav>"), F.concat(F.lit("</nav>"), F.expr(markup)))
    return table(spark, sf_dir, "pages").select("page_id", planted.alias("html"))


@query(
    "listing_cards",
    """SELECT page_id, position::INTEGER AS position, concat('Engineer ', page_id::VARCHAR) AS title, string_split(url, '?')[1] AS url,
        concat('Co of ', (page_id % 7)::VARCHAR) AS company, concat('/l', page_id::VARCHAR, '.png') AS logo, 'At office' AS mode,
        concat('Place ', (page_id % 5)::VARCHAR) AS location, concat('SQL, T', (page_id % 3)::VARCHAR) AS tags
       FROM (SELECT *, unnest(CASE WHEN page_id % 2 = 0 THEN [0, 2] ELSE [0] END) AS position FROM pages)""",
)
def listing_cards(spark, sf_dir):
    return pages.listing_cards(_planted(spark, sf_dir, CARDS), pages.CARDS_A)


@query(
    "detail_fields",
    """SELECT page_id, concat('Data, E', (page_id % 4)::VARCHAR) AS job_cat,
        concat('Job Build tables ', page_id::VARCHAR, ' a b tail') AS descriptions,
        concat('x & y Need Spark ', (page_id % 9)::VARCHAR, ' !') AS requirements FROM pages""",
)
def detail_fields(spark, sf_dir):
    return pages.detail_fields(_planted(spark, sf_dir, DETAIL), pages.DETAIL_A)


# Words that do occur on some of the pages stand for the protection phrases.
SIGNS = ("thing", "êeux", "stst")


@query(
    "challenge_pages",
    f"""SELECT page_id, regexp_matches(lower(title), 'thing|êeux|stst') OR regexp_matches(lower(body), 'thing|êeux|stst') AS marked,
        regexp_matches(lower(body), 'just a moment|attention required|verify you are human|cf-challenge|cloudflare') AS challenge
        FROM (SELECT page_id, {TITLE_SQL} AS title, {_text_sql('seen')} AS body FROM {SEEN_SQL})""",
)
def challenge_pages(spark, sf_dir):
    read = pages.page_text(table(spark, sf_dir, "pages"))
    return read.select(
        "page_id",
        pages.is_challenge("title", "body", SIGNS).alias("marked"),
        pages.is_challenge("title", "body", fv.CHALLENGE_SIGNS_A).alias("challenge"),
    )


HEADS = {0: "89504E470D0A1A0A", 1: "FFD8FFDB00430001", 2: "474946383961", 3: "424D3600"}
HEAD_SQL = "CASE s_suppkey % 5 " + " ".join(f"WHEN {k} THEN unhex('{v}')" for k, v in HEADS.items()) + " ELSE unhex('00') END"
KIND_SQL = "CASE s_suppkey % 5 WHEN 0 THEN 'png' WHEN 1 THEN 'jpeg' WHEN 2 THEN 'gif' WHEN 3 THEN 'bmp' END"
LOGO_URL = "concat('https://img.example/', cast(s_suppkey AS varchar(30)), '.png')"


def _pictures(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    body = F.encode(F.repeat("s_name", 6), "UTF-8")
    return suppliers.select(F.expr(LOGO_URL).alias("logo_url"), F.concat(F.expr(HEAD_SQL), body).alias("content"))


@query(
    "asset_names",
    f"""SELECT logo_url, kind, concat('logos/', md5(logo_url), '.', kind) AS object_name,
        'data:image/' || CASE kind WHEN 'png' THEN 'png' ELSE 'jpeg' END || ';base64,' || to_base64(content) AS logo_path,
        'stored' AS status FROM (SELECT {LOGO_URL} AS logo_url, {KIND_SQL} AS kind,
        {HEAD_SQL} || encode(repeat(s_name, 6)) AS content FROM supplier) WHERE kind IS NOT NULL""".replace(
        "concat('logos/', md5(logo_url), '.', kind)", "'logos/' || md5(logo_url) || '.' || kind"
    ),
)
def asset_names(spark, sf_dir):
    return assets.stored_or_raise(assets.store_logos(_pictures(spark, sf_dir)))
