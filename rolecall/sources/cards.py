"""Listings from the cards of crawled HTML pages."""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from rolecall.functions.compute import add_once
from rolecall.functions.pages import (
    WORK_TYPES, body_text, canonical_url, outcome_of_text, page_title, pattern_count, salary_label, shown_text,
)
from rolecall.functions.text import fold_blanks, ordered_unique_tags, strip_blank

from . import card_tags

# The page helper travels to executors inside the task, with no package install.
cloudpickle.register_pickle_by_value(card_tags)

# Selectors of the known sites' cards. A field lists readings,
# ``selector`` for the text or ``selector @attribute``; the first non-empty counts.
CARD_PROFILES = {
    "itviec": {
        "cards": [".job-card", "[data-controller='job-card']", ".job_content"],
        "title": ["h3[data-url]"],
        "url": ["h3[data-url] @data-url"],
        "company": ["span.ims-2 a, .employer-name a, [class*='employer'] a"],
        "location": ["div[title].text-truncate, div[title].text-nowrap @title"],
        "salary": ["div.salary, .salary-from-to, [class*='salary']"],
        "posted": [".small-text.text-dark-grey", "[class*='posted']", "span.small-text"],
        "work_types": "div.text-rich-grey.flex-shrink-0",
        "tags": "[data-responsive-tag-list-target='tag']",
        "salary_missing": "Negotiable",
        "sign_in": "sign in",
    },
    "topcv": {
        "cards": ["div.job-item-search-result"],
        "title": ["h3.title a @title", "h3.title a"],
        "url": ["h3.title a @href"],
        "company": ["a.company span.company-name @title", "a.company span.company-name"],
        "location": ["label.address span.city-text"],
        "salary": ["label.title-salary"],
        "posted": ["label.address.mobile-hidden.label-update"],
        "tags": "div.tag a.item-tag",
        "salary_missing": "Thoả thuận",
        "host": "https://www.topcv.vn",
        "keyword": "data",
        "work_type": "At office",
    },
}

_SINGLE = ("title", "url", "company", "location", "salary", "posted")
_MULTIPLE = ("work_types", "tags")


def read_page_cards(df: DataFrame, profile: dict, html: str = "html", keep=("page_id", "url"), site: str | None = None) -> DataFrame:
    """One row per card with the fields as found; kept page columns get ``page_``
    in front unless they have it.

    With ``site``, ``profile`` is a mapping of sites to profiles, and each page is read by
    that of the site in this (kept) column; pages of other sites have no cards. All pages
    are scanned once, in Arrow batches, where they are read.
    """
    profiles = {None: profile} if site is None else profile
    names = {c: c if c.startswith("page_") else f"page_{c}" for c in keep}
    number = F.lit(0) if site is None else reduce(
        lambda chain, x: chain.when(F.col(site) == x[1], x[0]), list(enumerate(profiles))[1:], F.when(F.col(site) == list(profiles)[0], 0)
    ).otherwise(-1)
    source = df.select(*[F.col(c).alias(n) for c, n in names.items()], number.alias("_site"), F.col(html).alias("_html"))
    compiled = [card_tags.compile_profile(p, _SINGLE, _MULTIPLE) for p in profiles.values()]
    single, multiple, card_columns, kept = _SINGLE, _MULTIPLE, card_tags.card_columns, list(names.values())

    # Nested, so that executors receive it by value.
    def cards(batches):
        for batch in batches:
            row, _, fields = card_columns(batch["_html"], np.asarray(batch["_site"]), compiled, single, multiple)
            columns = [batch[c].take(pa.array(row)) for c in kept]
            columns += [fields[n] for n in (*single, *multiple)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *single, *multiple])

    schema = StructType([source.schema[c] for c in kept])
    for n in _SINGLE:
        schema = schema.add(n, "string")
    for n in _MULTIPLE:
        schema = schema.add(n, ArrayType(StringType()))
    return source.mapInArrow(cards, schema)


def html_listing_extract(
    df: DataFrame, profile: dict, html: str = "html", keep=("page_id", "url"), keyword: str | None = None, site: str | None = None
) -> DataFrame:
    """Listing records of crawled pages; a card without a title gives none. ``site`` and
    ``profile`` are those of ``read_page_cards``."""
    profiles = {None: profile} if site is None else profile
    collapse = lambda c: fold_blanks(F.coalesce(c, F.lit("")))

    def by_site(value) -> Column:
        if site is None:
            return value(profile)
        named = site if site.startswith("page_") else f"page_{site}"
        return F.coalesce(*[F.when(F.col(named) == name, value(p)) for name, p in profiles.items()])

    # both are read several times below: columns of their own, so that they are worked out once
    read = read_page_cards(df, profile, html, keep, site)
    found = add_once(read, {"_title": strip_blank(F.col("title")), "_salary": fold_blanks(F.col("salary"))}).filter(F.col("_title") != "")
    listed = F.coalesce(F.get(F.filter("work_types", lambda t: t.isin(*WORK_TYPES)), F.lit(0)), F.lit(""))
    page_columns = [c for c in found.columns if c.startswith("page_")]
    return found.select(
        *page_columns,
        by_site(lambda p: F.lit(keyword or p.get("keyword")).cast("string")).alias("keyword"),
        F.col("_title").alias("title"),
        by_site(lambda p: canonical_url(F.coalesce("url", F.lit("")), p.get("host"))).alias("url"),
        collapse(F.col("company")).alias("company"),
        collapse(F.col("location")).alias("location"),
        by_site(lambda p: F.lit(p["work_type"]) if "work_type" in p else listed).alias("work_type"),
        by_site(lambda p: salary_label(F.col("_salary"), p["salary_missing"], p.get("sign_in"))).alias("salary"),
        ordered_unique_tags(F.col("tags")).alias("tags"),
        collapse(F.col("posted")).alias("posted"),
    )


def page_links(df: DataFrame, html: str = "html", keep=("page_id",)) -> DataFrame:
    """Title and url of every list item that is a plain link; a pattern is enough for
    these, and pages stay in the JVM."""
    item = r'(?i)<li(?:\s[^>]*+)?+>\s*+<a\s[^>]*?href="([^"]*+)"[^>]*+>([^<]*+)</a>'
    found = df.select(*keep, F.explode(F.regexp_extract_all(html, F.lit(item), F.lit(0))).alias("_item"))
    part = lambda n: F.regexp_extract("_item", item, n)
    return found.select(*keep, strip_blank(part(2)).alias("title"), canonical_url(part(1)).alias("url"))


def classify_pages(
    df: DataFrame, card_pattern: str, link_pattern: str, html: str = "html", url: str = "url", status: str | None = None
) -> DataFrame:
    """Adds card and link counts and the outcome of each page, from its HTML."""
    page = F.col(html)
    counted = df.withColumns({
        "card_count": pattern_count(page, card_pattern),
        "link_count": pattern_count(page, link_pattern),
        "page_title": page_title(page),
    }).withColumn("_text", shown_text(F.col("page_title"), body_text(page)))
    code = F.col(status) if status else F.lit(200)
    outcome = outcome_of_text(code, F.col(url), F.col("_text"), F.col("card_count"), F.col("link_count"))
    return add_once(counted, {"outcome": outcome}).drop("_text")
