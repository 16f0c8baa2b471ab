"""Page outcomes and card extraction."""

import random
import re
import time

import numpy as np
import plain_cards
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rolecall.functions import pages
from rolecall.sources import card_tags, cards

BASE = {"status": 200, "url": "https://jobs.example.test/list", "title": "", "body": "", "cards": 0, "links": 0}
CASES = [
    ({"cards": 50}, "jobs_visible"),
    ({"title": "Attention Required! | Cloudflare"}, "cloudflare_block"),
    ({"body": "Sorry, you have been blocked"}, "cloudflare_block"),
    ({"status": 429}, "rate_limited"),
    ({"status": 403}, "access_denied"),
    ({"body": "Verify you are human"}, "anti_bot_challenge"),
    ({"url": "https://jobs.example.test/dang-nhap"}, "login_redirect"),
    ({"links": 8}, "selector_drift"),
    ({}, "empty_unknown"),
    ({"title": None, "body": None, "url": None, "status": None}, "empty_unknown"),
    ({"status": 429, "title": "Error 1020"}, "cloudflare_block"),
]


def test_outcomes(spark):
    rows = [(i, *{**BASE, **change}.values()) for i, (change, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, status int, url string, title string, body string, cards int, links int")
    outcome = pages.page_outcome(*[F.col(c) for c in ("status", "url", "title", "body", "cards", "links")])
    assert [r[0] for r in df.orderBy("i").select(outcome).collect()] == [c[1] for c in CASES]


def test_parse_outcome(spark):
    df = spark.createDataFrame([(3, 5), (0, 5), (0, 0)], "records int, cards int")
    out = df.select(pages.parse_outcome(F.col("records"), F.col("cards"), F.lit("rate_limited"))).collect()
    assert [r[0] for r in out] == [None, "parser_drift", "rate_limited"]


FIRST_SITE = """
<html><body>
<div class="job-card"><h3 data-url="https://x.test/a?lab=1">  Data  Engineer </h3>
  <span class="ims-2"><a href="#">ACME &amp; Co</a></span>
  <div title="Hà Nội" class="text-truncate">HN</div>
  <div class="text-rich-grey flex-shrink-0">Full time</div><div class="text-rich-grey flex-shrink-0">Hybrid</div>
  <div class="salary"><b>Sign in</b> to view salary</div>
  <a data-responsive-tag-list-target="tag">Kafka</a><a data-responsive-tag-list-target="tag"> Kafka </a>
  <a data-responsive-tag-list-target="tag">SQL</a><a data-responsive-tag-list-target="more">no</a>
  <span class="small-text text-dark-grey">Posted 2 days ago</span></div>
<div class="job-card"><p>without a title</p></div>
<div class="job-card"><h3 data-url="/b">Other</h3></div>
</body></html>"""
SECOND_SITE = """
<div class="job-item-search-result extra"><h3 class="title"><a href="/viec-lam/1?ref=x" title="Kỹ sư">short</a></h3>
  <a class="company"><span class="company-name">Công ty</span></a>
  <label class="title-salary"><i></i> 20 -
     30 triệu </label><label class="address"><span class="city-text">Hà Nội</span></label>
  <div class="tag"><a class="item-tag">ETL</a><a class="other">no</a></div><a class="item-tag">outside</a>
  <label class="address mobile-hidden label-update">Cập nhật  hôm nay</label></div>
<div class="job-item-search-result"><h3 class="title"><span>no link</span></h3></div>
<div class="job-item-search-result"><h3 class="title"><a href="https://y.test/2">Plain</a></h3></div>"""


def extract(spark, html, profile):
    df = spark.createDataFrame([(1, "https://p.test", html)], "page_id int, url string, html string")
    out = cards.html_listing_extract(df, cards.CARD_PROFILES[profile])
    return [r.asDict() for r in out.collect()]


def test_first_site_cards(spark):
    first, second = extract(spark, FIRST_SITE, "itviec")
    assert first == {
        "page_id": 1, "page_url": "https://p.test", "keyword": None, "title": "Data Engineer", "url": "https://x.test/a",
        "company": "ACME & Co", "location": "Hà Nội", "work_type": "Hybrid", "salary": "Login to view",
        "tags": ["Kafka", "SQL"], "posted": "Posted 2 days ago",
    }
    assert (second["title"], second["url"], second["salary"], second["work_type"], second["tags"]) == ("Other", "/b", "Negotiable", "", [])


def test_second_site_cards(spark):
    first, second = extract(spark, SECOND_SITE, "topcv")
    assert first == {
        "page_id": 1, "page_url": "https://p.test", "keyword": "data", "title": "Kỹ sư", "url": "https://www.topcv.vn/viec-lam/1",
        "company": "Công ty", "location": "Hà Nội", "work_type": "At office", "salary": "20 - 30 triệu", "tags": ["ETL"],
        "posted": "Cập nhật hôm nay",
    }
    assert (second["title"], second["url"], second["salary"]) == ("Plain", "https://y.test/2", "Thoả thuận")


def test_broken_html_gives_no_error(spark):
    assert extract(spark, "<div class='job-card'><h3 data-url=x>T<p></div></section><b", "itviec")[0]["title"] == "T"
    assert extract(spark, None, "itviec") == []


def test_classify_pages(spark):
    html = "<html><head><title>Just a moment</title></head><body><script>captcha</script><a href='/x'>l</a></body></html>"
    calm = html.replace("Just a moment", "List")
    df = spark.createDataFrame([(1, "u", html), (2, "u", calm)], "page_id int, url string, html string")
    out = cards.classify_pages(df, "class=.job", "<a href").orderBy("page_id").select("card_count", "link_count", "outcome").collect()
    assert [tuple(r) for r in out] == [(0, 1, "anti_bot_challenge"), (0, 1, "selector_drift")]


# ---- cards of many pages against a tree of each page -----------------------

MARKUP = [
    '<div class="job-card">', "</div>", "<p>", "</p>", "<li>", "</li>", "<ul>", "</ul>", '<h3 data-url="/a?b&amp;c">', "</h3>", "<h3 data-url>",
    "<br>", "<br/>", "</br>", '<img src="x>y">', "<div/>", "text &amp; more", "  \n ", '<span class="ims-2">', '<a href="q">', "</a>", "</span>",
    "<script>var x=\"<div class='job-card'>\";</script>", "<style>p{}</style>", '<!-- <div class="job-card"> -->', "<!DOCTYPE html>",
    '<div title="Hà > Nội" class="x text-truncate">', "<div class=salary>", "a < b", "<div title='it\"s' class='text-nowrap'>",
    '<DIV CLASS="job_content">', "é日本", '<div class="job-item-search-result">', '<h3 class="title">', '<label class="title-salary">', "</label>",
    '<a title="L\'x" href="/z">', "<td>", "<tr>", "</table>", "<table>", '<a data-responsive-tag-list-target="tag">', "</section>", "<?php x ?>", "<a href=/z/>", "<b/>", "<i x=\"1\"/>",
]


def by_trees(page, profile):
    def reading(text):
        css, _, attribute = text.partition(" @")
        return plain_cards.compile_selector(css), attribute or None

    single = {n: [reading(r) for r in profile.get(n, [])] for n in cards._SINGLE}
    multiple = {n: plain_cards.compile_selector(profile[n]) for n in cards._MULTIPLE if n in profile}
    found = plain_cards.read_cards(page, [plain_cards.compile_selector(c) for c in profile["cards"]], single, multiple)
    return [{"work_types": [], "tags": []} | card for card in found]


def by_offsets(pages, sites):
    profiles = [card_tags.compile_profile(p, cards._SINGLE, cards._MULTIPLE) for p in cards.CARD_PROFILES.values()]
    row, _, fields = card_tags.read_cards(pa.array(pages, pa.string()), np.array(sites), profiles, cards._SINGLE, cards._MULTIPLE)
    out = [[] for _ in pages]
    for k, r in enumerate(row.tolist()):
        out[r].append({n: values[k] for n, values in fields.items()})
    return out


@pytest.mark.parametrize("step", [200, 1 << 20])
def test_cards_by_offsets_as_by_trees(monkeypatch, step):
    monkeypatch.setattr(card_tags, "STEP_BYTES", step)
    rng, profiles = random.Random(step), list(cards.CARD_PROFILES.values())
    pages = [FIRST_SITE, SECOND_SITE, None, "", "no markup"]
    for _ in range(1500):
        parts = re.split("(<[^>]*>)", rng.choice(["", FIRST_SITE, SECOND_SITE]))
        for _ in range(rng.randrange(1, 25)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(MARKUP))
        pages.append("".join(parts))
    sites = [rng.choice([0, 1, 0, 1, -1]) for _ in pages]
    found = by_offsets(pages, sites)
    assert sum(map(len, found)) > 1000
    for page, site, got in zip(pages, sites, found, strict=True):
        assert got == (by_trees(page, profiles[site]) if site >= 0 else []), page


def test_selectors_are_tried_on_shapes_of_tags():
    profile = card_tags.compile_profile(cards.CARD_PROFILES["itviec"], cards._SINGLE, cards._MULTIPLE)
    many = pa.array([FIRST_SITE.replace("x.test/a?lab=1", f"x.test/{i}?a=&#{65 + i % 9};&amp;b") for i in range(500)])
    (_, tags), *_ = card_tags._steps(many, card_tags._tested(profile))
    assert len(tags.attributes) > 500 and len(tags.shapes) < 20
    row, _, fields = card_tags.card_columns(many, np.zeros(500, int), [profile], cards._SINGLE, cards._MULTIPLE)
    assert all(isinstance(c, pa.Array) and len(c) == len(row) == 1500 for c in fields.values())
    assert fields["url"][3].as_py() == "https://x.test/1?a=B&b" and fields["tags"][0].as_py() == ["Kafka", "Kafka", "SQL"]


def test_salary_is_folded_once(spark):
    df = spark.createDataFrame([(1, "u", "itviec", FIRST_SITE)], "page_id int, url string, page_site string, html string")
    out = cards.html_listing_extract(df, cards.CARD_PROFILES, keep=("page_id", "page_site"), site="page_site").select("salary")
    assert out.first()[0] == "Login to view"
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(salary") == 1


@pytest.mark.parametrize("piece", ['<a"', "<a ", "<!--", "<script>", "<p>", "<div><p></div>", "<div>", "</span>", '<b c="', "<"])
def test_odd_pages_take_linear_time(piece):
    begin = time.perf_counter()
    by_offsets(["<div>" * 1000 + piece * (400_000 // len(piece)), FIRST_SITE], [0, 0])
    assert time.perf_counter() - begin < 10


def test_both_sites_in_one_scan(spark, tmp_path):
    rows = [(1, "itviec", FIRST_SITE), (2, "topcv", SECOND_SITE), (3, "other", FIRST_SITE), (4, None, FIRST_SITE), (5, "topcv", None)]
    spark.createDataFrame(rows, "page_id int, page_source string, html string").write.parquet(f"{tmp_path}/pages")
    out = cards.html_listing_extract(spark.read.parquet(f"{tmp_path}/pages"), cards.CARD_PROFILES, keep=("page_id", "page_source"), site="page_source")
    found = sorted((r.page_id, r.title, r.keyword, r.work_type, r.salary) for r in out.collect())
    assert found == [
        (1, "Data Engineer", None, "Hybrid", "Login to view"), (1, "Other", None, "", "Negotiable"),
        (2, "Kỹ sư", "data", "At office", "20 - 30 triệu"), (2, "Plain", "data", "At office", "Thoả thuận"),
    ]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
