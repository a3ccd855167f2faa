import json

from pyspark.sql import functions as F

from adloom.sources import pages

STATE = json.dumps([{"data": 1}, {"offer": 2}, {"title": 3, "description": 5, "company": 8, "salary": 10, "locations": 13, "remote": 16}, {"en": 4}, "Data Analyst", {"cs": 6, "en": 7}, "Krátký popis", "<p>You build models and reports for planners in six countries.</p>", {"name": 9}, "Vodník", {"min": 11, "max": 12}, 1, 2, [14], {"name": 15}, "Brno", True])


def test_site_cards():
    page = """<article class="x SearchResultCard"><h2><a href="/rpd/1?x=1">Data <b>Analyst</b></a></h2><ul><li class="SearchResultCard__footerItem">Vodník</li><li data-test="serp-locality">Brno</li></ul></article>
    <article class="SearchResultCard"><h2><a href="/rpd/1?x=1">Again</a></h2></article>"""
    assert pages.site_cards(page, "jobs") == [{"url": "/rpd/1?x=1", "title": "Data Analyst", "company": "Vodník", "location": "Brno", "salary": ""}]
    two = '<li class="job-item"><a href="/job/7"><h3>Tester</h3></a><i class="location">Praha</i><i class="location">Brno</i></li>'
    assert pages.site_cards(two, "jobstack")[0]["location"] == "Praha; Brno"
    assert pages.site_cards(two, "nowhere") == [] and pages.site_cards(None, "jobs") == []


def test_cards_from_links():
    page = '<div><div class="c"><a href="/nabidka/1/a"><h3>Analyst</h3></a><p>Vodník</p></div><div class="c"><a href="/nabidka/2/b">Tester</a><span>Rak</span><a href="/nabidka/2/b">more</a></div></div>'
    assert [(c["title"], c["company"]) for c in pages.site_cards(page, "startupjobs")] == [("Analyst", "Vodník"), ("Tester", "Rak")]


def test_offer_in_state():
    page = f'<script id="__NUXT_DATA__">{STATE}</script>'
    got = pages.detail_fields(page, "startupjobs")
    assert (got["title"], got["company"], got["location"], got["salary_low"], got["salary_high"], got["remote"]) == ("Data Analyst", "Vodník", "Brno", "1", "2", "REMOTE")
    assert got["description"] == "You build models and reports for planners in six countries."


def test_only_what_is_missing_is_filled():
    ld = '<script type="application/ld+json">{"@type": "JobPosting", "title": "From data", "hiringOrganization": "Vodník"}</script>'
    page = f"<title>Other | Vodník | Board</title><h1>Heading</h1>{ld}<dl><dt>Lokalita</dt><dd>Brno</dd></dl><h3>Popis</h3><p>You build models and reports for planners in six countries.</p><h3>Else</h3><p>no</p>"
    got = pages.detail_fields(page, "jobs")
    assert (got["title"], got["company"], got["location"], got["description"]) == ("From data", "Vodník", "Brno", "You build models and reports for planners in six countries.")
    assert pages.detail_fields(None, None) == dict.fromkeys(pages.POSTING)
    assert pages.html_title("<title>Vodník | Data Analyst | Board</title>", "Vodník") == "Data Analyst"


def test_pieces():
    assert pages.column("<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>", "b") == ["2"]
    assert pages.pay_text(1, 2, "EUR", "MONTH") == "1 - 2 EUR MONTH" and pages.pay_text(1, 1) == "1" and pages.pay_text(None, None, "EUR") is None
    assert pages.localized({"cs": "a", "de": "b"}) == "a" and pages.localized({"de": "b"}) == "b" and pages.localized(None) is None
    assert not pages.meaningful("lorem ipsum " * 20) and pages.meaningful("We look for somebody who likes tables and long walks")


def test_frames(spark):
    df = spark.createDataFrame([(1, '<li class="job-item"><a href="/job/7"><h3>Tester</h3></a></li>', "jobstack", "u"), (2, None, None, None)], "id int, page string, source string, url string")
    assert [(r["id"], r["position"], r["title"]) for r in pages.listing_rows(df, "id", "page", "source").collect()] == [(1, 1, "Tester")]
    assert {r["id"]: r["title"] for r in pages.parse_details(df, "id", "page", "source", "url").collect()} == {1: None, 2: None}
    a, c = pages.final_status(F.lit("OPEN"), F.lit("2025-01-01").cast("timestamp"), "2026-01-01", F.lit("x" * 600))
    assert tuple(spark.range(1).select(a, c).first()) == ("LIKELY_CLOSED", "FULL")
