import datetime as dt

import pytest
from pyspark.sql import functions as F

from adloom.functions import dates, text, urls
from adloom.operators import evidence, rules
from adloom.operators import tables as T
from adloom.sources import files, pages
from adloom.streaming import streams


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_text(spark):
    assert one(spark, " A\xa0 b ", text.clean) == "A b"
    assert one(spark, "NaN", text.clean) == "" and one(spark, None, text.clean) == ""
    assert one(spark, "Příliš Straße & R&D", text.normalise) == "prilis strasse and r and d"
    assert one(spark, "a; |b|", lambda x: text.split_multi(x)) == ["a", "b"]
    assert [one(spark, g, text.selected_grade) for g in ("1", "2.0", "1 - x", "3", "nan", None)] == ["1", "2", "1", None, None, None]
    assert one(spark, "score 3,5 of 9", text.leading_number) == 3.5
    assert one(spark, "<p>A<br>b</p><script>x</script>c &amp; d", text.html_text) == "A\nb\nc & d"
    assert one(spark, "x" * 200 + " key " + "y" * 200, lambda x: text.snippet(x, F.position(F.lit("key"), x), F.lit(3), 5)) == "…xxxx key yyyy…"


def test_urls(spark):
    assert one(spark, "HTTP://Ex.com//a//b/?b=2&a=1#x", urls.review_key) == "http://ex.com/a/b?b=2&a=1"
    assert one(spark, "ex.com/a/?utm_source=q&b=2&a=1", urls.canonical) == "https://ex.com/a?a=1&b=2"
    assert one(spark, None, urls.canonical) == ""
    assert one(spark, "https://www.jobstack.it/x", lambda u: urls.detect_source(u, [("jobstack", "js"), ("jobs", "jb")])) == "js"
    assert one(spark, "u", lambda u: urls.hash_id(u, "A_")) == one(spark, "u", lambda u: urls.hash_id(u, "A_"))


def test_dates(spark):
    assert one(spark, "2026-09-21T10:00:00+02:00", dates.instant) == dt.datetime(2026, 9, 21, 8)
    assert one(spark, "21.09.2026", dates.instant) == dt.datetime(2026, 9, 21) and one(spark, "31.02.2026", dates.instant) is None
    assert one(spark, "2026-12-01", lambda x: dates.age_days(dates.instant(x), "2026-11-20")) == 0
    assert one(spark, "5", lambda x: dates.bucket(x.cast("long"), dates.FRESHNESS, "OLD")) == "FRESH"


def test_align_and_union(spark):
    df = spark.createDataFrame([(" 1 ", "t", "m", "z"), ("", "", "", "")], "`﻿ID` string, job_title string, `Mining Date` string, other string")
    got = T.drop_blank(T.align(df, ["ID", "Job Title", "Mining_Date", "Salary"], ["ID"])).collect()
    assert [tuple(r) for r in got] == [("1", "t", "m", "")]
    with pytest.raises(ValueError):
        T.align(df, ["ID", "URL"], ["URL"])


def test_latest_first_and_compaction(spark):
    df = spark.createDataFrame([("a", "2025-01-02", 1, "ok", "x"), ("a", None, 2, "failed", ""), ("a", "2025-01-03", 3, "failed", "y"), ("b", "2025-01-01", 4, "ok", "z")], "k string, at string, o int, s string, c string")
    at = dates.instant(F.col("at"))
    assert {r["k"]: r["o"] for r in T.latest_by(df, ["k"], at, "o").collect()} == {"a": 2, "b": 4}
    assert {r["k"]: r["o"] for r in T.latest_by(df, ["k"], at, "o", undated_wins=False).collect()} == {"a": 3, "b": 4}
    assert {r["k"]: r["o"] for r in T.first_by(df, ["k"], "o").collect()} == {"a": 1, "b": 4}
    assert {r["k"]: (r["o"], r["c"], r["attempts"]) for r in T.compact_latest(df, "k", "o", F.col("s") == "ok", ["c"]).collect()} == {"a": (3, "x", 3), "b": (4, "z", 1)}


def test_upsert_lookup_and_checks(spark):
    base = spark.createDataFrame([("a", "1", "d1"), ("b", "2", "d2")], "k string, v string, first string")
    new = spark.createDataFrame([("b", "3", "d9"), ("c", "4", "d8")], "k string, v string, first string")
    assert {tuple(r) for r in T.upsert(base, new, "k", ["first"]).collect()} == {("a", "1", "d1"), ("b", "3", "d2"), ("c", "4", "d8")}
    other = spark.createDataFrame([("a", "x"), ("a", "x"), ("z", "y")], "k string, w string")
    assert T.lookup(base, other, "k", ["w"]).count() == 2
    with pytest.raises(ValueError):
        T.lookup(base, other, "k", ["w"], strict=True)
    with pytest.raises(ValueError):
        T.lookup(base, other.union(spark.createDataFrame([("a", "q")], "k string, w string")), "k", ["w"])
    with pytest.raises(ValueError):
        T.check_unique(other, "k")
    assert {r["rule"]: r["rows"] for r in T.violations(base, {"even": F.col("v") == "2"}).collect()} == {"even": 1}


def test_rules(spark):
    df = spark.createDataFrame([(t,) for t in ("Senior Data Analyst", "Assistant to CEO", "Vedoucí skladu", "", "xyz", "CEO")], "t string")
    got = {r["t"]: (r["root"], r["method"]) for r in rules.classify(df, "t", rules.ROOTS, rules.OVERRIDES).collect()}
    assert got["Senior Data Analyst"][0] == "Analyst" and got["Vedoucí skladu"][0] == "Manager"
    assert got["Assistant to CEO"][0] == "Assistant" and got[""] == ("Other", "blank") and got["xyz"] == ("Other", "unclassified") and got["CEO"] == ("Manager", "grounds")


def _extract(spark, f, **values):
    names = ["Languages", "Requirements", "Description", "Skills", "Page_Language", "Seniority_Detail", "Remote_Mode", "Current_Status", "HTTP_Status", "Status_Evidence"]
    df = spark.createDataFrame([tuple(values.get(n) for n in names)], ", ".join(f"{n} string" for n in names))
    out, fields = evidence.with_fields(df, names)
    return out.select(f(fields).alias("y")).first()["y"]


def test_skills(spark):
    skill = lambda **v: _extract(spark, lambda f: evidence.skill_signal("python", f["Skills"], [f["Requirements"], f["Description"]]), **v)["value"]
    assert skill(Description="We require Python. Tea is nice.") == "REQUIRED" and skill(Description="Nice to have: Python.") == "PREFERRED"
    assert skill(Description="Python here") == "MENTIONED" and skill(Description="none") == "NOT_MENTIONED" == skill() and skill(Skills="SQL | Python") == "PREFERRED"
    assert skill(Skills="Python [required]; SQL") == "REQUIRED" and skill(Skills="Python", Description="Python is not required but a plus") == "PREFERRED" and skill(Description="cpython must") == "NOT_MENTIONED"
    r = lambda **v: _extract(spark, lambda f: evidence.r_signal(f["Skills"], [f["Requirements"], f["Description"]]), **v)["value"]
    assert r(Skills="R; SQL") == "REQUIRED" and r(Skills="SQL | R") == "PREFERRED" and r(Skills="R&D") == "NOT_MENTIONED" and r(Description="r and d in Python or R") == "MENTIONED"
    assert r(Description="You must know R programming.") == "REQUIRED" and r(Description="letter r") == "NOT_MENTIONED"


def test_languages_years_levels_mode_status(spark):
    czech = lambda **v: _extract(spark, lambda f: evidence.czech_requirement(f["Languages"], f["Requirements"], f["Description"]), **v)["value"]
    assert czech(Description="English is used, Czech is not required.") == "NOT_REQUIRED" and czech(Requirements="Čeština výhodou") == "PREFERRED" and czech(Description="Fluent Czech") == "REQUIRED"
    assert czech(Languages="Czech; English") == "REQUIRED" and czech(Description="the Czech market") == "NOT_MENTIONED" and czech(Description="czech language courses") == "MENTIONED" and czech() == "NOT_MENTIONED"
    english = lambda **v: _extract(spark, lambda f: evidence.english_acceptable(f["Languages"], f["Requirements"], f["Description"], f["Page_Language"]), **v)["value"]
    assert english(Languages="en") == "YES" and english(Page_Language="en", Description="x" * 200) == "LIKELY" and english(Page_Language="en", Description="x") == "UNKNOWN" and english(Requirements="Znalost angličtiny") == "YES"
    years = lambda **v: _extract(spark, lambda f: evidence.minimum_years(f["Seniority_Detail"], f["Requirements"], f["Description"]), **v)
    assert years(Description="3-5 years of experience") == 3 and years(Description="2+ years in data, 1 year of experience") == 2 and years(Description="5-2 years of experience") is None and years(Description="20 years of experience") is None
    assert years(Requirements="alespoň 4 roky praxe") == 4 and years(Seniority_Detail="6 let") == 6 and years() is None
    level = lambda *ts: _extract(spark, lambda f: evidence.seniority([f["Seniority_Detail"], f["Requirements"]]), Seniority_Detail=ts[0], Requirements=ts[1])["value"]
    assert [level("Junior", None), level("medior", "Senior"), level("junior medior", "lead"), level(None, None)] == ["JUNIOR", "MID_SENIOR", "MIXED", "UNKNOWN"]
    mode = lambda **v: _extract(spark, lambda f: evidence.work_mode(f["Remote_Mode"], [f["Requirements"], f["Description"]]), **v)["value"]
    assert [mode(Remote_Mode="Remote, on-site"), mode(Description="remote villages"), mode(Description="100% remote"), mode(Description="home office"), mode(Remote_Mode="hybrid remote")] == ["FLEXIBLE", "UNKNOWN", "REMOTE", "HYBRID", "HYBRID"]
    status = lambda **v: _extract(spark, lambda f: evidence.page_status(f["Current_Status"], f["HTTP_Status"], f["Status_Evidence"]), **v)["value"]
    assert [status(Current_Status="open", HTTP_Status="404"), status(HTTP_Status="410"), status(Current_Status="?")] == ["OPEN", "CLOSED", "UNKNOWN"]
    shown = _extract(spark, lambda f: evidence.regex_evidence(f["Description"], r"sql|python"), Description="SQL and Python and SQL")
    assert shown == "Description: SQL and Python and SQL"


def test_flags_and_warnings(spark):
    df = spark.createDataFrame([("partial", "LIKELY_CLOSED", 4, "SENIOR", "REQUIRED", "UNKNOWN"), ("ok", "CLOSED", None, "JUNIOR", "NOT_MENTIONED", "YES")], "e string, s string, y int, l string, c string, n string")
    f = evidence.review_flags(F.col("e"), F.col("s"), F.col("y"), F.col("l"), F.col("c"), F.col("n"))
    k = evidence.conflicts(F.col("c"), F.col("s"))
    got = [tuple(r) for r in df.select(f, k, evidence.warnings(F.lit("YES"), k, f, F.col("s")), evidence.warnings(F.lit("YES"), F.lit(""), F.lit(None).cast("string"), F.lit("open"))).collect()]
    many = "PARTIAL_EXTRACTION | LIKELY_CLOSED | EXPERIENCE_3_PLUS | SENIOR_LEVEL_PRESENT | ENGLISH_UNCLEAR"
    assert got == [(many, "CZECH_REQUIRED", f"CZECH_REQUIRED | {many}", "HARD_CONFLICT"), ("", "CLOSED", "CLOSED", "HARD_CONFLICT")]


def test_places_without_one_task(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"g{i}", (i * 7) % 11) for i in range(300)], "i int, g string, x int")
    got = T.placed(df, [F.col("x"), F.col("i")]).collect()
    assert {r["i"]: r["position"] for r in got} == {r["i"]: k for k, r in enumerate(sorted(df.collect(), key=lambda r: (r["x"], r["i"])), 1)}
    want, last = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r["g"], r["x"], r["i"])):
        want[r["i"]] = last[r["g"]] = last.get(r["g"], 0) + 1
    assert {r["i"]: r["position"] for r in T.placed_within(df, ["g"], [F.col("x"), F.col("i")]).collect()} == want
    assert T.placed(df.limit(0), [F.col("i")]).count() == 0


def test_filter_without_choice_is_empty(spark):
    m = spark.createDataFrame([("t", "c", "", "OPEN", "OK")], "title string, company string, decision string, status string, enrichment string")
    assert T.review_filter(m, {"decision": []}).count() == 0 and T.review_filter(m, {"decision": ["Unreviewed"]}, search="T").count() == 1 and T.review_filter(m, {}, search="(").count() == 0


def test_unique_ids(spark):
    df = spark.createDataFrame([(f"https://x/{i}",) for i in range(500)] * 2, "u string")
    got = {r["url"]: r["id"] for r in urls.unique_ids(df, "u", "A_", places=2).collect()}
    assert len(got) == 500 == len(set(got.values())) and got == {r["url"]: r["id"] for r in urls.unique_ids(df.orderBy(F.desc("u")), "u", "A_", places=2).collect()}


def test_pages(spark):
    page = '<h1>T</h1><script type="application/ld+json">{bad</script><script type="application/ld+json">[{"@graph": [{"@type": ["JobPosting"], "title": "T", "hiringOrganization": "C", "jobLocation": [{"address": {"addressLocality": "Brno"}}, {"address": {"addressLocality": "Praha"}}], "baseSalary": {"currency": "EUR", "value": {"minValue": 1, "maxValue": 2, "unitText": "MONTH"}}}]}]</script>'
    f = pages.find_posting(page)
    assert (f["title"], f["company"], f["location"], f["salary_low"], f["salary_high"], f["salary_unit"]) == ("T", "C", "Brno; Praha", "1", "2", "MONTH")
    assert pages.find_posting(None)["title"] is None
    assert pages.page_state('<script id="__NUXT_DATA__">[{"a": 1, "b": 2}, "x", ["Reactive", 3], [1, 0]]</script>') == {"a": "x", "b": ["x", None]}
    cards = pages.listing_cards('<div class="card"><a href="/1"><b class="t">One<br></b></a></div><div class="card"><a href="/1"><b class="t">One</b></a></div><div class="card"><i class="t">Two</i></div>', "card", {"title": "t"})
    assert [(c["title"], c["url"]) for c in cards] == [("One", "/1"), ("Two", "")]
    assert pages.labelled("<dl><dt>Salary:</dt><dd>1 <b>EUR</b></dd></dl>", "Salary") == "1 EUR"


def test_files(spark, tmp_path):
    (tmp_path / "b_basic.csv").write_text('﻿ID,Job Title\n1,"a ""q"",\nb"\n', encoding="utf-8")
    (tmp_path / "A_basic.csv").write_text("ID,job_title,x\n2,c,9\n")
    found = files.discover(str(tmp_path))
    assert [f.split("/")[-1] for f in found] == ["A_basic.csv", "b_basic.csv"]
    got = files.read_listings(spark, found, ["ID", "Job Title"], ["ID"]).orderBy("source_order").collect()
    assert [(r["ID"], r["Job Title"]) for r in got] == [("2", "c"), ("1", 'a "q",\nb')]
    assert files.read_optional(spark, str(tmp_path / "none.csv"), ["ID"]).count() == 0
    out = str(tmp_path / "out")
    for n in (1, 2):
        files.write_atomic(spark.range(n).selectExpr("cast(id as string) id"), out)
    assert files.read_csv(spark, files.current(spark, out)).count() == 2
    with pytest.raises(FileNotFoundError):
        files.current(spark, str(tmp_path / "nothing"))
    files.append_growing(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "g"))
    files.append_growing(spark.createDataFrame([(2, "x")], "a int, b string"), str(tmp_path / "g"))
    assert files.read_grown(spark, str(tmp_path / "g")).columns == ["a", "b"]
    files.migrate(spark, str(tmp_path / "g"), ["b", "a", "c"])
    assert {(r["a"], r["b"], r["c"]) for r in spark.read.parquet(files.current(spark, str(tmp_path / "g") + ".migrated")).collect()} == {(1, None, None), (2, "x", None)}
    assert spark.read.parquet(files.current(spark, str(tmp_path / "g") + ".migrated")).columns == ["b", "a", "c"]
    files.write_queues(spark.createDataFrame([("q1", 1), ("q2", 2)], "queue string, n int"), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2
    assert files.merged({"a": {"x": 1, "y": 2}}, {"a": {"y": 3}}) == {"a": {"x": 1, "y": 3}}


def test_streams_go_on(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "k string, n int").write.parquet(src)
    assert streams.run(streams.first_seen(streams.read_stream(spark, src), "k"), out, state).count() == 2
    spark.createDataFrame([("b", 3), ("c", 3)], "k string, n int").write.mode("append").parquet(src)
    assert sorted(r["k"] for r in streams.run(streams.first_seen(streams.read_stream(spark, src), "k"), out, state).collect()) == ["a", "b", "c"]


def test_latest_view_goes_on(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    rows = lambda *xs: spark.createDataFrame(xs, "k string, d int, n int").selectExpr("k", "make_timestamp(2025, 1, d, 0, 0, 0) AS at", "n")
    run = lambda: {r["k"]: r["n"] for r in streams.keep_latest(streams.read_stream(spark, src), "k", "at", "n", out, state, buckets=4).collect()}
    rows(("a", 1, 1), ("b", 5, 2), ("a", 3, 3)).write.parquet(src)
    assert run() == {"a": 3, "b": 2} == run()
    rows(("b", 2, 4), ("c", 1, 5), ("a", 9, 6)).write.mode("append").parquet(src)
    assert run() == {"a": 6, "b": 2, "c": 5}
    assert streams.complete(spark, {"x": state, "none": str(tmp_path / "none")}) == {"x": True, "none": False}


def test_windows_and_unseen(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("a", 20)], "k string, d int").selectExpr("k", "make_timestamp(2025, 1, d, 1, 0, 0) AS at").write.parquet(src)
    got = streams.run(streams.windowed_counts(streams.read_stream(spark, src), "at", "k"), out, state)
    assert {(r["start"].day, r["k"], r["n"]) for r in got.collect()} <= {(1, "a", 2), (2, "b", 1), (20, "a", 1)}
    known = spark.createDataFrame([("a",)], "k string")
    assert [r["k"] for r in streams.unseen(spark.createDataFrame([("a",), ("b",)], "k string"), known, "k").collect()] == ["b"]


def test_small_helpers(spark):
    assert [one(spark, str(h), lambda x: dates.due(F.lit("blocked"), x.cast("double"), {"blocked": 72}, 168)) for h in (71, 72)] == [False, True]
    assert one(spark, None, lambda x: dates.due(x, x.cast("double"), {}, 1)) is True
    assert one(spark, "a", lambda x: urls.plan_signature(F.array(x, x))) != one(spark, "a", lambda x: urls.plan_signature(F.array(x)))
    assert one(spark, "Vodník Data Analyst | Board", lambda x: text.cut_title(x, F.lit("vodník"))) == "Data Analyst"
    assert not one(spark, "short", text.meaningful) and one(spark, "We look for somebody who likes tables and walks", text.meaningful)
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, t string")
    assert {tuple(r) for r in files.repair(old, spark.createDataFrame([("a", "z"), ("b", " ")], "k string, t string"), "k", ["t"]).collect()} == {("a", "z"), ("b", "y")}
    titles = spark.createDataFrame([(1, "Data Analyst"), (2, " data  analyst"), (3, "Tester"), (4, None)], "i int, t string")
    assert {r["i"]: r["root"] for r in rules.classify_distinct(titles, "t", "i", rules.ROOTS).collect()} == {1: "Analyst", 2: "Analyst", 3: "Tester", 4: None}
    p = evidence.publication(F.lit(None).cast("timestamp"), F.lit("2025-01-01").cast("timestamp"))
    assert spark.range(1).select(p["evidence"]).first()[0] == "MINIMUM_AGE"
    with pytest.raises(ValueError):
        rules.check_roots(spark.createDataFrame([(2, "t", "Wizard")], "line int, title string, root string"), "title", "root", "line")


def test_rules_as_a_relation(spark):
    table = rules.as_relation(spark)
    assert rules.from_relation(table) == rules.ROOTS
    with pytest.raises(ValueError):
        rules.from_relation(table.withColumn("pattern", F.lit("(")))


def test_ties_stamps_and_last_success(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, l string")
    assert T.argmax_label(df, "k", "l", ["y", "x"]).first()["label"] == "y" and T.argmax_label(df, "k", "l").first()["label"] == "x"
    base, new = (spark.createDataFrame(r, "k string, first string, at string") for r in ([("a", "1", "old"), ("b", "2", "old")], [("a", "3", None)]))
    assert {tuple(r) for r in T.upsert(base, new, "k", keep=["first"], stamp={"at": F.lit("now")}).collect()} == {("a", "1", "now"), ("b", "2", "old")}
    log = spark.createDataFrame([("a", 1, "ok", "c1", "t1"), ("a", 2, "failed", "", "t2")], "k string, o int, s string, c string, t string")
    r = T.compact_latest(log, "k", "o", F.col("s") == "ok", ["c"], at="t").first()
    assert (r["c"], r["last_success"], r["t"]) == ("c1", "t1", "t2")
