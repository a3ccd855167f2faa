"""Queries of single functions and small operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions import dates, text, urls
from adloom.operators import tables as T
from adloom.plans.queries import _at_sql, clean_sql, fold_sql, query, quote, word_sql
from adloom.plans.review import PAGES, _first, _key_sql, _u
from adloom.session import table
from adloom.sources import files

_TITLE = word_sql('"Job_Title_Input"')
_keep_sql = lambda c, keep: f"trim(regexp_replace(replace({fold_sql(c)}, '&', ' and '), '[^a-z0-9{keep}]+', ' ', 'g'))"


@query(f"""SELECT row_id, {_first('"Job_Title_Page"', '"Job_Title_Input"')} AS title, {_keep_sql('"Job_Title_Input"', '+#./|')} AS with_slashes, {_keep_sql('"Job_Title_Input"', '+#./ -')} AS with_dashes,
CASE WHEN length({_TITLE}) > 24 THEN substr({_TITLE}, 1, 23) || '…' ELSE {_TITLE} END AS short,
array_to_string(list_filter([{word_sql('"Location_Detail"')}, CASE WHEN {word_sql('"Remote_Mode"')} <> {word_sql('"Location_Detail"')} THEN {word_sql('"Remote_Mode"')} ELSE '' END], lambda v: v <> ''), ' | ') AS places FROM {PAGES}""")
def title_pieces(spark, d):
    """First title that says something, two ways of normalising, a short form, and places joined once each."""
    t = F.col("Job_Title_Input")
    return table(spark, d, PAGES).select(
        "row_id", text.first_nonempty(F.col("Job_Title_Page"), t).alias("title"), text.normalise(t, "+#./|").alias("with_slashes"), text.normalise(t, "+#./ -").alias("with_dashes"), text.truncate(text.clean(t), 24).alias("short"),
        text.join_unique(F.array("Location_Detail", "Remote_Mode"), " | ").alias("places"),
    )


_D, _F = word_sql('"Description"'), fold_sql('"Description"')


@query(f"""WITH s AS (SELECT row_id, {_D} AS d, strpos({_F}, 'sql') AS p FROM {PAGES}), w AS (SELECT *, greatest(p - 115, 1) AS a, least(p + 3 + 115 - 1, length(d)) AS b FROM s)
SELECT row_id, CASE WHEN p > 0 THEN CASE WHEN a > 1 THEN '…' ELSE '' END || regexp_replace(substr(d, a, b - a + 1), '^[ ,.;:\\-]+|[ ,.;:\\-]+$', '', 'g') || CASE WHEN b < length(d) THEN '…' ELSE '' END ELSE '' END AS around,
CASE WHEN d = '' THEN '' WHEN length('Description: ' || d) > 300 THEN substr('Description: ' || d, 1, 299) || '…' ELSE 'Description: ' || d END AS evidence,
length(regexp_replace(d, '[^\\p{{L}}]', '', 'g')) >= 30 AND len(regexp_extract_all(d, '[\\p{{L}}\\p{{N}}]+')) >= 6 AS meaningful FROM w""")
def description_pieces(spark, d):
    """Text around a word, a field as evidence, and whether it is a description at all."""
    x, f = text.clean(F.col("Description")), text.fold(F.col("Description"))
    return table(spark, d, PAGES).select("row_id", text.snippet(x, F.position(F.lit("sql"), f), F.lit(3)).alias("around"), text.field_evidence("Description", F.col("Description")).alias("evidence"), text.meaningful(x).alias("meaningful"))


@query("""SELECT row_id, try_cast(nullif(regexp_extract(replace("Fit.Score", ',', '.'), '-?\\d+(?:\\.\\d+)?'), '') AS DOUBLE) AS score, printf('%.2f', try_cast("Mining.Age.Days" AS DOUBLE) / 7) AS weeks FROM data_analytics""")
def scores(spark, d):
    """Score of a text, and a number with two decimals."""
    return table(spark, d, "data_analytics").select("row_id", text.leading_number(F.col("`Fit.Score`")).alias("score"), text.percent(F.col("`Mining.Age.Days`").try_cast("double") / 7).alias("weeks"))


_SITES = [("jst.board", True, True), ("sj.board", True, True), ("blt.board", False, True), ("jb.board", False, True), ("ind.board", False, False)]
_host, _path, _q = _u('"Input_URL"', 2), _u('"Input_URL"', 3), _u('"Input_URL"', 4)


@query(f"""SELECT row_id, CASE WHEN coalesce(trim("Input_URL"), '') = '' THEN '' {' '.join(f"WHEN contains(lower({_host}), '{h}') THEN 'https://' || {chr(39) + 'www.' + chr(39) + ' || regexp_replace(lower(' + _host + '), ' + chr(39) + '^www[.]' + chr(39) + ', ' + chr(39) + chr(39) + ')' if www else f'lower({_host})'} || regexp_replace({_path}, '/+$', '')" + ('' if drop else f" || CASE WHEN {_q} <> '' THEN '?' || {_q} ELSE '' END") for h, www, drop in _SITES)} ELSE {_key_sql('"Input_URL"')} END AS site_url,
lower({_host}) || {_path} || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split({_q}, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?:utm_[^=]*|searchId|rps|vjk|from)(?:=|$)'))), '&'), ''), '') AS page_key FROM {PAGES}""")
def site_urls(spark, d):
    """Canonical address by the rules of each board, and the key of a page without passing parameters."""
    u = F.col("Input_URL")
    return table(spark, d, PAGES).select("row_id", urls.site_url(u, _SITES).alias("site_url"), urls.page_key(u, ["searchId", "rps", "vjk", "from"]).alias("page_key"))


@query("""SELECT row_id FROM data_analytics WHERE coalesce(trim("ID"), '') <> '' OR coalesce(trim("URL"), '') <> ''""")
def identified(spark, d):
    """Rows with an ID or an address."""
    return table(spark, d, "data_analytics").where((F.trim(F.coalesce("ID", F.lit(""))) != "") | (F.trim(F.coalesce("URL", F.lit(""))) != "")).select("row_id")


@query(f"""SELECT {_key_sql('"URL"')} AS url_key, min(row_id) AS row_id FROM evaluation WHERE {_key_sql('"URL"')} <> '' GROUP BY ALL""")
def first_per_url(spark, d):
    df = table(spark, d, "evaluation").select(urls.review_key(F.col("URL")).alias("url_key"), "row_id").where("url_key <> ''")
    return T.first_by(df, ["url_key"], "row_id")


_TTL = {"failed": 0, "": 0, "blocked": 72, "partial": 24}
_HOURS = f"(epoch(TIMESTAMPTZ '2026-11-20 00:00:00+00') - epoch({_at_sql('"Extraction_Date"')})) / 3600"


@query(f"""SELECT row_id, {_HOURS} IS NULL OR {_HOURS} >= CASE coalesce("Extraction_Status", '') {' '.join(f"WHEN '{k}' THEN {v}" for k, v in _TTL.items())} ELSE 168 END AS due FROM {PAGES}""")
def refresh_due(spark, d):
    """Whether a page is to be fetched again, by the age and outcome of the last attempt."""
    hours = (F.unix_timestamp(F.lit("2026-11-20 00:00:00").cast("timestamp")) - F.unix_timestamp(dates.iso_instant(F.col("Extraction_Date")))) / 3600
    return table(spark, d, PAGES).select("row_id", dates.due(F.col("Extraction_Status"), hours, _TTL, 168).alias("due"))


@query(f"""SELECT DISTINCT {_key_sql('e."URL"')} AS url_key FROM evaluation e WHERE {_key_sql('e."URL"')} <> '' AND {_key_sql('e."URL"')} NOT IN (SELECT {_key_sql('"Input_URL"')} FROM {PAGES} WHERE "Input_URL" IS NOT NULL AND coalesce("Extraction_Status", '') = 'ok')""")
def pending_urls(spark, d):
    """Graded addresses without a good page."""
    done = table(spark, d, PAGES).where(F.col("Input_URL").isNotNull() & (F.coalesce("Extraction_Status", F.lit("")) == "ok")).select(urls.review_key(F.col("Input_URL")).alias("url_key"))
    return table(spark, d, "evaluation").select(urls.review_key(F.col("URL")).alias("url_key")).where("url_key <> ''").distinct().join(done, "url_key", "left_anti")


@query("""SELECT "ID", sha256(array_to_string(list("URL" ORDER BY "URL"), chr(10))) AS signature FROM (SELECT DISTINCT "ID", "URL" FROM evaluation WHERE "ID" IS NOT NULL AND "URL" IS NOT NULL) GROUP BY "ID" """)
def plan_signatures(spark, d):
    """Hash of the ordered addresses of each advert."""
    df = table(spark, d, "evaluation").select("ID", "URL").where(F.col("ID").isNotNull() & F.col("URL").isNotNull()).distinct()
    return df.groupBy("ID").agg(urls.plan_signature(F.array_sort(F.collect_list("URL"))).alias("signature"))  # distinct addresses of one advert


@query(f"""WITH n AS (SELECT "Input_URL", arg_max_null("Job_Title_Page", row_id) AS t, arg_max_null("Company_Page", row_id) AS c FROM {PAGES} WHERE "Input_URL" IS NOT NULL GROUP BY ALL)
SELECT e.row_id, coalesce(nullif(trim(n.t), ''), e."Job Title") AS "Job Title" FROM evaluation e LEFT JOIN n ON n."Input_URL" = e."URL" """)
def repaired_titles(spark, d):
    """Titles as the latest page has them, where it has one."""
    new = table(spark, d, PAGES).where(F.col("Input_URL").isNotNull()).groupBy(F.col("Input_URL").alias("URL")).agg(F.max_by("Job_Title_Page", "row_id").alias("Job Title"))
    return files.repair(table(spark, d, "evaluation").select("row_id", "URL", "`Job Title`"), new, "URL", ["Job Title"]).select("row_id", "`Job Title`")


_CUT = f"regexp_replace(regexp_replace(CASE WHEN {word_sql('\"Company_Page\"')} <> '' AND starts_with(lower({word_sql('\"Job_Title_Page\"')}), lower({word_sql('\"Company_Page\"')}) || ' ') THEN substr({word_sql('\"Job_Title_Page\"')}, length({word_sql('\"Company_Page\"')}) + 1) ELSE {word_sql('\"Job_Title_Page\"')} END, '\\s[|–·]\\s.*$', ''), '^[\\s#:–\\-]+', '')"


@query(f"""SELECT row_id, trim({_CUT}) AS title FROM {PAGES}""")
def cut_titles(spark, d):
    """Page titles without the company in front and the site's tail."""
    return table(spark, d, PAGES).select("row_id", text.cut_title(F.col("Job_Title_Page"), F.col("Company_Page")).alias("title"))


@query(f"""SELECT count(*) AS rows, count(*) FILTER ({clean_sql('"Input_URL"')} = '') AS blank_urls, count("Input_URL") - count(DISTINCT "Input_URL") AS repeated_urls, count("ID") - count(DISTINCT "ID") AS repeated_ids,
count(*) FILTER (coalesce("Parser", '') NOT IN (SELECT DISTINCT coalesce("Parser", '') FROM {PAGES})) AS unknown_parsers FROM {PAGES}""")
def page_gates(spark, d):
    """Counters that quality gates look at, in one pass."""
    df = table(spark, d, PAGES)
    parsers = [r[0] for r in df.select(F.coalesce("Parser", F.lit(""))).distinct().limit(1000).collect()]  # a closed vocabulary
    twice = lambda c: F.count(c) - F.count_distinct(F.col(c))
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(text.clean(F.col("Input_URL")) == "").alias("blank_urls"), twice("Input_URL").alias("repeated_urls"), twice("ID").alias("repeated_ids"),
        F.count_if(~F.coalesce(F.col("Parser"), F.lit("")).isin(*parsers)).alias("unknown_parsers"),
    )
