"""Queries on evidence from pages and on the review of adverts, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import dates, text, urls
from adloom.operators import evidence as E
from adloom.operators import tables as T
from adloom.plans.queries import AS_OF, HOSTS, _at_sql, _GRADED, _graded, fold_sql, query, quote, word_sql
from adloom.session import spread, table

PAGES = "prospects_enriched_raw"
FIELDS = [
    "Languages", "Requirements", "Description", "Page_Language", "Seniority_Detail", "Seniority_Input", "Job_Title_Page", "Job_Title_Input", "Skills", "Remote_Mode", "Current_Status", "HTTP_Status",
]


def page_values(spark, d: str, keep: list[str] = ()) -> DataFrame:
    """Every page with the values of all extractors; ``keep`` are own columns."""
    df, f = E.with_fields(spread(table(spark, d, PAGES).select("row_id", *dict.fromkeys([*FIELDS, *keep])), "row_id"), FIELDS, shown=False)
    prose = [f["Requirements"], f["Description"]]
    value = lambda x, name: x["value"].alias(name)
    return df.select(
        "row_id", *keep, value(E.czech_requirement(f["Languages"], *prose), "czech"), value(E.english_acceptable(f["Languages"], *prose, f["Page_Language"]), "english"),
        E.minimum_years(f["Seniority_Detail"], *prose).alias("years"), value(E.seniority([f[n] for n in ("Seniority_Detail", "Seniority_Input", "Job_Title_Page", "Job_Title_Input")]), "seniority"),
        *(value(E.skill_signal(p, f["Skills"], prose, E.SKILL_SAYS[name]), name) for name, p in E.SKILLS.items()), value(E.r_signal(f["Skills"], prose), "r"),
        value(E.work_mode(f["Remote_Mode"], prose), "work_mode"), value(E.page_status(f["Current_Status"], f["HTTP_Status"]), "status"),
    )


# --- SQL of the extractors -----------------------------------------------------------
_m = lambda c, p: f"regexp_matches({c}, {quote(p)})"


def _skill_sql(pattern: str) -> str:
    p = E.word(pattern)
    marked = p[: -len("(?:$|[^a-z0-9_])")] + r" ?\[required\]"
    w = "list_concat(" + ", ".join(f"regexp_extract_all({c}, {quote(rf'[\s\S]{{0,{E.NEAR}}}(?:{p})[\s\S]{{0,{E.NEAR}}}')})" for c in ("r", "d")) + ")"
    soft, hard = f"len(list_filter({w}, lambda x: {_m('x', E.PREFERRED)})) > 0", f"len(list_filter({w}, lambda x: {_m('x', E.REQUIRED)} AND NOT {_m('x', E.PREFERRED)})) > 0"
    return f"""CASE WHEN ({soft}) AND NOT ({hard}) THEN 'PREFERRED' WHEN {_m('s', marked)} OR {_m("split_part(s, '|', 1)", p)} THEN 'REQUIRED'
WHEN contains(s, '|') AND {_m("regexp_replace(s, '^[^|]*[|]', '')", p)} THEN 'PREFERRED' WHEN {hard} THEN 'REQUIRED' WHEN {soft} THEN 'PREFERRED' WHEN len({w}) > 0 THEN 'MENTIONED' ELSE 'NOT_MENTIONED' END"""


def _r_sql() -> str:
    w = "list_concat(" + ", ".join(f"regexp_extract_all({c}, {quote(rf'[\s\S]{{0,{E.NEAR}}}(?:{E.R_PROSE})[\s\S]{{0,{E.NEAR}}}')})" for c in ("rr", "dr")) + ")"
    soft, hard = f"len(list_filter({w}, lambda x: {_m(fold_sql('x'), E.PREFERRED)})) > 0", f"len(list_filter({w}, lambda x: {_m(fold_sql('x'), E.REQUIRED)} AND NOT {_m(fold_sql('x'), E.PREFERRED)})) > 0"
    return f"""CASE WHEN {_m('sr', r'(?:^|[;|,]\s*)R\s*\[required\]')} OR {_m("trim(split_part(sr, '|', 1))", E.R_ITEM)} THEN 'REQUIRED' WHEN contains(sr, '|') AND {_m("trim(regexp_replace(sr, '^[^|]*[|]', ''))", E.R_ITEM)} THEN 'PREFERRED'
WHEN {hard} THEN 'REQUIRED' WHEN {soft} THEN 'PREFERRED' WHEN len({w}) > 0 THEN 'MENTIONED' ELSE 'NOT_MENTIONED' END"""


def _years_sql() -> str:
    ints = lambda c, p, g=1: f"list_transform(regexp_extract_all({c}, {quote(p)}, {g}), lambda x: try_cast(x AS INTEGER))"
    lists = [ints("sd", rf"(\d{{1,2}}) ?{E.UNIT}")]
    for c in ("r", "d"):
        lists.append(f"list_transform(list_filter(list_zip({ints(c, E.RANGE, 1)}, {ints(c, E.RANGE, 2)}), lambda z: z[1] <= z[2] AND z[2] <= {E.MOST_YEARS}), lambda z: z[1])")
        lists += [ints(f"regexp_replace({c}, {quote(E.RANGE)}, ' ', 'g')", p) for p in E.MINIMA]
    out = lists[0]
    for x in lists[1:]:
        out = f"list_concat({out}, {x})"
    return f"list_max(list_filter({out}, lambda n: n > 0 AND n <= {E.MOST_YEARS}))"


def _evidence_sql(keep: str = "") -> str:
    czech = " ".join(f"WHEN {_m(c, p)} THEN '{v}'" for c in ("l", "r", "d") for p, v in ((E.CZECH_WELCOME, "PREFERRED"), (E.WAIVED, "NOT_REQUIRED")))
    either = lambda p: f"({_m('r', p)} OR {_m('d', p)})"
    level = {v: " OR ".join(_m(c, p) for c in ("sd", "si", "tp", "ti")) for v, p in E.LEVELS}
    mode = " ".join(f"WHEN {_m(c, p)} THEN '{v}'" for c in ("r", "d") for p, v in ((E.FULLY, "REMOTE"), (E.PARTLY, "HYBRID"), (E.OFFICE, "ONSITE")))
    columns = {"l": "Languages", "r": "Requirements", "d": "Description", "pl": "Page_Language", "sd": "Seniority_Detail", "si": "Seniority_Input", "tp": "Job_Title_Page", "ti": "Job_Title_Input", "s": "Skills", "m": "Remote_Mode"}
    raw = {"rr": "Requirements", "dr": "Description", "sr": "Skills", "st": "Current_Status", "h": "HTTP_Status"}
    return f"""WITH f AS (SELECT row_id{keep}, {', '.join(f'{fold_sql(chr(34) + c + chr(34))} AS {a}' for a, c in columns.items())}, {', '.join(f'{word_sql(chr(34) + c + chr(34))} AS {a}' for a, c in raw.items())} FROM {PAGES}),
g AS (SELECT *, ({level['JUNIOR']}) AS j, ({level['MID']}) AS k, ({level['SENIOR']}) AS n FROM f)
SELECT row_id{keep}, CASE {czech} WHEN {either(E.CZECH_REQUIRED)} THEN 'REQUIRED' WHEN {_m('l', rf'(?:^|[^a-z])(?:cs|{E.CZECH}|cesky)(?:$|[^a-z])')} THEN 'REQUIRED' WHEN {either(E.CZECH_SPOKEN)} THEN 'MENTIONED' ELSE 'NOT_MENTIONED' END AS czech,
CASE WHEN {_m('l', E.ENGLISH_LISTED)} OR {either(E.ENGLISH_WANTED)} THEN 'YES' WHEN starts_with(pl, 'en') AND length(dr) >= 180 THEN 'LIKELY' ELSE 'UNKNOWN' END AS english, {_years_sql()} AS years,
CASE WHEN j AND k AND n THEN 'MIXED' WHEN j AND k THEN 'JUNIOR_MID' WHEN k AND n THEN 'MID_SENIOR' WHEN j AND n THEN 'JUNIOR_SENIOR' WHEN j THEN 'JUNIOR' WHEN k THEN 'MID' WHEN n THEN 'SENIOR' ELSE 'UNKNOWN' END AS seniority,
{', '.join(f'{_skill_sql(p)} AS {name}' for name, p in E.SKILLS.items())}, {_r_sql()} AS r,
CASE WHEN {_m('m', E.HYBRID)} THEN 'HYBRID' WHEN {_m('m', E.REMOTE)} AND {_m('m', E.ONSITE)} THEN 'FLEXIBLE' WHEN {_m('m', E.REMOTE)} THEN 'REMOTE' WHEN {_m('m', E.ONSITE)} THEN 'ONSITE' {mode} ELSE 'UNKNOWN' END AS work_mode,
CASE WHEN upper(st) IN ({', '.join(map(quote, E.STATUSES))}) THEN upper(st) WHEN h IN ('404', '410') THEN 'CLOSED' ELSE 'UNKNOWN' END AS status FROM g"""


@query(_evidence_sql())
def page_evidence(spark, d):
    """Languages, experience, level, skills, work mode and status of every page."""
    return page_values(spark, d)


_VALUE_COLUMNS = ["czech", "english", "seniority", "python", "sql", "ml", "statistics", "r", "work_mode", "status"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS value, count(*) AS n FROM ({_evidence_sql()}) GROUP BY ALL" for c in _VALUE_COLUMNS))
def evidence_counts(spark, d):
    """How often each value of each extractor occurs."""
    return T.value_counts(page_values(spark, d), _VALUE_COLUMNS)


_FLAGS = [
    ("upper(e) = 'PARTIAL'", "PARTIAL_EXTRACTION"), ("upper(e) IN ('FAILED', 'BLOCKED')", "EXTRACTION_UNAVAILABLE"), ("status = 'LIKELY_CLOSED'", "LIKELY_CLOSED"), ("status IN ('REQUEST_FAILED', 'HTTP_ERROR')", "CURRENT_STATUS_UNCERTAIN"),
    ("years >= 3", "EXPERIENCE_3_PLUS"), ("seniority IN ('SENIOR', 'MID_SENIOR', 'MIXED', 'JUNIOR_SENIOR')", "SENIOR_LEVEL_PRESENT"), ("czech IN ('PREFERRED', 'MENTIONED')", "CZECH_SIGNAL_REVIEW"), ("english = 'UNKNOWN'", "ENGLISH_UNCLEAR"),
]
_joined = lambda pairs: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{v}' END" for c, v in pairs) + "], lambda x: x IS NOT NULL), ' | ')"
_HARD = [("czech = 'REQUIRED'", "CZECH_REQUIRED"), ("status = 'CLOSED'", "CLOSED")]
_BAD = ("status IN ('CLOSED', 'LIKELY_CLOSED', 'REQUEST_FAILED', 'HTTP_ERROR')", "")


@query(f"""SELECT row_id, conflicts, flags, array_to_string(list_filter([{', '.join(f"CASE WHEN {c} THEN '{v}' END" for c, v in _HARD + _FLAGS)}, CASE WHEN {_BAD[0]} AND status NOT IN ('CLOSED', 'LIKELY_CLOSED') THEN status END], lambda x: x IS NOT NULL), ' | ') AS warnings
FROM (SELECT *, {_joined(_HARD)} AS conflicts, {_joined(_FLAGS)} AS flags FROM (SELECT *, {word_sql('"Extraction_Status"')} AS e FROM ({_evidence_sql(', "Extraction_Status"')})))""")
def page_flags(spark, d):
    """Conflicts, review flags and warnings of every page."""
    p = page_values(spark, d, ["Extraction_Status"])
    p = p.select("*", E.conflicts(F.col("czech"), F.col("status")).alias("conflicts"), E.review_flags(F.col("Extraction_Status"), F.col("status"), F.col("years"), F.col("seniority"), F.col("czech"), F.col("english")).alias("flags"))
    hard = F.when(F.col("conflicts") != "", "YES").otherwise("NO")
    return p.select("row_id", "conflicts", "flags", E.warnings(hard, F.col("conflicts"), F.col("flags"), F.col("status")).alias("warnings"))


_PUB, _UP, _MINED = (_at_sql(f'"{c}"') for c in ("Published_At", "Published_Upper_Bound", "Mining_Date"))


@query(f"""WITH p AS (SELECT row_id, {_PUB} AS a, {_UP} AS b, {_MINED} AS c FROM {PAGES}), q AS (SELECT row_id, coalesce(a, b, c) AS seen, CASE WHEN a IS NOT NULL THEN 'EXACT' WHEN b IS NOT NULL THEN 'MINIMUM_AGE' WHEN c IS NOT NULL THEN 'SEEN' ELSE 'UNKNOWN' END AS basis FROM p)
SELECT row_id, basis, age_days, CASE WHEN age_days IS NULL THEN 'UNKNOWN' {' '.join(f"WHEN age_days <= {n} THEN '{v}'" for n, v in dates.FRESHNESS)} ELSE 'OLD' END AS freshness
FROM (SELECT row_id, basis, CASE WHEN seen IS NOT NULL THEN greatest(0, CAST(floor((epoch(TIMESTAMPTZ '{AS_OF}+00') - epoch(seen)) / 86400) AS BIGINT)) END AS age_days FROM q)""")
def page_publication(spark, d):
    """From when a page's age is counted, the age and its bucket."""
    at = lambda c: dates.iso_instant(F.col(c))
    p = table(spark, d, PAGES).select("row_id", F.explode(F.array(E.publication(at("Published_At"), at("Published_Upper_Bound"), at("Mining_Date")))).alias("p"))
    age = dates.age_days(F.col("p.value"), AS_OF)
    return p.select("row_id", F.col("p.evidence").alias("basis"), F.when(F.col("p.value").isNotNull(), age).alias("age_days")).select("row_id", "basis", "age_days", dates.bucket(F.col("age_days"), dates.FRESHNESS, "OLD").alias("freshness"))


@query(f"""SELECT row_id, CASE WHEN {_m(fold_sql('"Description"'), E.CHALLENGE)} THEN 'CHALLENGE' WHEN {_m(fold_sql('"Description"'), E.NO_RESULTS)} THEN 'NO_RESULTS' ELSE '' END AS blocked,
{_m(fold_sql('"Status_Evidence"'), E.CLOSED)} OR {_m(fold_sql('"Description"'), E.CLOSED)} AS closed, {_m(fold_sql('"Status_Evidence"'), E.APPLY)} OR {_m(fold_sql('"Description"'), E.APPLY)} AS apply FROM {PAGES}""")
def page_markers(spark, d):
    """Challenges, empty result lists, closing notices and apply controls in the text of pages."""
    df, f = E.with_fields(table(spark, d, PAGES).select("row_id", "Description", "Status_Evidence"), ["Description", "Status_Evidence"])
    t, s = f["Description"].folded, f["Status_Evidence"].folded
    blocked = F.when(t.rlike(E.CHALLENGE), "CHALLENGE").when(t.rlike(E.NO_RESULTS), "NO_RESULTS").otherwise("")
    return df.select("row_id", blocked.alias("blocked"), (s.rlike(E.CLOSED) | t.rlike(E.CLOSED)).alias("closed"), (s.rlike(E.APPLY) | t.rlike(E.APPLY)).alias("apply"))


# --- review list ---------------------------------------------------------------------------
DECISIONS, LEVELS = ["APPLY", "STRETCH", "HOLD", "REJECT"], ["HIGH", "MEDIUM", "LOW"]
_key_sql = lambda c: (
    f"CASE WHEN trim(coalesce({c}, '')) = '' THEN '' ELSE lower({_u(c, 1)}) || '://' || lower({_u(c, 2)}) || regexp_replace(regexp_replace({_u(c, 3)}, '/+', '/', 'g'), '/$', '') || CASE WHEN {_u(c, 4)} <> '' THEN '?' || {_u(c, 4)} ELSE '' END END"
)
_u = lambda c, k: f"regexp_extract(trim(coalesce({c}, '')), '^([a-zA-Z][a-zA-Z0-9+.\\-]*)://([^/?#]*)([^?#]*)(?:\\?([^#]*))?', {k})"
_PAGE = ["Job_Title_Page", "Company_Page", "Seniority_Detail", "Source", "Current_Status", "Extraction_Status", "Published_At", "Published_Upper_Bound", "Mining_Date", "Input_URL"]
_REVIEW = ["Review_Status", "Review_Decision", "Review_Priority", "Review_Fit", "Review_Reasons", "Reviewed_At"]


def _latest_pages(spark, d: str) -> DataFrame:
    """Latest page of each address, an undated one first."""
    df = table(spark, d, PAGES).select(urls.review_key(F.col("Input_URL")).alias("url_key"), "row_id", "Extraction_Date", *_PAGE).where("url_key <> ''")
    return T.latest_by(df, ["url_key"], dates.instant(F.col("Extraction_Date")), "row_id")


def _latest_reviews(spark, d: str) -> DataFrame:
    df = table(spark, d, "prospect_reviews").select(urls.review_key(F.col("Input_URL")).alias("url_key"), "row_id", "Review_Updated_At", *_REVIEW).where("url_key <> ''")
    return T.latest_by(df, ["url_key"], dates.instant(F.col("Review_Updated_At")), "row_id")


def review_master(spark, d: str) -> DataFrame:
    """Every graded advert once per address, with its latest page and review."""
    return T.review_master(_graded_adverts(spark, d), _latest_pages(spark, d), _latest_reviews(spark, d), HOSTS, AS_OF)


def _graded_adverts(spark, d: str) -> DataFrame:
    graded = T.first_by(_graded(spark, d), ["ID"], "row_id").select("ID", "grade", F.col("row_id").alias("graded_row"))
    e = table(spark, d, "evaluation").select(F.col("row_id").alias("graded_row"), F.col("`Job Title`").alias("title"), "Seniority", "URL")
    df = graded.join(e, "graded_row").withColumn("url_key", urls.review_key(F.col("URL"))).where("url_key <> ''")
    return T.first_by(df, ["url_key"], "graded_row")


_first = lambda *xs: "coalesce(" + ", ".join(f"nullif({word_sql(x)}, '')" for x in xs) + ", '')"
_LATEST = lambda t, key, at, cols: f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY {at} DESC NULLS FIRST, row_id DESC) AS k FROM (SELECT {_key_sql(key)} AS url_key, * FROM {t}) WHERE url_key <> '') WHERE k = 1"
_SOURCE = "CASE " + " ".join(f"WHEN contains(lower({_u('g.\"URL\"', 2)}), '{h}') THEN '{s}'" for h, s in HOSTS) + " ELSE 'generic' END"
_MASTER = f"""WITH q AS (SELECT "ID", min_by(grade, row_id) AS grade, min(row_id) AS graded_row FROM ({_GRADED}) WHERE grade IS NOT NULL AND "ID" IS NOT NULL GROUP BY "ID"),
g AS (SELECT * FROM (SELECT q.*, e."Job Title" AS title, e."Seniority" AS sen, e."URL", {_key_sql('e."URL"')} AS url_key, row_number() OVER (PARTITION BY {_key_sql('e."URL"')} ORDER BY graded_row) AS k1 FROM q JOIN evaluation e ON e.row_id = graded_row) WHERE k1 = 1 AND url_key <> ''),
p AS ({_LATEST(PAGES, '"Input_URL"', _at_sql('"Extraction_Date"'), '')}), r AS ({_LATEST('prospect_reviews', '"Input_URL"', _at_sql('"Review_Updated_At"'), '')}),
m AS (SELECT g.url_key, g."ID", g.grade, {_first('p."Job_Title_Page"', 'g.title')} AS title, {_first('p."Company_Page"')} AS company, {_first('p."Seniority_Detail"', 'g.sen')} AS seniority,
coalesce(nullif({word_sql('p."Source"')}, ''), {_SOURCE}) AS source, {_first('p."Current_Status"')} AS status, CASE WHEN p.url_key IS NULL THEN 'NOT ENRICHED' ELSE upper(coalesce(p."Extraction_Status", '')) END AS enrichment,
coalesce(nullif(r."Review_Status", ''), 'UNREVIEWED') AS review_status, coalesce(r."Review_Decision", '') AS decision, coalesce(r."Review_Priority", '') AS priority, coalesce(r."Review_Reasons", '') AS reasons,
coalesce({_at_sql('p."Published_At"')}, {_at_sql('p."Published_Upper_Bound"')}, {_at_sql('p."Mining_Date"')}) AS published FROM g LEFT JOIN p USING (url_key) LEFT JOIN r USING (url_key)),
a AS (SELECT *, CASE WHEN published IS NOT NULL THEN greatest(0, CAST(floor((epoch(TIMESTAMPTZ '{AS_OF}+00') - epoch(published)) / 86400) AS BIGINT)) END AS age_days FROM m),
master AS (SELECT * EXCLUDE (published, age_days), epoch_us(published) AS published_us, CASE WHEN age_days IS NULL THEN 'UNKNOWN' {' '.join(f"WHEN age_days <= {n} THEN '{v}'" for n, v in dates.FRESHNESS)} ELSE 'OLD' END AS freshness FROM a) """
_COLS = '"ID", grade, title, company, seniority, source, status, enrichment, review_status, decision, priority, reasons, published_us, freshness, url_key'


@query(f"{_MASTER} SELECT {_COLS} FROM master")
def review_adverts(spark, d):
    """Graded adverts with the columns of their latest page and review."""
    return review_master(spark, d)


_rank = lambda c, values: f"CASE {c} " + " ".join(f"WHEN '{v}' THEN {k}" for k, v in enumerate(values)) + " ELSE 99 END"


@query(f"""{_MASTER} SELECT url_key, row_number() OVER (ORDER BY CAST(review_status = 'REVIEWED' AS INTEGER), published_us DESC NULLS LAST, title, url_key) AS position FROM master""")
def review_order(spark, d):
    """Place of each advert in the review list: unreviewed first, then the latest, then by title."""
    return T.placed(review_master(spark, d), [(F.col("review_status") == "REVIEWED").cast("int"), F.col("published_us").desc_nulls_last(), F.col("title"), F.col("url_key")]).select("url_key", "position")


@query(f"""{_MASTER} SELECT url_key, decision, row_number() OVER (ORDER BY {_rank('decision', DECISIONS)}, {_rank('priority', LEVELS)}, published_us DESC NULLS LAST, url_key) AS position FROM master WHERE decision <> ''""")
def decided_order(spark, d):
    """Decided adverts by decision, priority and date."""
    m = review_master(spark, d).where("decision <> ''")
    return T.placed(m, [T.rank_of(F.col("decision"), DECISIONS), T.rank_of(F.col("priority"), LEVELS), F.col("published_us").desc_nulls_last(), F.col("url_key")]).select("url_key", "decision", "position")


_GROUP = "CASE WHEN company = '' THEN 'UNKNOWN_COMPANY_' || \"ID\" ELSE regexp_replace(upper(company), '[^A-Z0-9]+', '_', 'g') END"


@query(f"""{_MASTER} SELECT url_key, batch, row_number() OVER (ORDER BY batch, {_rank('decision', DECISIONS)}, {_rank('priority', LEVELS)}, freshness, title, url_key) AS position FROM (SELECT *, {_GROUP} AS batch FROM master WHERE decision <> '')""")
def grouped_order(spark, d):
    """Decided adverts by the employer's batch, decision, priority, freshness and title."""
    b = F.when(F.col("company") == "", F.concat(F.lit("UNKNOWN_COMPANY_"), F.col("ID"))).otherwise(F.regexp_replace(F.upper("company"), "[^A-Z0-9]+", "_"))
    m = review_master(spark, d).where("decision <> ''").withColumn("batch", b)
    return T.placed(m, [F.col("batch"), T.rank_of(F.col("decision"), DECISIONS), T.rank_of(F.col("priority"), LEVELS), F.col("freshness"), F.col("title"), F.col("url_key")]).select("url_key", "batch", "position")


@query(f"""{_MASTER} SELECT count(*) AS adverts, count(*) FILTER (review_status = 'REVIEWED') AS reviewed, count(*) FILTER (decision = 'APPLY') AS apply, count(*) FILTER (decision = 'STRETCH') AS stretch,
count(*) FILTER (enrichment <> 'NOT ENRICHED') AS enriched FROM master""")
def review_metrics(spark, d):
    """Counters of the review."""
    n = lambda c, name: F.count_if(c).alias(name)
    return review_master(spark, d).agg(
        F.count(F.lit(1)).alias("adverts"), n(F.col("review_status") == "REVIEWED", "reviewed"), n(F.col("decision") == "APPLY", "apply"), n(F.col("decision") == "STRETCH", "stretch"), n(F.col("enrichment") != "NOT ENRICHED", "enriched"),
    )


_FILTER = {"review_status": ["UNREVIEWED"], "freshness": ["NEW", "FRESH", "RECENT", "AGING", "OLD"], "decision": ["Unreviewed", "HOLD"]}


@query(f"""{_MASTER} SELECT url_key, title FROM master WHERE review_status IN ('UNREVIEWED') AND freshness IN ('NEW', 'FRESH', 'RECENT', 'AGING', 'OLD') AND coalesce(nullif(decision, ''), 'Unreviewed') IN ('Unreviewed', 'HOLD')
AND upper(status) NOT IN ('CLOSED', 'HTTP_ERROR', 'REQUEST_FAILED') AND enrichment <> 'NOT ENRICHED' AND (contains(lower(title), 'analy') OR contains(lower(company), 'analy'))""")
def review_filtered(spark, d):
    """The review list under filters; an empty choice would leave no rows."""
    return T.review_filter(review_master(spark, d), _FILTER, search="Analy", only_open=True, only_enriched=True).select("url_key", "title")


_CANON_SQL = "(SELECT lower(name) AS key, min(entry_id) AS entry_id FROM canon_entries WHERE field = 'Job.Title' GROUP BY lower(name))"
_EV = """(SELECT "ID", arg_min_null("Seniority", row_id) AS s FROM evaluation WHERE "ID" IS NOT NULL GROUP BY "ID")"""


@query(f"""WITH a AS (SELECT lower({word_sql('"Job.Title"')}) AS key, "ID", "Seniority" AS own FROM data_analytics), c AS {_CANON_SQL}, j AS (SELECT a.*, c.entry_id, e.s FROM a LEFT JOIN c USING (key) LEFT JOIN {_EV} e USING ("ID")),
f AS (SELECT *, lower({word_sql('own')}) NOT IN ('', 'n/a', 'na', 'none', 'null', 'nan') AS has, lower({word_sql('s')}) NOT IN ('', 'n/a', 'na', 'none', 'null', 'nan') AS inf FROM j)
SELECT count(*) AS rows, count(*) FILTER (key = '') AS blank_titles, count(DISTINCT key) AS titles, count(entry_id) AS matched, count(*) FILTER (entry_id IS NULL) AS unmatched, count(*) FILTER (has) AS own_level, count(*) FILTER (NOT has AND inf) AS inferred_level,
count(*) FILTER (has AND inf AND lower({word_sql('own')}) <> lower({word_sql('s')})) AS level_conflicts FROM f""")
def merge_metrics(spark, d):
    """Counters of the join of adverts to titles and levels, in one pass."""
    first = T.first_by(table(spark, d, "evaluation").where(F.col("ID").isNotNull()).select("ID", "row_id", "Seniority"), ["ID"], "row_id").select("ID", F.col("Seniority").alias("s"))
    canon = table(spark, d, "canon_entries").where("field = 'Job.Title'").groupBy(F.lower("name").alias("key")).agg(F.min("entry_id").alias("entry_id"))
    j = table(spark, d, "data_analytics").select(text.title_key(F.col("`Job.Title`")).alias("key"), "ID", "Seniority").join(F.broadcast(canon), "key", "left").join(first, "ID", "left")
    return T.merge_metrics(j, "key", "entry_id", F.col("Seniority"), F.col("s"))


@query(f"""SELECT epoch_us(min({_at_sql('"Mining_Date"')})) AS first_seen, epoch_us(max({_at_sql('"Mining_Date"')})) AS last_seen, count(*) AS times, {_key_sql('"URL"')} AS url_key FROM data_analytics WHERE {_key_sql('"URL"')} <> '' GROUP BY ALL""")
def first_last_seen(spark, d):
    """When each address was seen first and last, and how often."""
    df = table(spark, d, "data_analytics").select(urls.review_key(F.col("URL")).alias("url_key"), dates.instant(F.col("Mining_Date")).alias("at")).where("url_key <> ''")
    return T.seen_span(df, "url_key", "at").withColumns({c: F.unix_micros(c) for c in ("first_seen", "last_seen")})


@query(f"""WITH k AS (SELECT DISTINCT "URL" AS url FROM data_analytics WHERE "URL" IS NOT NULL), h AS (SELECT url, CAST('0x' || substr(sha256(url), 1, 8) AS BIGINT) % 10000 AS slot, sha256(url) AS s FROM k)
SELECT url, 'AD_' || lpad(CAST(slot AS VARCHAR), 4, '0') || CASE WHEN n = 1 THEN '' ELSE '_' || CAST(n AS VARCHAR) END AS id FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY s) AS n FROM h)""")
def unique_ids(spark, d):
    """One identifier per address, the same whatever the order of the rows."""
    return urls.unique_ids(table(spark, d, "data_analytics").where(F.col("URL").isNotNull()).select(F.col("URL").alias("url")), "url", "AD_")


@query(f"""SELECT row_id, {fold_sql('"Job.Title"')} AS folded, row_number() OVER (ORDER BY {fold_sql('"Job.Title"')}, row_id) AS position FROM data_analytics""")
def titles_in_order(spark, d):
    """All adverts by folded title."""
    df = table(spark, d, "data_analytics").select("row_id", text.fold(F.col("`Job.Title`")).alias("folded"))
    return T.placed(df, [F.col("folded"), F.col("row_id")])
