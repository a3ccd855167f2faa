"""Queries over the domain tables, one or more per operator group, and the same
results in SQL. All run over whole tables; names are alike on both sides."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions import dates, text, urls
from adloom.operators import evidence, rules
from adloom.operators import tables as T
from adloom.session import checkpoint_dir, spread, table
from adloom.sources import pages
from adloom.streaming import streams

AS_OF = "2026-11-20 00:00:00"
LISTING = ["ID", "Job Title", "Company", "Location", "Salary", "Seniority", "URL", "Mining_Date"]
BOARDS = ["indeed_basic", "jobstack_basic"]
HOSTS = [("sj.board", "startupjobs"), ("jst.board", "jobstack"), ("jb.board", "jobs"), ("blt.board", "builtin"), ("ind.board", "indeed")]
PRIORITIES = ["High", "Good", "Exploratory", "Stretch", "Deprioritized", "Exclude"]
SP = r"[\s\p{Z}]+"

#: SQL pieces shared by the oracles
clean_sql = lambda c: f"trim(regexp_replace(coalesce({c}, ''), '{SP}', ' ', 'g'))"
word_sql = lambda c: f"(CASE WHEN lower({clean_sql(c)}) = 'nan' THEN '' ELSE {clean_sql(c)} END)"
fold_sql = lambda c: f"replace(strip_accents(lower({word_sql(c)})), 'ß', 'ss')"
norm_sql = lambda c: f"trim(regexp_replace(replace({fold_sql(c)}, '&', ' and '), '[^a-z0-9+#]+', ' ', 'g'))"
missing_sql = lambda c: f"(lower({clean_sql(c)}) IN ('', 'n/a', 'na', 'none', 'null', 'nan'))"
quote = lambda s: "'" + s.replace("'", "''") + "'"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _union(spark: SparkSession, d: str) -> DataFrame:
    return T.union_sources({b: table(spark, d, b) for b in BOARDS}, LISTING, LISTING[:5])


_UNION_SQL = " UNION ALL ".join(
    f"SELECT '{b}' AS source, " + ", ".join(f"trim(coalesce(\"{c}\", ''), ' ') AS \"{c}\"" if not (c == "Seniority" and b == "indeed_basic") else "'' AS \"Seniority\"" for c in LISTING) + f" FROM {b}"
    for b in BOARDS
)


# --- sources, union, filters -------------------------------------------------------
@query(_UNION_SQL)
def union_sources(spark, d):
    """Aligned UNION ALL of two boards with different columns."""
    return _union(spark, d)


@query(f"""SELECT source, count(*) AS listings, count(*) FILTER ("ID" <> '') - count(DISTINCT nullif("ID", '')) AS repeated_ids,
count(*) FILTER ("URL" <> '') - count(DISTINCT nullif("URL", '')) AS repeated_urls FROM ({_UNION_SQL}) GROUP BY source""")
def union_repeats(spark, d):
    n = lambda c: (F.count(F.nullif(F.col(c), F.lit(""))) - F.count_distinct(F.nullif(F.col(c), F.lit("")))).alias
    return _union(spark, d).groupBy("source").agg(F.count("*").alias("listings"), n("ID")("repeated_ids"), n("URL")("repeated_urls"))


@query(f"""SELECT key, min_by(value, row_id) AS value, count(*) AS n FROM (SELECT lower({word_sql('"Job.Title"')}) AS key, {word_sql('"Job.Title"')} AS value, row_id FROM data_analytics)
WHERE value <> '' GROUP BY key""")
def distinct_titles(spark, d):
    return T.distinct_spelling(table(spark, d, "data_analytics"), "Job.Title", "row_id")


@query(f"""SELECT row_id, {norm_sql('"Job.Title"')} AS title, {fold_sql('"Location"')} AS place FROM data_analytics""")
def normalised_titles(spark, d):
    return table(spark, d, "data_analytics").select("row_id", text.normalise(F.col("`Job.Title`")).alias("title"), text.fold(F.col("Location")).alias("place"))


@query(f"""SELECT row_id, len(list_filter(regexp_split_to_array(coalesce("Fit.Reasons", ''), '[|;]'), lambda x: trim(x) <> '')) AS reasons,
array_to_string(list_transform(list_filter(regexp_split_to_array(coalesce("Fit.Reasons", ''), '[|;]'), lambda x: trim(x) <> ''), lambda x: trim(x)), ' | ') AS joined FROM data_analytics""")
def split_reasons(spark, d):
    items = text.split_multi(F.col("`Fit.Reasons`"))
    return table(spark, d, "data_analytics").select("row_id", F.size(items).cast("long").alias("reasons"), F.array_join(items, " | ").alias("joined"))


@query(f"""SELECT row_id, CASE WHEN try_cast({word_sql('"Grade"')} AS DOUBLE) IN (1.0, 2.0) THEN CAST(CAST(try_cast({word_sql('"Grade"')} AS DOUBLE) AS INTEGER) AS VARCHAR)
WHEN regexp_matches({word_sql('"Grade"')}, '^[12] -') THEN substr({word_sql('"Grade"')}, 1, 1) END AS grade FROM evaluation""")
def selected_grades(spark, d):
    return table(spark, d, "evaluation").select("row_id", text.selected_grade(F.col("Grade")).alias("grade"))


# --- URLs and identity ---------------------------------------------------------------
_U = "regexp_extract(trim(coalesce(\"Final_URL\", '')), '^([a-zA-Z][a-zA-Z0-9+.\\-]*)://([^/?#]*)([^?#]*)(?:\\?([^#]*))?', {})"
_PATH = f"regexp_replace(regexp_replace({_U.format(3)}, '/+', '/', 'g'), '/$', '')"
_PAIRS = f"list_sort(list_filter(string_split({_U.format(4)}, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?:utm_[^=]*|fbclid|gclid|searchId|rps)(?:=|$)')))"


@query(f"""SELECT row_id, CASE WHEN trim(coalesce("Final_URL", '')) = '' THEN '' ELSE lower({_U.format(1)}) || '://' || lower({_U.format(2)}) || {_PATH} || CASE WHEN {_U.format(4)} <> '' THEN '?' || {_U.format(4)} ELSE '' END END AS review_key,
CASE WHEN trim(coalesce("Final_URL", '')) = '' THEN '' ELSE lower({_U.format(1)}) || '://' || lower({_U.format(2)}) || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END || CASE WHEN len({_PAIRS}) > 0 THEN '?' || array_to_string({_PAIRS}, '&') ELSE '' END END AS canonical FROM prospects_enriched_raw""")
def url_keys(spark, d):
    u = F.col("Final_URL")
    return table(spark, d, "prospects_enriched_raw").select("row_id", urls.review_key(u).alias("review_key"), urls.canonical(u).alias("canonical"))


@query("SELECT source, count(*) AS n FROM (SELECT CASE " + " ".join(f"WHEN contains(lower(regexp_extract(coalesce(\"URL\", ''), '://([^/?#]*)', 1)), '{h}') THEN '{s}'" for h, s in HOSTS) + " ELSE 'generic' END AS source FROM data_analytics) GROUP BY source")
def source_of_url(spark, d):
    return table(spark, d, "data_analytics").select(urls.detect_source(F.col("URL"), HOSTS).alias("source")).groupBy("source").agg(F.count("*").alias("n"))


@query("""SELECT row_id, 'AD_' || lpad(CAST(CAST('0x' || substr(sha256("URL"), 1, 8) AS BIGINT) % 10000 AS VARCHAR), 4, '0') AS hash_id, regexp_extract("URL", '/ad/([0-9]+)', 1) AS site_id FROM data_analytics WHERE "URL" IS NOT NULL""")
def hashed_ids(spark, d):
    return table(spark, d, "data_analytics").where(F.col("URL").isNotNull()).select("row_id", urls.hash_id(F.col("URL"), "AD_").alias("hash_id"), urls.site_id(F.col("URL"), r"/ad/([0-9]+)").alias("site_id"))


# --- deduplication ------------------------------------------------------------------
_GRADED = "SELECT row_id, \"ID\", CASE WHEN try_cast({g} AS DOUBLE) IN (1.0, 2.0) THEN CAST(CAST(try_cast({g} AS DOUBLE) AS INTEGER) AS VARCHAR) WHEN regexp_matches({g}, '^[12] -') THEN substr({g}, 1, 1) END AS grade FROM evaluation".format(g=word_sql('"Grade"'))


def _graded(spark, d):
    return table(spark, d, "evaluation").select("row_id", "ID", text.selected_grade(F.col("Grade")).alias("grade")).where(F.col("grade").isNotNull() & F.col("ID").isNotNull())


@query(f"SELECT \"ID\", min_by(grade, row_id) AS grade, min(row_id) AS row_id FROM ({_GRADED}) WHERE grade IS NOT NULL AND \"ID\" IS NOT NULL GROUP BY \"ID\"")
def first_qualifying_grade(spark, d):
    return T.first_by(_graded(spark, d), ["ID"], "row_id").select("ID", "grade", "row_id")


_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"
_at_sql = lambda c: f"CASE WHEN regexp_matches(trim({c}), '{_ISO}') THEN try_cast(trim({c}) AS TIMESTAMPTZ) END"


@query(f"""SELECT "Input_URL", row_id, "Extraction_Status" FROM (SELECT *, row_number() OVER (PARTITION BY "Input_URL" ORDER BY {_at_sql('"Extraction_Date"')} DESC NULLS FIRST, row_id DESC) AS k FROM prospects_enriched_raw WHERE "Input_URL" IS NOT NULL) WHERE k = 1""")
def latest_per_url(spark, d):
    """Latest extraction per address; an undated one wins."""
    df = table(spark, d, "prospects_enriched_raw").where(F.col("Input_URL").isNotNull()).select("Input_URL", "row_id", "Extraction_Status", "Extraction_Date")
    return T.latest_by(df, ["Input_URL"], dates.instant(F.col("Extraction_Date")), "row_id").select("Input_URL", "row_id", "Extraction_Status")


@query("""WITH g AS (SELECT "Input_URL", max_by("Extraction_Status", row_id) AS s, max_by("Description", row_id) AS last_d, max_by(CASE WHEN "Description" IS NULL THEN '<null>' ELSE "Description" END, row_id) FILTER ("Extraction_Status" = 'ok') AS good_d,
max_by(coalesce("Extraction_Status" = 'ok', false), row_id) AS is_ok, count(*) FILTER ("Extraction_Status" = 'ok') AS oks, max(row_id) AS row_id, count(*) AS attempts, arg_max_null("Extraction_Status", row_id) AS s2, arg_max_null("Description", row_id) AS last_d2
FROM prospects_enriched_raw WHERE "Input_URL" IS NOT NULL GROUP BY "Input_URL")
SELECT "Input_URL", row_id, s2 AS "Extraction_Status", CASE WHEN NOT is_ok AND oks > 0 THEN nullif(good_d, '<null>') ELSE last_d2 END AS "Description", attempts FROM g""")
def compacted_attempts(spark, d):
    df = table(spark, d, "prospects_enriched_raw").where(F.col("Input_URL").isNotNull()).select("Input_URL", "row_id", "Extraction_Status", "Description")
    return T.compact_latest(df, "Input_URL", "row_id", F.col("Extraction_Status") == "ok", ["Description"])


_LAST_REVIEW = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "ID" ORDER BY row_id DESC) AS k FROM prospect_reviews WHERE "ID" IS NOT NULL) WHERE k = 1"""


@query(f"""SELECT l."ID", l.row_id, l."Review_Decision", f.first_at AS "Reviewed_At" FROM ({_LAST_REVIEW}) l JOIN
(SELECT "ID", arg_min_null("Reviewed_At", row_id) AS fa, coalesce(arg_min_null("Reviewed_At", row_id), arg_max_null("Reviewed_At", row_id)) AS first_at FROM prospect_reviews WHERE "ID" IS NOT NULL GROUP BY "ID") f ON l."ID" = f."ID" """)
def review_upsert(spark, d):
    """The last review of each advert over the first one, whose time stays."""
    df = table(spark, d, "prospect_reviews").where(F.col("ID").isNotNull()).select("ID", "row_id", "Review_Decision", "Reviewed_At")
    last = T.latest_by(df, ["ID"], F.lit(None).cast("timestamp"), "row_id")
    return T.upsert(T.first_by(df, ["ID"], "row_id"), last, "ID", keep=["Reviewed_At"])


# --- joins ----------------------------------------------------------------------------
_CANON = "(SELECT lower(name) AS key, min(entry_id) AS entry_id FROM canon_entries WHERE field = 'Job.Title' GROUP BY lower(name))"


def _canon(spark, d):
    return table(spark, d, "canon_entries").where("field = 'Job.Title'").groupBy(F.lower("name").alias("key")).agg(F.min("entry_id").alias("entry_id"))


@query(f"""SELECT a.row_id, a."ID", c.entry_id FROM data_analytics a LEFT JOIN {_CANON} c ON lower({word_sql('a."Job.Title"')}) = c.key""")
def enriched_titles(spark, d):
    """Left join of the adverts to the list of titles (of fixed size)."""
    df = table(spark, d, "data_analytics").select("row_id", "ID", text.title_key(F.col("`Job.Title`")).alias("key"))
    return df.join(F.broadcast(_canon(spark, d)), "key", "left").select("row_id", "ID", "entry_id")


@query(f"""SELECT key, entry_id FROM {_CANON} WHERE key NOT IN (SELECT DISTINCT lower({word_sql('"Job Title"')}) FROM indeed_basic)""")
def unused_titles(spark, d):
    used = table(spark, d, "indeed_basic").select(text.title_key(F.col("`Job Title`")).alias("key")).distinct()
    return _canon(spark, d).join(used, "key", "left_anti")


_EV1 = """(SELECT "ID", arg_min_null("Seniority", row_id) AS s FROM evaluation WHERE "ID" IS NOT NULL GROUP BY "ID")"""
_own, _inf = '"Seniority"', "e.s"


@query(f"""SELECT a.row_id, CASE WHEN NOT {missing_sql('a."Seniority"')} THEN {word_sql('a."Seniority"')} WHEN NOT {missing_sql("e.s")} THEN {word_sql("e.s")} ELSE '' END AS seniority,
NOT {missing_sql('a."Seniority"')} AND NOT {missing_sql("e.s")} AND lower({word_sql('a."Seniority"')}) <> lower({word_sql("e.s")}) AS conflict FROM data_analytics a LEFT JOIN {_EV1} e ON a."ID" = e."ID" """)
def seniority_conflicts(spark, d):
    """Own level, else the evaluation's, with a flag where both differ."""
    first = T.first_by(table(spark, d, "evaluation").where(F.col("ID").isNotNull()).select("ID", "row_id", "Seniority"), ["ID"], "row_id").select("ID", F.col("Seniority").alias("s"))
    j = table(spark, d, "data_analytics").select("row_id", "ID", "Seniority").join(first, "ID", "left")
    value, conflict = T.coalesce_with_conflict(F.col("Seniority"), F.col("s"))
    return j.select("row_id", value.alias("seniority"), conflict.alias("conflict"))


@query("""SELECT DISTINCT a."ID" FROM data_analytics a WHERE a."ID" IS NOT NULL AND NOT EXISTS (SELECT 1 FROM evaluation e WHERE e."ID" = a."ID")""")
def pending_ids(spark, d):
    """Adverts not yet evaluated."""
    done = table(spark, d, "evaluation").select("ID")
    return table(spark, d, "data_analytics").where(F.col("ID").isNotNull()).select("ID").distinct().join(done, "ID", "left_anti")


@query(f"""WITH g AS (SELECT "ID", min_by(grade, row_id) AS grade FROM ({_GRADED}) WHERE grade IS NOT NULL AND "ID" IS NOT NULL GROUP BY "ID"),
p AS (SELECT "ID", max(row_id) AS page_row FROM prospects_enriched_raw WHERE "ID" IS NOT NULL GROUP BY "ID"), r AS (SELECT "ID", max(row_id) AS review_row FROM prospect_reviews WHERE "ID" IS NOT NULL GROUP BY "ID"),
a AS (SELECT "ID", max(row_id) AS advert_row FROM data_analytics WHERE "ID" IS NOT NULL GROUP BY "ID")
SELECT g."ID", g.grade, a.advert_row, p.page_row, r.review_row FROM g LEFT JOIN a USING ("ID") LEFT JOIN p USING ("ID") LEFT JOIN r USING ("ID")""")
def review_list(spark, d):
    """Graded adverts with the latest advert, page and review of each: every
    side is reduced to one row per key before the joins."""
    last = lambda name, alias: table(spark, d, name).where(F.col("ID").isNotNull()).groupBy("ID").agg(F.max("row_id").alias(alias))
    g = T.first_by(_graded(spark, d), ["ID"], "row_id").select("ID", "grade")
    return g.join(last("data_analytics", "advert_row"), "ID", "left").join(last("prospects_enriched_raw", "page_row"), "ID", "left").join(last("prospect_reviews", "review_row"), "ID", "left")


# --- aggregates, orders ---------------------------------------------------------------
@query("SELECT 'priority' AS section, c.category, c.position, count(a.row_id) AS n FROM (VALUES " + ", ".join(f"({quote(p)}, {k})" for k, p in enumerate(PRIORITIES)) + ') c(category, position) LEFT JOIN data_analytics a ON coalesce(a."Review.Priority", \'\') = c.category GROUP BY ALL')
def priority_summary(spark, d):
    """Counts over a fixed spine of categories, zero-filled."""
    return T.summary(table(spark, d, "data_analytics"), {"priority": ("Review.Priority", PRIORITIES)})


_COUNTED = ["Remote_Mode", "Employment_Type", "Current_Status", "Page_Language", "Parser"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, coalesce(\"{c}\", '') AS value, count(*) AS n FROM prospects_enriched_raw GROUP BY ALL" for c in _COUNTED))
def page_value_counts(spark, d):
    return T.value_counts(table(spark, d, "prospects_enriched_raw"), _COUNTED)


@query("""SELECT key, min_by(label, (-n, label)) AS label, max(n) AS n FROM (SELECT "ID" AS key, "Primary.Track" AS label, count(*) AS n FROM data_analytics WHERE "ID" IS NOT NULL AND "Primary.Track" IS NOT NULL GROUP BY ALL) GROUP BY key""")
def main_track(spark, d):
    """Most frequent track per advert."""
    return T.argmax_label(table(spark, d, "data_analytics").where(F.col("ID").isNotNull() & F.col("`Primary.Track`").isNotNull()), "ID", "Primary.Track")


_BATCH = "regexp_replace(upper(" + word_sql('"Company"') + "), '[^A-Z0-9]+', '_', 'g')"


@query(f"""SELECT batch, count(*) AS listings, count(DISTINCT "Job Title") AS roles FROM (SELECT {_BATCH} AS batch, "Job Title" FROM jobstack_basic) GROUP BY batch HAVING count(DISTINCT "Job Title") > 1""")
def company_batches(spark, d):
    """Companies with more than one role."""
    b = F.regexp_replace(F.upper(text.clean(F.col("Company"))), "[^A-Z0-9]+", "_").alias("batch")
    return table(spark, d, "jobstack_basic").groupBy(b).agg(F.count("*").alias("listings"), F.count_distinct("Job Title").alias("roles")).where("roles > 1")


@query("""SELECT array_to_string(list_sort(list(DISTINCT "Source")), ',') AS sources FROM prospects_enriched_raw""")
def sorted_sources(spark, d):
    return table(spark, d, "prospects_enriched_raw").agg(F.array_join(F.array_sort(F.collect_set("Source")), ",").alias("sources"))


_RANK = "CASE coalesce(\"Review.Priority\", '') " + " ".join(f"WHEN {quote(p)} THEN {k}" for k, p in enumerate(PRIORITIES)) + " ELSE 99 END"


@query(f"""SELECT row_id, row_number() OVER (PARTITION BY "ID" ORDER BY {_RANK}, try_cast("Fit.Score" AS DOUBLE) DESC NULLS LAST, {_at_sql('"Mining_Date"')} DESC NULLS LAST, {fold_sql('"Job.Title"')}, row_id) AS position FROM data_analytics""")
def queue_order(spark, d):
    """Place of each observation of an advert in the review order."""
    rank = F.lit(99)
    for k, p in enumerate(PRIORITIES):
        rank = F.when(F.coalesce(F.col("`Review.Priority`"), F.lit("")) == p, F.lit(k)).otherwise(rank)
    order = [rank, F.col("`Fit.Score`").try_cast("double").desc_nulls_last(), dates.instant(F.col("Mining_Date")).desc_nulls_last(), text.fold(F.col("`Job.Title`")), F.col("row_id")]
    return T.placed_within(table(spark, d, "data_analytics").select("row_id", "ID", "`Review.Priority`", "`Fit.Score`", "Mining_Date", "`Job.Title`"), ["ID"], order).select("row_id", F.col("position").cast("long").alias("position"))


@query("""SELECT row_id, "ID", "Job.Title", "Fit.Score" FROM data_analytics ORDER BY try_cast("Fit.Score" AS DOUBLE) DESC NULLS LAST, row_id LIMIT 200""")
def top_fit(spark, d):
    """Top-k report by score."""
    return table(spark, d, "data_analytics").orderBy(F.col("`Fit.Score`").try_cast("double").desc_nulls_last(), "row_id").limit(200).select("row_id", "ID", "`Job.Title`", "`Fit.Score`")


@query("SELECT row_id, \"ID\" FROM evaluation ORDER BY md5('audit|' || CAST(row_id AS VARCHAR)), row_id LIMIT 200")
def audit_sample(spark, d):
    """Seeded sample without replacement of 200 rows (a sampling operator)."""
    return T.shuffled(table(spark, d, "evaluation"), "row_id", "audit").orderBy("_shuffle", "row_id").limit(200).select("row_id", "ID")


_QUEUES = {
    "active": ("coalesce(\"Review.Priority\" IN ('High', 'Good', 'Exploratory'), false)", lambda: F.coalesce(F.col("`Review.Priority`").isin("High", "Good", "Exploratory"), F.lit(False))),
    "unclassified": ("coalesce(\"Position.Type\", '') = '' OR coalesce(\"Position.Subtype\", '') = ''", lambda: (F.coalesce(F.col("`Position.Type`"), F.lit("")) == "") | (F.coalesce(F.col("`Position.Subtype`"), F.lit("")) == "")),
    "with_pay": ("regexp_matches(coalesce(\"Salary\", ''), '[0-9]')", lambda: F.coalesce(F.col("Salary"), F.lit("")).rlike("[0-9]")),
    "fresh": ("coalesce(try_cast(\"Mining.Age.Days\" AS INTEGER) <= 3, false)", lambda: F.coalesce(F.col("`Mining.Age.Days`").try_cast("int") <= 3, F.lit(False))),
}


@query("SELECT queue, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{q}' AS queue FROM data_analytics WHERE {sql}" for q, (sql, _) in _QUEUES.items()) + ") GROUP BY queue")
def routed_counts(spark, d):
    """Rows per queue; a row may go to several."""
    return T.route(table(spark, d, "data_analytics"), [(q, make()) for q, (_, make) in _QUEUES.items()]).groupBy("queue").agg(F.count("*").alias("n"))


# --- rule engines -----------------------------------------------------------------------
def _masked_sql(t: str) -> str:
    for pattern, keep in rules.MASKS:
        t = f"regexp_replace({t}, {quote(pattern)}, {quote(keep.replace('$', chr(92)))}, 'g')"
    return t


def _rule_sql(column: str, source: str) -> str:
    hits = ", ".join(
        f"CASE WHEN regexp_matches(k, {quote(r.pattern)}) THEN {{'rank': {r.ground}, 'start': strpos(k, regexp_extract(k, {quote(r.pattern)})),"
        f" 'length': -length(regexp_extract(k, {quote(r.pattern)})), 'position': {n}, 'label': {quote(r.label)}, 'signal': {quote(r.signal)}}} END"
        for n, r in enumerate(rules.ROOTS)
    )
    exact = "CASE " + " ".join(f"WHEN t = {quote(k)} THEN {quote(v)}" for k, v in rules.OVERRIDES.items()) + " END"
    sure = "CASE " + " ".join(f"WHEN h[1].rank = {k} THEN {v}" for k, (_, v) in enumerate(rules.GROUNDS)) + " END"
    return f"""WITH s AS (SELECT DISTINCT {norm_sql(column)} AS t FROM {source}), x AS (SELECT t, {_masked_sql('t')} AS k FROM s),
m AS (SELECT t, {exact} AS ex, list_sort(list_filter([{hits}], lambda x: x IS NOT NULL)) AS h FROM x), o AS (SELECT *, list_filter(h, lambda x: x.label <> h[1].label) AS r FROM m)
SELECT t AS title, CASE WHEN t = '' THEN 'Other' WHEN ex IS NOT NULL THEN ex WHEN len(h) > 0 THEN h[1].label ELSE 'Other' END AS root,
CAST(CASE WHEN t = '' THEN 0.0 WHEN ex IS NOT NULL THEN 1.0 WHEN len(h) > 0 THEN CASE WHEN len(r) > 0 AND r[1].rank = h[1].rank THEN round({sure} - {rules.RIVAL}, 2) ELSE {sure} END ELSE {rules.UNCLASSIFIED} END AS DOUBLE) AS confidence,
CASE WHEN t = '' OR ex IS NOT NULL OR len(h) = 0 THEN '' ELSE h[1].signal END AS signal FROM o"""


@query(_rule_sql('"Job.Title"', "data_analytics"))
def root_of_titles(spark, d):
    """Occupation of each distinct title by weighted rules."""
    titles = table(spark, d, "data_analytics").select(text.normalise(F.col("`Job.Title`")).alias("title")).distinct()
    got = rules.classify(titles, "title", rules.ROOTS, rules.OVERRIDES)
    return got.select("title", "root", "confidence", F.when(F.col("method") == "exact override", "").otherwise(F.col("signal")).alias("signal"))


_tags_sql = lambda pairs, t: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches({t}, {quote(p)}) THEN {quote(v)} END" for v, p in pairs) + "], lambda x: x IS NOT NULL), ', ')"
_TOOL_RULES = [(t, rules.tool_pattern(t)) for t in rules.TOOLS]


@query(f"""SELECT t AS title, {_tags_sql(rules.DOMAINS, 't')} AS domains, {_tags_sql(rules.LEVELS, 't')} AS levels FROM (SELECT DISTINCT {norm_sql('"Job.Title"')} AS t FROM data_analytics)""")
def title_tags(spark, d):
    titles = table(spark, d, "data_analytics").select(text.normalise(F.col("`Job.Title`")).alias("title")).distinct()
    t = F.col("title")
    return titles.select("title", F.array_join(rules.tags(t, rules.DOMAINS), ", ").alias("domains"), F.array_join(rules.tags(t, rules.LEVELS), ", ").alias("levels"))


_tool_sql = lambda c: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches({c if t in rules.CASED else f'lower({c})'}, {quote(p)}) THEN {quote(t)} END" for t, p in _TOOL_RULES) + "], lambda x: x IS NOT NULL), ', ')"


@query(f"""SELECT doc_id, {_tool_sql("coalesce(text, '')")} AS tools FROM documents""")
def document_tools(spark, d):
    """Tools named in each document."""
    return spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id").select("doc_id", F.array_join(rules.tools(F.coalesce(F.col("text"), F.lit(""))), ", ").alias("tools"))


def _subtype_sql(t: str, root: str) -> str:
    """First subtype of a root by a list of conditions in order."""
    pick = " ".join(f"WHEN {root} = {quote(r)} AND regexp_matches({t}, {quote(p)}) THEN {quote(v)}" for r, pairs in rules.SUBTYPES.items() for v, p in pairs)
    rest = " ".join(f"WHEN {root} = {quote(r)} THEN {quote(v)}" for r, v in rules.GENERAL.items())
    return f"CASE {pick} {rest} WHEN {root} = 'Other' THEN 'Other' ELSE 'General ' || {root} END"


@query(f"""SELECT title, root, {_subtype_sql("title", "root")} AS subtype FROM ({_rule_sql('"Job Title"', "jobstack_basic")})""")
def title_topics(spark, d):
    """Root and subtype of each distinct normalised title."""
    titles = table(spark, d, "jobstack_basic").select(text.normalise(F.col("`Job Title`")).alias("title")).distinct()
    got = rules.classify(titles, "title", rules.ROOTS, rules.OVERRIDES)
    return got.select("title", "root", rules.subtype(F.col("title"), F.col("root")).alias("subtype"))


_NAMES = " ".join(f"WHEN root = {quote(v)} THEN list_filter(parts, lambda p: regexp_matches(p, {quote('|'.join(r.pattern for r in rules.ROOTS if r.label == v and rules.GROUNDS[r.ground][0] != 'function'))}))" for v in sorted({r.label for r in rules.ROOTS}))


@query(f"""WITH o AS (SELECT min_by({word_sql('"Job Title"')}, row_id) AS value FROM indeed_basic WHERE {word_sql('"Job Title"')} <> '' GROUP BY lower({word_sql('"Job Title"')})),
r AS (SELECT value, {norm_sql("value")} AS n FROM o), c AS ({_rule_sql('"Job Title"', "indeed_basic")}),
p AS (SELECT value, root, {_subtype_sql("n", "root")} AS subtype, list_transform(regexp_split_to_array(value, '\\s/\\s'), lambda x: {norm_sql("x")}) AS parts FROM r JOIN c ON c.title = r.n),
k AS (SELECT value, root, subtype, CASE {_NAMES} ELSE [] END AS named FROM p),
l AS (SELECT value, root, subtype, named, list_filter(list_transform(named, lambda x: {_subtype_sql("x", "root")}), lambda v: v <> subtype AND v NOT LIKE 'General %' AND v <> 'Executive/General Manager') AS others FROM k)
SELECT value, root, subtype, CASE WHEN len(named) > 1 THEN coalesce(others[1], '') ELSE '' END AS secondary FROM l""")
def title_subtypes(spark, d):
    """Root, subtype and second subtype of every distinct title as written."""
    once = T.distinct_spelling(table(spark, d, "indeed_basic"), "Job Title", "row_id").select("value")
    got = rules.classify(once, "value", rules.ROOTS, rules.OVERRIDES)
    return got.select("value", "root", rules.subtype(text.normalise(F.col("value")), F.col("root")).alias("subtype"), rules.secondary(F.col("value"), F.col("root")).alias("secondary"))


_AGE = f"greatest(0, CAST(floor((epoch(TIMESTAMPTZ '{AS_OF}+00') - epoch({{}})) / 86400) AS BIGINT))"
_AGE1 = f"CASE WHEN {_at_sql('\"Mining_Date\"')} IS NULL THEN NULL ELSE {_AGE.format(_at_sql('\"Mining_Date\"'))} END"


@query(f"""SELECT row_id, age_days, CASE WHEN age_days IS NULL THEN 'UNKNOWN' {' '.join(f"WHEN age_days <= {n} THEN '{b}'" for n, b in dates.FRESHNESS)} ELSE 'OLD' END AS freshness FROM (SELECT row_id, {_AGE1} AS age_days FROM data_analytics)""")
def freshness(spark, d):
    """Age in whole days and its bucket."""
    at = dates.instant(F.col("Mining_Date"))
    age = F.when(at.isNotNull(), dates.age_days(at, AS_OF))
    return table(spark, d, "data_analytics").select("row_id", age.alias("age_days"), dates.bucket(age, dates.FRESHNESS, "OLD").alias("freshness"))


# --- pages -------------------------------------------------------------------------------
@query("""SELECT row_id, nullif("Job_Title_Page", '') AS title, nullif("Company_Page", '') AS company, nullif("Location_Detail", '') AS location, nullif("Employment_Type", '') AS employment_type FROM prospects_enriched_raw""")
def jsonld_round_trip(spark, d):
    """Facts of every row set as JSON-LD into a page and read back from it."""
    p = table(spark, d, "prospects_enriched_raw")
    n = lambda c: F.nullif(F.col(c), F.lit(""))
    data = F.to_json(
        F.struct(
            F.lit("JobPosting").alias("@type"), n("Job_Title_Page").alias("title"), F.struct(n("Company_Page").alias("name")).alias("hiringOrganization"), n("Employment_Type").alias("employmentType"),
            F.array(F.struct(F.struct(n("Location_Detail").alias("addressLocality")).alias("address"))).alias("jobLocation"),
        )
    )
    page = F.concat(F.lit("<html><head><script type='application/ld+json'>{broken</script><script type=\"application/ld+json\">{\"@graph\": ["), F.replace(data, F.lit("</"), F.lit("<\\/")), F.lit("]}</script></head><body><br><p>text</body>"))
    got = pages.parse_postings(p.select("row_id", page.alias("page")), "row_id", "page")
    return got.select("row_id", "title", "company", "location", "employment_type")


def _text_sql(c: str) -> str:
    t = c
    for tag in ("script", "style", "noscript"):
        t = f"regexp_replace({t}, '(?is)<{tag}\\b[^>]*>.*?</{tag}\\s*>', ' ', 'g')"
    t = rf"regexp_replace({t}, '(?i)<br\s*/?>|</?(?:p|li|div|h[1-6]|ul|ol|tr|table|section|article)\b[^>]*>', chr(10), 'g')"
    t = f"regexp_replace({t}, '<[a-zA-Z/!][^<>]*>', '', 'g')"
    for mark, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        t = f"replace({t}, '{mark}', '{ch}')"
    return rf"regexp_replace(regexp_replace(regexp_replace({t}, '[\t\x0B\f\r ]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^\s+|\s+$', '', 'g')"


@query(f"""SELECT doc_id, {_text_sql('text')} AS plain FROM documents""")
def document_text(spark, d):
    """Visible text of documents that carry markup."""
    return table(spark, d, "documents").select("doc_id", text.html_text(F.col("text")).alias("plain"))


# --- quality -----------------------------------------------------------------------------
@query("""SELECT rule, rows FROM (SELECT 'id_present' AS rule, count(*) FILTER (NOT coalesce("ID" <> '', false)) AS rows FROM prospect_reviews UNION ALL
SELECT 'decision_known', count(*) FILTER (NOT coalesce(coalesce("Review_Decision", '') IN ('', 'APPLY', 'STRETCH', 'HOLD', 'REJECT'), false)) FROM prospect_reviews UNION ALL
SELECT 'url_absolute', count(*) FILTER (NOT coalesce(regexp_matches("Input_URL", '^https?://'), false)) FROM prospect_reviews)""")
def review_violations(spark, d):
    """Rows that break each rule, counted in one pass."""
    rs = {"id_present": F.col("ID") != "", "decision_known": F.coalesce(F.col("Review_Decision"), F.lit("")).isin("", "APPLY", "STRETCH", "HOLD", "REJECT"), "url_absolute": F.col("Input_URL").rlike("^https?://")}
    return T.violations(table(spark, d, "prospect_reviews"), rs)


# --- streaming ----------------------------------------------------------------------------
def _stream_folder(spark: SparkSession) -> str:
    """A new folder for a stream's output and state in the shared folder."""
    return f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"


@query("""SELECT DISTINCT "Input_URL" FROM prospects_enriched_raw WHERE "Input_URL" IS NOT NULL""")
def stream_seen_urls(spark, d):
    """Addresses seen, kept as state of a stream over the pages."""
    table(spark, d, "prospects_enriched_raw")
    where = _stream_folder(spark)
    s = streams.read_stream(spark, f"{d}/prospects_enriched_raw.parquet").where(F.col("Input_URL").isNotNull()).select("Input_URL")
    return streams.run(streams.first_seen(s, "Input_URL"), f"{where}/out", f"{where}/state")


@query("""SELECT user_id, max(ts) AS ts, max_by(event_id, (ts, event_id)) AS event_id FROM events WHERE ts IS NOT NULL GROUP BY user_id""")
def stream_latest_event(spark, d):
    """Latest event per user, merged batch by batch."""
    table(spark, d, "events")
    where = _stream_folder(spark)
    s = streams.read_stream(spark, f"{d}/events.parquet").where(F.col("ts").isNotNull()).select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id")
    return streams.keep_latest(s, "user_id", "ts", "event_id", f"{where}/out", f"{where}/state").select("user_id", "ts", "event_id")
