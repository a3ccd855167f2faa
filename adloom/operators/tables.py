"""Table operators: alignment, deduplication, lookups, routing, summaries.

Order matters in many of them; it is always an explicit column, never the
physical order. Windows are partitioned by the entity's key; where a key may
hold a large share of the rows (latest and first per key), an aggregate with a
struct ordering is used instead, so that partial results meet before the
shuffle and a hot key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom.functions import dates
from adloom.functions.text import clean, first_nonempty, missing, title_key
from adloom.functions.urls import detect_source
from adloom.session import cut


def header_key(name: str) -> str:
    """Header without BOM, case and kind of blank."""
    return " ".join(name.replace("\ufeff", "").replace("_", " ").replace(".", " ").split()).casefold()


def align(df: DataFrame, columns: list[str], required: list[str] = (), aliases: dict[str, str] | None = None) -> DataFrame:
    """The canonical columns of a table, whatever its headers look like.

    The last of colliding headers wins, absent optional columns are '', absent
    required ones raise; surplus columns are dropped; values are trimmed.
    """
    known = {header_key(a): c for a, c in (aliases or {}).items()} | {header_key(c): c for c in columns}
    found = {known[k]: name for name in df.columns if (k := header_key(name)) in known}
    absent = [c for c in required if c not in found]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df.select(*(F.trim(F.coalesce(F.col(f"`{found[c]}`").cast("string"), F.lit(""))).alias(c) if c in found else F.lit("").alias(c) for c in columns))


def drop_blank(df: DataFrame) -> DataFrame:
    """Rows with at least one non-blank value."""
    some = F.lit(False)
    for c in df.columns:
        some = some | (clean(F.col(f"`{c}`").cast("string")) != "")
    return df.where(some)


def union_sources(parts: dict[str, DataFrame], columns: list[str], required: list[str] = ()) -> DataFrame:
    """UNION ALL of aligned sources with the source's name."""
    out = None
    for name, df in parts.items():
        part = drop_blank(align(df, columns, required)).select(F.lit(name).alias("source"), *(F.col(f"`{c}`") for c in columns))
        out = part if out is None else out.unionByName(part)
    return out


def _pick(df: DataFrame, keys: list[str], order: Column, best) -> DataFrame:
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(best(whole, order).alias("_row")).select("_row.*")


def first_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest unique ``order`` of each key."""
    return _pick(df, keys, F.col(f"`{order}`"), F.min_by)


def latest_by(df: DataFrame, keys: list[str], at: Column, order: str, undated_wins: bool = True) -> DataFrame:
    """The latest row of each key, ties to the largest ``order``; a row without
    a date beats dated ones, or loses to them if ``undated_wins`` is off."""
    undated = at.isNull().cast("int") * (1 if undated_wins else -1)
    return _pick(df, keys, F.struct(undated, F.coalesce(at, F.lit(0).cast("timestamp")), F.col(f"`{order}`")), F.max_by)


def distinct_spelling(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct values by ``title_key``, first spelling kept, blanks dropped."""
    t = df.select(clean(F.col(f"`{column}`")).alias("value"), F.col(f"`{order}`").alias("_o")).where("value <> ''")
    return t.groupBy(title_key(F.col("value")).alias("key")).agg(F.min_by("value", "_o").alias("value"), F.count("*").alias("n"))


def compact_latest(df: DataFrame, key: str, order: str, good: Column, content: list[str], at: str | None = None) -> DataFrame:
    """Last attempt of each key; if it isn't good, ``content`` comes from the
    last good one. With ``at`` the time of the last good one is told, too."""
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    body = F.struct(*(F.col(f"`{c}`").alias(c) for c in content))
    o = F.col(f"`{order}`")
    g = df.groupBy(F.col(f"`{key}`")).agg(
        F.max_by(whole, o).alias("_last"), F.max_by(F.when(good, body), F.when(good, o)).alias("_good"), F.max_by(F.coalesce(good, F.lit(False)), o).alias("_ok"), F.count("*").alias("attempts"),
        *([F.max_by(F.when(good, F.col(f"`{at}`")), F.when(good, o)).alias("_success")] if at else []),
    )
    return g.select(
        *(
            (F.when(~F.col("_ok") & F.col("_good").isNotNull(), F.col(f"_good.`{c}`")).otherwise(F.col(f"_last.`{c}`")) if c in content else F.col(f"_last.`{c}`")).alias(c)
            for c in df.columns
        ),
        "attempts", *([F.col("_success").alias("last_success")] if at else []),
    )


def upsert(base: DataFrame, changes: DataFrame, key: str, keep: list[str] = (), stamp: dict[str, Column] | None = None) -> DataFrame:
    """Rows of ``changes`` replace those of ``base`` with the same key; the
    columns in ``keep`` stay as they were first, those in ``stamp`` get their
    value wherever a row came in. One row per key on both sides."""
    b = base.select(*(F.col(f"`{c}`").alias(f"_b{i}") for i, c in enumerate(base.columns)))
    k = base.columns.index(key)
    j = changes.join(b, F.col(f"`{key}`") == F.col(f"_b{k}"), "full")
    new = F.col(f"`{key}`").isNotNull()
    return j.select(
        *(
            (F.coalesce(F.col(f"_b{i}"), F.col(f"`{c}`")) if c in keep else F.when(new, (stamp or {}).get(c, F.col(f"`{c}`"))).otherwise(F.col(f"_b{i}"))).alias(c)
            for i, c in enumerate(base.columns)
        )
    )


def conflicting(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Keys that carry more than one combination of ``values``."""
    return df.groupBy(F.col(f"`{key}`").alias("key")).agg(F.count_distinct(F.struct(*(F.coalesce(F.col(f"`{v}`"), F.lit("")) for v in values))).alias("versions")).where("versions > 1")


def lookup(df: DataFrame, other: DataFrame, on: str, columns: list[str], strict: bool = False) -> DataFrame:
    """Left join to a table whose keys must be unique up to identical rows;
    conflicting rows raise, and with ``strict`` unmatched ones do too."""
    one = other.select(F.col(f"`{on}`"), *(F.col(f"`{c}`") for c in columns)).distinct()
    twice = conflicting(one, on, columns).limit(5).collect()
    if twice:
        raise ValueError(f"conflicting rows for {[r['key'] for r in twice]}")
    if strict:
        lost = df.join(one, on, "left_anti").select(on).limit(5).collect()
        if lost:
            raise ValueError(f"no match for {[r[0] for r in lost]}")
    return df.join(one, on, "left")


def coalesce_with_conflict(own: Column, inferred: Column) -> tuple[Column, Column]:
    """(value, conflict): own if it says something, else inferred; a conflict
    is both saying different things."""
    value = F.when(~missing(own), clean(own)).when(~missing(inferred), clean(inferred)).otherwise("")
    return value, ~missing(own) & ~missing(inferred) & (title_key(own) != title_key(inferred))


def route(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """One row per queue that a row goes to; rows of no queue drop out."""
    names = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules)))
    return df.withColumn("queue", F.explode(names))


def summary(df: DataFrame, sections: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """(section, category, n) over a fixed spine of categories, zero-filled."""
    spark = df.sparkSession
    spine = spark.createDataFrame([(s, c, k) for s, (_, cs) in sections.items() for k, c in enumerate(cs)], "section string, category string, position int")
    pairs = F.explode(F.array(*(F.struct(F.lit(s).alias("section"), F.coalesce(F.col(f"`{col}`"), F.lit("")).alias("category")) for s, (col, _) in sections.items())))
    counts = df.select(pairs.alias("p")).select("p.*").groupBy("section", "category").agg(F.count("*").alias("n"))
    # the spine is as long as the list of categories
    return F.broadcast(spine).join(counts, ["section", "category"], "left").select("section", "category", "position", F.coalesce("n", F.lit(0)).alias("n"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, n) of several columns in one pass."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias("value")) for c in columns)))
    return df.select(pairs.alias("p")).select("p.*").groupBy("field", "value").agg(F.count("*").alias("n"))


def argmax_label(df: DataFrame, key: str, label: str, order: list[str] = ()) -> DataFrame:
    """Most frequent label per key, ties to the first in the given order, then by name."""
    n = df.groupBy(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")).agg(F.count("*").alias("n"))
    place = rank_of(F.col("label"), list(order), len(order))
    return n.groupBy("key").agg(F.min_by("label", F.struct(-F.col("n"), place, F.col("label"))).alias("label"), F.max("n").alias("n"))


def shuffled(df: DataFrame, key: str, seed: str) -> DataFrame:
    """A column that orders rows at random, the same for the same seed."""
    return df.withColumn("_shuffle", F.md5(F.concat(F.lit(f"{seed}|"), F.col(f"`{key}`").cast("string"))))


def rank_within(df: DataFrame, by: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """1-based place of each row within its group under a total order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*(F.col(f"`{c}`") for c in by)).orderBy(*order)))


def check_unique(df: DataFrame, key: str) -> None:
    """Raise if a key occurs twice."""
    twice = df.groupBy(F.col(f"`{key}`")).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{key} is not unique: {[r[0] for r in twice]}")


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, rows): how many rows break each rule, in one pass."""
    counts = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("rows")) for n in rules))).alias("r")).select("r.*")


def rank_of(x: Column, values: list[str], other: int = 99) -> Column:
    """Place of a value in a list, ``other`` if it isn't there."""
    out = F.lit(other)
    for k, v in enumerate(values):
        out = F.when(x == v, F.lit(k)).otherwise(out)
    return out


def placed(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """1-based place of every row under a total order, without a single task
    that holds all rows: rows are spread by ranges of the order and sorted, the
    ranges are counted, and each row's place is its own in the range plus all
    ranges before. The sorted rows are cut, so that both steps see the same ranges."""
    keys = [F.col(f"`{c}`") for c in df.columns]
    sorted_ = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).select(*keys, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")))
    per = sorted_.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = per.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a range
    return sorted_.join(F.broadcast(before), "_range").select(*keys, (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("long").alias(name))


def placed_within(df: DataFrame, by: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """1-based place of every row within its group, also if one group holds a
    third of all rows: places under (group, order) less the group's first one."""
    everywhere = placed(df, [*(F.col(f"`{c}`") for c in by), *order], "_place")
    firsts = everywhere.groupBy(*(F.col(f"`{c}`") for c in by)).agg(F.min("_place").alias("_first"))
    same = [F.col(f"r.`{c}`").eqNullSafe(F.col(f"f.`{c}`")) for c in by]
    return everywhere.alias("r").join(firsts.alias("f"), same).select(*(F.col(f"r.`{c}`") for c in df.columns), (F.col("_place") - F.col("_first") + 1).alias(name))


def seen_span(df: DataFrame, key: str, at: str) -> DataFrame:
    """(key, first_seen, last_seen, times) of each key."""
    return df.groupBy(key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count(F.lit(1)).alias("times"))


def merge_metrics(joined: DataFrame, key: str, found: str, own: Column, inferred: Column) -> DataFrame:
    """Counters of a lookup join and of levels coalesced by it, in one row."""
    has, inf = ~missing(own), ~missing(inferred)
    n = lambda c, name: F.count_if(c).alias(name)
    return joined.agg(
        F.count(F.lit(1)).alias("rows"), n(F.col(key) == "", "blank_titles"), F.count_distinct(key).alias("titles"), F.count(found).alias("matched"), n(F.col(found).isNull(), "unmatched"),
        n(has, "own_level"), n(~has & inf, "inferred_level"), n(has & inf & (title_key(own) != title_key(inferred)), "level_conflicts"),
    )


def review_master(graded: DataFrame, pages: DataFrame, reviews: DataFrame, hosts: list[tuple[str, str]], as_of: str) -> DataFrame:
    """The review list: every graded advert (ID, grade, title, Seniority, URL,
    url_key) with its latest page and review by address. Without graded adverts
    the pages drive the list. All sides have one row per address."""
    if graded.isEmpty():
        graded = pages.select(F.lit("").alias("ID"), F.lit("").alias("grade"), F.col("Job_Title_Page").alias("title"), F.col("Seniority_Detail").alias("Seniority"), F.col("Input_URL").alias("URL"), "url_key")
    one = lambda df, names, mark: df.select("url_key", *(F.col(n).alias(f"{mark}{n}") for n in names), F.lit(True).alias(f"{mark}here"))
    j = graded.join(one(pages, [c for c in pages.columns if c != "url_key"], "p_"), "url_key", "left").join(one(reviews, [c for c in reviews.columns if c != "url_key"], "r_"), "url_key", "left")
    at = F.coalesce(*(dates.iso_instant(F.col(f"p_{c}")) for c in ("Published_At", "Published_Upper_Bound", "Mining_Date")))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return j.select(
        "ID", "grade", first_nonempty(F.col("p_Job_Title_Page"), F.col("title")).alias("title"), first_nonempty(F.col("p_Company_Page")).alias("company"), first_nonempty(F.col("p_Seniority_Detail"), F.col("Seniority")).alias("seniority"),
        first_nonempty(F.col("p_Source"), detect_source(F.col("URL"), hosts)).alias("source"), first_nonempty(F.col("p_Current_Status")).alias("status"), F.when(F.col("p_here"), F.upper(blank("p_Extraction_Status"))).otherwise("NOT ENRICHED").alias("enrichment"),
        F.coalesce(F.nullif(F.col("r_Review_Status"), F.lit("")), F.lit("UNREVIEWED")).alias("review_status"), blank("r_Review_Decision").alias("decision"), blank("r_Review_Priority").alias("priority"), blank("r_Review_Reasons").alias("reasons"),
        F.unix_micros(at).alias("published_us"), dates.bucket(dates.age_days(at, as_of), dates.FRESHNESS, "OLD").alias("freshness"), "url_key",
    )


def review_filter(master: DataFrame, chosen: dict[str, list[str]], search: str = "", only_open: bool = False, only_enriched: bool = False) -> DataFrame:
    """Rows whose columns have one of the chosen values (none chosen: no rows;
    "Unreviewed" stands for no decision) and whose title or company holds the
    searched text literally, whatever its case."""
    out = master
    for column, values in chosen.items():
        x = F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("Unreviewed")) if column == "decision" else F.col(column)
        out = out.where(x.isin(*values) if values else F.lit(False))
    if search.strip():
        q = F.lit(search.strip().lower())
        out = out.where(F.contains(F.lower("title"), q) | F.contains(F.lower("company"), q))
    if only_open:
        out = out.where(~F.upper("status").isin("CLOSED", "HTTP_ERROR", "REQUEST_FAILED"))
    return out.where(F.col("enrichment") != "NOT ENRICHED") if only_enriched else out
