"""The words around mentions, against the pattern that defines them."""

import random
import time

import pytest
from pyspark.sql import functions as F

from adloom.functions.text import clean, fold
from adloom.operators import evidence as E
from adloom.plans import review

WORDS = ["sql", "SQL", "mysql", "t-sql", "sql server", "R", "Python", "or", "with", "RStudio", "data.table", "x", "a_b", "č", "😀", "\x01", "must", "a plus"]


def _texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(WORDS) + rng.choice([" ", ",", "", "/", " · " + "z" * rng.randint(0, 150)]) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    return [*made, "", "sql", "(sql", "sql,sql;sql", "😀sql😀sql", "y" * 110 + " sql", "y" * 111 + " sql " + "y" * 300 + "sql"]


@pytest.mark.parametrize("kind", ["sql", "r"])
def test_windows_equal_the_pattern(spark, kind):
    pattern, later = (E.word(E.SKILLS["sql"]), None) if kind == "sql" else (E.R_PROSE, None)
    later = pattern.replace("^|", "", 1) if kind == "sql" else later
    df = spark.createDataFrame([(t,) for t in _texts()], "t string")
    want = F.regexp_extract_all("t", F.lit(rf"[\s\S]{{0,{E.NEAR}}}(?:{pattern})[\s\S]{{0,{E.NEAR}}}"), F.lit(0))
    rows = df.select("t", E._windows(F.col("t"), pattern, later).alias("got"), want.alias("want")).collect()
    assert sum(len(r["want"]) for r in rows) > 200
    assert [r for r in rows if r["got"] != r["want"]] == []


def test_long_pages_take_no_minutes(spark, data, tmp_path):
    # what a page says, once more after a long text without mentions
    pages = spark.read.parquet(f"{data}/{review.PAGES}.parquet").limit(20)
    far = F.concat(F.repeat(F.lit("lorem ipsum dolor "), 6000), F.coalesce("Description", F.lit("")))
    pages.withColumn("Description", far).coalesce(1).write.parquet(str(tmp_path / f"{review.PAGES}.parquet"))
    began = time.time()
    assert len(review.page_evidence(spark, str(tmp_path)).collect()) == pages.count()
    assert time.time() - began < 60


def test_pages_are_spread(spark, data):
    # one small file would else be one task
    assert review.page_values(spark, data).rdd.getNumPartitions() > 1


def test_counts_of_long_pages_take_no_minutes(spark, data, tmp_path):
    pages = spark.read.parquet(f"{data}/{review.PAGES}.parquet").limit(20)
    pages.withColumn("Requirements", F.repeat(F.lit("lorem ipsum dolor "), 6000)).coalesce(1).write.parquet(str(tmp_path / f"{review.PAGES}.parquet"))
    began = time.time()
    counts = review.evidence_counts(spark, str(tmp_path)).groupBy("field").agg(F.sum("n").alias("n")).collect()
    assert {r["n"] for r in counts} == {pages.count()} and time.time() - began < 60


def test_counts_make_no_evidence(spark, data):
    # texts that nobody reads were cut and cleaned for every match
    plan = review.evidence_counts(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert "czech" in plan and "Description: " not in plan and "…" not in plan


def test_spellings_equal_clean_and_fold(spark):
    rng = random.Random(7)
    marks = ["a", "NaN", "nan", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", " ", " ", "　", "Č", "ß", "İ", "é", "é", "😀", "–"]
    texts = [None, "", *("".join(rng.choice(marks) for _ in range(rng.randint(0, 9))) for _ in range(3000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", E.spellings(F.col("t")).alias("s"))
    assert df.where(~(F.col("s.raw").eqNullSafe(clean(F.col("t"))) & F.col("s.folded").eqNullSafe(fold(F.col("t"))))).collect() == []


SPOKEN = (
    "czech,čeština,češtinu,český jazyk,českého jazyka,znalost,fluent,native,is a plus,výhodou,not required,není nutná,isn't required,mandatory,needed,language,úroveň,English,fluent english,angličtina,plynulá,denně,daily,"
    "Python,R,and/or R,or,RStudio,R.,R programming,using R,in R,data.table,SQL,T-SQL,PL/SQL,MySQL,nosql,machine learning,scikit-learn,sklearn,xgboost,TensorFlow,PyTorch,predictive models,statistics,statistical,statistik,"
    "probability,inference,regression,time series,hypothesis testing,econometrics,must,bonus,fully remote,100% remote,remote,hybrid,home office,work from home,práce z domova,on-site,onsite,office-based,Reporting,"
    "at least 3 years,of experience,3+ yrs,2-4 years experience,3-5 let praxe,4 years of commercial experience,2 roky praxe,praxe,minimum 5 years,min. 10 years,alespoň 4 roky,zkušenosti,47 months,letter,.,!,|,;,[required]"
).split(",")


def _pages(n: int = 1500):
    rng = random.Random(11)
    said = lambda most: " ".join(rng.choice(SPOKEN) for _ in range(rng.randint(0, most))) or None
    return [(k, *(said(30) if x in ("Requirements", "Description") else said(4) for x in review.FIELDS)) for k in range(n)]


def test_words_are_in_every_match(spark):
    df, f = E.with_fields(spark.createDataFrame(_pages(), "row_id int, " + ", ".join(f"{x} string" for x in review.FIELDS)), ["Description"])
    raw, folded = f["Description"].raw, f["Description"].folded
    pairs = [(folded, E.word(p), E.SKILL_SAYS[n]) for n, p in E.SKILLS.items()] + [(raw, E.R_PROSE, E.R_SAYS), (folded, E.ENGLISH_WANTED, E.ENGLISH_SAYS)]
    pairs += [(folded, p, E.CZECH_SAYS) for p in (E.CZECH_WELCOME, E.WAIVED, E.CZECH_REQUIRED, E.CZECH_SPOKEN)]
    pairs += [(folded, p, w) for p, w in ((E.FULLY, E.FULLY_SAYS), (E.PARTLY, E.PARTLY_SAYS), (E.OFFICE, E.OFFICE_SAYS))]
    looked = [(x.rlike(p), E.says(x, w)) for x, p, w in pairs] + [(folded.rlike(p), folded.rlike(E.YEARS_SAY)) for p in (E.RANGE, *E.MINIMA)]
    got = df.agg(*(F.sum((m & c).cast("int")).alias(f"{kind}{k}") for k, (m, w) in enumerate(looked) for kind, c in (("all", F.lit(True)), ("missed", ~w)))).first().asDict()
    assert all(v == 0 for k, v in got.items() if k.startswith("missed"))
    assert all(v > 0 for k, v in got.items() if k.startswith("all"))
    for name, p in E.SKILLS.items():
        assert all(any(w in alias for w in E.SKILL_SAYS[name]) for alias in p.split("|"))


def test_values_equal_the_sql(spark, tmp_path):
    import duckdb

    df = spark.createDataFrame(_pages(), "row_id int, " + ", ".join(f"{x} string" for x in review.FIELDS))
    df.coalesce(1).withColumn("Status_Evidence", F.lit(None).cast("string")).write.parquet(str(tmp_path / f"{review.PAGES}.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {review.PAGES} AS SELECT * FROM '{tmp_path}/{review.PAGES}.parquet/*.parquet'")
    got = review.page_evidence(spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({review._evidence_sql()})").fetchall()
    have = {tuple(r) for r in got.collect()}
    assert len(have) == len(want) and [w for w in want if w not in have] == []
