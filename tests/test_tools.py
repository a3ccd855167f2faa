"""Tools in texts: as the patterns say, but in one pass."""

from pyspark.sql import functions as F

from adloom.operators import rules

TEXTS = ["Python, R and Go", "use of data.table", "golang Golang", "R", "PYTHON/sql c++ c# .NET node.js", "rust-free, javascript", "MS SQL Server", "Bigit", "we go with Go.", "ŘR;Č", "", "3dexperience\nplm"]


def test_tools_equal_the_patterns(spark):
    t = F.col("t")
    plain = F.array_compact(F.array(*(F.when((t if n in rules.CASED else F.lower(t)).rlike(rules.tool_pattern(n)), F.lit(n)) for n in rules.TOOLS)))
    rows = spark.createDataFrame([(x,) for x in TEXTS], "t string").select("t", rules.tools(t).alias("got"), plain.alias("want")).collect()
    assert [r for r in rows if r["got"] != r["want"]] == [] and sum(len(r["want"]) for r in rows) > 12


def test_a_text_is_searched_once_for_all_plain_names(spark):
    plan = spark.createDataFrame([("x",)], "t string").select(rules.tools(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") + plan.count("regexp_extract_all") <= 1 + len(rules.CASED)
