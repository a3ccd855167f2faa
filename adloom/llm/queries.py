"""Queries of the llm operators: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import abuse, canon, leakage, linkage, residue, tokens
from adloom.session import table

RESIDUE_FIELDS = ["Extraction_Status", "Status_Evidence", "Description"]
CANON_FIELDS = ["Job.Title", "Position.Type", "Position.Subtype"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.find_residue(table(spark, d, "prospects_enriched_raw"), RESIDUE_FIELDS).select("row_id", "field")


def p1_rows_kept(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose three fields are free of residue."""
    raw = table(spark, d, "prospects_enriched_raw")
    bad = residue.find_residue(raw, RESIDUE_FIELDS).select("row_id").distinct()
    return raw.select("row_id", "ID", "Source").join(bad, "row_id", "left_anti")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _linked(spark, d).pairs().select("row_id_a", "row_id_b")


def p6_confidence(spark: SparkSession, d: str) -> DataFrame:
    """The matches with their confidence."""
    return _linked(spark, d).pairs()


def p6_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate pair of classes of equal rows, also those that don't match."""
    return _linked(spark, d).classes()


def p6_members(spark: SparkSession, d: str) -> DataFrame:
    """The class of every row."""
    return _linked(spark, d).members()


def _linked(spark: SparkSession, d: str) -> linkage.Linked:
    return linkage.Linked(table(spark, d, "indeed_basic"), table(spark, d, "jobstack_basic"), table(spark, d, "canon_entries"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return canon.map_values(table(spark, d, "data_analytics"), table(spark, d, "canon_entries"), CANON_FIELDS)


def p7_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Rows without an entry, by field."""
    return p7_found(spark, d).where("entry_id = 0").groupBy("field").agg(F.count("*").alias("unmatched"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked test items with the number of documents that hold them."""
    return p9_found(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where("abusive").select("doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("doc_id", "score", "abusive", F.size("offending").alias("offending_sentences"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse.rates(_scored(spark, d))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return abuse.score_documents(table(spark, d, "documents"), table(spark, d, "doc_labels"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_rows_kept, p6_found, p6_confidence, p6_classes, p6_members, p7_found, p7_unmatched, p8_ids, p9_found, p9_items, p10_found, p10_scores, p10_rates)
}
#: these operators are learned or search texts; SQL can't express them
ORACLES: dict[str, str] = {}
