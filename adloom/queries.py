"""Queries of the core training-data operators: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom import oracles
from adloom.operators import drift, packed, timestamps, units
from adloom.session import table

TIME_FIELDS = ["Mining_Date", "Published_At", "Valid_Through"]
PACKED_FIELDS = {"data_analytics": ["Tags", "Technology", "Caution.Flags"], "prospect_reviews": ["Review_Reasons"]}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_formats(spark, d).select("row_id", "field", "utc_us")


def p2_formats(spark: SparkSession, d: str) -> DataFrame:
    """With the format each value was read in."""
    return timestamps.normalise(table(spark, d, "prospects_enriched_raw"), table(spark, d, "board_defaults"), TIME_FIELDS)


def p2_undeclared(spark: SparkSession, d: str) -> DataFrame:
    """The same with no date order declared: slashed dates are read by the order
    of the records alone."""
    undeclared = table(spark, d, "board_defaults").withColumn("date_order", F.lit(None).cast("string"))
    return timestamps.normalise(table(spark, d, "prospects_enriched_raw"), undeclared, TIME_FIELDS)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, fields in PACKED_FIELDS.items():
        part = packed.explode_packed(table(spark, d, name), fields).select(F.lit(name).alias("table_name"), "row_id", "field", "position", "value")
        out = part if out is None else out.unionByName(part)
    return out


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(table(spark, d, "raw_records")).select("file_id", "change", "column_name")


def p4_unified_evaluation(spark: SparkSession, d: str) -> DataFrame:
    return drift.unify(table(spark, d, "raw_records"), "evaluation")


def p4_unified_indeed_basic(spark: SparkSession, d: str) -> DataFrame:
    return drift.unify(table(spark, d, "raw_records"), "indeed_basic")


def p4_unified_data_analytics(spark: SparkSession, d: str) -> DataFrame:
    return drift.unify(table(spark, d, "raw_records"), "data_analytics")


def _pay_tables(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, name) for name in ("data_analytics", "board_defaults", "fx_rates", "pay_units")]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return units.monthly_pay(*_pay_tables(spark, d))


def p5_unconverted(spark: SparkSession, d: str) -> DataFrame:
    """Stated amounts that cannot be converted, with the reason."""
    return units.unconverted(*_pay_tables(spark, d))


QUERIES = {
    f.__name__: f
    for f in (p2_found, p2_formats, p2_undeclared, p3_found, p4_found, p4_unified_evaluation, p4_unified_indeed_basic, p4_unified_data_analytics, p5_found, p5_unconverted)
}
ORACLES = {"p2_found": oracles.instants(), "p3_found": oracles.split_values(), "p4_found": oracles.header_changes(), "p5_found": oracles.pay(), "p5_unconverted": oracles.pay(unconverted=True)}
