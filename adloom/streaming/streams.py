"""Incremental operators on Structured Streaming.

Each runs with the availableNow trigger and its own checkpoint folder, so a
restart goes on where the last run ended and nothing is counted twice.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.tables import latest_by


def read_stream(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """A parquet folder or file as a stream, with the schema it has now."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", per_trigger)
    if os.path.isfile(path):  # a stream reads folders
        return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))
    return reader.parquet(path)


def run(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there and return what it has written."""
    q = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def first_seen(df: DataFrame, key: str) -> DataFrame:
    """One row per key over all runs: the state is the set of keys."""
    return df.dropDuplicates([key])


def unseen(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in a static table of known keys."""
    return df.join(known.select(key).distinct(), key, "left_anti")


#: buckets of the latest view; a batch rewrites only those it has keys of
BUCKETS = 64


def keep_latest(df: DataFrame, key: str, at: str, order: str, out: str, checkpoint: str, buckets: int = BUCKETS) -> DataFrame:
    """Latest row per key, kept by buckets of keys: each batch writes a new
    version of the buckets that it touches, merged with their last ones, and the
    newest version of each bucket is the view. A batch that is run again writes
    the same versions anew."""
    spark = df.sparkSession
    schema = df.schema
    versions = f"{out}/versions"
    bucket = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")

    def newest(before: int | None) -> DataFrame | None:
        """The newest version of each bucket ahead of a batch."""
        if not _exists(spark, versions):
            return None
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("v", T.IntegerType()), T.StructField("b", T.IntegerType())])).parquet(versions)
        rows = rows if before is None else rows.where(F.col("v") < before)
        last = rows.groupBy("b").agg(F.max("v").alias("v"))  # one row a bucket
        return rows.join(F.broadcast(last), ["b", "v"])

    def merge(batch: DataFrame, epoch: int) -> None:
        new = batch.withColumn("b", bucket)
        touched = new.select("b").distinct()
        old = newest(epoch)
        if old is not None:
            new = new.unionByName(old.join(F.broadcast(touched), "b", "left_semi").select(*df.columns, "b"))
        latest = latest_by(new, [key], F.col(f"`{at}`"), order, undated_wins=False)
        latest.repartition("b").write.mode("overwrite").partitionBy("b").parquet(f"{versions}/v={epoch}")

    q = df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    view = newest(None)
    return spark.createDataFrame([], schema) if view is None else view.select(*df.columns)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def complete(spark: SparkSession, runs: dict[str, str]) -> dict[str, bool]:
    """Whether each source's stream has done all that it planned: every planned
    batch in its checkpoint folder is committed. What follows waits for it."""
    out = {}
    for source, checkpoint in runs.items():
        done = {kind: _names(spark, f"{checkpoint}/{kind}") for kind in ("offsets", "commits")}
        out[source] = bool(done["offsets"]) and done["offsets"] <= done["commits"]
    return out


def _names(spark: SparkSession, path: str) -> set[str]:
    if not _exists(spark, path):
        return set()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return {f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p) if f.getPath().getName().isdigit()}


def windowed_counts(df: DataFrame, at: str, kind: str, late: str = "10 minutes", size: str = "1 day") -> DataFrame:
    """Counts per window and kind; rows later than the watermark are left out."""
    return df.withWatermark(at, late).groupBy(F.window(at, size), F.col(kind)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")
