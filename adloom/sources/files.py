"""File sources and sinks: CSV in the tolerant dialect, JSON state, atomic
replacement, partitioned queues, appends whose schema may grow."""

from __future__ import annotations

import glob
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.operators.tables import align


def discover(folder: str, pattern: str = "*_basic.csv", exclude: str | None = None) -> list[str]:
    """Files of a folder in the order of their names without case; none raises."""
    found = sorted((p for p in glob.glob(os.path.join(folder, pattern)) if os.path.basename(p) != exclude), key=lambda p: os.path.basename(p).casefold())
    if not found:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    return found


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text; quotes may hold line breaks and doubled quotes."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8", inferSchema=False, ignoreLeadingWhiteSpace=False)


def read_listings(spark: SparkSession, files: list[str], columns: list[str], required: list[str] = ()) -> DataFrame:
    """Union of CSV files aligned to ``columns``, with the file's name and its
    place in the list."""
    out = None
    for k, path in enumerate(files):
        df = read_csv(spark, path)
        if not df.columns:
            raise ValueError(f"no header in {path}")
        part = align(df, columns, required).withColumns({"source_file": F.lit(os.path.basename(path)), "source_order": F.lit(k)})
        out = part if out is None else out.unionByName(part)
    return out


def read_optional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV that may be absent or empty: then no rows with these columns."""
    if not os.path.exists(path) or not os.path.isdir(path) and os.path.getsize(path) == 0:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return align(read_csv(spark, path), columns)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """JSON state of earlier runs, one object per file or line."""
    return spark.read.json(path, multiLine=True)


def merged(defaults: dict, override: dict) -> dict:
    """Defaults with an override laid over them, nested objects key by key."""
    out = dict(defaults)
    for k, v in override.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def write_atomic(df: DataFrame, path: str, fmt: str = "csv", **options) -> str:
    """Rebuild a table whole under ``path``: a new version is written beside the
    old ones, and then one small file that names it is put in place in one
    step, so readers always see a complete one, on any file system that Spark
    writes to. Returns the folder of the new version; older ones but the last go."""
    spark = df.sparkSession
    version = f"v-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    options = {"header": True, "quote": '"', "escape": '"'} | options if fmt == "csv" else options
    df.write.format(fmt).options(**options).save(f"{path}/{version}")
    fs, P = _fs(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    before = current(spark, path, missing_ok=True)
    out = fs.create(P(f"{path}/.current.{version}"), True)
    out.write(bytearray(version.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(P(path).toUri() if "://" in path else P(f"file://{os.path.abspath(path)}").toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    flags = spark.sparkContext._gateway.new_array(rename, 1)
    flags[0] = rename.OVERWRITE
    at = path if "://" in path else f"file://{os.path.abspath(path)}"
    context.rename(P(f"{at}/.current.{version}"), P(f"{at}/.current"), flags)
    for f in fs.listStatus(P(path)):
        name = f.getPath().getName()
        if name.startswith("v-") and name not in (version, (before or "").rsplit("/", 1)[-1]):
            fs.delete(f.getPath(), True)
    return f"{path}/{version}"


def current(spark: SparkSession, path: str, missing_ok: bool = False) -> str | None:
    """Folder of the version that ``write_atomic`` put in place last."""
    fs, P = _fs(spark, path), spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(P(f"{path}/.current")):
        if missing_ok:
            return None
        raise FileNotFoundError(f"no version in {path}")
    stream = fs.open(P(f"{path}/.current"))
    name = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    stream.close()
    return f"{path}/{name}"


def _fs(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def write_queues(df: DataFrame, path: str, queue: str = "queue", order: list | None = None) -> None:
    """One partition folder per queue, rows sorted within files.

    Rows are spread by queue and a hash, so a hot queue is written by many tasks.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(16)))
    sorted_ = salted.repartition(F.col(f"`{queue}`"), F.col("_salt")).drop("_salt").sortWithinPartitions(F.col(f"`{queue}`"), *(order or []))
    sorted_.write.mode("overwrite").partitionBy(queue).parquet(path)


def append_growing(df: DataFrame, path: str) -> None:
    """Append rows; columns that are new or absent are allowed."""
    df.write.mode("append").option("mergeSchema", "true").parquet(path)


def migrate(spark: SparkSession, path: str, columns: list[str]) -> None:
    """Bring a grown table to one schema: all rows with these columns (absent
    ones null) as a new version; the old files stay as a backup beside it."""
    grown = read_grown(spark, path)
    one = grown.select(*(F.col(f"`{c}`") if c in grown.columns else F.lit(None).cast("string").alias(c) for c in columns))
    write_atomic(one, f"{path}.migrated", "parquet")


def read_grown(spark: SparkSession, path: str) -> DataFrame:
    """All columns that any append brought."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def repair(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Old rows with the columns that ``new`` knows better; blanks don't count."""
    n = new.select(F.col(f"`{key}`"), *(F.col(f"`{c}`").alias(f"_n_{i}") for i, c in enumerate(columns)))
    j = old.join(n, key, "left")
    return j.select(*((F.coalesce(F.nullif(F.trim(F.col(f"_n_{columns.index(c)}")), F.lit("")), F.col(f"`{c}`")).alias(c) if c in columns else F.col(f"`{c}`")) for c in old.columns))
