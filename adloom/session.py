"""Session helpers shared by all operators: table access, checkpoints, spread."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster without a shared code folder submit it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a local one is set only
    where none is named (tests on one machine)."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="adloom-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: bytes that one task of a CPU-heavy stage may well read
TASK_BYTES = 64 << 20


def spread(df: DataFrame, key: str, per_core: int = 3) -> DataFrame:
    """Give a CPU-heavy stage enough tasks.

    Large inputs come in many splits anyway and pass unchanged; a small one is
    hashed by ``key`` (unique, so even; deterministic on retry). The size is the
    planner's estimate, so nothing runs while the plan is built.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 2 * cores * TASK_BYTES:
        return df
    return df.repartition(per_core * cores, F.col(f"`{key}`"))


#: most rows, and most characters of their texts, of a table that is sent whole to every task
SMALL = 500_000
SMALL_TEXT = 32_000_000


def small(df: DataFrame) -> DataFrame:
    """Broadcast a lookup table if its checked size allows; else leave the join
    to the planner. The table is counted, so it should be cheap or cut."""
    texts = [F.length(F.to_json(F.struct(F.col(f"`{c}`")))) if "<" in t else F.length(F.col(f"`{c}`").cast("string")) for c, t in df.dtypes]
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(sum((F.coalesce(x, F.lit(0)) for x in texts), F.lit(0)).cast("long")).alias("chars")).first()
    return F.broadcast(df) if size["n"] <= SMALL and (size["chars"] or 0) <= SMALL_TEXT else df


def quoted(name: str) -> str:
    """A column name as one identifier, dots and blanks included."""
    return f"`{name}`"


def env_path(name: str, default: str) -> str:
    return os.environ.get(name, default)
