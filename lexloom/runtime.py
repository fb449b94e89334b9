"""Session helpers shared by the operators: tables, checkpoints, size checks, dealing by key."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when it is proven not to hold more rows than this.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table `name` (a file or a folder of part files) of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder (spark.checkpoint.dir). Where it is unset, a local session gets one; a cluster must name one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="lexloom-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    context.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the reliable checkpoint folder, so that a lost executor costs no recomputation of its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def work_partitions(spark: SparkSession) -> int:
    """Partitions for stages whose work outgrows their input, which adaptive coalescing would put on too few cores."""
    return max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def clustered(df: DataFrame, *keys: str) -> DataFrame:
    """`df` with the rows of each key side by side within one partition, sorted by the keys.

    The rows are dealt by a hash of their own. A plain repartition by the keys is dropped by the planner where the input has that
    partitioning already, and adaptive execution may then read such an input without it (a join turned to a broadcast).
    """
    return df.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` (materialised) marked for broadcast if it is proven to hold no more than `rows` rows; else as it is, to be shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ship(spark: SparkSession) -> None:
    """Give the executors this package, for sessions whose workers can't import it by path; once per context."""
    context = spark.sparkContext
    if getattr(context, "_lexloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lexloom-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(archive)
    context._lexloom_shipped = True
