"""Session set-up, and the shared folder that cut lineage goes to."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on: re-planning from real sizes, and
# splitting of skewed join partitions. What a task takes from a shuffle is a
# quarter of Spark's default: sorted and hashed rows take some thirty times the
# bytes they are shuffled in.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
OWN_SETTINGS = {**ADAPTIVE_SETTINGS, "spark.sql.session.timeZone": "UTC"}

# Pieces a shuffle is cut into at the least before small ones are put together
# again, so that it is the size above that tells how much a task gets.
INITIAL_PARTITIONS = 1000

# What a task reads of a file at the most, an eighth of Spark's default: a task
# that shuffles what it reads holds all its rows until they are written, and a
# row is some ten times the bytes it has in a compressed file.
SPLIT_KEY, SPLIT_SIZE = "spark.sql.files.maxPartitionBytes", "16m"


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """A session with the adaptive settings and any others; ``master`` only for local runs."""
    builder = SparkSession.builder.appName("courtside")
    if master:
        builder = builder.master(master)
    for key, value in {**OWN_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def _in_bytes(size: str) -> int:
    """Bytes of a size as Spark writes it: ``16m``, ``128MB``, ``134217728b`` or a bare number."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a session somebody else built; its time zone and smaller splits stay."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    if _in_bytes(spark.conf.get(SPLIT_KEY)) > _in_bytes(SPLIT_SIZE):
        spark.conf.set(SPLIT_KEY, SPLIT_SIZE)
    pieces = max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(pieces))
    return spark


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="courtside-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets a folder of
    its own. On a cluster a missing setting is an error, because a temporary
    folder of one machine is lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _own_folder()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/courtside/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what this package stored below the shared folder; frames that were read from there are gone with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/courtside")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Functions that run in tasks are sent by name, and a worker that was not
    started in this folder, or on this machine, would not find them.
    """
    package = Path(__file__).parent
    context = spark.sparkContext
    if context.applicationId in _shipped or not package.is_dir():
        return
    # The driver reads the archive from here and hands it to the workers itself.
    archive = Path(tempfile.mkdtemp(prefix="courtside-")) / package.name
    context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
    _shipped.add(context.applicationId)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Later passes scan the written columns instead of running the plan again,
    and an executor that is lost takes nothing with it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
