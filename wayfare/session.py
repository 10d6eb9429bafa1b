"""Session settings and the shared folder that iterative jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "wayfare", **conf: str) -> SparkSession:
    """A session with the settings every operator here assumes.

    Adaptive execution splits hot keys of joins and sizes shuffles at run time. Parsing
    costs much time per byte, so small shuffles are not merged below a quarter megabyte.
    The time zone is pinned so that dates do not depend on the machine.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Bytes of rows that go to a Python worker in one batch, besides a single longer row.
BATCH_BYTES = 2 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds the batches between Spark and its Python workers by bytes, unless the session has a bound of its own.

    Batches of 10,000 long rows are held several times at once by an executor and by each of its
    workers, and both keep the memory for the jobs that follow. No result depends on the bound; it
    stays set, as the rows are read only when the caller asks for them.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints, from ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("wayfare.local.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="wayfare-")
        spark.conf.set("wayfare.local.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    The rows survive the loss of executors, later steps neither recompute the plan so
    far nor see another outcome of a non-deterministic step, and the known table size
    lets the optimiser choose joins by it.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
