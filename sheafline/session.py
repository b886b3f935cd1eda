"""Session and table loading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "sheafline", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with UTC time and adaptive execution; a cluster's own settings win over these defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder. The path is only ever opened by Spark's readers."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Application id -> the folder of a local session that names none.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which the driver and all executors share. Only a session in local mode may leave that unset: it gets a temporary one."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not found and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not found:
        found = _LOCAL.setdefault(context.applicationId, "file://" + tempfile.mkdtemp(prefix="sheafline-core-"))
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"
