"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Adaptive execution stays on: it coalesces small shuffle partitions, splits
# skewed ones, and picks broadcast joins by the size seen at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings. ``master`` is left to
    spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 * 2**20) -> int:
    """Raise the number of shuffle partitions to fit the input.

    Rows of the input pass through the shuffle once, so its bytes set how
    many partitions keep each within a task's memory. Adaptive execution
    joins those that turn out small. A higher setting is left alone.
    """
    wanted = -(-input_bytes // partition_bytes)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def pin_timezone(spark: SparkSession) -> SparkSession:
    """Epoch seconds, hours and days are read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path for intermediate tables.

    On a cluster it lies in the shared folder named by
    ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder of this machine, which goes when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@cache
def _local_base() -> str:
    base = tempfile.mkdtemp(prefix="ledgersift-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base
