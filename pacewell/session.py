"""Session settings and the shared folder for checkpoints and scratch tables."""

import atexit
import functools
import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "pacewell") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    partitions = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("PACEWELL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Sets shuffle partitions for jobs that shuffle about ``input_bytes``.

    Adaptive execution merges partitions that turn out small but cannot make
    more of them than were asked for, so the number must fit the largest
    shuffle: the ordered work on raw samples moves every row once.
    """
    wanted = max(spark.sparkContext.defaultParallelism, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is only acceptable when driver and executors are
    one process, so anything but a local master must set the option. Under a
    local master without it, a folder of this process is made, named in the
    option from then on, and removed when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    spark.conf.set("spark.checkpoint.dir", _local_root())
    return _local_root()


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="pacewell-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused between runs."""
    return f"{shared_root(spark)}/pacewell/{name}-{uuid.uuid4().hex}"


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver does, unless it is installed on them anyway."""
    root, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def use_checkpoints(spark: SparkSession) -> None:
    """Give the context a reliable checkpoint folder unless it has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/pacewell/checkpoints")
