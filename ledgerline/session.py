"""Session construction for tests / bench and checkpoint-directory handling.

On a cluster the session comes from the platform; these helpers only fill
in settings that are unset.  The checkpoint directory is always read from
the session (`spark.checkpoint.dir`); a scratch default is set only when the
session has none, as in local tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Shuffle / AQE settings the operators are designed around.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime broadcast: AQE broadcasts a join side only when its measured
    # shuffle output is below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # HotSpot does not JIT methods above 8000 bytes of bytecode; wide record
    # stages (staging + decisions + 40 columns) exceed that, so let Spark fall
    # back per subtree instead of running an uncompiled whole-stage method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


# Suggested settings for a large cluster (not applied by this library; the
# platform's session owns them).  Only aggregated rows and record ids are
# ever shuffled, so a high initial partition count that AQE coalesces keeps
# every reducer near the advisory size; broadcasts stay behind explicit
# row-count checks (see operators/joins.py).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline",
                  driver_memory: str = "8g", extra: dict[str, str] | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (`spark.checkpoint.dir`),
    else the SparkContext's checkpoint directory."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set on this session")
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.  A local session that names none gets a
    scratch one, through SparkContext.setCheckpointDir as `spark.checkpoint.dir`
    cannot change at run time; on a cluster a machine-local folder would lose
    rows, so there it is an error."""
    try:
        d = checkpoint_dir(spark)
    except RuntimeError:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}") from None
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, remembered for `remove_scratch`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline/{uuid.uuid4().hex}/{name}"
    _SCRATCH.append(path.rpartition("/")[0])
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete every scratch folder this process made, once their tables are no
    longer read; returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
