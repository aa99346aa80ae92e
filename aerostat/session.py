"""Session construction and shared storage locations.

Jobs that must cut lineage or materialise an intermediate table write it
under the cluster's shared ``spark.checkpoint.dir``; a private directory is
only created when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators are designed around. AQE re-plans joins
# and coalesces shuffle partitions at runtime; skew-join splitting covers a
# hot key (or the null key of an outer join) holding a large share of rows.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # coalesce shuffle partitions to the advisory size rather than keeping
    # at least the default parallelism: on a shared cluster small results
    # then run as few tasks, and large stages are unaffected
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Spark broadcasts a join side whose files are under this size (compressed
    # sizes understate a side, hence the low bound), or one whose finished
    # stage AQE has measured; every other join is shuffled. The operators
    # themselves say nothing about it, so they behave alike at every size.
    "spark.sql.autoBroadcastJoinThreshold": "4m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


def build_session(
    master: str | None = None,
    app_name: str = "aerostat",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's recommended settings."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.sql.session.timeZone", "UTC")
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session (tests) may fall back
    to a private directory; on a cluster an unset value is an error, since
    a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="aerostat-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location under the shared folder (never reused)."""
    return os.path.join(shared_dir(spark), "aerostat", *parts, uuid.uuid4().hex)
