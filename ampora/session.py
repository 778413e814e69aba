"""Session construction and shared-storage helpers."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

# Settings every job in the library relies on.  ``timeZone`` matters: the
# warehouse timestamps are instants and are rendered in UTC everywhere.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app_name: str = "ampora",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster, pass ``master=None`` and let ``spark-submit`` decide; the
    shuffle width then stays at the cluster's setting unless given here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in CORE_CONF.items():
        if key not in (extra_conf or {}):
            builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (timestamps in the warehouse are instants)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, durable
    folder there).  Only a local master may go without: the driver and its
    tasks are one process then, and a private folder is set, so later calls
    agree on it.  Anywhere else a missing setting is an error, as tables
    written to one machine's disk would be missed by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{uuid.uuid4().hex[:12]}"
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None for a remote (Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Initial shuffle width ~ input / 256 MB (at least 2x cores) so no reduce
    task spills badly even before AQE looks at the data; AQE then coalesces
    small partitions to the advisory size and splits skewed ones.  Scan
    splits stay at 256 MB.  Broadcasts stay size-checked by the planner:
    the threshold is raised only moderately (64 MB), never to "always".
    """
    width = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
