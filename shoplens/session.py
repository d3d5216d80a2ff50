"""SparkSession construction and the shared checkpoint folder.

Jobs never invent a machine-local folder: lineage cuts and streaming
checkpoints live under ``spark.checkpoint.dir`` as configured on the
cluster.  Only tests (where it is unset) pass a fallback.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins/partition counts from
# runtime sizes and splits skewed join partitions; the broadcast threshold is
# Spark's own size check (plan statistics), so nothing is broadcast blindly.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size post-shuffle partitions by bytes (the advisory size), not by the
    # number of cores: no swarm of tiny tasks on small stages
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (100 TB inputs); merged in with cluster=True.
#  * many initial shuffle partitions, coalesced by AQE to ~128 MB each, so
#    no reducer holds more than it can sort in memory;
#  * 256 MB scan splits;
#  * skew splitting from 256 MB / 5x the median partition;
#  * a 64 MB broadcast ceiling (Spark's size check; AQE also converts joins
#    whose runtime side is small);
#  * RocksDB state store with changelog checkpoints for the streaming state
#    (ban state per user, running counts): off-heap, incremental.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "shoplens",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
    cluster: bool = False,
) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` is only set when given; otherwise spark-submit / the
    environment decides (``local[*]`` when nothing is configured).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and materialised intermediates.

    Reads ``spark.checkpoint.dir`` from the session.  When it is unset (local
    tests) ``fallback`` is installed as the session's setting; with neither,
    this raises instead of silently using a local temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not fallback:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
            )
        root = fallback
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
