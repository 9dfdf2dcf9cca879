"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every report relies on: AQE re-plans joins and partition counts
# from runtime sizes and splits skewed shuffle partitions; timestamps carry
# no zone (the source data has none).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # AQE merges small shuffle partitions up to this size and splits
    # skewed ones above a multiple of it.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A selective small side (e.g. one district's students) pre-filters the
    # big side of a shuffle join with a bloom filter.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoint files are removed once their DataFrame is unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "scorecast",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must come from the cluster configuration (a
    folder that every executor reaches).  Only a single-process session
    (``local[...]``: tests, bench) without it gets a scratch folder."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; configure a shared folder for the cluster")
        d = tempfile.mkdtemp(prefix="scorecast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d
