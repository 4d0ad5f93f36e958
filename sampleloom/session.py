"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "sampleloom", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and skew handling on; a cluster's own settings win."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # buckets written as one sorted file each are not sorted again before a merge join
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        # sums of many vector elements are too wide for the small first-level map
        "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
        # hash instead of sort-merge where every build partition turned out small
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # no Python call site per Column: it costs more than planning for wide expressions
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**defaults, **conf}.items():
        b = b.config(key, value)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="sampleloom-ckpt-")
    sc.setCheckpointDir(named)
    return named


def settled(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``: later branches see the same rows in the same partitions,
    also after an executor is lost."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
