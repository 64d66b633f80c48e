"""Session set-up and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spinneret")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.compress", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that folder would exist on one machine.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="spinneret-")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir() or fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, so that two runs never write to the same place."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor and are computed once."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def has_at_most(df: DataFrame, n_rows: int) -> bool:
    """Size check before a broadcast, for a frame that is cheap to read again. Each task counts its own rows."""
    return df.count() <= n_rows


def in_buckets(df: DataFrame, key: str) -> tuple[str, DataFrame]:
    """Name and rows of a written table in hash buckets of ``key``; joins on ``key`` read it without a shuffle.

    One key must not hold a large part of the rows, since a bucket is one task. The caller ends with
    :func:`drop_buckets`.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"spinneret_{uuid.uuid4().hex}"
    writer = df.repartition(n, key).write.format("parquet").bucketBy(n, key)
    writer.option("path", scratch_path(spark, "buckets")).saveAsTable(name)
    return name, spark.table(name)


def drop_buckets(spark: SparkSession, name: str) -> None:
    """Forget a table of :func:`in_buckets` and delete its files."""
    where = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if where:
        path = spark._jvm.org.apache.hadoop.fs.Path(where["data_type"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
