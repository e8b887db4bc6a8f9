"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# For a large cluster. Partitions start out many and are merged to the advised size; skewed ones
# are split; window state lives on disk and is checkpointed as changes.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps without a zone are read as UTC throughout the library."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def cluster_session(builder: SparkSession.Builder) -> SparkSession:
    for name, value in CLUSTER_SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dirs.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="tablestream-"))


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared folder."""
    return f"{shared_dir(spark)}/tablestream/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows (and any partition ids stored in them) are fixed and survive
    the loss of executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame, name: str = "rows") -> DataFrame:
    """The rows as a table in the shared folder, read from there: fixed like a checkpoint, but in
    compressed columns, of which a later step reads those it needs."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
