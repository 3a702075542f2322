"""Session construction and lineage cutting.

On a cluster the session comes from the platform; we only read its settings.
``get_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every local run uses. AQE re-plans joins from runtime sizes (a small
# side becomes a broadcast only when it is measured small), coalesces tiny
# shuffle partitions and splits skewed join partitions.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "annolake", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("ANNOLAKE_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session and returned as is (the
    same folder across applications, so streaming checkpoints survive restarts);
    RDD checkpoints are pointed at it too. Only when it is unset on a local
    master (tests, local runs) do we make a scratch folder of our own.
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local folder "
                               "does not survive the loss of an executor")
        conf_dir = tempfile.mkdtemp(prefix="annolake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read
    it back: one job, survives executor loss, and later reads prune columns and
    push filters. (An RDD checkpoint would compute its input twice.)"""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place under the shared checkpoint folder; ``drop_tables`` deletes what is written there."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


_WRITTEN: list[str] = []


def drop_tables(spark: SparkSession, after: int = 0) -> int:
    """Delete what this process has written at its scratch paths (``cut_lineage``), and nothing else: to be
    called when the results that read them have been written. Returns their number. ``after``: leave the first ones."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = 0
    while len(_WRITTEN) > after:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


@contextmanager
def temporary_tables(spark: SparkSession):
    """What is written at scratch paths inside the block is deleted at its end: for flows that write their results in it."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        drop_tables(spark, before)
