"""Session helpers: a configured SparkSession and a reliable checkpoint dir."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "pansift",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with AQE on and UTC session time.

    On a cluster call it without ``master``; the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is also the only executor
            b = b.config("spark.driver.memory", "8g")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    When the session has none, a fresh scratch folder is created in local
    mode only (tests); on a cluster the setting is required, since a
    node-local folder would not survive the loss of that node.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: stage tables and lineage cuts "
                               "must survive executor loss")
        configured = tempfile.mkdtemp(prefix="pansift-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from that table (never ``localCheckpoint``).

    Unlike ``Dataset.checkpoint()`` on an unpersisted plan, which runs the
    lineage twice (once to count, once to write the files), this computes
    it once; the written table survives executor loss and gives the
    optimizer real file statistics for the stages that follow.
    """
    return df.sparkSession.read.parquet(write_stage(df, name))


def write_stage(df: DataFrame, name: str = "stage") -> str:
    """Write ``df`` as a Parquet table in the shared checkpoint folder; return its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate
    written tables (never a machine-local temp folder on a cluster)."""
    import uuid
    ship_package(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/pansift-scratch/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per Spark application), so
    that Python workers can import it wherever the session was started."""
    import zipfile

    sc = spark.sparkContext
    if any(str(f).endswith("/pansift.zip") for f in sc.listFiles):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="pansift-ship-"), "pansift.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("pansift", os.path.relpath(full, top)))
    sc.addPyFile(path)
