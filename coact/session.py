"""Session construction and shared-storage helpers.

Checkpoints and scratch files live under ``spark.checkpoint.dir`` — the shared
folder a cluster names for that purpose.  We read the setting from the session
and only fall back to a private temporary folder when Spark runs in local mode
(tests, the single-node bench); on a cluster an unset directory is an error
rather than a silent write to a machine-local disk.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every coact job wants; a cluster launcher may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "coact", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the coact defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure the SparkContext has a reliable checkpoint directory.

    Order: an already-set context directory, then the ``spark.checkpoint.dir``
    setting of the session, then (local mode only) a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; coact needs a shared folder for "
                "checkpoints and scratch tables on a cluster")
        configured = tempfile.mkdtemp(prefix="coact-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per application.

    Functions that run in workers are pickled by reference to their module, so
    the workers must be able to import ``coact`` wherever the driver runs.
    """
    sc = spark.sparkContext
    if getattr(sc, "_coact_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    # built on the driver only; Spark's file server hands it to the executors
    out = os.path.join(tempfile.mkdtemp(prefix="coact-src-"), "coact_sources.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("coact", os.path.relpath(full, here)))
    sc.addPyFile(out)
    sc._coact_shipped = True


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/coact-scratch/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh shared folder and read back: a table that several
    parts of a plan read is then computed once, and none of them carries its plan."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def default_parallelism(spark: SparkSession) -> int:
    """Partitions to use for a repartition whose size follows the data."""
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # noqa: BLE001
        n = 200
    return max(1, n)


__all__ = ["get_session", "ensure_checkpoint_dir", "ship_package", "scratch_dir", "staged", "default_parallelism",
           "DEFAULT_CONF"]
