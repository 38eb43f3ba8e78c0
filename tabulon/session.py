"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tabulon", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster ``master`` stays ``None`` so spark-submit decides; locally the
    caller passes ``local[N]`` and a shuffle-partition count close to the cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins. With a local master, as in tests,
    a scratch folder is created where nothing is set; on a cluster that is an error,
    since executors could not read a folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tabulon-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it back.

    Used where one derived table feeds several branches of a plan (the tree
    would otherwise repeat the whole upstream chain in every branch). Reliable
    checkpoint files survive executor loss; ``localCheckpoint`` would not.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str = "survey"):
    """``df`` as a Parquet table below the shared checkpoint folder: cuts lineage like
    :func:`materialize`, and later passes read only the columns they need."""
    spark = df.sparkSession
    path = shared_scratch(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make ``tabulon`` importable in executor Python workers (pandas UDFs, mapInPandas).

    Zips the installed package once per SparkContext and registers it with
    ``addPyFile`` — what ``--py-files`` does at submit time — so Arrow UDF
    tasks can import it on any executor, whatever the driver's working directory.
    """
    import shutil

    sc = spark.sparkContext
    if getattr(sc, "_tabulon_shipped", False):
        return
    import tabulon
    pkg = os.path.dirname(os.path.abspath(tabulon.__file__))
    work = tempfile.mkdtemp(prefix="tabulon-pyfiles-")
    archive = shutil.make_archive(os.path.join(work, "tabulon"), "zip", root_dir=os.path.dirname(pkg),
                                  base_dir="tabulon")
    sc.addPyFile(archive)
    sc._tabulon_shipped = True
