"""Session helpers: a local session for tests and benches, and the checkpoint folder.

On a cluster the caller owns the session; the library only reads
``spark.checkpoint.dir`` from it and never sets cluster-wide options.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark import SparkFiles
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "itemstats") -> SparkSession:
    """A local session for tests and benches (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ITEMSTATS_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the session names, setting one only where it is unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only a local-mode session without it (tests) gets a fresh scratch
    folder; a cluster session without it is an error, since a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir() or named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running itemstats on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="itemstats-ckpt-"))
    return sc.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once per application.

    Functions that run in tasks are found by their module's name, so the executors need the package even
    where the driver alone has it on its path.  The archive lies in the folder from which Spark's driver
    serves the files of an application.
    """
    sc = spark.sparkContext
    if getattr(sc, "_itemstats_shipped", None) == sc.applicationId:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(SparkFiles.getRootDirectory(), "itemstats-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("itemstats", os.path.relpath(path, package)))
    sc.addPyFile(archive)
    sc._itemstats_shipped = sc.applicationId
