"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "veredas") -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("VEREDAS_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did.

    Needed where the package was put on the driver's path only; a cluster that
    ships it (``--py-files``, PYTHONPATH) is not affected.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only where that setting is
    missing and all runs in one process (``local`` masters: tests, a laptop) a
    temporary folder is made and set; executors elsewhere could not read it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="veredas-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and forget how it was made.

    The rows are written once to reliable storage, so losing an executor later
    costs a re-read of the file and not a re-run of the iterations before it.

    A checkpoint alone still carries the constraints and the size estimate of its
    plan. Constraints of united branches double with every round of a loop, and
    estimates know nothing of exploded or parsed columns, so large tables would be
    broadcast through the driver. The frame returned has neither: joins are planned
    by the sizes that adaptive execution measures.
    """
    spark = reachable(df.sparkSession)
    shared_folder(spark)
    written = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(written.queryExecution().toRdd(), written.schema(), False), spark)
