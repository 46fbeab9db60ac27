"""A local session for tests and the benchmark. Jobs take any session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def own_shared_folder(spark: SparkSession) -> str:
    """For a local master without a shared folder: a folder of this machine, which is all there is.

    On a cluster there is no such choice, and none is made.
    """
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="larkspur-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Python workers import the package from the checkout
    path = os.environ.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (root, path) if p)
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("larkspur")
             .config("spark.sql.shuffle.partitions", shuffle_partitions)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", memory)
             .config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
