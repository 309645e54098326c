"""Session helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "paperloom") -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` through the shared checkpoint folder.

    The folder is the one named in ``spark.checkpoint.dir``.  Only a local
    session that names none (tests, a laptop) gets a folder of its own, which
    goes with the process; a cluster without a shared folder is an error, as
    one machine's disk would not outlive it.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
            named = tempfile.mkdtemp(prefix="paperloom-checkpoints-")
            atexit.register(shutil.rmtree, named, True)
        sc.setCheckpointDir(named)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Lets the Python workers import this package, where their path has no copy of it."""
    root = Path(__file__).resolve().parent.parent
    sc = spark.sparkContext
    if sc.applicationId in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    made = os.path.join(tempfile.mkdtemp(), "paperloom.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(made, "w") as z:
        for f in (root / "paperloom").rglob("*.py"):
            z.write(f, f.relative_to(root))
    sc.addPyFile(made)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
