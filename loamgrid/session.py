"""Session building and settings that every operator relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows of a task where a table is dealt by its size: a shuffle's bytes, by which Spark itself deals, say little of the memory that narrow rows take.
TASK_ROWS = 500_000


def build_session(cores: int | None = None, app: str = "loamgrid", memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution and UTC time; clusters bring their own."""
    cores = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and all is local (tests)."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = getattr(spark.sparkContext, "_loamgrid_dir", None) or tempfile.mkdtemp(prefix="loamgrid-")
        spark.sparkContext._loamgrid_dir = folder
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows without their lineage, kept in the shared folder, so a lost executor costs no recomputation chain."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, *key: str) -> DataFrame:
    """The same rows, dealt by their key to as many tasks as the session has; for narrow rows that are few bytes but much work."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *key)


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """The rows of a table, counted from its Parquet footers, dealt by their key to tasks of about TASK_ROWS; groups and joins by that key need no other shuffle."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS)), *key)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that Python workers can import it from any working folder."""
    context = spark.sparkContext
    if getattr(context, "_loamgrid_shipped", False):
        return
    home = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="loamgrid-")) / "loamgrid_package.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(home.rglob("*.py")):
            out.write(path, path.relative_to(home.parent))
    context.addPyFile(str(target))
    context._loamgrid_shipped = True
