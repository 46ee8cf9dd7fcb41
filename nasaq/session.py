"""Session settings and the shared folder that cuts lineage.

Lineage is cut either by ``DataFrame.checkpoint()`` or by a Parquet table, both in
the folder that the session names in ``spark.checkpoint.dir``. All executors see
that folder, so a lost executor costs nothing. Only a local session without that
setting gets a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and single-machine use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("nasaq")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Lets the Python workers of every executor import this package, wherever it was started from. Once for each context."""
    sc = spark.sparkContext
    if getattr(sc, "_nasaq_shipped", False):
        return
    package = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="nasaq-package-")  # the driver serves this file to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/nasaq.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)
    sc._nasaq_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints; all executors can read and write it."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="nasaq-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, work: Column, per_task: int) -> DataFrame:
    """The same rows checkpointed, in tasks of about ``per_task`` units of work each, not fewer than the cores.

    For steps whose cost isn't that of their bytes, which is what partitions are sized by otherwise.
    """
    df = checkpointed(df)
    units = df.agg(F.sum(work)).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-units // per_task)))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows written as a Parquet table in the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    _remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


class Slices:
    """A Parquet table in the shared folder whose rows lie in ``COUNT`` folders by the hash in one column (in one folder without it).

    A step that meets rows by that hash can take some folders after others, and a folder that has been taken
    can go, so that neither its shuffles nor the table are on disk as a whole.
    """

    COUNT = 8

    def __init__(self, spark: SparkSession, name: str, schema: str, by: str | None = None):
        self.spark, self.schema, self.by = spark, schema, by
        self.path, self.written = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", False
        _remove_at_exit(spark, self.path)

    def add(self, rows: DataFrame) -> None:
        rows = rows.withColumn("slice", F.pmod(F.col(self.by), F.lit(self.COUNT)).cast("int") if self.by else F.lit(0))
        rows.write.option("compression", "zstd").partitionBy("slice").mode("append").parquet(self.path)
        self.written = True
        del rows
        release(self.spark)

    def rows(self, slices: Iterable[int] | None = None) -> DataFrame:
        """The rows of these slices, or all."""
        if not self.written:
            return self.spark.createDataFrame([], self.schema)
        table = self.spark.read.schema(f"{self.schema}, slice int").parquet(self.path)
        return (table if slices is None else table.where(F.col("slice").isin(*slices))).drop("slice")

    def drop(self, slices: Iterable[int] | None = None) -> None:
        """Deletes these slices, or all. What was read from them and isn't stored is lost."""
        for path in [self.path] if slices is None else [f"{self.path}/slice={k}" for k in slices]:
            _remove(self.spark, path)

    @classmethod
    def passes(cls, units: int, per_pass: int) -> list[list[int]]:
        """The slices of each pass, of about ``per_pass`` units, if that many passes can be."""
        n = min(cls.COUNT, max(1, -(-units // per_pass)))
        return [list(range(k, cls.COUNT, n)) for k in range(n)]


def release(spark: SparkSession) -> None:
    """Lets the driver drop the shuffle files of plans that nothing refers to any more.

    Spark cleans them when the driver's garbage is collected, which a driver with a
    large heap may not do for half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(jpath, True)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    def remove() -> None:
        try:
            _remove(spark, path)
        except Exception:  # the session has ended and its folder with it
            pass

    atexit.register(remove)
