"""Session settings and lineage cuts shared by the iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCRATCH_CONF = "spark.checkpoint.dir"
_LOCAL_SCRATCH: dict[str, str] = {}


def get_session(app: str = "vizquarry", cpus: int | str = "*", **conf) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session spark-submit gives."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("VIZQUARRY_DRIVER_MEMORY", "16g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local master may fall back to a fresh one."""
    named = spark.conf.get(SCRATCH_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SCRATCH_CONF} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="vizquarry-")
    return _LOCAL_SCRATCH[app]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """What writes of the block have shuffled goes from the disks as soon as they are done: their tables are read from then on."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared scratch folder and read it back; also the folder, for ``remove``.

    The copy survives the loss of executors, and Catalyst sees real file sizes when it plans the next
    round of a loop.
    """
    path = os.path.join(scratch_dir(df.sparkSession), f"round-{uuid.uuid4().hex}")
    with shuffles_given_back(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a stored table."""
    return stored(df)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Give back the space of a stored round that nothing reads any more, wherever Spark stored it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Rounds:
    """What the rounds of a loop leave, in one table; its plan stays one scan however many rounds there are."""

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema, self.used = spark, schema, False
        self.path = os.path.join(scratch_dir(spark), f"rounds-{uuid.uuid4().hex}")

    def add(self, df: DataFrame) -> None:
        with shuffles_given_back(self.spark):
            df.write.mode("append").parquet(self.path)
        self.used = True

    def all(self) -> DataFrame:
        if not self.used:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)


class Steps:
    """The rounds of a loop, each written once; the next round reads the last one, the result reads them all."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.schema = spark, [], None
        self.path = os.path.join(scratch_dir(spark), f"steps-{uuid.uuid4().hex}")

    def add(self, df: DataFrame) -> DataFrame:
        """Write a round and read it back."""
        self.paths.append(os.path.join(self.path, str(len(self.paths))))
        with shuffles_given_back(self.spark):
            df.write.parquet(self.paths[-1])
        self.schema = df.schema
        return self.spark.read.schema(self.schema).parquet(self.paths[-1])

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="vizquarry-py-"), "vizquarry.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
