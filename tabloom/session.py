"""Session settings, the shared scratch folder and written intermediate tables."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_own_folders: dict[str, str] = {}


def build_session(app_name: str = "tabloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tested under."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder, because
    there the driver and the executors are one process on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tabloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folders[app] = folder
    return _own_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tabloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


#: Seconds of work after which a scope lets Spark drop the shuffle files of finished steps.
TIDY_SECONDS = 5.0


class TemporaryTables:
    """Written tables of a piece of work, deleted when it is done.

    Spark deletes shuffle files when the driver's garbage collector finds that
    no plan refers to them, which may be never while memory suffices.  A scope
    of many steps asks for that now and then, so disk follows the step at hand.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tidied = spark, [], time.monotonic()

    def step_done(self) -> None:
        if time.monotonic() - self.tidied > TIDY_SECONDS:
            self.tidy()

    def tidy(self) -> None:
        gc.collect()
        self.spark._jvm.System.gc()
        self.tidied = time.monotonic()

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` to stay when the others go; a scope around this one takes it over."""
        path = scratch_path(self.spark, label)
        around = _open_scopes.index(self) - 1
        if around >= 0:
            _open_scopes[around].paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        self.paths = []
        self.tidy()


_open_scopes: list[TemporaryTables] = []


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables materialized inside are deleted at the end; what is needed later must be written with ``keep``."""
    scope = TemporaryTables(spark)
    _open_scopes.append(scope)
    try:
        yield scope
    finally:
        _open_scopes.remove(scope)
        scope.delete()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage and pins values that a second evaluation could
    change (range-partition bounds, partition ids).  The files outlive any
    executor, so later jobs never recompute them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    scope = _open_scopes[-1] if _open_scopes else None
    if scope:
        scope.paths.append(path)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    if scope:
        del df
        scope.step_done()
    return written


def local_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A DataFrame over a bounded list of driver-side facts."""
    return spark.createDataFrame(rows, schema)
