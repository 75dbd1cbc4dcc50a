"""Where intermediate tables and checkpoints live.

The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local master, as in tests,
may fall back to a folder of this machine.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"

# The folder below that of the application for tables that ``temporary`` deletes.
_SCOPE: ContextVar[str] = ContextVar("scope", default="")


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and handed-over tables, registered with the Spark context."""
    sc = spark.sparkContext
    named = spark.conf.get(_CONF, None)
    if sc.getCheckpointDir() is None:
        if named is None and not sc.master.startswith("local"):
            raise RuntimeError(f"set {_CONF} to a folder every executor can reach")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="barweave-"))
    return named or sc.getCheckpointDir()


def run_dir(spark: SparkSession) -> str:
    """The folder of this application inside the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/barweave-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the folder of this application that nothing has used before."""
    return f"{run_dir(spark)}/{_SCOPE.get()}{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete every table handed over so far by this application.

    For when all results that read them have been written; a frame that still needs one fails.
    """
    _delete(spark, run_dir(spark))


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the tables handed over inside at the end, such as those of one micro-batch, whose
    results have been written by then."""
    scope = f"scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(f"{scope}/")
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _delete(spark, f"{run_dir(spark)}/{scope}")


def hand_over(df: DataFrame, label: str = "table", compression: str | None = None) -> DataFrame:
    """Write a table and read it back: for rows that several jobs need.

    Each reader then prunes columns and row groups, and the files split evenly however the keys
    are distributed. ``compression`` names another codec than the session's.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table that ``hand_over`` gave, once nothing reads it any more."""
    _delete(df.sparkSession, df.inputFiles()[0].rsplit("/", 1)[0])


def freeze(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint: later stages read these exact rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
