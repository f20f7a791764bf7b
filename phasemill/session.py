"""Session helpers: a local session for tests, table loading, and the folder shared by all executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from phasemill.functions.values import known, missing, ms_of

__all__ = ["known", "local_session", "materialize", "missing", "ms_of", "release", "scratch", "shared_dir", "table"]


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("phasemill")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder. ``timestamp`` columns without a zone stay TIMESTAMP_NTZ."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where that is unset (a local session) a folder of this machine is taken and set, because
    there driver and executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="phasemill-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        named = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_written: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete what this process has written to the shared folder; results that still read it can't be computed again."""
    jvm, n = spark.sparkContext._jvm, len(_written)
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def scratch(spark: SparkSession, what: str) -> str:
    """A path of its own in the shared folder, deleted by :func:`release`."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and keeps a result that several
    branches read from being computed once per branch.
    """
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
