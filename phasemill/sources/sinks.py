"""Table sinks: partition replacement, overwrite with read-back, append-only logs, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def replace_partitions(df: DataFrame, path: str, partition: str = "take") -> int:
    """Idempotent load: the partitions that ``df`` has are replaced, others stay. Gives the rows written, observed while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return seen.get["n"]


def overwrite_table(df: DataFrame, name: str) -> int:
    """Managed table replaced with its schema; gives the count read back."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("overwriteSchema", "true").format("parquet").saveAsTable(name)
    return spark.table(name).count()


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_parquet(df: DataFrame, path: str, partition: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(partition) if partition else w).parquet(path)


def fetch(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    """A query over tables under the names they have in it."""
    return spark.sql(sql, **tables) if "{" in sql else _on_views(spark, sql, tables)


def _on_views(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def publish(tables: dict[str, DataFrame], root: str, log: DataFrame | None = None) -> dict[str, int]:
    """All tables overwritten below ``root``, and a row per table appended to the publish log; rows written by table."""
    written = {}
    for name, df in tables.items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
        written[name] = seen.get["n"]
        df.sparkSession.createDataFrame([(name, written[name])], "table string, rows long").withColumn("published_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/publish_runs")
    return written
