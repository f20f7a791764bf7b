"""Readers of the landing zone with fixed schemas, and SQL files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasemill.schemas import GROUND_TRUTH, OUT_OF_FRAME, RAW_KEYPOINTS, TAKE_META


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, lineage: bool = True) -> DataFrame:
    """CSV by a fixed schema; a header with other names or order, or a bad value, fails the read."""
    df = spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST")
    return df.withColumn("source_file", F.col("_metadata.file_name")) if lineage else df


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType, lineage: bool = True) -> DataFrame:
    """Multi-line JSON; keys beyond the schema are dropped."""
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return df.withColumn("source_file", F.col("_metadata.file_name")) if lineage else df


def read_landing(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four bronze tables of a landing folder, each by a glob over its files."""
    return {
        "raw_keypoints": read_csv(spark, f"{folder}/raw/*_keypoints.csv", RAW_KEYPOINTS),
        "ground_truth": read_csv(spark, f"{folder}/ground_truth/take_*.csv", GROUND_TRUTH),
        "out_of_frame_intervals": read_csv(spark, f"{folder}/raw/out_of_frame_intervals.csv", OUT_OF_FRAME),
        "take_meta": read_json(spark, f"{folder}/raw/*_meta.json", TAKE_META),
    }


def keypoint_violations(raw: DataFrame) -> DataFrame:
    """``rule, n``: broken constraints of the landing table (key, landmark range, detected exactly where coordinates are)."""
    known = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
    keys = raw.groupBy("take", "frame_idx", "keypoint_id").agg(F.count(F.lit(1)).alias("n"))
    rules = raw.agg(F.count_if(~F.coalesce(F.col("keypoint_id").between(0, 20), F.lit(False))).alias("keypoint_id in 0..20"), F.count_if(~F.col("detected").eqNullSafe(known)).alias("detected = coordinates known"))
    dup = keys.agg(F.count_if(F.col("n") > 1).alias("n"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").alias("n")) for c in rules.columns]))
    return rules.select(pairs.alias("r")).select("r.*").unionByName(dup.select(F.lit("primary key").alias("rule"), "n"))


def scan_takes(df: DataFrame, takes: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of the listed takes in order; the list reaches the scan."""
    return df.filter(F.col("take").isin(list(takes))).orderBy(*order)


_NAMED = re.compile(r"^--\s*name:\s*(\S+)\s*$", re.M)


def named_queries(text: str) -> dict[str, str]:
    """The statements of a SQL file, each under the name in the comment before it."""
    parts = _NAMED.split(text)
    out = {}
    for name, body in zip(parts[1::2], parts[2::2], strict=True):
        lines = [x for x in body.splitlines() if not x.lstrip().startswith("--")]
        out[name] = "\n".join(lines).strip().split(";")[0].strip()
    return out


_VIEW = re.compile(r"CREATE\s+OR\s+REPLACE\s+VIEW\s+(\w+)\s+AS\s+(.*?);", re.I | re.S)


def view_statements(text: str) -> dict[str, str]:
    """Name and query of each view that a SQL file creates."""
    return {m[1].lower(): m[2].strip() for m in _VIEW.finditer(re.sub(r"--[^\n]*", "", text))}


def create_views(spark: SparkSession, text: str) -> list[str]:
    views = view_statements(text)
    for name, sql in views.items():
        spark.sql(sql).createOrReplaceTempView(name)
    return list(views)
