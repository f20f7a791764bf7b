"""Streaming and sink queries, with DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasemill.plans.catalogue import TRUTH, truth
from phasemill.plans.governance import manifest
from phasemill.schemas import GROUND_TRUTH
from phasemill.session import scratch, table
from phasemill.sources import sinks
from phasemill.sources.landing import keypoint_violations, read_csv
from phasemill.streaming.sessions import read_events, run_available, sessions


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    out = run_available(sessions(read_events(spark, d, "events.parquet")), "sessions")
    return out.select("user_id", F.unix_micros("from_ts").alias("from_us"), F.unix_micros("until_ts").alias("until_us"), "n", F.round("total", 4).alias("total"))


def sink_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Partitions written, replaced and read back."""
    path = scratch(spark, "replace")
    rows = table(spark, d, "phase_events").distinct().withColumn("kind", F.coalesce("take_group", F.lit("none")))
    sinks.replace_partitions(rows, path, "kind")
    sinks.replace_partitions(rows.filter("kind = 'hard'"), path, "kind")
    return spark.read.parquet(path).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def sink_csv(spark: SparkSession, d: str) -> DataFrame:
    """Labels through CSV and the fixed-schema reader."""
    path = scratch(spark, "csv")
    sinks.write_csv(truth(spark, d).select(*GROUND_TRUTH.names), path)
    return read_csv(spark, path, GROUND_TRUTH, lineage=False)


def violations(spark: SparkSession, d: str) -> DataFrame:
    return keypoint_violations(table(spark, d, "raw_keypoints"))


def table_manifest(spark: SparkSession, d: str) -> DataFrame:
    return manifest({n: table(spark, d, n) for n in ("takes", "phase_events", "scores_full", "tableau_phases", "mix_targets")})


QUERIES = {f.__name__: f for f in (stream_sessions, sink_partitions, sink_csv, violations, table_manifest)}

_HOURS = 6 * 3_600_000_000
ORACLES = {
    "stream_sessions": f"""
WITH e AS (SELECT user_id, epoch_us(ts) AS t, value FROM events),
n AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < {_HOURS} THEN 0 ELSE 1 END AS new FROM e),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM n)
SELECT user_id, min(t) AS from_us, max(t) + {_HOURS} AS until_us, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, k""",
    "sink_partitions": "SELECT coalesce(take_group, 'none') AS kind, count(*) AS n FROM (SELECT DISTINCT * FROM phase_events) GROUP BY 1",
    "sink_csv": f"WITH {TRUTH} SELECT * FROM truth",
    "violations": """
SELECT 'keypoint_id in 0..20' AS rule, count(*) FILTER (keypoint_id IS NULL OR keypoint_id NOT BETWEEN 0 AND 20) AS n FROM raw_keypoints
UNION ALL SELECT 'detected = coordinates known', count(*) FILTER (detected IS DISTINCT FROM (x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL)) FROM raw_keypoints
UNION ALL SELECT 'primary key', count(*) FROM (SELECT 1 FROM raw_keypoints GROUP BY take, frame_idx, keypoint_id HAVING count(*) > 1)""",
}
