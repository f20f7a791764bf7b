"""Hold-out labels, locks, run logs, gates and history."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phasemill.operators.reach import neighbours
from phasemill.schemas import CYCLE, LABELS, RUN_LOG


class GovernanceError(RuntimeError):
    """A step is out of order, or what it needs isn't in the required state."""


def label_template(spark: SparkSession, take: str, cycles: int) -> DataFrame:
    """Blank label rows: an opening REST, then the six phases of each cycle."""
    phases = F.explode(F.sequence(F.lit(0), F.lit(len(CYCLE) - 1)))
    body = spark.range(1, cycles + 1).withColumn("pos", phases).select(F.col("id").cast("int").alias("cycle"), (F.col("id") * len(CYCLE) + F.col("pos")).alias("ord"), F.element_at(F.array(*[F.lit(x) for x in CYCLE]), F.col("pos") + 1).alias("label"))
    head = spark.range(1).select(F.lit(1).alias("cycle"), F.lit(0).cast("long").alias("ord"), F.lit("REST").alias("label"))
    blank = F.lit(None)
    return head.unionByName(body).select(F.lit(take).alias("take"), "cycle", "label", blank.cast("double").alias("start_s"), blank.cast("double").alias("end_s"), blank.cast("string").alias("source"), "ord")


def label_problems(labels: DataFrame, last_times: DataFrame, cycles: DataFrame | None = None) -> DataFrame:
    """``take, problem, n`` for each rule a take's labels break; the order of phases is not a rule.

    ``last_times`` has take and last_s, the time of its last frame, ``cycles`` take and n_cycles.
    """
    # looked at across shards of time; the first row of a take is the one with none before it
    near = neighbours(labels.withColumn("__here", F.lit(1)), ["take"], F.floor(F.col("start_s") / 600), ["start_s"], {"__before": ("end_s", -1), "__prior": ("__here", -1)})
    rows = near.withColumn("__first", F.col("__prior").isNull())
    unfilled = F.col("start_s").isNull() | F.col("end_s").isNull() | F.col("source").isNull()
    tests = {
        "unfilled rows": unfilled,
        "unknown label": ~F.coalesce(F.col("label").isin(LABELS), F.lit(False)),
        "source not manual": F.col("source").isNotNull() & (F.col("source") != "manual"),
        "end not after start": F.col("end_s") <= F.col("start_s"),
        "not contiguous": F.abs(F.col("start_s") - F.col("__before")) > 1e-6,
        "does not start at 0": F.col("__first") & (F.abs(F.col("start_s")) > 1e-3),
    }
    per_row = rows.groupBy("take").agg(*[F.count_if(c).alias(n) for n, c in tests.items()], F.max("end_s").alias("__end"), F.max("cycle").alias("__cycles"))
    per_row = per_row.join(last_times, "take", "left").withColumn("last end is not the last frame", F.when(F.coalesce(F.abs(F.col("__end") - F.col("last_s")) > 1e-3, F.lit(True)), 1).otherwise(0))
    names = [*tests, "last end is not the last frame"]
    if cycles is not None:
        per_row = per_row.join(cycles, "take", "left").withColumn("number of cycles", F.when(F.col("__cycles") != F.col("n_cycles"), 1).otherwise(0))
        names.append("number of cycles")
    found = F.explode(F.filter(F.array(*[F.struct(F.lit(n).alias("problem"), F.col(f"`{n}`").cast("long").alias("n")) for n in names]), lambda x: x["n"] > 0))
    return per_row.select("take", found.alias("f")).select("take", "f.problem", "f.n")


def content_hash(df: DataFrame) -> DataFrame:
    """``rows, sha256`` of a table's content, whatever the order of its rows and files.

    Each row is hashed; the hashes are combined by xor and by sum of their words, both of which merge
    on the map side, and the row count joins in.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    words = [F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("long") for i in range(4)]
    agg = df.select(row.alias("h")).select(*[w.alias(f"w{i}") for i, w in enumerate(words)]).agg(F.count(F.lit(1)).alias("rows"), *[F.bit_xor(f"w{i}").alias(f"x{i}") for i in range(4)], *[F.sum(F.col(f"w{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(4)])
    return agg.select("rows", F.sha2(F.concat_ws(",", "rows", *[f"x{i}" for i in range(4)], *[f"s{i}" for i in range(4)]), 256).alias("sha256"))


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """``table, columns, rows, sha256`` per table."""
    parts = [content_hash(df).select(F.lit(n).alias("table"), F.lit(",".join(df.columns)).alias("columns"), "rows", "sha256") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lock(locks: DataFrame | None, take: str, labels: DataFrame, last_times: DataFrame, trained_on: list[str], model_sha256: str) -> DataFrame:
    """The lock row of a hold-out take; refuses labels with problems, takes trained on, and a second lock."""
    spark = labels.sparkSession
    if take in trained_on:
        raise GovernanceError(f"{take} was trained on")
    if locks is not None and locks.filter(F.col("take") == take).limit(1).count():
        raise GovernanceError(f"{take} is locked already")
    problems = [f"{r['problem']} ({r['n']})" for r in label_problems(labels.filter(F.col("take") == take), last_times).collect()]
    if problems:
        raise GovernanceError(f"{take}: {', '.join(problems)}")
    digest = content_hash(labels.filter(F.col("take") == take)).first()["sha256"]
    return spark.createDataFrame([(take, digest, model_sha256, datetime.now(UTC).isoformat())], "take string, labels_sha256 string, model_sha256 string, locked_at string")


def check_lock(locks: DataFrame, take: str, labels: DataFrame, model_sha256: str) -> None:
    """Raise unless labels and model are those locked."""
    held = locks.filter(F.col("take") == take).first()
    if held is None:
        raise GovernanceError(f"{take} isn't locked")
    if held["labels_sha256"] != content_hash(labels.filter(F.col("take") == take)).first()["sha256"]:
        raise GovernanceError(f"{take}: labels changed since they were locked")
    if held["model_sha256"] != model_sha256:
        raise GovernanceError(f"{take}: the model changed since the labels were locked")


def file_sha256(path: str | Path) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def run_rows(checks: DataFrame, run_id: str | None = None, run_at: datetime | None = None) -> DataFrame:
    """Check results as rows of the append-only run log."""
    stamped = checks.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex)).withColumn("run_at", F.lit(run_at or datetime.now(UTC)).cast("timestamp"))
    return stamped.select(*RUN_LOG.names)


def gate(run_log: DataFrame) -> None:
    """Raise unless every check of the latest run passed."""
    latest = run_log.groupBy("run_at").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") != "PASS").alias("failed")).orderBy(F.col("run_at").desc()).first()
    if latest is None:
        raise GovernanceError("no run is logged")
    if latest["failed"]:
        raise GovernanceError(f"the latest run failed {latest['failed']} of {latest['n']} checks")


def holdout_status(takes: DataFrame, labels: DataFrame, locks: DataFrame, scores: DataFrame) -> DataFrame:
    """``take, status``: recorded, labelled, locked or scored."""
    has = lambda df, n: df.select("take").distinct().withColumn(n, F.lit(True))
    rows = takes.select("take").distinct().join(has(labels.filter(F.col("start_s").isNotNull()), "l"), "take", "left").join(has(locks, "k"), "take", "left").join(has(scores, "s"), "take", "left")
    return rows.select("take", F.when(F.col("s"), "scored").when(F.col("k"), "locked").when(F.col("l"), "labelled").otherwise("recorded").alias("status"))


def run_steps(steps: list[tuple[str, Callable[[], DataFrame | None]]], log: Callable[[DataFrame], None]) -> None:
    """Run steps in order; each gives its check results, which are logged; a failed check stops the rest."""
    for name, step in steps:
        checks = step()
        if checks is None:
            continue
        rows = run_rows(checks).collect()
        log(checks.sparkSession.createDataFrame(rows, RUN_LOG))
        failed = [r["check"] for r in rows if r["status"] != "PASS"]
        if failed:
            raise GovernanceError(f"step {name}: failed {failed}")


def score_report(scores: DataFrame) -> str:
    """Scores of scope ``all`` as Markdown, a table per group; one row per take comes to the driver."""
    rows = scores.filter("scope = 'all'").select("take_group", "take", "recall", "precision", "mae_matched_s", "frame_accuracy", "balanced_accuracy", "tolerant_accuracy").orderBy("take_group", "take").collect()
    out, group = [], object()
    show = lambda v: "-" if v is None else f"{v:.3f}"
    for r in rows:
        if r["take_group"] != group:
            group = r["take_group"]
            out += [f"\n## {group}\n", "| take | recall | precision | error s | frames | balanced | tolerant |", "|-|-|-|-|-|-|-|"]
        out.append(f"| {r['take']} | " + " | ".join(show(v) for v in r[2:]) + " |")
    return "\n".join(out)


# Key, tolerance and allowance for extra rows of each stage and serving table that is compared with a saved one.
STAGE_CHECKS = {
    "frames": (["take", "frame_idx"], 1e-12, False), "signals": (["take", "position"], 1e-9, False), "posteriors": (["take", "position"], 1e-9, False),
    "events": (["take", "event_idx"], 1e-12, False), "scores": (["take", "scope"], 1e-12, True),
}
SERVING_CHECKS = {
    "events": (["take", "event_idx"], 1e-6, False), "signals": (["take", "sample_idx"], 1e-6, False), "frames": (["take", "frame_idx"], 1e-6, False), "ground_truth": (["take", "start_s"], 1e-6, False),
    "takes": (["take"], 1e-6, False), "scores": (["take", "scope"], 1e-6, True), "raw_keypoints": (["take", "frame_idx", "keypoint_id"], 1e-6, False),
}


def worker_probe(spark: SparkSession, package: str = "phasemill", tasks: int | None = None) -> DataFrame:
    """``check, status, detail``: whether workers import the package and run the driver's versions of Python, Spark and Arrow; a task per slot asks."""
    import sys

    import pyarrow
    import pyspark

    mine = {"python": sys.version.split()[0], "pyspark": pyspark.__version__, "pyarrow": pyarrow.__version__, package: "imported"}
    slots = tasks or spark.sparkContext.defaultParallelism

    def ask(batches):
        import importlib
        import sys

        import pandas as pd
        import pyarrow
        import pyspark

        for b in batches:
            try:
                importlib.import_module(package)
                found = "imported"
            except ImportError as e:
                found = f"{type(e).__name__}: {e}"
            theirs = {"python": sys.version.split()[0], "pyspark": pyspark.__version__, "pyarrow": pyarrow.__version__, package: found}
            yield pd.DataFrame([(k, v) for _ in range(len(b)) for k, v in theirs.items()], columns=["name", "value"])

    said = spark.range(0, slots, 1, slots).mapInPandas(ask, "name string, value string").groupBy("name").agg(F.array_sort(F.collect_set("value")).alias("values"))
    wanted = spark.createDataFrame(list(mine.items()), "name string, want string")
    return wanted.join(said, "name", "left").select(F.concat(F.lit("worker "), "name").alias("check"), F.when(F.col("values") == F.array("want"), "PASS").otherwise("FAIL").alias("status"), F.array_join("values", ", ").alias("detail"))


def run_evidence(run_log: DataFrame) -> DataFrame:
    """One row per run: ``run_id, run_at, n_checks, n_failed, failed, sha256`` of its checks, to keep beside what the run published."""
    line = F.concat_ws("|", "check", "status", "detail")
    return run_log.groupBy("run_id", "run_at").agg(F.count(F.lit(1)).alias("n_checks"), F.count_if(F.col("status") != "PASS").alias("n_failed"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("status") != "PASS", F.col("check")))), ", ").alias("failed"), F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("sha256"))


def prepare_holdout(take: str, status: DataFrame, extract: Callable[[str], DataFrame], trained_on: list[str]) -> DataFrame:
    """The recorded frames of a hold-out take, by the injected ``extract``; refused for takes trained on and for those locked or scored."""
    if take in trained_on:
        raise GovernanceError(f"{take} was trained on")
    held = status.filter(F.col("take") == take).first()
    if held is not None and held["status"] in ("locked", "scored"):
        raise GovernanceError(f"{take} is {held['status']}")
    return extract(take)
