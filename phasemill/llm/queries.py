"""Queries of the operators for training data, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phasemill.llm.mixing import mix_sources
from phasemill.llm.nearest import nearest_in_time
from phasemill.llm.runs import collapse_runs
from phasemill.llm.tokens import decode_corpus, encode_corpus
from phasemill.llm.truncation import TRAILING, length_encodings, truncated_texts
from phasemill.session import ms_of, table

RUN_GAP_MS, NEAR_MS = 250, 40
ALIKE = 0.6


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    events, phases = table(spark, d, "phase_events"), table(spark, d, "tableau_phases")
    columns = ["take", "label", "start_s", "end_s"]
    both = events.select(F.lit("phase_events").alias("table_name"), F.lit("events").alias("seq"), *columns, "n_frames").unionByName(phases.select(F.lit("tableau_phases").alias("table_name"), F.col("source").alias("seq"), *columns, F.lit(0).cast("long").alias("n_frames")))
    runs = collapse_runs(both, {c: F.col(c) for c in ("table_name", "take", "seq")}, F.upper(F.trim("label")), ms_of(F.col("start_s")), ms_of(F.col("end_s")), F.col("n_frames"), 1.0, RUN_GAP_MS)
    return runs.filter("n_events > 1").select("table_name", "take", "seq", F.col("start").alias("start_ms"), "n_events", F.col("duration").alias("duration_ms"), "n_frames")


def p4_similar(spark: SparkSession, d: str) -> DataFrame:
    """Runs of near-identical labels as they are spelled: neighbours whose character pairs agree by 0.6 or more."""
    phases = table(spark, d, "tableau_phases")
    runs = collapse_runs(phases, {c: F.col(c) for c in ("take", "source")}, F.col("label"), ms_of(F.col("start_s")), ms_of(F.col("end_s")), None, ALIKE, RUN_GAP_MS)
    return runs.filter("n_events > 1").select("take", "source", "label", F.col("start").alias("start_ms"), "n_events", F.col("duration").alias("duration_ms"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    frames = table(spark, d, "raw_keypoints").filter((F.col("keypoint_id") == 0) & F.col("detected"))
    phases = table(spark, d, "tableau_phases")
    pairs = nearest_in_time(phases, frames, ["take"], ms_of(F.col("start_s")), F.col("timestamp_ms"), NEAR_MS, ["source"], "frame_idx")
    return pairs.select("take", "source", F.col("left_time").alias("start_ms"), F.col("right_value").alias("frame_idx"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"), ["doc_id"], "text")


def p7_stats(spark: SparkSession, d: str) -> DataFrame:
    """Tokens per source and language."""
    counts = encode_corpus(table(spark, d, "documents"), ["source", "lang"], "text", count_only=True)
    return counts.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("longest"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Every text encoded and decoded again: its hash and bytes are those of the text."""
    decoded = decode_corpus(p7_ids(spark, d), ["doc_id"], "ids")
    return decoded.select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("md5"), F.octet_length("text").cast("long").alias("n_bytes"))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = encode_corpus(table(spark, d, "documents"), ["doc_id", "source"], "text", count_only=True)
    return mix_sources(sizes, "doc_id", "source", "n_tokens", table(spark, d, "mix_targets"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1]


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What holds of every mixture, from its rows: caps kept, no use twice, each source's share as near to its target as whole documents allow (of the sources that have any)."""
    mixture, shares = _mixed(spark, d)
    uses = mixture.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("k"), F.countDistinct("copy").alias("c"), F.sum("n_tokens").alias("n"), F.max("n_tokens").alias("long"))
    per = uses.groupBy("source").agg(F.max("k").alias("most"), F.bool_and(F.col("k") == F.col("c")).alias("once"), F.sum("n").alias("tokens"), F.max("long").alias("long"))
    rows = shares.select("source", "target_share", "max_repeats", "available_tokens", "used_tokens").join(per, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    every = Window.partitionBy(F.lit(1))  # one row per target
    usable = F.sum(F.when(F.col("available_tokens") > 0, F.col("target_share"))).over(every)
    # each quota ends within half a document, so shares differ by a document per source at most
    off = F.abs(F.col("tokens") - F.sum("tokens").over(every) * F.col("target_share") / usable)
    most = F.max("long").over(every) * F.count(F.lit(1)).over(every) / 2
    return rows.select("source", F.coalesce(F.col("most") <= F.col("max_repeats"), F.lit(True)).alias("within_cap"), F.coalesce("once", F.lit(True)).alias("each_use_once"), (F.col("tokens") == F.col("used_tokens")).alias("as_reported"), F.when(F.col("available_tokens") > 0, off <= most).otherwise(F.col("tokens") == 0).alias("near_target"))


def _truncated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return truncated_texts(table(spark, d, "documents"), "doc_id", "text", "source", "page_id")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _truncated(spark, d)[0].filter("truncated").select("doc_id").distinct()


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source truncates, and how many of the texts at a limit are cut."""
    cut, at = F.col("truncated"), F.col("at_limit")
    rates = _truncated(spark, d)[0].groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(cut).alias("n_truncated"), F.count_if(at).alias("n_at_limit"), F.count_if(at & cut).alias("n_truncated_at_limit"))
    return rates.withColumn("rate", F.col("n_truncated") / F.col("n_texts"))


def p9_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Every text's length under each encoding."""
    return table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", *[c.alias(k) for k, c in length_encodings(F.col("text")).items()])


def p9_limits(spark: SparkSession, d: str) -> DataFrame:
    """The hidden storage limits of each source."""
    return _truncated(spark, d)[1]


QUERIES = {f.__name__: f for f in (p4_found, p4_similar, p5_found, p7_ids, p7_decoded, p7_stats, p8_mix, p8_shares, p8_checks, p9_found, p9_rates, p9_lengths, p9_limits)}

# the lengths of texts as SQL: characters replaced by nothing, counted
_less = lambda part: f"(length(text) - length(replace(text, {part}, '')))"
_LINES, _XML = _less("chr(10)"), f"{_less(repr('&'))} * 4 + ({_less(repr('<'))} + {_less(repr('>'))}) * 3"
_HTML = f"{_XML} + {_less(repr(chr(34)))} * 5 + {_less('chr(39)')} * 4"
_JSON = f"{_less(repr(chr(34)))} + {_less('chr(92)')} + {_LINES} + {_less('chr(13)')} + {_less('chr(9)')}"
_ASTRAL, _BEYOND = r"length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g'))", r"length(regexp_replace(text, '[\x{0}-\x{7F}]', '', 'g'))"
_SQL_LENGTHS = {
    "chars": "length(text)", "utf8": "strlen(text)", "utf16": f"length(text) + {_ASTRAL}", "xml": f"length(text) + {_XML}", "xml_utf8": f"strlen(text) + {_XML}", "html": f"length(text) + {_HTML}", "html_utf8": f"strlen(text) + {_HTML}",
    "json": f"length(text) + {_JSON}", "json_utf8": f"strlen(text) + {_JSON}", "json_ascii": f"length(text) + {_JSON} + {_BEYOND} * 5 + {_ASTRAL} * 6", "crlf": f"length(text) + {_LINES}", "crlf_utf8": f"strlen(text) + {_LINES}",
}
_BLANK = " || ".join(f"chr({ord(c)})" for c in TRAILING)

ORACLES = {
    "p7_decoded": "SELECT doc_id, md5(coalesce(text, '')) AS md5, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes FROM documents",
    "p8_checks": "SELECT source, true AS within_cap, true AS each_use_once, true AS as_reported, true AS near_target FROM mix_targets",
    "p9_lengths": "SELECT doc_id, " + ", ".join(f"CAST({e} AS BIGINT) AS {k}" for k, e in _SQL_LENGTHS.items()) + " FROM documents WHERE text IS NOT NULL",
    "p9_limits": f"""
WITH f AS (SELECT doc_id, source, text, min(page_id) OVER (PARTITION BY text) AS grp, {", ".join(f"{e} AS {k}" for k, e in _SQL_LENGTHS.items())} FROM documents WHERE text IS NOT NULL AND rtrim(text, {_BLANK}) <> ''),
l AS (SELECT source, grp, encoding, length, place FROM f CROSS JOIN LATERAL (VALUES {", ".join(f"('{k}', {k}, {i})" for i, k in enumerate(_SQL_LENGTHS))}) v(encoding, length, place) WHERE source IS NOT NULL),
c AS (SELECT source, encoding, place, length, count(DISTINCT grp) AS n FROM l GROUP BY ALL),
s AS (SELECT *, (sum(n) OVER (PARTITION BY source, encoding ORDER BY length RANGE BETWEEN 30 PRECEDING AND 30 FOLLOWING) - n) / 60.0::DOUBLE AS expected FROM c),
k AS (SELECT * FROM s WHERE n >= 4 + 10 * expected),
o AS (SELECT l.source, l.grp, max((k.n, -k.place, k.encoding, k.length, k.expected)) AS b FROM l JOIN k USING (source, encoding, length) GROUP BY ALL)
SELECT source, b[3] AS encoding, b[4] AS "limit", max(b[1]) AS n_groups, max(b[5]) AS expected FROM o GROUP BY ALL HAVING count(*) >= 4""",
    "p4_found": f"""
WITH ms AS (
  SELECT 'phase_events' AS table_name, take, 'events' AS seq, upper(trim(label)) AS label, start_s, end_s, n_frames FROM phase_events
  UNION ALL SELECT 'tableau_phases', take, source, upper(trim(label)), start_s, end_s, 0 FROM tableau_phases),
e AS (SELECT table_name, take, seq, label, CAST(floor(start_s * 1000 + 0.5) AS BIGINT) AS s, CAST(floor(end_s * 1000 + 0.5) AS BIGINT) AS e, max(coalesce(n_frames, 0)) AS f
      FROM ms WHERE label IS NOT NULL AND start_s IS NOT NULL AND end_s IS NOT NULL GROUP BY ALL),
a AS (SELECT *, lag(label) OVER w AS before FROM e WINDOW w AS (PARTITION BY table_name, take, seq ORDER BY s, e, label)),
b AS (SELECT *, sum(CASE WHEN label = before THEN 0 ELSE 1 END) OVER (PARTITION BY table_name, take, seq ORDER BY s, e, label ROWS UNBOUNDED PRECEDING) AS streak FROM a),
c AS (SELECT *, max(e) OVER (PARTITION BY table_name, take, seq, streak ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
r AS (SELECT *, sum(CASE WHEN s - reach <= {RUN_GAP_MS} THEN 0 ELSE 1 END) OVER (PARTITION BY table_name, take, seq, streak ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT table_name, take, seq, min(s) AS start_ms, count(*) AS n_events, max(e) - min(s) AS duration_ms, CAST(sum(f) AS BIGINT) AS n_frames
FROM r GROUP BY table_name, take, seq, streak, run HAVING count(*) > 1""",
    "p4_similar": f"""
WITH e AS (SELECT DISTINCT take, source, label, CAST(floor(start_s * 1000 + 0.5) AS BIGINT) AS s, CAST(floor(end_s * 1000 + 0.5) AS BIGINT) AS e
           FROM tableau_phases WHERE label IS NOT NULL AND start_s IS NOT NULL AND end_s IS NOT NULL),
g AS (SELECT *, list_distinct([label[i:i + 1] FOR i IN range(1, length(label))]) AS pairs FROM e),
a AS (SELECT *, lag(label) OVER w AS before, lag(pairs) OVER w AS others FROM g WINDOW w AS (PARTITION BY take, source ORDER BY s, e, label)),
b AS (SELECT *, sum(CASE WHEN label = before OR (len(pairs) > 0 AND len(others) > 0 AND 2 * len(list_intersect(pairs, others)) / (len(pairs) + len(others)) >= {ALIKE}) THEN 0 ELSE 1 END)
             OVER (PARTITION BY take, source ORDER BY s, e, label ROWS UNBOUNDED PRECEDING) AS streak FROM a),
c AS (SELECT *, max(e) OVER (PARTITION BY take, source, streak ORDER BY s, e, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
r AS (SELECT *, sum(CASE WHEN s - reach <= {RUN_GAP_MS} THEN 0 ELSE 1 END) OVER (PARTITION BY take, source, streak ORDER BY s, e, label ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT take, source, arg_min(label, (s, e, label)) AS label, min(s) AS start_ms, count(*) AS n_events, max(e) - min(s) AS duration_ms FROM r GROUP BY take, source, streak, run HAVING count(*) > 1""",
    "p5_found": f"""
WITH f AS (SELECT take, timestamp_ms AS t, min(frame_idx) AS i FROM raw_keypoints WHERE keypoint_id = 0 AND detected AND timestamp_ms IS NOT NULL GROUP BY ALL),
l AS (SELECT DISTINCT take, source, CAST(floor(start_s * 1000 + 0.5) AS BIGINT) AS start_ms FROM tableau_phases WHERE start_s IS NOT NULL AND NOT isnan(start_s))
SELECT take, source, start_ms, i AS frame_idx FROM (
  SELECT l.*, f.i, row_number() OVER (PARTITION BY l.take, l.source, l.start_ms ORDER BY abs(f.t - l.start_ms), f.t, f.i) AS n
  FROM l JOIN f ON l.take = f.take AND f.t BETWEEN l.start_ms - {NEAR_MS} AND l.start_ms + {NEAR_MS}) WHERE n = 1""",
}
