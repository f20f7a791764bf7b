"""Queries of single stages of the pipeline, from keypoints to decoded events and scores, each with its DuckDB twin.

Where a stage needs a fitted model, the model here is a fixed one, given by a rule, so that SQL can
compute its probabilities too.
"""

from __future__ import annotations

import tempfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phasemill.operators import models as M
from phasemill.operators import relational as R
from phasemill.operators import segmentation as G
from phasemill.operators import signals as S
from phasemill.operators.metrics import boundary_metrics, full_scores, objective
from phasemill.plans import catalogue as C
from phasemill.plans import pipeline as P
from phasemill.plans.serving import serve_events, serve_signals
from phasemill.plans.serving import prediction_agreement_by_label as agreement
from phasemill.schemas import BOUNDARY_TOLERANCE_S, EPS, LABELS, PROTOCOL, TUNED
from phasemill.session import materialize, missing, table

QUERIES, ORACLES = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def rounded(df: DataFrame, digits: int, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _round(columns: list[str], digits: int) -> str:
    # the sum turns -0.0 into 0.0
    return ", ".join(f"round({c}, {digits}) + 0.0::DOUBLE AS {c}" for c in columns)


# ---- signals ----
CHANNELS = ("X", "Y", "ap")
_SANE = "detected AND coalesce(x BETWEEN -1 AND 2 AND y BETWEEN -1 AND 2, false)"
_FRAMES = C.FRAMES.replace("frames AS", "usable AS").replace("max(detected) AS detected", f"max({_SANE}) AS detected")


def _filled(v: str) -> str:
    line = lambda a, b: f"{v}{a} + ({v}{b} - {v}{a}) * (t - a{a}) / nullif(a{b} - a{a}, 0)"
    return f"coalesce(CASE WHEN {v}1 IS NOT NULL AND {v}2 IS NOT NULL THEN {line(1, 2)} END, CASE WHEN {v}0 IS NOT NULL AND {v}2 IS NOT NULL AND {v}1 IS NULL THEN {line(0, 2)} END, CASE WHEN {v}1 IS NOT NULL AND {v}3 IS NOT NULL AND {v}2 IS NULL THEN {line(1, 3)} END)"


def _savgol(column: str, derivative: int, window: int = 5) -> str:
    weights = S.savgol_weights(window, 2, derivative, 1 / S.GRID_HZ)
    half = window // 2
    at = lambda k: f"lead({column}, {k}) OVER x" if k > 0 else f"lag({column}, {-k}) OVER x" if k < 0 else column
    total = lambda row, own: " + ".join(f"CAST({float(weights[row, j])!r} AS DOUBLE) * {at(j - own)}" for j in range(window))
    cases = " ".join(f"WHEN sample_idx = {r} THEN {total(r, r)} WHEN last_idx - sample_idx = {r} THEN {total(window - 1 - r, window - 1 - r)}" for r in range(half))
    return f"CASE WHEN last_idx < {window - 1} THEN NULL {cases} ELSE {total(half, half)} END"


def _by_index(name: str, source: str, columns: list[str], keep: str) -> str:
    """A CTE with ``<column>_full`` for each column: linear in the index between known samples, constant beyond."""
    near = ", ".join(f"last_value(CASE WHEN {c} IS NOT NULL THEN sample_idx END IGNORE NULLS) OVER b AS {c}_i, last_value({c} IGNORE NULLS) OVER b AS {c}_v, first_value(CASE WHEN {c} IS NOT NULL THEN sample_idx END IGNORE NULLS) OVER f AS {c}_j, first_value({c} IGNORE NULLS) OVER f AS {c}_w" for c in columns)
    full = ", ".join(f"coalesce({c}, CASE WHEN {c}_i IS NULL THEN {c}_w WHEN {c}_j IS NULL THEN {c}_v ELSE {c}_v + ({c}_w - {c}_v) / ({c}_j - {c}_i) * (sample_idx - {c}_i) END) AS {c}_full" for c in columns)
    return f"""{name}_near AS (SELECT *, {near} FROM {source} WINDOW b AS (PARTITION BY take ORDER BY sample_idx ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY take ORDER BY sample_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{name} AS (SELECT {keep}, {full} FROM {name}_near)"""


def _channel(c: str) -> str:
    return f"""
k_{c} AS (SELECT take, t, v, lead(t) OVER w AS nt, lead(v) OVER w AS nv FROM (SELECT take, t, min({c}) AS v FROM nat WHERE {c} IS NOT NULL GROUP BY ALL) WINDOW w AS (PARTITION BY take ORDER BY t)),
g_{c} AS (SELECT g.take, g.sample_idx, CASE WHEN g.t = n.t THEN n.v WHEN nt - n.t <= {3.5 / 30!r} THEN n.v + (nv - n.v) * (g.t - n.t) / (nt - n.t) END AS {c} FROM points g ASOF LEFT JOIN k_{c} n ON g.take = n.take AND g.t >= n.t)"""


_OUT = {
    "speed": "sqrt(vx * vx + vy * vy) / nullif(hand, 0)", "aperture": "aperture", "aperture_slope": "aperture_slope",
    "p": "CASE WHEN L < 1e-6 THEN 0.0 ELSE ((Xs - hx) * ux + (Ys - hy) * uy) / L END", "dp": "CASE WHEN L < 1e-6 THEN 0.0 ELSE (vx * ux + vy * uy) / L END",
    "q": "CASE WHEN L < 1e-6 THEN 0.0 ELSE ((Ys - hy) * ux - (Xs - hx) * uy) / nullif(hand, 0) END", "dq": "CASE WHEN L < 1e-6 THEN 0.0 ELSE (vy * ux - vx * uy) / nullif(hand, 0) END",
    "ydev": "-(Ys - hy) / nullif(hand, 0)", "dy": "-vy / nullif(hand, 0)",
}
_GAP = {c: _filled(f"{c}_") for c in CHANNELS}
SIGNALS = f"""
{_FRAMES},
d AS (SELECT take, frame_idx, t, CASE WHEN detected THEN i0_x END * 1920 AS x0, CASE WHEN detected THEN i0_y END * 1080 AS y0,
  sqrt(pow((i0_x - i9_x) * 1920, 2) + pow((i0_y - i9_y) * 1080, 2)) AS h0, detected,
  sqrt(pow(w4_x - w8_x, 2) + pow(w4_y - w8_y, 2) + pow(w4_z - w8_z, 2)) / nullif(sqrt(pow(w0_x - w9_x, 2) + pow(w0_y - w9_y, 2) + pow(w0_z - w9_z, 2)), 0) AS a0 FROM usable WHERE t IS NOT NULL),
n0 AS (SELECT take, frame_idx, t, CASE WHEN abs(x0) < 'inf'::DOUBLE THEN x0 END AS X, CASE WHEN abs(y0) < 'inf'::DOUBLE THEN y0 END AS Y,
  CASE WHEN detected AND abs(a0) < 'inf'::DOUBLE THEN a0 END AS ap, CASE WHEN detected AND h0 < 'inf'::DOUBLE THEN h0 END AS hand FROM d),
n1 AS (SELECT *, lag(t, 2) OVER w AS a0, lag(t) OVER w AS a1, lead(t) OVER w AS a2, lead(t, 2) OVER w AS a3, {', '.join(f"lag({c}, 2) OVER w AS {c}_0, lag({c}) OVER w AS {c}_1, lead({c}) OVER w AS {c}_2, lead({c}, 2) OVER w AS {c}_3" for c in CHANNELS)} FROM n0 WINDOW w AS (PARTITION BY take ORDER BY frame_idx)),
nat AS (SELECT take, frame_idx, t, hand, {', '.join(f"coalesce({c}, {_GAP[c]}) AS {c}" for c in CHANNELS)}, {' OR '.join(f"({c} IS NULL AND {_GAP[c]} IS NOT NULL)" for c in CHANNELS)} AS was_gap FROM n1),
bounds AS (SELECT take, min(t) AS t0, max(t) AS t1, CAST(floor((max(t) - min(t) + 1e-9) * 30) AS BIGINT) AS last_idx FROM nat GROUP BY take),
points AS (SELECT take, CAST(i AS BIGINT) AS sample_idx, last_idx, t0, t0 + i / 30.0::DOUBLE AS t FROM (SELECT *, unnest(generate_series(0, last_idx)) AS i FROM bounds)),
{','.join(_channel(c) for c in CHANNELS)},
times AS (SELECT take, t, bool_or(was_gap) AS was_gap FROM nat GROUP BY take, t),
gaps AS (SELECT g.take, g.sample_idx, g.t > g.t0 AND n.was_gap AS flag FROM points g ASOF LEFT JOIN times n ON g.take = n.take AND g.t <= n.t),
grid AS (SELECT take, sample_idx, last_idx, t, X, Y, ap, X IS NULL OR Y IS NULL OR ap IS NULL AS missing, coalesce(flag, false) AND NOT (X IS NULL OR Y IS NULL OR ap IS NULL) AS interpolated
  FROM points {' '.join(f"JOIN g_{c} USING (take, sample_idx)" for c in CHANNELS)} JOIN gaps USING (take, sample_idx)),
{_by_index("whole", "grid", list(CHANNELS), "take, sample_idx, last_idx, t, missing, interpolated")},
sm AS (SELECT take, sample_idx, t, missing, interpolated, {_savgol("X_full", 0)} AS Xs, {_savgol("Y_full", 0)} AS Ys, {_savgol("X_full", 1)} AS vx, {_savgol("Y_full", 1)} AS vy, {_savgol("ap_full", 0)} AS aperture, {_savgol("ap_full", 1)} AS aperture_slope FROM whole WINDOW x AS (PARTITION BY take ORDER BY sample_idx)),
hands AS (SELECT take, median(hand) AS hand FROM nat WHERE hand IS NOT NULL GROUP BY take),
home AS (SELECT take, median(Xs) AS hx, median(Ys) AS hy FROM (SELECT *, row_number() OVER (PARTITION BY take ORDER BY sample_idx) AS r FROM sm WHERE NOT missing) WHERE r <= 15 GROUP BY take),
dists AS (SELECT sm.*, sqrt(pow(Xs - hx, 2) + pow(Ys - hy, 2)) AS dist FROM sm JOIN home USING (take) WHERE NOT missing),
ranks AS (SELECT take, list_sort(list(dist)) AS s, round(0.9::DOUBLE * (count(dist) - 1), 9) AS place FROM dists WHERE dist IS NOT NULL GROUP BY take),
reach AS (SELECT take, s[CAST(floor(place) AS BIGINT) + 1] + (s[least(CAST(floor(place) AS BIGINT) + 2, len(s))] - s[CAST(floor(place) AS BIGINT) + 1]) * (place - floor(place)) AS reach FROM ranks),
far AS (SELECT take, avg(Xs) AS fx, avg(Ys) AS fy FROM dists JOIN reach USING (take) WHERE dist >= reach GROUP BY take),
sc0 AS (SELECT take, hx, hy, fx, fy, hand, sqrt(pow(fx - hx, 2) + pow(fy - hy, 2)) AS L FROM home JOIN far USING (take) JOIN hands USING (take)),
sc AS (SELECT *, (fx - hx) / nullif(L, 0) AS ux, (fy - hy) / nullif(L, 0) AS uy FROM sc0),
sig AS (SELECT take, sample_idx, t, {', '.join(f"CASE WHEN NOT missing THEN {e} END AS {c}" for c, e in _OUT.items())}, missing, interpolated FROM sm LEFT JOIN sc USING (take))"""


@query(f"WITH {SIGNALS} SELECT take, sample_idx, {_round(['t', *S.BASE], 6)}, missing, interpolated FROM sig")
def motion_signals(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.signals(spark, d), 6, ["t", *S.BASE])


# ---- features, labels, probabilities ----
def _features_sql() -> str:
    full = _by_index("fb", "sig", S.BASE, "take, sample_idx, t, missing")
    base = ", ".join((f"sqrt(greatest(coalesce({c}_full, 0.0), 0.0))" if c == "speed" else f"coalesce({c}_full, 0.0)") + f" AS {c}" for c in S.BASE)
    frame = lambda a, b: f"(PARTITION BY take ORDER BY sample_idx ROWS BETWEEN {a} PRECEDING AND {b} FOLLOWING)"
    out = [f"{c}, " + ", ".join(f"avg({c}) OVER {frame(n, n)} AS {c}_m{n}" for n in S.MEAN_WINDOWS) for c in S.BASE]
    out += [f"avg({c}) OVER {frame(0, n - 1)} - avg({c}) OVER {frame(n - 1, 0)} AS {c}_trend{n}" for c in S.TREND_CHANNELS for n in S.TREND_WINDOWS]
    out += [f"max(speed) OVER {frame(8, 8)} AS speed_max8", f"coalesce(stddev_samp(speed) OVER {frame(8, 8)}, 0.0) AS speed_std8", f"min(aperture) OVER {frame(20, 20)} AS ap_min20", "missing"]
    return f"{full}, fc AS (SELECT take, sample_idx, t, CAST(missing AS DOUBLE) AS missing, {base} FROM fb), feat AS (SELECT take, sample_idx, t, {', '.join(out)} FROM fc)"


FEATURES = _features_sql()
NAMES = S.feature_names()


@query(f"WITH {SIGNALS}, {FEATURES} SELECT take, sample_idx, {_round(['t', *NAMES], 5)} FROM feat")
def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(S.build_features(materialize(P.signals(spark, d), "signals")), 5, ["t", *NAMES])


TRUTH_AT = "ts AS (SELECT *, start_s = max(start_s) OVER (PARTITION BY take) AS is_last FROM truth)"


@query(f"WITH {SIGNALS}, {C.TRUTH}, {TRUTH_AT} SELECT take, sample_idx, label, round(start_s, 6) AS start_s FROM (SELECT s.take, s.sample_idx, q.label, q.start_s FROM sig s JOIN ts q ON s.take = q.take AND {C.LABEL_AT.format(p='s', s='q')})")
def training_labels(spark: SparkSession, d: str) -> DataFrame:
    """Samples with the hand label that holds at their time, as the classifiers are trained on."""
    seg = R.with_last_flag(C.truth(spark, d).select("take", "label", "start_s", "end_s"), ["take"], "start_s")
    rows = P.labelled_samples(P.signals(spark, d), C.truth(spark, d)).select("take", "sample_idx", "t", "label")
    starts = R.range_join(rows.drop("label"), seg, ["take"], "t", how="inner")
    return starts.select("take", "sample_idx", "label", F.round("start_s", 6).alias("start_s"))


def fixed_model() -> M.Logistic:
    """Weights by a rule: small, and different for each pair of feature and label."""
    n, k = len(NAMES), len(LABELS)
    weights = np.array([[((7 * j + 11 * i + j * i) % 13 - 6) / 40 for i in range(k)] for j in range(n)] + [[(3 * i) % 5 / 4 for i in range(k)]])
    return M.Logistic(np.zeros(n), np.ones(n), weights)


def stored_model() -> M.Logistic:
    """The fixed model saved, and loaded by its hash, as a stored model is. The file is the driver's own and gone afterwards; executors get the model by broadcast."""
    with tempfile.TemporaryDirectory() as folder:
        M.save(fixed_model(), Path(folder, "model.npz"), note="fixed")
        return M.load(Path(folder, "model.npz"))[0]


def fixed_posteriors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Class probabilities by the fixed model, and the signals."""
    sig = materialize(P.signals(spark, d), "signals")
    return materialize(P.segment_posteriors(S.build_features(sig), stored_model()), "posteriors"), sig


def _posterior_sql() -> str:
    w = fixed_model().weights
    scores = ", ".join(" + ".join([f"{float(w[-1, i])!r}::DOUBLE", *[f"{float(w[j, i])!r}::DOUBLE * {c}" for j, c in enumerate(NAMES)]]) + f" AS s_{x}" for i, x in enumerate(LABELS))
    top = "greatest(" + ", ".join(f"s_{x}" for x in LABELS) + ")"
    total = " + ".join(f"exp(s_{x} - top)" for x in LABELS)
    return f"fs AS (SELECT take, sample_idx, t, {scores} FROM feat), ft AS (SELECT *, {top} AS top FROM fs), post AS (SELECT take, sample_idx, t, {', '.join(f'exp(s_{x} - top) / ({total}) AS p_{x}' for x in LABELS)} FROM ft)"


def _smoothed_sql(n: int) -> str:
    return "smooth AS (SELECT take, sample_idx, t, " + ", ".join(f"avg(p_{x}) OVER w AS p_{x}" for x in LABELS) + f" FROM post WINDOW w AS (PARTITION BY take ORDER BY sample_idx ROWS BETWEEN {n // 2} PRECEDING AND {n // 2} FOLLOWING))"


POSTERIORS = _posterior_sql()
_MOST = "greatest(" + ", ".join(f"p_{x}" for x in LABELS) + ")"
_LIKELIEST = "CASE " + " ".join(f"WHEN p_{x} = {_MOST} THEN '{x}'" for x in LABELS) + " END"
_CHOSEN = "CASE label " + " ".join(f"WHEN '{x}' THEN p_{x}" for x in LABELS) + " END"
_P = [f"p_{x}" for x in LABELS]


@query(f"WITH {SIGNALS}, {FEATURES}, {POSTERIORS} SELECT take, sample_idx, {_round(_P, 6)} FROM post")
def model_probs(spark: SparkSession, d: str) -> DataFrame:
    """Probabilities of a stored model for every sample."""
    return rounded(fixed_posteriors(spark, d)[0].drop("t"), 6, _P)


@query(f"WITH {SIGNALS}, {FEATURES}, {POSTERIORS}, {_smoothed_sql(5)} SELECT take, sample_idx, {_round(_P, 6)} FROM smooth")
def smooth_probs(spark: SparkSession, d: str) -> DataFrame:
    return rounded(G.smoothed_posteriors(fixed_posteriors(spark, d)[0], 5).drop("t"), 6, _P)


def _runs_sql(source: str, name: str, label: str) -> str:
    return f"""{name}_n AS (SELECT *, sum(CASE WHEN {label} IS NOT DISTINCT FROM before AND rn > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY take ORDER BY sample_idx ROWS UNBOUNDED PRECEDING) - 1 AS island
  FROM (SELECT *, row_number() OVER w AS rn, lag({label}) OVER w AS before FROM {source} WINDOW w AS (PARTITION BY take ORDER BY sample_idx)))"""


_EVENTS_OF = f"""{_runs_sql("lab", "ev", "label")},
ends AS (SELECT take, max(t) AS t_end FROM sig GROUP BY take),
runs AS (SELECT take, CAST(island AS BIGINT) AS event_idx, min_by(label, sample_idx) AS label, min(t) AS start_s, count(*) AS n_samples, sum({_CHOSEN}) / count(*) AS mean_confidence FROM ev_n GROUP BY take, island),
found AS (SELECT *, coalesce(lead(start_s) OVER (PARTITION BY take ORDER BY event_idx), t_end) AS end_s FROM runs JOIN ends USING (take))"""
_EVENT_COLUMNS = "take, event_idx, label, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, round(end_s - start_s, 6) + 0.0::DOUBLE AS duration_s, n_samples, round(mean_confidence, 6) AS mean_confidence, 1::BIGINT AS labels_in_event"
ARGMAX = f"""{_smoothed_sql(5)}, likely AS (SELECT *, {_LIKELIEST} AS first_label FROM smooth),
{_runs_sql("likely", "lk", "first_label")},
short AS (SELECT take, island, min_by(first_label, sample_idx) AS l, count(*) AS n FROM lk_n GROUP BY take, island),
absorbed AS (SELECT take, island, last_value(CASE WHEN n >= 6 OR island = 0 THEN l END IGNORE NULLS) OVER (PARTITION BY take ORDER BY island ROWS UNBOUNDED PRECEDING) AS label FROM short),
lab AS (SELECT lk_n.* EXCLUDE (rn, before, island), absorbed.label FROM lk_n JOIN absorbed USING (take, island)), {_EVENTS_OF}"""


@query(f"WITH {SIGNALS}, {FEATURES}, {POSTERIORS}, {ARGMAX} SELECT {_EVENT_COLUMNS} FROM found")
def argmax_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Events of the stored model's probabilities: likeliest label, short runs absorbed."""
    return rounded(P.segment_frames(P.usable_frames(spark, d), stored_model(), decode=G.decode_argmax), 6, ["start_s", "end_s", "duration_s", "mean_confidence"])


@query(f"""WITH {SIGNALS}, {FEATURES}, {POSTERIORS}, {ARGMAX}, {C.TRUTH}, {TRUTH_AT},
held AS (SELECT s.*, l.label AS predicted_label, q.label AS true_label FROM sig s JOIN lab l USING (take, sample_idx) JOIN ts q ON s.take = q.take AND {C.LABEL_AT.format(p='s', s='q')})
SELECT take, true_label AS label, count(*) AS n_samples, round(avg(CASE WHEN predicted_label = true_label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 3) AS agreement FROM held WHERE NOT missing GROUP BY take, true_label""")  # fmt: skip
def q5_samples(spark: SparkSession, d: str) -> DataFrame:
    """The fifth named query over the served 30 Hz samples with their decoded labels."""
    post, sig = fixed_posteriors(spark, d)
    events = R.with_last_flag(G.decode_argmax(post, P.take_ends(sig)).select("take", "event_idx", "label", "start_s", "end_s"), ["take"], "event_idx")
    decoded = R.range_join(sig, events, ["take"], "t", relative=False).withColumnRenamed("label", "predicted_label").drop("event_idx", "start_s", "end_s", "is_last")
    return agreement(serve_signals(decoded, C.truth(spark, d)))


def _viterbi_sql() -> str:
    """Scores forward only: the best path's is the greatest at a take's last sample."""
    move = lambda a, b: 0.0 if a == b else -4.0 if PROTOCOL[a] == b else -12.0
    logs = ", ".join(f"ln(greatest(p_{x}, 1e-4)) AS l_{x}" for x in LABELS)
    first = ", ".join(f"l_{x} AS v_{x}" for x in LABELS)
    step = ", ".join("greatest(" + ", ".join(f"v.v_{a} + {move(a, b)!r}::DOUBLE" for a in LABELS) + f") + g.l_{b}" for b in LABELS)
    top = "greatest(" + ", ".join(f"v_{x}" for x in LABELS) + ")"
    return f"""{_smoothed_sql(3)}, lg AS (SELECT take, sample_idx, {logs} FROM smooth),
vit AS (SELECT take, sample_idx, {first} FROM lg WHERE sample_idx = 0 UNION ALL SELECT g.take, g.sample_idx, {step} FROM vit v JOIN lg g ON g.take = v.take AND g.sample_idx = v.sample_idx + 1)
SELECT take, round({top}, 5) AS score FROM (SELECT *, sample_idx = max(sample_idx) OVER (PARTITION BY take) AS final FROM vit) WHERE final"""


@query(f"WITH RECURSIVE {SIGNALS}, {FEATURES}, {POSTERIORS}, {_viterbi_sql()}")
def viterbi_score(spark: SparkSession, d: str) -> DataFrame:
    """The score of the path that the grammar decoder takes: no other path has a greater one."""
    post, sig = fixed_posteriors(spark, d)
    s = G.smoothed_posteriors(post, 3)
    path = R.range_join(s, R.with_last_flag(G.decode_grammar(post, P.take_ends(sig)).select("take", "event_idx", "label", "start_s", "end_s"), ["take"], "event_idx"), ["take"], "t", relative=False)
    chosen = F.element_at(F.create_map(*[v for x in LABELS for v in (F.lit(x), F.log(F.greatest(F.col(f"p_{x}"), F.lit(1e-4))))]), F.col("label"))
    before = F.lag("label").over(Window.partitionBy("take").orderBy("sample_idx"))
    rows = path.select("take", chosen.alias("own"), F.col("label"), before.alias("before"))
    cost = F.when(F.col("before").isNull() | (F.col("before") == F.col("label")), 0.0).when(R.lookup(PROTOCOL, F.col("before")) == F.col("label"), -4.0).otherwise(-12.0)
    return rows.groupBy("take").agg(F.round(F.sum(F.col("own") + cost), 5).alias("score"))


def _pelt_sql(channels: list[str], penalty: float, size: int) -> str:
    """Exact optimal partitioning over all last changepoints, without pruning: ``(take, cost)`` of ``pc (take, i, *channels)`` with i from 0."""
    square = " + ".join(f"{c} * {c}" for c in channels)
    sums = ", ".join(f"list_prepend(0.0::DOUBLE, list(s_{c} ORDER BY i)) AS s_{c}" for c in channels)
    running = ", ".join(f"sum({c}) OVER w AS s_{c}" for c in channels)
    between = " + ".join(f"pow(ps.s_{c}[v.n + 2] - ps.s_{c}[z + 1], 2)" for c in channels)
    cost = f"v.best[z + 1] + (ps.s2[v.n + 2] - ps.s2[z + 1]) - ({between}) / (v.n + 1 - z) + {penalty!r}::DOUBLE"
    # best[z + 1] is the cost of the first z samples, those too few to make up segments cost infinitely
    return f"""cum AS (SELECT take, i, sum({square}) OVER w AS s2, {running} FROM pc WINDOW w AS (PARTITION BY take ORDER BY i ROWS UNBOUNDED PRECEDING)),
ps AS (SELECT take, count(*) AS total, list_prepend(0.0::DOUBLE, list(s2 ORDER BY i)) AS s2, {sums} FROM cum GROUP BY take),
dp AS (SELECT take, CAST(0 AS BIGINT) AS n, [{-penalty!r}::DOUBLE] AS best FROM ps
  UNION ALL SELECT v.take, v.n + 1, list_append(v.best, coalesce(list_min([{cost} FOR z IN range(0, v.n + 1 - {size} + 1)]), 'inf'::DOUBLE)) FROM dp v JOIN ps ON ps.take = v.take WHERE v.n < ps.total)
SELECT dp.take, round(dp.best[dp.n + 1], 4) + 0.0::DOUBLE AS cost FROM dp JOIN ps ON ps.take = dp.take AND dp.n = ps.total WHERE dp.n >= {size}"""


def segment_cost(marked: DataFrame, channels: list[str], penalty: float) -> DataFrame:
    """Squared deviations within segments plus the penalty per changepoint, per take."""
    per = marked.groupBy("take", "segment").agg(*[F.var_pop(c).alias(c) for c in channels], F.count(F.lit(1)).alias("n"))
    return per.groupBy("take").agg(F.round(F.sum(F.col("n") * sum(F.col(c) for c in channels)) + penalty * (F.count(F.lit(1)) - 1), 4).alias("cost"))


@query(f"WITH RECURSIVE {SIGNALS}, {FEATURES}, {POSTERIORS}, {_smoothed_sql(5)}, pc AS (SELECT take, sample_idx AS i, {', '.join(_P)} FROM smooth), {_pelt_sql(_P, 1.0, 3)}")
def pelt_cost(spark: SparkSession, d: str) -> DataFrame:
    """What the changepoints of the probabilities cost: no other set costs less."""
    post, _ = fixed_posteriors(spark, d)
    marked = G.changepoints(G.smoothed_posteriors(post, 5), "sample_idx", _P, 1.0)
    held = marked.groupBy("take").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3").select("take")
    return segment_cost(marked.join(held, "take", "left_semi"), _P, 1.0)


_RULE_FULL = _by_index("rf", "sig", ["speed", "aperture", "p"], "take, sample_idx, t, missing")
_SCALED = f"SELECT take, row_number() OVER (PARTITION BY take ORDER BY sample_idx) - 1 AS i, sqrt(greatest(speed_full, 0.0)) / {TUNED.speed_scale!r}::DOUBLE AS c0, aperture_full / {TUNED.ap_scale!r}::DOUBLE AS c1 FROM rf WHERE speed_full IS NOT NULL"


@query(f"WITH RECURSIVE {SIGNALS}, {_RULE_FULL}, pc AS ({_SCALED}), {_pelt_sql(['c0', 'c1'], TUNED.pen, max(2, round(TUNED.min_size_s * 30)))}")
def rule_cost(spark: SparkSession, d: str) -> DataFrame:
    """What the changepoints of speed and aperture cost: no other set costs less."""
    marked = materialize(P.rule_segments(materialize(P.signals(spark, d), "signals")), "segments")
    size = P.rule_size(TUNED)
    held = marked.groupBy("take").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= size).select("take")
    return segment_cost(marked.join(held, "take", "left_semi"), ["c0", "c1"], TUNED.pen)


# ---- segments ----
RULE_SEGMENTS = f"""{C.EVENTS}, {C.DISJOINT}, {_RULE_FULL},
sl AS (SELECT *, start_s = max(start_s) OVER (PARTITION BY take) AS is_last FROM dis),
sd AS (SELECT r.*, s.event_idx AS segment FROM rf r JOIN sl s ON r.take = s.take AND {C.LABEL_AT.format(p='r', s='s')} WHERE speed_full IS NOT NULL),
so AS (SELECT *, row_number() OVER (PARTITION BY take, segment ORDER BY sample_idx) AS h, row_number() OVER (PARTITION BY take, segment ORDER BY sample_idx DESC) AS e FROM sd),
sf AS (SELECT take, segment, min(sample_idx) AS first, min(t) AS start_s, count(*) AS n_samples, avg(speed_full) AS mean_speed, avg(aperture_full) AS mean_aperture, avg(p_full) AS p_mean,
  median(p_full) FILTER (e <= 3) - median(p_full) FILTER (h <= 3) AS dp, median(aperture_full) FILTER (e <= 3) - median(aperture_full) FILTER (h <= 3) AS d_ap, avg(CAST(missing AS DOUBLE)) AS frac_missing FROM so GROUP BY take, segment)"""
_SEGMENT_VALUES = ["start_s", "mean_speed", "mean_aperture", "p_mean", "dp", "d_ap", "frac_missing"]


def _segment_features(spark: SparkSession, d: str) -> DataFrame:
    sig = materialize(P.signals(spark, d), "signals")
    full = P.rule_channels(sig)
    seg = R.with_last_flag(C.disjoint_events(spark, d).select("take", F.col("event_idx").alias("segment"), "start_s", "end_s"), ["take"], "start_s")
    return G.segment_features(R.range_join(full, seg, ["take"], "t", how="inner").drop("start_s", "end_s", "is_last"))


@query(f"WITH {SIGNALS}, {RULE_SEGMENTS} SELECT take, segment, first, n_samples, {_round(_SEGMENT_VALUES, 6)} FROM sf")
def segment_features(spark: SparkSession, d: str) -> DataFrame:
    """The features of given segments (the detected phases) that the rule labeller reads."""
    return rounded(_segment_features(spark, d), 6, _SEGMENT_VALUES)


def _rule_sql() -> str:
    r = TUNED
    way = lambda tie: f"CASE WHEN c.dp < {-r.dp_min!r} THEN 'RETRACT' WHEN c.dp > {r.dp_min!r} THEN 'REACH' ELSE '{tie}' END"
    rule = f"""CASE WHEN c.mean_speed > {r.moving_thr!r} THEN CASE WHEN c.dp < 0 THEN 'RETRACT' ELSE 'REACH' END
  WHEN c.p_mean < {r.p_home!r} THEN CASE WHEN c.mean_speed < {r.still_thr!r} THEN 'REST' ELSE {way("REST")} END
  WHEN c.p_mean <= {r.p_far!r} THEN CASE WHEN {{b}} IN ('REACH', 'RETRACT') THEN {{b}} ELSE {way("REACH")} END
  WHEN abs(c.d_ap) > {r.ap_delta!r} THEN CASE WHEN c.d_ap < 0 THEN 'GRASP' ELSE 'RELEASE' END
  WHEN c.mean_aperture < {r.ap_closed!r} THEN CASE WHEN c.mean_speed < {r.still_thr!r} THEN 'HOLD' ELSE 'GRASP' END
  WHEN {{b}} IN ('HOLD', 'RELEASE') THEN 'RELEASE' ELSE 'REACH' END"""
    return f"""sk AS (SELECT *, row_number() OVER (PARTITION BY take ORDER BY segment) AS k FROM sf),
rl AS (SELECT c.take, c.segment, c.k, {rule.format(b="NULL::VARCHAR")} AS label FROM sk c WHERE k = 1 UNION ALL SELECT c.take, c.segment, c.k, {rule.format(b="b.label")} FROM rl b JOIN sk c ON c.take = b.take AND c.k = b.k + 1)
SELECT take, segment, label FROM rl"""


@query(f"WITH RECURSIVE {SIGNALS}, {RULE_SEGMENTS}, {_rule_sql()}")
def rule_labels(spark: SparkSession, d: str) -> DataFrame:
    """Given segments labelled in order by the tuned rules."""
    return G.label_segments(_segment_features(spark, d), TUNED).select("take", "segment", "label")


# ---- scores ----
def _match_sql(name: str, pred: str, true: str) -> str:
    """CTEs ``{name} (take, scope, n, e)``: most pairs within the tolerance and their least total error, of boundaries ``take, scope, b``.

    A prefix table per group of neighbouring boundaries, one predicted boundary at a time: each cell
    is 1000 for a pair, less the errors.
    """
    reach = BOUNDARY_TOLERANCE_S + EPS
    return f"""{name}_u AS (SELECT take, scope, b, 0 AS side FROM {pred} UNION ALL SELECT take, scope, b, 1 FROM {true}),
{name}_g AS (SELECT *, sum(CASE WHEN b - before <= {reach!r} THEN 0 ELSE 1 END) OVER (PARTITION BY take, scope ORDER BY b, side ROWS UNBOUNDED PRECEDING) AS part FROM (SELECT *, lag(b) OVER (PARTITION BY take, scope ORDER BY b, side) AS before FROM {name}_u)),
{name}_l AS (SELECT take, scope, part, list_sort(list(b) FILTER (side = 0)) AS p, list_sort(list(b) FILTER (side = 1)) AS t FROM {name}_g GROUP BY take, scope, part HAVING count(*) FILTER (side = 0) > 0 AND count(*) FILTER (side = 1) > 0),
{name}_d AS (SELECT take, scope, part, 0 AS i, [0.0::DOUBLE FOR x IN t] AS cells FROM {name}_l
  UNION ALL SELECT l.take, l.scope, l.part, v.i + 1, [list_max([greatest(v.cells[k], CASE WHEN abs(l.p[v.i + 1] - l.t[k]) <= {reach!r} THEN (CASE WHEN k > 1 THEN v.cells[k - 1] ELSE 0.0 END) + 1000.0 - abs(l.p[v.i + 1] - l.t[k]) ELSE 0.0 END) FOR k IN range(1, j + 1)]) FOR j IN range(1, len(l.t) + 1)]
  FROM {name}_d v JOIN {name}_l l ON l.take = v.take AND l.scope = v.scope AND l.part = v.part WHERE v.i < len(l.p)),
{name}_b AS (SELECT d.take, d.scope, d.cells[len(d.cells)] AS best FROM {name}_d d JOIN {name}_l l ON l.take = d.take AND l.scope = d.scope AND l.part = d.part AND d.i = len(l.p)),
{name} AS (SELECT take, scope, CAST(sum(ceil(best / 1000)) AS BIGINT) AS n, sum(1000 * ceil(best / 1000) - best) AS e FROM {name}_b GROUP BY take, scope)"""


_CYCLE = "'cycle' || CAST(cycle AS VARCHAR)"
BOUNDARY = f"""
cyc AS (SELECT take, {_CYCLE} AS scope, min(start_s) AS a, max(end_s) AS z FROM truth GROUP BY take, cycle),
tb AS (SELECT take, cycle, start_s AS b FROM (SELECT *, min(start_s) OVER (PARTITION BY take) AS f FROM truth) WHERE start_s > f),
pb AS (SELECT take, start_s AS b FROM (SELECT *, min(start_s) OVER (PARTITION BY take) AS f FROM dis) WHERE start_s > f),
tr AS (SELECT take, 'all' AS scope, b FROM tb UNION ALL SELECT take, {_CYCLE}, b FROM tb),
pr AS (SELECT take, 'all' AS scope, b FROM pb UNION ALL SELECT pb.take, scope, b FROM pb JOIN cyc ON pb.take = cyc.take AND b >= a AND b < z),
spans AS (SELECT take, min(start_s) AS t0, max_by(end_s, start_s) AS t1 FROM truth GROUP BY take),
scopes AS (SELECT take, scope, t0, t1 FROM (SELECT take, 'all' AS scope FROM spans UNION ALL SELECT take, scope FROM cyc) JOIN spans USING (take)),
counts AS (SELECT take, scope, t0, t1, (SELECT count(*) FROM tr WHERE tr.take = s.take AND tr.scope = s.scope) AS nt, (SELECT count(*) FROM pr WHERE pr.take = s.take AND pr.scope = s.scope) AS np FROM scopes s),
even AS (SELECT take, scope, t0 + (t1 - t0) * i / (np + 1) AS b FROM (SELECT *, unnest(range(1, np + 1)) AS i FROM counts)),
{_match_sql("mt", "pr", "tr")}, {_match_sql("un", "even", "tr")},
bm AS (SELECT take, scope, nt AS n_true, np AS n_pred, coalesce(mt.n, 0) AS n_matched, mt.e AS err, coalesce(un.n, 0) AS by_chance FROM counts LEFT JOIN mt USING (take, scope) LEFT JOIN un USING (take, scope))"""
_BOUNDARY_COLUMNS = """n_true, n_pred, n_matched, round(n_matched / nullif(n_true, 0), 6) AS recall, round(n_matched / nullif(n_pred, 0), 6) AS precision, round(CASE WHEN n_matched > 0 THEN err / n_matched END, 6) AS mae_matched_s,
n_true - n_matched AS missed, n_pred - n_matched AS false_boundaries, round(CASE WHEN n_pred = 0 THEN 0.0 ELSE by_chance / nullif(n_true, 0) END, 6) AS chance_uniform_recall, round(by_chance / nullif(n_pred, 0), 6) AS chance_uniform_precision"""
_BOUNDARY_VALUES = ["recall", "precision", "mae_matched_s", "chance_uniform_recall", "chance_uniform_precision"]
_HEAD = f"WITH RECURSIVE {C.PAIRS},"


@query(f"{_HEAD} {BOUNDARY} SELECT take, scope, {_BOUNDARY_COLUMNS} FROM bm")
def boundary_match(spark: SparkSession, d: str) -> DataFrame:
    """Boundary scores with the chance baseline of even boundaries, per take and cycle; that of random ones is in chance_baselines."""
    out = boundary_metrics(C.disjoint_events(spark, d), C.truth(spark, d))
    return rounded(out.drop("chance_random_recall", "chance_random_precision"), 6, _BOUNDARY_VALUES)


_OK = "predicted_label IS NOT NULL AND true_label IS NOT NULL"
_HIT = f"CASE WHEN {_OK} THEN CAST(predicted_label = true_label AS DOUBLE) END"
_PER = ", ".join(f"avg(CASE WHEN predicted_label IS NOT NULL AND true_label = '{x}' THEN CAST(predicted_label = true_label AS DOUBLE) END) AS acc_{x}, count(*) FILTER (predicted_label IS NOT NULL AND true_label = '{x}') AS n_{x}" for x in LABELS)
_ACCS = ", ".join(f"acc_{x}" for x in LABELS)
_FRAME_VALUES = ["frame_accuracy", *[f"acc_{x}" for x in LABELS], "balanced_accuracy", "majority_baseline", "tolerant_accuracy"]
FULL = f"""{BOUNDARY},
auto AS (SELECT lower(trim(take)) AS take, start_s - 1e-9 AS a, end_s - 1e-9 AS b FROM label_segments WHERE source = 'auto' AND start_s IS NOT NULL AND end_s IS NOT NULL AND NOT isnan(start_s) AND NOT isnan(end_s)),
fl AS (SELECT p.*, EXISTS (SELECT 1 FROM auto WHERE auto.take = p.take AND p.t >= a AND p.t < b) AS out_of_frame FROM pairs p),
scf AS (SELECT *, CASE WHEN out_of_frame THEN 'out_of_frame' ELSE 'all' END AS scope FROM fl UNION ALL SELECT fl.*, cyc.scope FROM fl JOIN cyc ON fl.take = cyc.take AND t >= a AND t < z + 1e-9 WHERE NOT out_of_frame),
bo AS (SELECT take, {_CYCLE} AS own, b, before, label AS after FROM (SELECT take, cycle, start_s AS b, label, lag(label) OVER (PARTITION BY take ORDER BY start_s) AS before FROM truth) WHERE before IS NOT NULL),
tol AS (SELECT take, scope, avg(CASE WHEN {_OK} THEN CAST(predicted_label = true_label OR EXISTS (SELECT 1 FROM bo WHERE bo.take = s.take AND (s.scope = 'all' OR s.scope = own) AND abs(s.t - b) <= {BOUNDARY_TOLERANCE_S + EPS!r} AND (predicted_label = before OR predicted_label = after)) AS DOUBLE) END) AS tolerant_accuracy
  FROM scf s WHERE scope <> 'out_of_frame' GROUP BY take, scope),
fm AS (SELECT take, scope, count(*) FILTER ({_OK}) AS n_frames, count(*) FILTER (NOT ({_OK})) AS n_unlabelled, avg({_HIT}) AS frame_accuracy, {_PER} FROM scf GROUP BY take, scope),
fb AS (SELECT *, list_avg([v FOR v IN [{_ACCS}] IF v IS NOT NULL]) AS balanced_accuracy, greatest({', '.join(f"n_{x}" for x in LABELS)}) / nullif(n_frames, 0) AS majority_baseline FROM fm),
fs AS (SELECT * REPLACE (coalesce(n_frames, 0) AS n_frames, coalesce(n_unlabelled, 0) AS n_unlabelled, {', '.join(f"coalesce(n_{x}, 0) AS n_{x}" for x in LABELS)}) FROM fb FULL JOIN bm USING (take, scope) LEFT JOIN tol USING (take, scope))"""
_COUNTED = ["n_true", "n_pred", "n_matched", "missed", "false_boundaries"]


@query(f"{_HEAD} {FULL} SELECT take, scope, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _COUNTED)}, {', '.join(f'{c}' for c in _BOUNDARY_VALUES)}, n_frames, n_unlabelled, {', '.join(f'n_{x}' for x in LABELS)}, {_round(_FRAME_VALUES, 6)} FROM (SELECT take, scope, {_BOUNDARY_COLUMNS}, n_frames, n_unlabelled, {', '.join(f'n_{x}' for x in LABELS)}, {', '.join(_FRAME_VALUES)} FROM fs)")
def event_scores(spark: SparkSession, d: str) -> DataFrame:
    """All scores of the detected phases but the random baselines, with the automatic labels as intervals out of frame."""
    away = table(spark, d, "label_segments").filter((F.col("source") == "auto") & ~missing(F.col("start_s")) & ~missing(F.col("end_s"))).withColumn("take", F.lower(F.trim("take")))
    out = full_scores(S.build_frames(table(spark, d, "raw_keypoints")), C.disjoint_events(spark, d), C.truth(spark, d), None, away)
    return rounded(out.drop("take_group", "tolerance_s", "chance_random_recall", "chance_random_precision"), 6, [*_BOUNDARY_VALUES, *_FRAME_VALUES])


@query("""WITH s AS (SELECT DISTINCT * FROM scores_full WHERE scope = 'all'),
o AS (SELECT take_group, round(avg(0.5 * coalesce(2 * recall * precision / nullif(recall + precision, 0), 0.0) + 0.5 * frame_accuracy), 9) AS objective FROM s GROUP BY take_group)
SELECT * FROM o ORDER BY round(objective, 6) DESC, take_group DESC LIMIT 1""")  # fmt: skip
def best_group(spark: SparkSession, d: str) -> DataFrame:
    """The kind of takes with the greatest mean objective, as the best setting of a grid is chosen."""
    rows = table(spark, d, "scores_full").distinct()
    per = objective(rows).join(rows.filter("scope = 'all'").select("take", "take_group"), "take")
    return M.best_setting(per.groupBy("take_group").agg(F.round(F.avg("objective"), 9).alias("objective")), tie="take_group")


@query(f"""WITH {SIGNALS}, {C.EVENTS}, {C.DISJOINT}, {C.FRAMES},
se AS (SELECT dis.*, event_idx = max(event_idx) OVER (PARTITION BY take) AS is_last FROM dis),
a AS (SELECT s.take, s.event_idx, count(*) AS n FROM frames f JOIN se s ON f.take = s.take AND f.t >= s.start_s AND (f.t < s.end_s OR (s.is_last AND f.t <= s.end_s + 1e-9)) GROUP BY ALL),
b AS (SELECT s.take, s.event_idx, avg(speed) AS v, avg(aperture) AS w, avg(CAST(missing AS DOUBLE)) AS m FROM sig f JOIN se s ON f.take = s.take AND f.t >= s.start_s AND (f.t < s.end_s OR (s.is_last AND f.t <= s.end_s + 1e-9)) GROUP BY ALL)
SELECT take, event_idx, label, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, coalesce(n, 0) AS n_frames, round(v, 6) AS mean_speed, round(w, 6) AS mean_aperture, round(m, 6) AS frac_missing, 'given' AS model_version
FROM dis LEFT JOIN a USING (take, event_idx) LEFT JOIN b USING (take, event_idx)""")  # fmt: skip
def serving_events(spark: SparkSession, d: str) -> DataFrame:
    """The serving table of given events: what their frames and samples add up to."""
    ev = C.disjoint_events(spark, d).withColumns({"duration_s": F.col("end_s") - F.col("start_s"), "mean_confidence": F.lit(1.0), "model_version": F.lit("given")})
    out = serve_events(ev, S.build_frames(table(spark, d, "raw_keypoints")), P.signals(spark, d), F.lit(None).cast("string"))
    return rounded(out.drop("take_group", "duration_s", "mean_confidence"), 6, ["start_s", "end_s", "mean_speed", "mean_aperture", "frac_missing"])
