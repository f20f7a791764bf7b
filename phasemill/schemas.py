"""Labels, tolerances and table schemas of the motion pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The closed vocabulary in protocol order, display names, and the allowed successions.
LABELS = ["REST", "REACH", "GRASP", "HOLD", "RELEASE", "RETRACT"]
PHASE_NAMES = {"REST": "At rest", "REACH": "Reaching", "GRASP": "Grasping", "HOLD": "Holding", "RELEASE": "Releasing", "RETRACT": "Returning"}
PROTOCOL = {"REST": "REACH", "REACH": "GRASP", "GRASP": "HOLD", "HOLD": "RELEASE", "RELEASE": "RETRACT", "RETRACT": "REST"}
CYCLE = ["REACH", "GRASP", "HOLD", "RELEASE", "RETRACT", "REST"]

# Grid rate, picture size, landmarks kept, tolerances.
GRID_HZ = 30
FRAME_W, FRAME_H = 1920, 1080
LANDMARKS = [0, 4, 8, 9]
MAX_GAP_FRAMES = 2
BOUNDARY_TOLERANCE_S = 0.10
EPS = 1e-9

# Columns of the serving tables.
EVENT_TABLE = {"take": "string", "take_group": "string", "event_idx": "long", "label": "string", "start_s": "double", "end_s": "double", "duration_s": "double", "n_frames": "long", "mean_speed": "double", "mean_aperture": "double", "mean_confidence": "double", "frac_missing": "double", "model_version": "string"}
SIGNAL_TABLE = {"t": "t_s", "speed": "speed", "aperture": "aperture", "aperture_slope": "aperture_slope", "p": "progress", "dp": "progress_rate", "q": "offaxis", "dq": "offaxis_rate", "ydev": "height", "dy": "vertical_velocity", "missing": "missing", "interpolated": "interpolated", "predicted_label": "predicted_label", "ground_truth_label": "ground_truth_label", "sample_idx": "sample_idx"}
FRAME_PARTS = {0: "wrist", 4: "thumb_tip", 8: "index_tip"}
TAKE_FIGURES = {"frames_extracted": "n_frames", "last_timestamp_s": "duration_s", "mean_fps_from_timestamps": "mean_fps"}
TAKE_TABLE = ["take", "take_group", "n_frames", "duration_s", "mean_fps", "frames_not_detected", "fraction_not_detected", "left_handedness_frames", "n_ground_truth_segments", "n_events"]

_D, _L, _S = T.DoubleType(), T.LongType(), T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


RAW_KEYPOINTS = _struct(take=_S, frame_idx=T.IntegerType(), timestamp_ms=_L, keypoint_id=T.IntegerType(), x=_D, y=_D, z=_D, world_x=_D, world_y=_D, world_z=_D, detected=T.BooleanType(), handedness=_S, handedness_score=_D)
GROUND_TRUTH = _struct(take=_S, cycle=T.IntegerType(), label=_S, start_s=_D, end_s=_D, source=_S)
OUT_OF_FRAME = _struct(take=_S, start_s=_D, end_s=_D, cause=_S)
TAKE_META = _struct(take=_S, frames_extracted=_L, nominal_fps=_D, last_timestamp_s=_D, mean_fps_from_timestamps=_D, frames_not_detected=_L, fraction_not_detected=_D, handedness_counts=_struct(Right=_L, Left=_L))
RUN_LOG = _struct(run_id=_S, run_at=T.TimestampType(), check=_S, status=_S, detail=_S)


# Defaults of signals and rules.
@dataclass(frozen=True)
class SignalParams:
    smooth_win: int = 7
    home_samples: int = 15
    far_quantile: float = 0.90


@dataclass(frozen=True)
class RuleParams:
    """Thresholds of the rule labeller; :data:`TUNED` holds those found on the first two takes."""

    pen: float = 1.0
    speed_scale: float = 1.0
    ap_scale: float = 0.5
    min_size_s: float = 0.1
    still_thr: float = 0.35
    moving_thr: float = 1.0
    p_home: float = 0.25
    p_far: float = 0.6
    ap_closed: float = 0.9
    ap_delta: float = 0.12
    dp_min: float = 0.05


# Tuned thresholds.
TUNED = RuleParams(
    pen=7.1917125256386, speed_scale=1.0, ap_scale=0.8, min_size_s=0.1, still_thr=0.7686120792223263, moving_thr=1.8474126185843054,
    p_home=0.30855223367010287, p_far=0.643912989325173, ap_closed=0.8321638250805338, ap_delta=0.24334939809342243, dp_min=0.03928716354164684,
)
