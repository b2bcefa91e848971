"""The advanced per-event families: statistics, rhythm, spectrum, trajectory, encodings, interaction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, NumericType

from fingertrail.functions.numeric import inverse, over_eps, step, wrap_angle
from fingertrail.functions.phases import any_phase
from fingertrail.operators.features import (arrange_sequences, behavioral_features, movement,
                                            sequence_keys)
from fingertrail.operators.groups import (SESSION, Position, Previous, Quantile, RunningSum, Touches,
                                          split_sessions)
from fingertrail.schema import COLORING_PHASES, EPS

STATISTICS_OF = ["x", "y", "time", "completionPerc"]
STATISTICS = ["mean", "std", "min", "max", "range", "skew", "kurtosis", "q25", "q75", "iqr", "cv"]
SPECTRUM_MIN = 8            # shortest touch with a spectrum
SPECTRUM_MAX = 1_000_000    # longest touch transformed inside one row


def _keys(touches: Touches) -> list[str]:
    return sequence_keys(touches.columns)[0]


def statistical_features(touches: Touches) -> Touches:
    """Moments, range and quartiles of a touch, and the z-score of each event."""
    for name in [c for c in STATISTICS_OF if c in touches.columns]:
        value, at = F.col(name), f"{name}_seq_"
        touches = touches.totals(_keys(touches), **{
            f"{at}mean": F.avg(value), f"{at}std": F.stddev_samp(value), f"{at}min": F.min(value),
            f"{at}max": F.max(value), f"{at}skew": F.skewness(value), f"{at}kurtosis": F.kurtosis(value),
            f"{at}q25": Quantile(value, 0.25), f"{at}q75": Quantile(value, 0.75)})
        touches = touches.with_columns(**{
            f"{at}range": F.col(f"{at}max") - F.col(f"{at}min"),
            f"{at}iqr": F.col(f"{at}q75") - F.col(f"{at}q25"),
            f"{at}cv": over_eps(F.col(f"{at}std"), F.col(f"{at}mean")),
            f"{name}_z_score": over_eps(value - F.col(f"{at}mean"), F.col(f"{at}std"))})
    return touches


def _regularity(std: str, size: str):
    """1 / (1 + std); 1 for a single event."""
    return F.when(F.col(size) > 1, inverse(F.col(std))).otherwise(1.0)


def advanced_temporal_features(touches: Touches) -> Touches:
    """Time steps, rhythm, pauses and the place of each event on the time axis of its touch."""
    keys = _keys(touches)
    rows = (arrange_sequences(touches).running(_time=Previous(F.col("time")))
            .with_columns(time_diff=step("time", "_time"))
            .running(_diff=Previous(F.col("time_diff")))
            .totals(keys, _n=F.count(F.lit(1)), _mean=F.avg("time_diff"), _std=F.stddev_samp("time_diff"),
                    _t0=F.min("time"), _t1=F.max("time"))
            .with_columns(is_pause=(F.col("time_diff") > F.col("_mean") * 2).cast("int"))
            .totals(keys, pause_count=F.sum("is_pause")))
    return rows.with_columns(
        time_diff_normalized=over_eps(F.col("time_diff") - F.col("_mean"), F.col("_std")),
        time_acceleration=step("time_diff", "_diff"),
        rhythm_regularity=_regularity("_std", "_n"),
        time_since_start=F.col("time") - F.col("_t0"), time_to_end=F.col("_t1") - F.col("time"),
        relative_time_position=over_eps(F.col("time") - F.col("_t0"), F.col("_t1") - F.col("_t0")),
    ).drop("_time", "_diff", "_n", "_mean", "_std", "_t0", "_t1")


@F.pandas_udf(LongType())
def _spectral_peak(series: pd.Series) -> pd.Series:
    """Index of the strongest frequency of each windowed series; of mirrored twins the smaller."""
    def peak(values):
        power = np.abs(np.fft.rfft(np.asarray(values, dtype=float))) ** 2
        # equal up to rounding noise counts as equal: the first of them is taken
        return int(np.argmax(power >= power.max() * (1 - 1e-9)))
    return series.map(peak)


def _windowed(touches: Touches) -> Touches:
    """Mean-removed time steps under a symmetric Hamming window, as column ``_w``."""
    rows = (arrange_sequences(touches).running(_time=Previous(F.col("time")), _pos=Position())
            .with_columns(_d=step("time", "_time"))
            .totals(_keys(touches), _n=F.count(F.lit(1)), _mean=F.avg("_d")))
    angle = F.lit(2 * np.pi) * F.col("_pos") / F.greatest(F.col("_n") - 1, F.lit(1))
    return rows.with_columns(_w=(F.col("_d") - F.col("_mean")) * (F.lit(0.54) - F.lit(0.46) * F.cos(angle)))


def spectral_features(touches: Touches, longest: int = SPECTRUM_MAX) -> DataFrame:
    """Per touch: energy, peak and centroid of the spectrum of its time steps; 0 below 8 events.

    Energy follows from Parseval's theorem and the centroid from the mirror symmetry of a real
    series, so both are plain sums of any touch. Only the peak needs the transform: touches up to
    ``longest`` events are transformed in one row, longer ones by ``long_spectrum_peaks``.
    """
    from fingertrail.operators.spectrum import long_spectrum_peaks
    keys = _keys(touches)
    rows = _windowed(touches)
    table = rows.aggregate(keys, _n=F.max("_n"), _w2=F.sum(F.col("_w") * F.col("_w")), _w1=F.sum("_w"))
    usable = rows.filter(F.col("_n") >= SPECTRUM_MIN)
    short = usable.filter(F.col("_n") <= longest).rows()
    series = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_w"))), lambda s: s["_w"])
    peaks = short.groupBy(*keys).agg(series.alias("_series")).select(
        *keys, _spectral_peak("_series").alias("_peak"))
    if touches.at_most is None or touches.at_most > longest:
        long = long_spectrum_peaks(usable.filter(F.col("_n") > longest).rows(), keys)
        peaks = peaks.unionByName(long)
    energy = F.col("_n") * F.col("_w2")
    centroid = F.col("_n") / 2 * (energy - F.col("_w1") * F.col("_w1")) / (energy + EPS)
    long_enough = F.col("_n") >= SPECTRUM_MIN
    return table.join(peaks, keys, "left").select(
        *keys, F.when(long_enough, energy).otherwise(0.0).alias("temporal_energy"),
        F.coalesce("_peak", F.lit(0)).cast("double").alias("temporal_peak_freq"),
        F.when(long_enough, centroid).otherwise(0.0).alias("temporal_spectral_centroid"))


def advanced_spatial_features(touches: Touches) -> Touches:
    """Trajectory features with wrapped direction changes; needs time_diff."""
    keys, order = sequence_keys(touches.columns)
    at = F.struct(*order)
    rows = (movement(touches)
            .running(_v=Previous(F.col("velocity")), _a=Previous(F.col("direction_angle")),
                     cumulative_distance=RunningSum(F.col("distance")))
            .with_columns(acceleration=step("velocity", "_v"),
                          direction_change=wrap_angle(step("direction_angle", "_a")))
            .with_columns(acceleration_magnitude=F.abs("acceleration"),
                          direction_change_magnitude=F.abs("direction_change"))
            .running(cumulative_direction_change=RunningSum(F.col("direction_change_magnitude")))
            .totals(keys, _n=F.count(F.lit(1)), _x0=F.min("x"), _x1=F.max("x"), _y0=F.min("y"),
                    _y1=F.max("y"), _d_std=F.stddev_samp("distance"),
                    _turn_std=F.stddev_samp("direction_change_magnitude"), _path=F.sum("distance"),
                    _sx=F.min_by("x", at), _sy=F.min_by("y", at), _ex=F.max_by("x", at), _ey=F.max_by("y", at)))
    straight = F.sqrt(F.pow(F.col("_ex") - F.col("_sx"), 2) + F.pow(F.col("_ey") - F.col("_sy"), 2))
    x_range, y_range = F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")
    return rows.with_columns(
        x_range=x_range, y_range=y_range, spatial_spread=F.sqrt(x_range * x_range + y_range * y_range),
        trajectory_smoothness=_regularity("_d_std", "_n"),
        direction_consistency=_regularity("_turn_std", "_n"),
        spatial_efficiency=F.when(F.col("_n") >= 2, over_eps(straight, F.col("_path"))).otherwise(0.0),
    ).drop("_v", "_a", "_n", "_x0", "_x1", "_y0", "_y1", "_d_std", "_turn_std", "_path", "_sx", "_sy",
           "_ex", "_ey")


def encode_categories(touches: Touches, columns: list[str]) -> Touches:
    """Alphabetical 0-based codes of values among the distinct values of their session.

    All code tables come from the same input, so encoding several columns does not nest.
    """
    rows = touches
    for name in columns:
        values = touches.rows().select(SESSION, name).filter(F.col(name).isNotNull()).distinct()
        codes = (split_sessions(values, touches.hot_rows, touches.at_most)
                 .arrange([SESSION], [name]).running(_code=Position()).rows()
                 .select(SESSION, name, F.col("_code").cast("int").alias(f"{name}_encoded")))
        rows = rows.attach(codes, [SESSION, name])
    return rows


def advanced_behavioral_features(touches: Touches) -> Touches:
    """Encodings, transitions, phase durations and completion consistency."""
    keys = _keys(touches)
    names = sorted(COLORING_PHASES)
    rows = behavioral_features(touches, start="start_to_")
    rows = rows.totals([*keys, "touchPhase"], _pn=F.count(F.lit(1)), _p0=F.min("time"), _p1=F.max("time"))
    code = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("touchPhase")) - 1
    rows = rows.with_columns(
        touchPhase_encoded=F.when(code >= 0, code).cast("int"),
        phase_duration=F.when(F.col("_pn") > 1, F.col("_p1") - F.col("_p0")).otherwise(0.0))
    if "completionPerc" in touches.columns:
        rows = rows.totals(keys, _n=F.count(F.lit(1)), _c_std=F.stddev_samp("completion_rate")).with_columns(
            completion_consistency=_regularity("_c_std", "_n")).drop("_n", "_c_std")
    rows = rows.drop("_pn", "_p0", "_p1")
    return encode_categories(rows, [c for c in ("zone", "color") if c in touches.columns])


def sequence_shape_features(touches: Touches) -> Touches:
    """Length, duration, density, position and completeness of the touch."""
    keys = _keys(touches)
    rows = (arrange_sequences(touches).running(sequence_position=Position())
            .totals(keys, sequence_length=F.count(F.lit(1)), _t0=F.min("time"), _t1=F.max("time"),
                    _began=any_phase("Began"), _ended=any_phase("Ended"), _canceled=any_phase("Canceled"))
            .with_columns(sequence_duration=F.col("_t1") - F.col("_t0"), has_began=F.col("_began").cast("int"),
                          has_ended=F.col("_ended").cast("int"), has_canceled=F.col("_canceled").cast("int")))
    return rows.with_columns(
        sequence_density=over_eps(F.col("sequence_length"), F.col("sequence_duration")),
        relative_sequence_position=over_eps(F.col("sequence_position"), F.col("sequence_length") - 1),
        sequence_pattern_score=(F.col("has_began") + F.col("has_ended")) / 2.0 - F.col("has_canceled") * 0.3,
    ).drop("_t0", "_t1", "_began", "_ended", "_canceled")


def interaction_features(touches: Touches) -> Touches:
    """Fingers, intensity, hesitation, precision and rhythm; needs velocity, distance, time_diff and
    direction_change_magnitude.

    A hesitation compares with the previous event of the session in touch order, so the first event
    of a touch is compared with the last event of the touch before it.
    """
    keys, order = sequence_keys(touches.columns)
    rows = arrange_sequences(touches).running(_v=Previous(F.col("velocity")))
    rows = rows.with_columns(velocity_drop=step("velocity", "_v"))
    # a finger counts where it is first met
    rows = rows.running(within=[*keys, "fingerId"], _met=Position())
    rows = rows.arrange(["session_id"], [*keys[1:], *order]).running(_sv=Previous(F.col("velocity")))
    stopped = (F.col("velocity") < 0.1) & (F.col("_sv") > 1.0)
    rows = rows.with_columns(hesitation_events=F.coalesce(stopped, F.lit(False)).cast("int"))
    rows = rows.totals(keys, _n=F.count(F.lit(1)), unique_fingers=F.count_if(F.col("_met") == 0),
                       interaction_intensity=F.sum("distance"), max_movement_burst=F.max("distance"),
                       hesitation_count=F.sum("hesitation_events"),
                       _turn=F.avg("direction_change_magnitude"), _t_std=F.stddev_samp("time_diff"))
    return rows.with_columns(
        is_multitouch=(F.col("unique_fingers") > 1).cast("int"),
        precision_score=inverse(F.col("_turn")), rhythm_score=_regularity("_t_std", "_n"),
    ).drop("_v", "_sv", "_n", "_met", "_turn", "_t_std")


def extract_advanced_features(touches: Touches) -> Touches:
    """All advanced families except the spectrum, which is a table per touch."""
    rows = statistical_features(touches)
    rows = advanced_spatial_features(advanced_temporal_features(rows))
    rows = advanced_behavioral_features(rows)
    return interaction_features(sequence_shape_features(rows))


def feature_importance(df: DataFrame, features: list[str], target: str | None = None) -> DataFrame:
    """Importance per numeric feature: variance over absolute mean, with a target averaged with the
    absolute correlation, scaled so that the largest is 1. One aggregation pass over the data."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    chosen = [f for f in features if f in numeric]
    parts = []
    for name in chosen:
        value = F.col(name).cast("double")
        parts += [F.variance(value).alias(f"v_{name}"), F.avg(value).alias(f"m_{name}")]
        if target and name != target:
            parts.append(F.corr(value, F.col(target).cast("double")).alias(f"c_{name}"))
    line = df.agg(*parts)

    def score(name):
        spread = F.try_divide(F.col(f"v_{name}"), F.abs(F.col(f"m_{name}")) + F.lit(EPS))
        if not target or name == target:
            return spread
        relation = F.col(f"c_{name}")
        usable = relation.isNotNull() & ~F.isnan(relation)
        return F.when(usable, F.coalesce(spread, F.lit(0.0)) * 0.5 + F.abs(relation) * 0.5).otherwise(spread)

    cells = F.array(*[F.struct(F.lit(n).alias("feature"), score(n).alias("score")) for n in chosen])
    scores = line.select(F.explode(cells).alias("_s")).select("_s.*").filter(F.col("score").isNotNull())
    top = scores.agg(F.max("score").alias("_top"))
    return scores.join(F.broadcast(top)).select(  # one row
        "feature", F.when(F.col("_top") > 0, F.col("score") / F.col("_top")).otherwise(F.col("score")).alias("importance"))


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most important features."""
    return importance.orderBy(F.desc("importance"), "feature").limit(n)
