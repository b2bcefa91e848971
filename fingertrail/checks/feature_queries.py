"""Queries over the feature families."""

from __future__ import annotations

from pyspark.sql import functions as F

from fingertrail.checks.catalog import query
from fingertrail.checks.sql import STEPS, TOUCH, sql, tidy as t
from fingertrail.functions.numeric import tidy
from fingertrail.operators import advanced_features as advanced
from fingertrail.operators import features, sequence_features
from fingertrail.operators.metrics import TOUCH as TOUCH_KEYS
from fingertrail.sources.touch_view import touch_view

WINDOW = "OVER (PARTITION BY session_id, Touchdata_id)"


def out(rows, columns: dict[str, int | None], keys=("event_id",)):
    """Select columns, rounding those with a number of digits."""
    return rows.select(*keys, *[(tidy(F.col(c), d) if d is not None else F.col(c)).alias(c)
                                for c, d in columns.items()])


@query("temporal_features", sql(TOUCH + STEPS, f"""
SELECT event_id, {t('time_diff')} AS time_diff,
       {t(f'(time_diff - avg(time_diff) {WINDOW}) / (stddev_samp(time_diff) {WINDOW} + 1e-8)')} AS time_diff_normalized,
       {t('cumulative_time', 4)} AS cumulative_time, {t('time_acceleration')} AS time_acceleration,
       event_index AS sequence_position, n AS sequence_length, {t('event_index / (n + 1e-8)')} AS position_ratio,
       {t(f'1 / (stddev_samp(time_diff) {WINDOW} + 1e-8)', 4)} AS time_rhythm_consistency
FROM f3"""))
def temporal_features(spark, sf_dir):
    rows = features.temporal_features(touch_view(spark, sf_dir)).rows()
    return out(rows, {"time_diff": 6, "time_diff_normalized": 6, "cumulative_time": 4, "time_acceleration": 6,
                      "sequence_position": None, "sequence_length": None, "position_ratio": 6,
                      "time_rhythm_consistency": 4})


@query("spatial_features", sql(TOUCH + STEPS, f"""
SELECT event_id, x_diff, y_diff, {t('distance')} AS distance, {t('velocity', 3)} AS velocity,
       {t('acceleration', 3)} AS acceleration, {t('direction_angle')} AS direction_angle,
       {t('raw_turn')} AS direction_change, {t('cumulative_distance', 4)} AS cumulative_distance,
       {t(f'1 / (avg(abs(raw_turn)) {WINDOW} + 1e-8)', 4)} AS spatial_smoothness,
       max(x) {WINDOW} - min(x) {WINDOW} AS bbox_width, max(y) {WINDOW} - min(y) {WINDOW} AS bbox_height,
       (max(x) {WINDOW} - min(x) {WINDOW}) * (max(y) {WINDOW} - min(y) {WINDOW}) AS bbox_area
FROM f3"""))
def spatial_features(spark, sf_dir):
    rows = features.spatial_features(features.temporal_features(touch_view(spark, sf_dir))).rows()
    return out(rows, {"x_diff": None, "y_diff": None, "distance": 6, "velocity": 3, "acceleration": 3,
                      "direction_angle": 6, "direction_change": 6, "cumulative_distance": 4,
                      "spatial_smoothness": 4, "bbox_width": None, "bbox_height": None, "bbox_area": None})


_BEHAVIOUR = TOUCH + STEPS + """,
b1 AS (SELECT *, coalesce(c_step, 0) AS rate, sqrt(power(x / 1920, 2) + power(y / 1000, 2) + power(completionPerc / 100, 2)) AS acc FROM f1),
b2 AS (SELECT *, coalesce(rate - lag(rate) OVER s, 0) AS rate_step, coalesce(acc - lag(acc) OVER s, 0) AS acc_step
       FROM b1 WINDOW s AS (PARTITION BY session_id, Touchdata_id ORDER BY event_index))"""


def _with_sensor(touches):
    return touches.with_columns(accx=F.col("x") / 1920, accy=F.col("y") / 1000, accz=F.col("completionPerc") / 100)


@query("behavioral_features", sql(_BEHAVIOUR, f"""
SELECT event_id, coalesce(prev_phase || '_to_', 'start_') || touchPhase AS phase_transition,
       {t('rate')} AS completion_rate, {t('rate_step')} AS completion_acceleration, {t('acc')} AS acc_magnitude,
       {t('acc_step')} AS acc_change, CAST(z_new AS INTEGER) AS zone_change,
       CAST(sum(CAST(z_new AS INTEGER)) {WINDOW} AS BIGINT) AS zone_stability, CAST(k_new AS INTEGER) AS color_change
FROM b2"""))
def behavioral_features(spark, sf_dir):
    rows = features.behavioral_features(_with_sensor(touch_view(spark, sf_dir))).rows()
    return out(rows, {"phase_transition": None, "completion_rate": 6, "completion_acceleration": 6,
                      "acc_magnitude": 6, "acc_change": 6, "zone_change": None, "zone_stability": None,
                      "color_change": None})


def far(column):
    return (f"CAST(CASE WHEN stddev_samp({column}) {WINDOW} > 0 AND abs({column} - median({column}) {WINDOW}) > "
            f"3 * stddev_samp({column}) {WINDOW} THEN 1 ELSE 0 END AS INTEGER)")


QUALITY_SQL = f"""
SELECT f3.*, CAST(bool_or(touchPhase = 'Began') {WINDOW} AS INTEGER) AS has_began,
       CAST(bool_or(touchPhase = 'Ended') {WINDOW} AS INTEGER) AS has_ended,
       CAST(bool_or(touchPhase = 'Canceled') {WINDOW} AS INTEGER) AS has_canceled,
       CAST(regexp_full_match(word, 'B[MS]*C?[MS]*E') AS INTEGER) AS sequence_valid_pattern,
       {far('velocity')} AS velocity_outlier, {far('distance')} AS distance_outlier,
       CAST(time_diff > 2 * quantile_cont(time_diff, 0.95) {WINDOW} AS INTEGER) AS time_gap_outlier
FROM f3 JOIN letters USING (session_id, Touchdata_id)"""


def _letters():
    from fingertrail.checks.sql import PATTERN
    return PATTERN


@query("sequence_quality_features", sql(TOUCH + STEPS + _letters() + f", q AS ({QUALITY_SQL})", """
SELECT event_id, has_began, has_ended, has_canceled, sequence_valid_pattern, velocity_outlier,
       distance_outlier, time_gap_outlier FROM q"""))
def sequence_quality_features(spark, sf_dir):
    rows = features.extract_all_features(touch_view(spark, sf_dir)).rows()
    return rows.select("event_id", *features.QUALITY)


@query("feature_matrix", sql(TOUCH + STEPS, f"""
SELECT event_id, coalesce({t(f'(time_diff - avg(time_diff) {WINDOW}) / (stddev_samp(time_diff) {WINDOW} + 1e-8)')}, 0) AS time_diff_normalized,
       {t('distance')} AS distance, CAST(event_index AS DOUBLE) AS sequence_position,
       coalesce({t('CASE WHEN event_id % 10 > 0 THEN velocity END', 3)}, 0) AS marked
FROM f3"""))
def feature_matrix(spark, sf_dir):
    """Texts are left out; null, NaN and infinite values become 0."""
    touches = features.extract_all_features(touch_view(spark, sf_dir))
    tenth = F.col("event_id") % 10
    marked = (F.when(tenth > 0, F.col("velocity")).when(F.col("event_id") % 20 == 0, F.lit(float("nan")))
              .otherwise(F.lit(float("inf"))))
    rows = touches.rows().withColumn("marked", marked)
    names = ["time_diff_normalized", "phase_transition", "distance", "sequence_position", "marked"]
    matrix = features.feature_matrix(rows, names, keep=["event_id"])
    return out(matrix, {"time_diff_normalized": 6, "distance": 6, "sequence_position": None, "marked": 3})


# ---- advanced ---------------------------------------------------------------------------------

def _moments(c):
    return f"""
  avg({c}) {WINDOW} AS {c}_mean, stddev_samp({c}) {WINDOW} AS {c}_std, min({c}) {WINDOW} AS {c}_min,
  max({c}) {WINDOW} AS {c}_max, quantile_cont({c}, 0.25) {WINDOW} AS {c}_q25, quantile_cont({c}, 0.75) {WINDOW} AS {c}_q75"""


def _shape(c):
    # moments about the mean; DuckDB's own skewness is corrected for bias
    m = [f"avg(power({c} - {c}_mean, {k})) {WINDOW}" for k in (2, 3, 4)]
    return (f"CASE WHEN {m[0]} > 0 THEN {m[1]} / power({m[0]}, 1.5) END AS {c}_skew, "
            f"CASE WHEN {m[0]} > 0 THEN {m[2]} / power({m[0]}, 2) - 3 END AS {c}_kurtosis")


_STAT_COLUMNS = ["x", "y", "completionPerc"]


def _stat_out(c):
    return f"""{t(f'{c}_mean')} AS {c}_seq_mean, {t(f'{c}_std')} AS {c}_seq_std, {t(f'{c}_min')} AS {c}_seq_min,
  {t(f'{c}_max')} AS {c}_seq_max, {t(f'{c}_max - {c}_min')} AS {c}_seq_range, {t(f'{c}_skew', 4)} AS {c}_seq_skew,
  {t(f'{c}_kurtosis', 4)} AS {c}_seq_kurtosis, {t(f'{c}_q25')} AS {c}_seq_q25, {t(f'{c}_q75')} AS {c}_seq_q75,
  {t(f'{c}_q75 - {c}_q25')} AS {c}_seq_iqr, {t(f'{c}_std / ({c}_mean + 1e-8)')} AS {c}_seq_cv,
  {t(f'({c} - {c}_mean) / ({c}_std + 1e-8)')} AS {c}_z_score"""


@query("statistical_features", sql(TOUCH + f""",
m1 AS (SELECT *, {','.join(_moments(c) for c in _STAT_COLUMNS)} FROM touch),
m2 AS (SELECT *, {', '.join(_shape(c) for c in _STAT_COLUMNS)} FROM m1)""",
    f"SELECT event_id, {', '.join(_stat_out(c) for c in _STAT_COLUMNS)} FROM m2"))
def statistical_features(spark, sf_dir):
    # the absolute time of a touch is compared in ``sequence_feature_table``; here the bounded columns
    rows = advanced.statistical_features(touch_view(spark, sf_dir)).rows()
    digits = {"skew": 4, "kurtosis": 4}
    columns = {f"{c}_seq_{s}": digits.get(s, 6) for c in _STAT_COLUMNS for s in advanced.STATISTICS}
    return out(rows, columns | {f"{c}_z_score": 6 for c in _STAT_COLUMNS})


@query("advanced_temporal_features", sql(TOUCH + STEPS + f""",
p AS (SELECT *, CAST(time_diff > 2 * avg(time_diff) {WINDOW} AS INTEGER) AS is_pause,
        min(time) {WINDOW} AS t0, max(time) {WINDOW} AS t1, stddev_samp(time_diff) {WINDOW} AS sd FROM f3)""", f"""
SELECT event_id, is_pause, CAST(sum(is_pause) {WINDOW} AS BIGINT) AS pause_count,
       {t('CASE WHEN n > 1 THEN 1 / (1 + sd) ELSE 1 END')} AS rhythm_regularity,
       {t('time - t0')} AS time_since_start, {t('t1 - time')} AS time_to_end,
       {t('(time - t0) / (t1 - t0 + 1e-8)')} AS relative_time_position
FROM p"""))
def advanced_temporal_features(spark, sf_dir):
    rows = advanced.advanced_temporal_features(touch_view(spark, sf_dir)).rows()
    return out(rows, {"is_pause": None, "pause_count": None, "rhythm_regularity": 6, "time_since_start": 6,
                      "time_to_end": 6, "relative_time_position": 6})


_SPECTRUM = TOUCH + STEPS + f""",
w1 AS (SELECT session_id, Touchdata_id, event_index AS i, n,
         (time_diff - avg(time_diff) {WINDOW}) * (0.54 - 0.46 * cos(2 * pi() * event_index / greatest(n - 1, 1))) AS w FROM f1),
freq AS (SELECT session_id, Touchdata_id, k, any_value(n) AS n,
         power(sum(w * cos(2 * pi() * k * i / n)), 2) + power(sum(w * sin(2 * pi() * k * i / n)), 2) AS p
       FROM w1, unnest(range(n)) AS u(k) WHERE n >= 8 GROUP BY session_id, Touchdata_id, k),
spec AS (SELECT session_id, Touchdata_id, sum(p) AS energy, sum(k * p) / (sum(p) + 1e-8) AS centroid, max(p) AS top
         FROM freq GROUP BY session_id, Touchdata_id),
peak AS (SELECT session_id, Touchdata_id, min(k) AS k FROM freq JOIN spec USING (session_id, Touchdata_id)
         WHERE p >= top * (1 - 1e-9) GROUP BY session_id, Touchdata_id)"""


@query("spectral_features", sql(_SPECTRUM, f"""
SELECT session_id, Touchdata_id, {t('coalesce(any_value(energy), 0)', 4)} AS temporal_energy,
       CAST(coalesce(any_value(k), 0) AS DOUBLE) AS temporal_peak_freq,
       {t('coalesce(any_value(centroid), 0)')} AS temporal_spectral_centroid
FROM touch LEFT JOIN spec USING (session_id, Touchdata_id) LEFT JOIN peak USING (session_id, Touchdata_id)
GROUP BY session_id, Touchdata_id"""))
def spectral_features(spark, sf_dir):
    table = advanced.spectral_features(touch_view(spark, sf_dir))
    return out(table, {"temporal_energy": 4, "temporal_peak_freq": None, "temporal_spectral_centroid": 6},
               TOUCH_KEYS)


_ADVANCED = TOUCH + STEPS + """,
a1 AS (SELECT *, CASE WHEN raw_turn > pi() THEN raw_turn - 2 * pi() WHEN raw_turn < -pi() THEN raw_turn + 2 * pi()
                      ELSE raw_turn END AS turn FROM f3)"""


@query("advanced_spatial_features", sql(_ADVANCED, f"""
SELECT event_id, {t('abs(acceleration)', 3)} AS acceleration_magnitude, {t('turn')} AS direction_change,
       {t('abs(turn)')} AS direction_change_magnitude,
       {t('sum(abs(turn)) OVER (PARTITION BY session_id, Touchdata_id ORDER BY event_index)')} AS cumulative_direction_change,
       max(x) {WINDOW} - min(x) {WINDOW} AS x_range, max(y) {WINDOW} - min(y) {WINDOW} AS y_range,
       {t(f'sqrt(power(max(x) {WINDOW} - min(x) {WINDOW}, 2) + power(max(y) {WINDOW} - min(y) {WINDOW}, 2))')} AS spatial_spread,
       {t(f'CASE WHEN n > 1 THEN 1 / (1 + stddev_samp(distance) {WINDOW}) ELSE 1 END')} AS trajectory_smoothness,
       {t(f'CASE WHEN n > 1 THEN 1 / (1 + stddev_samp(abs(turn)) {WINDOW}) ELSE 1 END')} AS direction_consistency,
       {t(f'''CASE WHEN n > 1 THEN sqrt(power(arg_max(x, event_index) {WINDOW} - arg_min(x, event_index) {WINDOW}, 2)
            + power(arg_max(y, event_index) {WINDOW} - arg_min(y, event_index) {WINDOW}, 2)) / (sum(distance) {WINDOW} + 1e-8) ELSE 0 END''')} AS spatial_efficiency
FROM a1"""))
def advanced_spatial_features(spark, sf_dir):
    base = advanced.advanced_temporal_features(touch_view(spark, sf_dir))
    rows = advanced.advanced_spatial_features(base).rows()
    return out(rows, {"acceleration_magnitude": 3, "direction_change": 6, "direction_change_magnitude": 6,
                      "cumulative_direction_change": 6, "x_range": None, "y_range": None, "spatial_spread": 6,
                      "trajectory_smoothness": 6, "direction_consistency": 6, "spatial_efficiency": 6})


@query("advanced_behavioral_features", sql(_BEHAVIOUR + """,
codes AS (SELECT session_id, zone, dense_rank() OVER (PARTITION BY session_id ORDER BY zone) - 1 AS zc
          FROM (SELECT DISTINCT session_id, zone FROM touch)),
kodes AS (SELECT session_id, color, dense_rank() OVER (PARTITION BY session_id ORDER BY color) - 1 AS kc
          FROM (SELECT DISTINCT session_id, color FROM touch))""", f"""
SELECT event_id, list_position(['Began', 'Canceled', 'Ended', 'Moved', 'Stationary'], touchPhase) - 1 AS touchPhase_encoded,
       coalesce(prev_phase, 'start') || '_to_' || touchPhase AS phase_transition,
       {t('max(time) OVER (PARTITION BY session_id, Touchdata_id, touchPhase) - min(time) OVER (PARTITION BY session_id, Touchdata_id, touchPhase)')} AS phase_duration,
       {t(f'CASE WHEN n > 1 THEN 1 / (1 + stddev_samp(rate) {WINDOW}) ELSE 1 END')} AS completion_consistency,
       CAST(zc AS INTEGER) AS zone_encoded, CAST(kc AS INTEGER) AS color_encoded
FROM b2 JOIN codes USING (session_id, zone) JOIN kodes USING (session_id, color)"""))
def advanced_behavioral_features(spark, sf_dir):
    rows = advanced.advanced_behavioral_features(touch_view(spark, sf_dir)).rows()
    return out(rows, {"touchPhase_encoded": None, "phase_transition": None, "phase_duration": 6,
                      "completion_consistency": 6, "zone_encoded": None, "color_encoded": None})


@query("sequence_shape_features", sql(TOUCH + STEPS + f""",
s1 AS (SELECT *, max(time) {WINDOW} - min(time) {WINDOW} AS dur, CAST(bool_or(touchPhase = 'Began') {WINDOW} AS INTEGER) AS has_began,
         CAST(bool_or(touchPhase = 'Ended') {WINDOW} AS INTEGER) AS has_ended,
         CAST(bool_or(touchPhase = 'Canceled') {WINDOW} AS INTEGER) AS has_canceled FROM f1)""", f"""
SELECT event_id, n AS sequence_length, {t('dur')} AS sequence_duration, {t('n / (dur + 1e-8)', 3)} AS sequence_density,
       event_index AS sequence_position, {t('event_index / (n - 1 + 1e-8)')} AS relative_sequence_position,
       {t('(has_began + has_ended) / 2 - has_canceled * 0.3::DOUBLE')} AS sequence_pattern_score
FROM s1"""))
def sequence_shape_features(spark, sf_dir):
    rows = advanced.sequence_shape_features(touch_view(spark, sf_dir)).rows()
    return out(rows, {"sequence_length": None, "sequence_duration": 6, "sequence_density": 3,
                      "sequence_position": None, "relative_sequence_position": 6, "sequence_pattern_score": 6})


@query("interaction_features", sql(_ADVANCED + """,
i1 AS (SELECT *, coalesce(velocity < 0.1 AND lag(velocity) OVER (PARTITION BY session_id ORDER BY Touchdata_id, event_index) > 1, FALSE) AS stop
       FROM a1)""", f"""
SELECT event_id, 1 AS unique_fingers, 0 AS is_multitouch, {t(f'sum(distance) {WINDOW}', 4)} AS interaction_intensity,
       {t(f'max(distance) {WINDOW}')} AS max_movement_burst, {t('acceleration', 3)} AS velocity_drop,
       CAST(stop AS INTEGER) AS hesitation_events, CAST(sum(CAST(stop AS INTEGER)) {WINDOW} AS BIGINT) AS hesitation_count,
       {t(f'1 / (1 + avg(abs(turn)) {WINDOW})')} AS precision_score,
       {t(f'CASE WHEN n > 1 THEN 1 / (1 + stddev_samp(time_diff) {WINDOW}) ELSE 1 END')} AS rhythm_score
FROM i1"""))
def interaction_features(spark, sf_dir):
    base = advanced.advanced_temporal_features(touch_view(spark, sf_dir))
    rows = advanced.interaction_features(advanced.advanced_spatial_features(base)).rows()
    return out(rows, {"unique_fingers": None, "is_multitouch": None, "interaction_intensity": 4,
                      "max_movement_burst": 6, "velocity_drop": 3, "hesitation_events": None,
                      "hesitation_count": None, "precision_score": 6, "rhythm_score": 6})


_IMPORTANCE_OF = ["x", "y", "completionPerc", "distance", "time_diff", "x_diff"]


def _importance_sql(target: bool) -> str:
    def score(c):
        base = f"var_samp({c}) / (abs(avg({c})) + 1e-8)"
        return f"({base}) * 0.5 + abs(corr({c}, completionPerc)) * 0.5" if target and c != "completionPerc" else base
    union = " UNION ALL ".join(f"SELECT '{c}' AS feature, {score(c)} AS s FROM f3" for c in _IMPORTANCE_OF)
    return f"SELECT feature, {t('s / max(s) OVER ()')} AS importance FROM ({union})"


def _importance(spark, sf_dir, target):
    rows = features.spatial_features(features.temporal_features(touch_view(spark, sf_dir))).rows()
    return advanced.feature_importance(rows, _IMPORTANCE_OF, target)


@query("feature_importance", sql(TOUCH + STEPS, _importance_sql(False)))
def feature_importance(spark, sf_dir):
    return out(_importance(spark, sf_dir, None), {"importance": 6}, ("feature",))


@query("feature_importance_target", sql(TOUCH + STEPS, _importance_sql(True)))
def feature_importance_target(spark, sf_dir):
    return out(_importance(spark, sf_dir, "completionPerc"), {"importance": 6}, ("feature",))


@query("top_features", sql(TOUCH + STEPS, _importance_sql(False) + " ORDER BY importance DESC, feature LIMIT 3"))
def top_features(spark, sf_dir):
    return out(advanced.top_features(_importance(spark, sf_dir, None), 3), {"importance": 6}, ("feature",))


# ---- per touch --------------------------------------------------------------------------------

_TABLE = TOUCH + STEPS + """,
g1 AS (SELECT *, CASE WHEN event_index > 0 THEN time_diff END AS dt, CASE WHEN event_index > 0 THEN distance END AS dd,
         CASE WHEN event_index > 0 THEN direction_angle END AS an, prev_phase || '_to_' || touchPhase AS tr FROM f3),
g2 AS (SELECT *, abs((((an - lag(an) OVER s + pi()) % (2 * pi())) + 2 * pi()) % (2 * pi()) - pi()) AS ad
       FROM g1 WINDOW s AS (PARTITION BY session_id, Touchdata_id ORDER BY event_index)),
g AS (SELECT session_id, Touchdata_id, count(*) AS n, max(time) - min(time) AS dur, avg(dt) AS mt, stddev_samp(dt) AS st,
        max(dt) AS gt, sum(dd) AS td, avg(dd) AS md, stddev_samp(dd) AS sd, max(dd) AS xd, max(x) - min(x) AS xr,
        max(y) - min(y) AS yr, stddev_pop(ad) AS sa, count(DISTINCT touchPhase) AS pd, count(DISTINCT tr) AS ut,
        count(*) FILTER (touchPhase = 'Began') AS bc, count(*) FILTER (touchPhase = 'Moved') AS mc,
        count(*) FILTER (touchPhase = 'Canceled') AS cc, max(completionPerc) - min(completionPerc) AS cr,
        stddev_samp(c_step) AS cs, count(DISTINCT zone) AS zd, CAST(sum(CAST(z_new AS INTEGER)) AS BIGINT) AS zc,
        avg(x) AS xm, quantile_cont(x, 0.25) AS xq1, quantile_cont(x, 0.75) AS xq3, avg(time) AS tm, stddev_samp(time) AS ts,
        kurtosis_pop(y) AS yk
      FROM g2 GROUP BY session_id, Touchdata_id)"""


@query("sequence_feature_table", sql(_TABLE, f"""
SELECT session_id, Touchdata_id, n AS sequence_length, {t('dur')} AS sequence_duration, {t('mt')} AS mean_time_interval,
  {t('st')} AS std_time_interval, {t('st / (mt + 1e-8)')} AS time_interval_cv, {t('gt')} AS max_time_gap,
  {t('1 / (1 + st / (mt + 1e-8))')} AS time_regularity, {t('td', 4)} AS total_distance, {t('md')} AS mean_distance,
  {t('sd')} AS std_distance, {t('xd')} AS max_distance, {t('sd / (md + 1e-8)')} AS distance_cv,
  CASE WHEN n > 1 THEN xr END AS x_range, CASE WHEN n > 1 THEN yr END AS y_range,
  CASE WHEN n > 1 THEN {t('sqrt(xr * xr + yr * yr)')} END AS spatial_spread,
  CASE WHEN n > 3 THEN {t('1 / (1 + sd)')} END AS trajectory_smoothness,
  CASE WHEN n > 2 THEN {t('1 / (1 + sa)')} END AS direction_consistency, pd AS phase_diversity, ut AS unique_transitions,
  bc AS began_count, mc AS moved_count, cc AS canceled_count, {t('cr')} AS completion_range,
  {t('cr / (dur + 1e-8)', 3)} AS completion_rate, {t('1 / (1 + cs)')} AS completion_consistency,
  zd AS zone_diversity, zc AS zone_changes, {t('xm')} AS x_mean, {t('xq1')} AS x_q25, {t('xq3 - xq1')} AS x_iqr,
  {t('tm')} AS time_mean, {t('ts')} AS time_std, CASE WHEN isfinite(yk) THEN {t('yk', 4)} END AS y_kurtosis
FROM g"""))
def sequence_feature_table(spark, sf_dir):
    table = sequence_features.sequence_feature_table(touch_view(spark, sf_dir))
    columns = {"sequence_length": None, "sequence_duration": 6, "mean_time_interval": 6, "std_time_interval": 6,
               "time_interval_cv": 6, "max_time_gap": 6, "time_regularity": 6, "total_distance": 4,
               "mean_distance": 6, "std_distance": 6, "max_distance": 6, "distance_cv": 6, "x_range": None,
               "y_range": None, "spatial_spread": 6, "trajectory_smoothness": 6, "direction_consistency": 6,
               "unique_transitions": None, "began_count": None, "moved_count": None, "canceled_count": None,
               "completion_range": 6, "completion_rate": 3, "completion_consistency": 6, "zone_diversity": None,
               "zone_changes": None, "x_mean": 6, "x_q25": 6, "x_iqr": 6, "time_mean": 6, "time_std": 6,
               "y_kurtosis": 4, "phase_diversity": None}
    return out(table, columns, TOUCH_KEYS)


@query("basic_features", sql(TOUCH + STEPS, f"""
SELECT event_id, {t('time_diff')} AS time_diff, event_index AS sequence_position, n AS sequence_length, x_diff, y_diff,
       {t('distance')} AS distance, {t('cumulative_distance', 4)} AS cumulative_distance FROM f3"""))
def basic_features(spark, sf_dir):
    rows = features.basic_features(touch_view(spark, sf_dir)).rows()
    return out(rows, {"time_diff": 6, "sequence_position": None, "sequence_length": None, "x_diff": None,
                      "y_diff": None, "distance": 6, "cumulative_distance": 4})


@query("fixed_length_packing", sql(TOUCH, f"""
SELECT session_id, Touchdata_id, least(count(*), 6) AS steps, 6 AS padded,
       {t('sum(x + 2 * y + 3 * completionPerc) FILTER (event_index < 6)', 4)} AS checksum,
       coalesce(any_value(x) FILTER (event_index = 2), 0) AS third_x
FROM touch GROUP BY session_id, Touchdata_id"""))
def fixed_length_packing(spark, sf_dir):
    """Touches cut or zero-padded to six steps, checked by sums over the packed arrays."""
    packed = features.pack_fixed_length(touch_view(spark, sf_dir), max_length=6)
    total = F.aggregate("inputs", F.lit(0.0), lambda acc, s: acc + s[0] + s[1] * 2 + s[3] * 3)
    return packed.select(*TOUCH_KEYS, F.col("steps").cast("bigint").alias("steps"), F.size("inputs").alias("padded"),
                         tidy(total, 4).alias("checksum"), F.element_at("inputs", 3)[0].alias("third_x"))
