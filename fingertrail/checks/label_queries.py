"""Queries over quality, behaviour, labels, statistical anomalies, subsets and reports on labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from fingertrail.checks.catalog import query
from fingertrail.checks.core_queries import flagged
from fingertrail.checks.feature_queries import QUALITY_SQL, WINDOW, out
from fingertrail.checks.sql import FLAGS, PATTERN, STEPS, TOUCH, sql, tidy as t
from fingertrail.operators import anomaly, features, labels, projections, quality, reports
from fingertrail.operators.metrics import TOUCH as TOUCH_KEYS
from fingertrail.plans import cleaning
from fingertrail.schema import LABEL_COLUMNS
from fingertrail.sources.touch_view import touch_view

# one row per touch; phases are asked of the word of phase letters
_PROFILE_BODY = """
  SELECT session_id, Touchdata_id, any_value(word) AS word, count(*) AS n, max(time) - min(time) AS dur,
         avg(dt) AS mt, stddev_samp(dt) AS st, bool_or(coalesce(dt < 0, FALSE)) AS neg,
         coalesce(sum(dd), 0) AS td, avg(dd) AS md, stddev_samp(dd) AS sd, max(dd) AS xd,
         max(x) - min(x) AS xr, max(y) - min(y) AS yr, avg(velocity) AS mv, stddev_samp(velocity) AS sv"""
_STEPPED = """,
steps AS (SELECT *, CASE WHEN event_index > 0 THEN time_diff END AS dt, CASE WHEN event_index > 0 THEN distance END AS dd
          FROM f3 JOIN letters USING (session_id, Touchdata_id))"""
PROFILE = STEPS + _STEPPED + f""",
prof AS ({_PROFILE_BODY} FROM steps GROUP BY session_id, Touchdata_id)"""

# a middle of moves, stops and cancels only: no begin or end inside the word
QUALITY = """,
parts AS (
  SELECT *,
    CASE WHEN n < 2 THEN 0::DOUBLE ELSE least(1::DOUBLE, CASE WHEN word LIKE 'B%' THEN 0.4::DOUBLE ELSE 0::DOUBLE END
      + CASE WHEN word LIKE '%E' THEN 0.4::DOUBLE WHEN word LIKE '%C' THEN 0.2::DOUBLE ELSE 0::DOUBLE END
      + CASE WHEN regexp_full_match(word, '.[MSC]*.') THEN 0.2::DOUBLE ELSE 0::DOUBLE END) END AS comp,
    CASE WHEN n < 3 OR neg OR mt <= 0 THEN 0::DOUBLE ELSE greatest(0::DOUBLE, 1 - least(1::DOUBLE, st / mt)) END AS temp,
    CASE WHEN n < 2 THEN 0::DOUBLE WHEN n < 3 THEN 1::DOUBLE WHEN md = 0 THEN CASE WHEN sd = 0 THEN 1::DOUBLE ELSE 0::DOUBLE END
         ELSE greatest(0::DOUBLE, 1 - least(1::DOUBLE, sd / md / 2)) END AS spat
  FROM prof),
qual AS (SELECT *, 0.4::DOUBLE * comp + 0.3::DOUBLE * temp + 0.3::DOUBLE * spat AS score FROM parts),
tier AS (SELECT *, CASE WHEN score >= 0.8 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS quality_tier,
  CASE WHEN n < 2 THEN 'unknown' WHEN word = 'BE' THEN 'tap' WHEN word LIKE '%M%' AND n > 3 THEN 'drag'
       WHEN word LIKE '%S%' THEN 'hold' ELSE 'complex' END AS pattern,
  CASE WHEN n < 2 THEN 'unknown' WHEN word LIKE 'B%E' THEN 'deliberate' WHEN word LIKE '%C%' THEN 'interrupted' ELSE 'irregular' END AS style,
  CASE WHEN n < 2 THEN 0::DOUBLE WHEN word LIKE 'B%E' THEN 0.9::DOUBLE WHEN word LIKE '%C%' THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END AS confidence,
  CASE WHEN n < 2 THEN 'unknown' WHEN n < 3 THEN 'minimal' WHEN td < 10 THEN 'stationary' WHEN xd > md * 5 THEN 'erratic'
       WHEN sd < md * 0.5 THEN 'smooth' ELSE 'variable' END AS movement,
  CASE WHEN n > 1 THEN CASE WHEN dur < 100 THEN 'quick' WHEN dur > 2000 THEN 'slow' ELSE 'normal' END END AS tempo
  FROM qual)"""

BASE = TOUCH + PATTERN + PROFILE + QUALITY


def profile(spark, sf_dir):
    return quality.touch_profile(touch_view(spark, sf_dir))


@query("sequence_quality", sql(BASE, f"""
SELECT session_id, Touchdata_id, {t('comp')} AS sequence_completeness, {t('temp')} AS temporal_consistency,
       {t('spat')} AS spatial_consistency, {t('score')} AS ml_quality_score, quality_tier FROM tier"""))
def sequence_quality(spark, sf_dir):
    return out(quality.sequence_quality(profile(spark, sf_dir)), {
        "sequence_completeness": 6, "temporal_consistency": 6, "spatial_consistency": 6,
        "ml_quality_score": 6, "quality_tier": None}, TOUCH_KEYS)


SIMPLE = """,
simple AS (SELECT *, CASE WHEN n < 2 THEN 0::DOUBLE ELSE least(1::DOUBLE, CASE WHEN word LIKE 'B%' THEN 0.4::DOUBLE ELSE 0::DOUBLE END
   + CASE WHEN word LIKE '%E' THEN 0.4::DOUBLE WHEN word LIKE '%C' THEN 0.2::DOUBLE ELSE 0::DOUBLE END
   + CASE WHEN n BETWEEN 2 AND 20 THEN 0.2::DOUBLE ELSE 0::DOUBLE END) END AS sq,
  CASE WHEN word = 'BE' THEN 'tap' WHEN word LIKE '%M%' AND n > 3 THEN 'drag' WHEN word LIKE '%C%' THEN 'interrupted' ELSE 'complex' END AS sp
  FROM prof)"""


@query("simple_quality", sql(BASE + SIMPLE, f"""
SELECT session_id, Touchdata_id, {t('sq')} AS ml_quality_score,
       CASE WHEN sq >= 0.8 THEN 'high' WHEN sq >= 0.5 THEN 'medium' ELSE 'low' END AS quality_tier FROM simple"""))
def simple_quality(spark, sf_dir):
    return out(quality.simple_quality(profile(spark, sf_dir)), {"ml_quality_score": 6, "quality_tier": None}, TOUCH_KEYS)


@query("behaviour", sql(BASE, """
SELECT session_id, Touchdata_id, pattern AS behavioral_pattern, style AS interaction_style,
       confidence AS user_intent_confidence, movement AS movement_type, tempo AS temporal_pattern FROM tier"""))
def behaviour(spark, sf_dir):
    return quality.behaviour(profile(spark, sf_dir)).select(*TOUCH_KEYS, *cleaning.BEHAVIOUR_COLUMNS, "temporal_pattern")


@query("simple_behaviour", sql(BASE + SIMPLE, """
SELECT session_id, Touchdata_id, sp AS behavioral_pattern,
       CASE sp WHEN 'tap' THEN 'deliberate' WHEN 'drag' THEN 'deliberate' WHEN 'interrupted' THEN 'interrupted' ELSE 'unknown' END AS interaction_style,
       CASE sp WHEN 'tap' THEN 0.9::DOUBLE WHEN 'drag' THEN 0.8::DOUBLE WHEN 'interrupted' THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END AS user_intent_confidence FROM simple"""))
def simple_behaviour(spark, sf_dir):
    return quality.simple_behaviour(profile(spark, sf_dir)).select(
        *TOUCH_KEYS, "behavioral_pattern", "interaction_style", "user_intent_confidence")


ENHANCED = """,
eb AS (SELECT *,
  CASE WHEN n <= 2 THEN 'unknown' WHEN dur < 0.5 THEN 'quick' WHEN dur > 5 THEN 'hesitant' WHEN st / mt < 0.3 THEN 'precise' ELSE 'erratic' END AS estyle,
  CASE WHEN n <= 2 THEN 0.5::DOUBLE WHEN dur < 0.5 THEN 0.7::DOUBLE WHEN dur > 5 THEN 0.9::DOUBLE WHEN st / mt < 0.3 THEN 0.95::DOUBLE ELSE 0.4::DOUBLE END AS conf,
  CASE WHEN NOT regexp_full_match(word, 'B.+E') THEN 'incomplete' WHEN word LIKE '%C%' THEN 'interrupted'
       WHEN regexp_full_match(word, '[BMSE]*') THEN 'complete' ELSE 'irregular' END AS epattern,
  CASE WHEN td < 10 THEN 'stationary' WHEN xd > md * 5 THEN 'erratic' WHEN coalesce(sd < md * 0.5, FALSE) THEN 'smooth' ELSE 'variable' END AS emove
  FROM prof),
enh AS (SELECT *, CASE WHEN n < 2 THEN 0.5::DOUBLE ELSE greatest(0::DOUBLE, least(1::DOUBLE, conf *
   CASE epattern WHEN 'interrupted' THEN 0.7::DOUBLE WHEN 'complete' THEN 1.1::DOUBLE WHEN 'irregular' THEN 0.8::DOUBLE ELSE 0.5::DOUBLE END)) END AS econf FROM eb)"""


@query("enhanced_behaviour", sql(BASE + ENHANCED, f"""
SELECT session_id, Touchdata_id, CASE WHEN n < 2 THEN 'unknown' ELSE epattern END AS behavioral_pattern,
       CASE WHEN n < 2 THEN 'unknown' ELSE estyle END AS interaction_style, {t('econf')} AS user_intent_confidence,
       CASE WHEN n < 2 THEN 'unknown' ELSE emove END AS movement_type FROM enh"""))
def enhanced_behaviour(spark, sf_dir):
    return out(quality.enhanced_behaviour(profile(spark, sf_dir)), {
        "behavioral_pattern": None, "interaction_style": None, "user_intent_confidence": 6,
        "movement_type": None}, TOUCH_KEYS)


# ---- statistical anomalies --------------------------------------------------------------------

SESSION = "OVER (PARTITION BY session_id)"
SIMPLE_ANOMALY = f""",
za AS (SELECT *, CASE WHEN stddev_samp(distance) {SESSION} > 0
         THEN abs((distance - avg(distance) {SESSION}) / stddev_samp(distance) {SESSION}) ELSE 0 END AS z FROM f3),
anom AS (SELECT event_id, z / 3 AS anomaly_score, CASE WHEN z > 3 THEN 'outlier' ELSE 'normal' END AS anomaly_type FROM za)"""


@query("simple_anomalies", sql(TOUCH + STEPS + SIMPLE_ANOMALY, f"""
SELECT event_id, {t('anomaly_score')} AS anomaly_score, anomaly_type FROM anom"""))
def simple_anomalies(spark, sf_dir):
    rows = anomaly.simple_anomalies(features.basic_features(touch_view(spark, sf_dir))).rows()
    return out(rows, {"anomaly_score": 6, "anomaly_type": None})


OUTLIER_FEATURES = ["x", "time_diff", "velocity", "completionPerc"]


def _fence_sql():
    stats = ", ".join(
        f"avg({c}) {SESSION} AS m{i}, stddev_samp({c}) {SESSION} AS s{i}, quantile_cont({c}, 0.25) {SESSION} AS a{i}, "
        f"quantile_cont({c}, 0.75) {SESSION} AS b{i}" for i, c in enumerate(OUTLIER_FEATURES))
    z = [f"CASE WHEN s{i} > 0 AND abs({c} - m{i}) / s{i} > 3 THEN abs({c} - m{i}) / s{i} END" for i, c in enumerate(OUTLIER_FEATURES)]
    f = [f"CASE WHEN b{i} > a{i} AND ({c} < a{i} - 1.5 * (b{i} - a{i}) OR {c} > b{i} + 1.5 * (b{i} - a{i})) THEN 1 END"
         for i, c in enumerate(OUTLIER_FEATURES)]
    hits = f"[v for v in [{', '.join(z + f)}] if v IS NOT NULL]"
    return f""",
fs AS (SELECT *, {stats} FROM f3),
fh AS (SELECT *, {hits} AS hits FROM fs),
fx AS (SELECT *, coalesce(list_sum(hits), 0) / greatest(len(hits), 1) AS fscore FROM fh),
fence AS (SELECT *, CASE WHEN fscore > quantile_cont(fscore, 0.9) {SESSION} THEN 'outlier' ELSE 'normal' END AS fence_type,
            fscore / (max(fscore) {SESSION} + 1e-8) AS fconf FROM fx)"""


FENCE = _fence_sql()


def fenced(touches):
    rows = features.spatial_features(features.temporal_features(touches))
    return anomaly.statistical_outliers(rows, OUTLIER_FEATURES)


@query("statistical_outliers", sql(TOUCH + STEPS + FENCE, f"""
SELECT event_id, {t('fscore')} AS anomaly_score, fence_type AS anomaly_type, {t('fconf')} AS anomaly_confidence FROM fence"""))
def statistical_outliers(spark, sf_dir):
    rows = fenced(touch_view(spark, sf_dir)).rows()
    return out(rows, {"anomaly_score": 6, "anomaly_type": None, "anomaly_confidence": 6})


# ---- labels -----------------------------------------------------------------------------------

ENHANCED_QUALITY = BASE + ENHANCED + FENCE + """,
shares AS (SELECT session_id, Touchdata_id, avg(CASE WHEN fence_type = 'outlier' THEN 1 ELSE 0 END) AS share
           FROM fence GROUP BY session_id, Touchdata_id),
eq AS (SELECT *, greatest(0, least(100, 100 * (0.4::DOUBLE * CASE WHEN regexp_full_match(word, 'B.*E') THEN 1::DOUBLE WHEN word LIKE '%B%' OR word LIKE '%E%' THEN 0.6::DOUBLE ELSE 0.2::DOUBLE END
  + 0.3::DOUBLE * CASE WHEN n <= 2 THEN 0.5::DOUBLE ELSE greatest(0::DOUBLE, 1 - st / (mt + 1e-8)) * CASE WHEN neg THEN 0.5::DOUBLE ELSE 1::DOUBLE END END
  + 0.2::DOUBLE * CASE WHEN n <= 2 THEN 0.5::DOUBLE ELSE greatest(0::DOUBLE, 1 - 0.5::DOUBLE * (sd / (md + 1e-8))) * CASE WHEN xd > 10 * md THEN 0.7::DOUBLE ELSE 1::DOUBLE END END
  + 0.1::DOUBLE * greatest(0::DOUBLE, 1 - 2 * share)))) AS escore
  FROM enh JOIN shares USING (session_id, Touchdata_id))"""


@query("enhanced_quality", sql(ENHANCED_QUALITY, f"""
SELECT session_id, Touchdata_id, {t('escore')} AS ml_quality_score FROM eq"""))
def enhanced_quality(spark, sf_dir):
    table = quality.enhanced_quality(quality.touch_profile(fenced(touch_view(spark, sf_dir))))
    return out(table, {"ml_quality_score": 6}, TOUCH_KEYS)


_KIND = """CASE WHEN {f} = '' THEN 'None'
  WHEN regexp_matches(lower({f}), 'missing_began|missing_ended|improper_sequence_order|orphaned_events|multiple_end_events|unterminated') THEN 'Technical'
  WHEN regexp_matches(lower({f}), 'zero_distance|phantom_move|overlapping_fingerids') THEN 'Spatial'
  WHEN regexp_matches(lower({f}), 'has_canceled|too_few_points|short_duration') THEN 'Behavioral' ELSE 'Technical' END"""

_FIRST = """,
firsts AS (SELECT session_id, Touchdata_id, arg_min(flags, event_index) AS ff FROM flagged GROUP BY session_id, Touchdata_id)"""

CONSOLIDATED = FLAGS + PROFILE + QUALITY + _FIRST + SIMPLE_ANOMALY + f""",
marks AS (SELECT session_id, Touchdata_id, arg_min(anomaly_type, event_index) AS fa,
            bool_or(fast) AS fast FROM (
              SELECT f3.session_id, f3.Touchdata_id, event_index, anomaly_type,
                stddev_samp(velocity) {WINDOW} > 0 AND abs(velocity - median(velocity) {WINDOW}) > 3 * stddev_samp(velocity) {WINDOW} AS fast
              FROM f3 JOIN anom USING (event_id)) GROUP BY session_id, Touchdata_id),
l1 AS (SELECT *, CAST(floor(least(100, greatest(0, score * 100))) AS INTEGER) AS qs,
  CASE WHEN pattern = 'tap' THEN 'Quick' WHEN pattern = 'hold' THEN 'Hesitant' WHEN pattern = 'complex' THEN 'Erratic'
       WHEN n <= 2 THEN 'Unknown' WHEN mv < 10 THEN 'Precise' WHEN mv > 50 THEN 'Quick' WHEN sv > 0.8 * mv THEN 'Erratic' ELSE 'Hesitant' END AS it,
  CASE WHEN fa = 'outlier' THEN CASE WHEN NOT regexp_full_match(word, 'B[MS]*C?[MS]*E') THEN 'Technical' WHEN fast THEN 'Spatial' ELSE 'Behavioral' END
       ELSE {_KIND.format(f='ff')} END AS af
  FROM tier JOIN firsts USING (session_id, Touchdata_id) JOIN marks USING (session_id, Touchdata_id)),
l1s AS (SELECT *, CASE WHEN qs >= 80 AND af = 'None' THEN 'All'
  WHEN qs >= 60 THEN CASE WHEN af IN ('None', 'Behavioral') THEN CASE WHEN it IN ('Precise', 'Quick') THEN 'Timing,Spatial' ELSE 'Behavioral' END
                          WHEN af = 'Technical' THEN 'Behavioral' ELSE 'Timing' END
  WHEN qs >= 40 THEN CASE af WHEN 'None' THEN 'Behavioral' WHEN 'Behavioral' THEN 'Timing' ELSE 'Limited' END
  ELSE 'Limited' END AS rs FROM l1)"""
_LABEL_OUT = "qs AS quality_score, it AS interaction_type, af AS anomaly_flag, rs AS research_suitability"


@query("consolidated_labels", sql(CONSOLIDATED, f"SELECT session_id, Touchdata_id, {_LABEL_OUT} FROM l1s"))
def consolidated_labels(spark, sf_dir):
    return cleaning.label_touches(flagged(spark, sf_dir)).select(*TOUCH_KEYS, *LABEL_COLUMNS)


RULES = FLAGS + PROFILE + _FIRST + f""",
r1 AS (SELECT *, CAST(greatest(0, least(100, 50 + CASE WHEN n >= 2 AND word LIKE 'B%E' THEN 30 WHEN n >= 2 AND word LIKE '%C' THEN 15 ELSE 0 END
    - CASE WHEN ff <> '' THEN 20 ELSE 0 END + CASE WHEN n >= 3 THEN 10 WHEN n < 2 THEN -20 ELSE 0 END)) AS INTEGER) AS qs,
  CASE WHEN n = 2 AND dur < 200 THEN 'Quick' WHEN word LIKE '%S%' THEN 'Hesitant' WHEN dur > 1000 THEN 'Precise' ELSE 'Quick' END AS it,
  {_KIND.format(f='ff')} AS af FROM prof JOIN firsts USING (session_id, Touchdata_id)),
r2 AS (SELECT *, CASE WHEN qs >= 80 AND af = 'None' THEN 'All' WHEN qs >= 60 THEN CASE WHEN af = 'None' THEN 'Timing,Spatial' ELSE 'Behavioral' END
                      WHEN qs >= 40 THEN 'Behavioral' ELSE 'Limited' END AS rs FROM r1)"""


@query("rule_labels", sql(RULES, f"SELECT session_id, Touchdata_id, {_LABEL_OUT} FROM r2"))
def rule_labels(spark, sf_dir):
    return labels.rule_labels(quality.touch_profile(flagged(spark, sf_dir))).select(*TOUCH_KEYS, *LABEL_COLUMNS)


@query("enhanced_labels", sql(ENHANCED_QUALITY + """,
e1 AS (SELECT *, CAST(floor(escore) AS INTEGER) AS qs,
  CASE WHEN n >= 2 AND estyle <> 'unknown' THEN upper(estyle[1]) || estyle[2:] WHEN n < 2 THEN 'Unknown'
       WHEN dur < 0.5 THEN 'Quick' WHEN dur > 3 THEN 'Hesitant' ELSE 'Precise' END AS it,
  CASE WHEN share <= 0.5 THEN 'None' WHEN NOT regexp_full_match(word, 'B.*E') THEN 'Technical'
       WHEN n >= 2 AND emove = 'erratic' THEN 'Behavioral' WHEN xr > 1000 OR yr > 1000 THEN 'Spatial' ELSE 'Behavioral' END AS af FROM eq),
e2 AS (SELECT *, CASE WHEN escore >= 80 THEN CASE af WHEN 'None' THEN ['Behavioral', 'Spatial', 'Timing'] WHEN 'Technical' THEN ['Behavioral']
                                                WHEN 'Spatial' THEN ['Timing'] ELSE ['Spatial', 'Timing'] END
            WHEN escore >= 60 THEN [v for v in [CASE WHEN af = 'None' THEN 'Spatial' END, CASE WHEN it = 'Precise' THEN 'Timing' END] if v IS NOT NULL]
            ELSE [] END AS tags FROM e1),
e3 AS (SELECT *, CASE WHEN it = 'Precise' AND escore >= 70 AND NOT list_contains(tags, 'Timing') THEN list_append(tags, 'Timing') ELSE tags END AS tags2 FROM e2),
e4 AS (SELECT *, CASE WHEN len(tags2) >= 3 THEN 'All' WHEN len(tags2) > 0 THEN array_to_string(list_sort(tags2), ',') ELSE 'Limited' END AS rs FROM e3)""",
    f"SELECT session_id, Touchdata_id, {_LABEL_OUT} FROM e4"))
def enhanced_labels(spark, sf_dir):
    table = labels.enhanced_labels(quality.touch_profile(fenced(touch_view(spark, sf_dir))))
    return table.select(*TOUCH_KEYS, *LABEL_COLUMNS)


@query("basic_labels", sql(BASE, """
SELECT session_id, Touchdata_id,
  CAST(CASE WHEN word LIKE '%C%' THEN greatest(30, base - 20) ELSE base END AS INTEGER) AS quality_score,
  CASE WHEN n > 1 THEN CASE WHEN dur < 0.5 THEN 'Quick' WHEN dur > 3 THEN 'Hesitant' ELSE 'Precise' END
       WHEN base = 65 THEN 'Quick' ELSE 'Unknown' END AS interaction_type,
  CASE WHEN word LIKE '%C%' THEN 'Behavioral' WHEN base = 35 THEN 'Technical' ELSE 'None' END AS anomaly_flag,
  CASE base WHEN 85 THEN 'All' WHEN 65 THEN 'Spatial' ELSE 'Limited' END AS research_suitability
FROM (SELECT *, CASE WHEN regexp_full_match(word, 'B.*E') THEN 85 WHEN word LIKE '%B%' OR word LIKE '%E%' THEN 65 ELSE 35 END AS base FROM prof)"""))
def basic_labels(spark, sf_dir):
    return labels.basic_labels(profile(spark, sf_dir)).select(*TOUCH_KEYS, *LABEL_COLUMNS)


@query("statistical_fallback_labels", sql(BASE, """
SELECT session_id, Touchdata_id, CAST(base AS INTEGER) AS quality_score,
  CASE WHEN n < 2 THEN 'Unknown' WHEN dur < 0.5 THEN 'Quick' WHEN dur > 3 THEN 'Hesitant' ELSE 'Precise' END AS interaction_type,
  'None' AS anomaly_flag, CASE base WHEN 80 THEN 'All' WHEN 60 THEN 'Spatial' ELSE 'Limited' END AS research_suitability
FROM (SELECT *, CASE WHEN regexp_full_match(word, 'B.*E') THEN 80 WHEN word LIKE '%B%' OR word LIKE '%E%' THEN 60 ELSE 30 END AS base FROM prof)"""))
def statistical_fallback_labels(spark, sf_dir):
    return labels.statistical_fallback_labels(profile(spark, sf_dir)).select(*TOUCH_KEYS, *LABEL_COLUMNS)


@query("validated_labels", sql(BASE, """
SELECT session_id, Touchdata_id,
  CAST(CASE n % 4 WHEN 0 THEN 50 WHEN 1 THEN 100 WHEN 2 THEN 0 ELSE n END AS INTEGER) AS quality_score,
  CASE WHEN n % 2 = 0 THEN 'Quick' ELSE 'Unknown' END AS interaction_type,
  CASE WHEN n % 3 = 0 THEN 'Spatial' ELSE 'None' END AS anomaly_flag,
  CASE n % 3 WHEN 0 THEN 'Timing, Spatial' ELSE 'Limited' END AS research_suitability FROM prof"""))
def validated_labels(spark, sf_dir):
    """Labels spoilt on purpose are brought back to their vocabularies."""
    n = F.col("n")
    spoilt = profile(spark, sf_dir).select(
        *TOUCH_KEYS,
        F.when(n % 4 == 0, "bad").when(n % 4 == 1, "250").when(n % 4 == 2, "-7").otherwise(n.cast("string")).alias("quality_score"),
        F.when(n % 2 == 0, "Quick").otherwise("Fast").alias("interaction_type"),
        F.when(n % 3 == 0, "Spatial").when(n % 3 == 1, "spatial").alias("anomaly_flag"),
        F.when(n % 3 == 0, "Timing, Spatial").when(n % 3 == 1, "Timing,Speed").alias("research_suitability"))
    return labels.validate_labels(spoilt)


DESCRIBED = TOUCH + PATTERN + PROFILE + QUALITY + SIMPLE_ANOMALY + f""",
qrow AS ({QUALITY_SQL}),
described AS (SELECT qrow.*, anomaly_type, score AS ml_quality_score, quality_tier, temp AS temporal_consistency,
                spat AS spatial_consistency, comp AS sequence_completeness, pattern AS behavioral_pattern, style AS interaction_style,
                confidence AS user_intent_confidence, movement AS movement_type
              FROM qrow JOIN anom USING (event_id) JOIN tier USING (session_id, Touchdata_id))"""

_ADVICE = {
    "cleaning": (
        "CASE WHEN ml_quality_score > 0.8 THEN 'timing_analysis,spatial_analysis,completion_tracking' WHEN ml_quality_score > 0.5 THEN 'general_analysis,pattern_recognition' ELSE 'quality_research' END",
        "CASE behavioral_pattern WHEN 'tap' THEN 'interaction_timing_analysis' WHEN 'drag' THEN 'movement_analysis' END",
        "CASE WHEN anomaly_type = 'outlier' THEN 'outlier_investigation' END",
        "CASE quality_tier WHEN 'high' THEN 'primary_analysis' WHEN 'medium' THEN 'secondary_analysis' ELSE 'exploratory_analysis' END"),
}


@query("usage_advice_cleaning", sql(DESCRIBED, f"""
SELECT event_id, concat_ws(',', {', '.join(_ADVICE['cleaning'])}) AS usage_recommendations FROM described"""))
def usage_advice_cleaning(spark, sf_dir):
    rows = cleaning.clean_and_enhance(touch_view(spark, sf_dir), anomalies="simple").rows()
    return rows.select("event_id", F.array_join("usage_recommendations", ",").alias("usage_recommendations"))


@query("usage_advice_short", sql(DESCRIBED, f"""
SELECT event_id, concat_ws(',', {_ADVICE['cleaning'][0]}, {_ADVICE['cleaning'][2]}) AS usage_recommendations FROM described"""))
def usage_advice_short(spark, sf_dir):
    rows = cleaning.clean_and_enhance(touch_view(spark, sf_dir), "short", anomalies="simple").rows()
    return rows.select("event_id", F.array_join("usage_recommendations", ",").alias("usage_recommendations"))


@query("simple_cleaning", sql(BASE + SIMPLE + SIMPLE_ANOMALY, f"""
SELECT event_id, {t('sq')} AS ml_quality_score, sp AS behavioral_pattern, anomaly_type, {t('anomaly_score')} AS anomaly_score,
  concat_ws(',', CASE WHEN sq > 0.8 THEN 'timing_analysis,spatial_analysis' WHEN sq > 0.5 THEN 'general_analysis' ELSE 'quality_research' END,
            CASE sp WHEN 'tap' THEN 'interaction_timing_analysis' WHEN 'drag' THEN 'movement_analysis' WHEN 'interrupted' THEN 'error_analysis' END) AS usage_recommendations
FROM f3 JOIN simple USING (session_id, Touchdata_id) JOIN anom USING (event_id)"""))
def simple_cleaning(spark, sf_dir):
    rows = cleaning.clean_simple(touch_view(spark, sf_dir)).rows()
    rows = rows.withColumn("usage_recommendations", F.array_join("usage_recommendations", ","))
    return out(rows, {"ml_quality_score": 6, "behavioral_pattern": None, "anomaly_type": None, "anomaly_score": 6,
                      "usage_recommendations": None})


@query("enhanced_cleaning", sql(DESCRIBED, f"""
SELECT event_id, {t('ml_quality_score')} AS ml_quality_score, quality_tier, {t('temporal_consistency')} AS temporal_consistency,
       {t('spatial_consistency')} AS spatial_consistency, {t('sequence_completeness')} AS sequence_completeness,
       behavioral_pattern, interaction_style, user_intent_confidence, movement_type, anomaly_type, velocity_outlier,
       sequence_valid_pattern, x, y, touchPhase, 'enhanced_v1.0' AS ml_processing_version FROM described"""))
def enhanced_cleaning(spark, sf_dir):
    """The composed cleaning path, with the deterministic anomaly marks."""
    rows = cleaning.clean_and_enhance(touch_view(spark, sf_dir), anomalies="simple").rows()
    return out(rows, {"ml_quality_score": 6, "quality_tier": None, "temporal_consistency": 6, "spatial_consistency": 6,
                      "sequence_completeness": 6, "behavioral_pattern": None, "interaction_style": None,
                      "user_intent_confidence": None, "movement_type": None, "anomaly_type": None,
                      "velocity_outlier": None, "sequence_valid_pattern": None, "x": None, "y": None,
                      "touchPhase": None, "ml_processing_version": None})


# ---- subsets ----------------------------------------------------------------------------------

_RULES = {
    "high_quality": ("ml_quality_score >= 0.8 AND quality_tier = 'high'", "sequence_valid_pattern = 1"),
    "research_grade": ("ml_quality_score >= 0.85 AND temporal_consistency >= 0.9 AND spatial_consistency >= 0.6 AND anomaly_type = 'normal'",
                       "behavioral_pattern IN ('drag', 'tap', 'hold')"),
    "timing_ready": ("temporal_consistency >= 0.8 AND time_gap_outlier = 0 AND ml_quality_score >= 0.8", "time_diff >= 0"),
    "spatial_ready": ("spatial_consistency >= 0.5 AND distance_outlier = 0 AND velocity_outlier = 0", "velocity <= 5000"),
}


def _retention_sql(saved):
    def rule(name):
        return _RULES[name][0] if saved else " AND ".join(_RULES[name])
    return " UNION ALL ".join(
        f"SELECT '{name}' AS subset, count(*) FILTER ({rule(name)}) AS points, "
        f"round(count(*) FILTER ({rule(name)}) * 100.0 / count(*), 1)::DOUBLE AS retention FROM described" for name in _RULES)


@query("subset_retention", sql(DESCRIBED, _retention_sql(False)))
def subset_retention(spark, sf_dir):
    return projections.subset_retention(cleaning.describe(touch_view(spark, sf_dir)).rows())


@query("subset_retention_saved", sql(DESCRIBED, _retention_sql(True)))
def subset_retention_saved(spark, sf_dir):
    return projections.subset_retention(cleaning.describe(touch_view(spark, sf_dir)).rows(), saved=True)


@query("subset_spatial_ready", sql(DESCRIBED, f"SELECT event_id, session_id FROM described WHERE {' AND '.join(_RULES['spatial_ready'])}"))
def subset_spatial_ready(spark, sf_dir):
    return projections.named_subset(cleaning.describe(touch_view(spark, sf_dir)).rows(), "spatial_ready").select(
        "event_id", "session_id")


# ---- reports on labels ------------------------------------------------------------------------

def _map_text(column):
    entries = F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(entries, ",")


def _counts(column):
    return (f"(SELECT string_agg({column} || '=' || c, ',' ORDER BY {column}) FROM (SELECT {column}, count(*) AS c "
            f"FROM described d WHERE d.session_id = s.session_id GROUP BY {column}))")


@query("processing_statistics", sql(DESCRIBED, f"""
SELECT session_id, points, sequences, {_counts('quality_tier')} AS tiers, {_counts('behavioral_pattern')} AS patterns,
       {_counts('anomaly_type')} AS anomalies
FROM (SELECT session_id, count(*) AS points, count(DISTINCT Touchdata_id) AS sequences FROM described GROUP BY session_id) s"""))
def processing_statistics(spark, sf_dir):
    touches = touch_view(spark, sf_dir)
    rows = cleaning.describe(touches).rows()
    table = reports.processing_statistics(rows, len(touches.columns), ["quality_tier", "behavioral_pattern", "anomaly_type"])
    return table.select("session_id", "points", "sequences", _map_text("quality_tier_counts").alias("tiers"),
                        _map_text("behavioral_pattern_counts").alias("patterns"),
                        _map_text("anomaly_type_counts").alias("anomalies"))


@query("label_distribution", sql(RULES, """
SELECT label, value, count(*) AS sequences FROM (
  SELECT 'quality_score' AS label, CAST(qs AS VARCHAR) AS value FROM r2
  UNION ALL SELECT 'interaction_type', it FROM r2 UNION ALL SELECT 'anomaly_flag', af FROM r2
  UNION ALL SELECT 'research_suitability', rs FROM r2) GROUP BY label, value"""))
def label_distribution(spark, sf_dir):
    rows = flagged(spark, sf_dir)
    chosen = labels.rule_labels(quality.touch_profile(rows)).select(*TOUCH_KEYS, *LABEL_COLUMNS)
    return reports.label_distribution(rows.attach(chosen, TOUCH_KEYS).rows(), LABEL_COLUMNS)
