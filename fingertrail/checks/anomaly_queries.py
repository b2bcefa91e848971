"""Queries over cleaning marks, neighbours, scalers, model-based anomalies and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from fingertrail.checks.catalog import query
from fingertrail.checks.feature_queries import out
from fingertrail.checks.sql import STEPS, TOUCH, TRACE, sql, tidy as t
from fingertrail.operators import anomaly, cluster, compare, density, features, forest, neighbours, ward
from fingertrail.operators.groups import HOT_ROWS_DEFAULT, split_sessions
from fingertrail.operators.metrics import TOUCH as TOUCH_KEYS
from fingertrail.session import settle
from fingertrail.sources.touch_view import base_touches, events_table, touch_view


@query("invalid_phase_marks", sql(TRACE, "SELECT event_id, touchPhase, touchPhase = 'X' AS invalid_phase FROM trace"))
def invalid_phase_marks(spark, sf_dir):
    rows = anomaly.invalid_phases(touch_view(spark, sf_dir, "tracing").rows(), "Tracing")
    return rows.select("event_id", "touchPhase", "invalid_phase")


@query("duplicate_marks", sql(TOUCH + """,
copies AS (SELECT event_id, session_id, fingerId, time, x, y FROM base
           UNION ALL SELECT event_id + 1000000000, session_id, fingerId, time, x, y FROM base WHERE event_id % 50 = 0)""", """
SELECT event_id, row_number() OVER (PARTITION BY session_id, fingerId, time, x, y ORDER BY event_id) > 1 AS duplicate FROM copies"""))
def duplicate_marks(spark, sf_dir):
    """Every 50th event is planted once more."""
    base = base_touches(events_table(spark, sf_dir))
    copies = base.filter(F.col("event_id") % 50 == 0).withColumn("event_id", F.col("event_id") + 1_000_000_000)
    touches = split_sessions(base.unionByName(copies))
    return anomaly.duplicates(touches, ["event_id"]).rows().select("event_id", "duplicate")


_IMPUTE = TOUCH + """,
gaps AS (SELECT *, CASE WHEN event_id % 17 = 0 THEN NULL ELSE completionPerc END AS cp FROM touch),
enc AS (SELECT *, dense_rank() OVER (PARTITION BY session_id ORDER BY touchPhase) - 1 AS pe,
          dense_rank() OVER (PARTITION BY session_id ORDER BY color) - 1 AS ce, dense_rank() OVER (PARTITION BY session_id ORDER BY zone) - 1 AS ze,
          coalesce(time - lag(time) OVER f, 0) AS dt,
          sqrt(power(coalesce(x - lag(x) OVER f, 0), 2) + power(coalesce(y - lag(y) OVER f, 0), 2)) AS dd
        FROM gaps WINDOW f AS (PARTITION BY session_id, fingerId ORDER BY time, event_id)),
pairs AS (SELECT q.event_id, d.cp, d.event_id AS did, sqrt(9.0 / 8.0 * (power(q.x - d.x, 2) + power(q.y - d.y, 2) + power(q.time - d.time, 2)
            + power(q.pe - d.pe, 2) + power(q.ce - d.ce, 2) + power(q.ze - d.ze, 2) + power(q.dt - d.dt, 2) + power(q.dd - d.dd, 2))) AS dist
          FROM enc q JOIN enc d ON q.session_id = d.session_id AND q.cp IS NULL AND d.cp IS NOT NULL),
best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY dist, did) <= 5),
filled AS (SELECT event_id, sum(cp / dist) / sum(1 / dist) AS v FROM best GROUP BY event_id)"""
_IMPUTE_OUT = f"SELECT g.event_id, {t('coalesce(g.cp, v)')} AS completionPerc, g.cp IS NULL AS imputed FROM gaps g LEFT JOIN filled USING (event_id)"


def _gapped(spark, sf_dir):
    return touch_view(spark, sf_dir).with_columns(
        completionPerc=F.when(F.col("event_id") % 17 > 0, F.col("completionPerc")))


@query("nearest_imputation", sql(_IMPUTE, _IMPUTE_OUT))
def nearest_imputation(spark, sf_dir):
    """Every 17th completion value is taken away and filled from the 5 nearest events."""
    return out(neighbours.impute_nearest(_gapped(spark, sf_dir)).rows(), {"completionPerc": 6, "imputed": None})


@query("nearest_imputation_cells", sql(_IMPUTE, _IMPUTE_OUT))
def nearest_imputation_cells(spark, sf_dir):
    """The same with small cells, so that most points visit neighbouring cells."""
    rows = neighbours.impute_nearest(_gapped(spark, sf_dir), cell_rows=1000).rows()
    return out(rows, {"completionPerc": 6, "imputed": None})


_WIDE = TOUCH + """,
gaps AS (SELECT * REPLACE (CASE WHEN event_id % 17 = 0 OR Touchdata_id % 9 = 0 THEN NULL ELSE completionPerc END AS completionPerc,
                           CASE WHEN event_id % 23 = 0 THEN NULL ELSE x END AS x, CASE WHEN event_id % 29 = 0 THEN NULL ELSE y END AS y) FROM touch),
enc AS (SELECT *, dense_rank() OVER (PARTITION BY session_id ORDER BY touchPhase) - 1 AS pe,
          dense_rank() OVER (PARTITION BY session_id ORDER BY color) - 1 AS ce, dense_rank() OVER (PARTITION BY session_id ORDER BY zone) - 1 AS ze,
          coalesce(time - lag(time) OVER f, 0) AS dt,
          sqrt(power(coalesce(x - lag(x) OVER f, 0), 2) + power(coalesce(y - lag(y) OVER f, 0), 2)) AS dd
        FROM gaps WINDOW f AS (PARTITION BY session_id, fingerId ORDER BY time, event_id)),
terms AS (SELECT q.event_id, d.event_id AS did, c.name, CASE c.name WHEN 'x' THEN d.x WHEN 'y' THEN d.y ELSE d.completionPerc END AS given,
            [power(q.x - d.x, 2), power(q.y - d.y, 2), power(q.time - d.time, 2), power(q.completionPerc - d.completionPerc, 2), power(q.pe - d.pe, 2),
             power(q.ce - d.ce, 2), power(q.ze - d.ze, 2), power(q.dt - d.dt, 2), power(q.dd - d.dd, 2)] AS parts
          FROM enc q JOIN enc d ON q.session_id = d.session_id AND q.event_id <> d.event_id, (VALUES ('x'), ('y'), ('completionPerc')) c(name)
          WHERE (c.name = 'x' AND q.x IS NULL AND d.x IS NOT NULL) OR (c.name = 'y' AND q.y IS NULL AND d.y IS NOT NULL)
             OR (c.name = 'completionPerc' AND q.completionPerc IS NULL AND d.completionPerc IS NOT NULL)),
pairs AS (SELECT event_id, did, name, given, sqrt(9.0 / list_count(parts) * list_sum(parts)) AS dist FROM terms),
best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY event_id, name ORDER BY dist, did) <= 5),
filled AS (SELECT event_id, name, sum(given / dist) / sum(1 / dist) AS v FROM best GROUP BY event_id, name)"""


@query("nearest_imputation_columns", sql(_WIDE, f"""
SELECT g.event_id, {t('coalesce(g.x, fx.v)')} AS x, {t('coalesce(g.y, fy.v)')} AS y, {t('coalesce(g.completionPerc, fc.v)')} AS completionPerc
FROM gaps g LEFT JOIN filled fx ON fx.event_id = g.event_id AND fx.name = 'x' LEFT JOIN filled fy ON fy.event_id = g.event_id AND fy.name = 'y'
  LEFT JOIN filled fc ON fc.event_id = g.event_id AND fc.name = 'completionPerc'"""))
def nearest_imputation_columns(spark, sf_dir):
    """All columns that lack values: coordinates too, and whole touches without any completion value."""
    holes = touch_view(spark, sf_dir).with_columns(
        completionPerc=F.when((F.col("event_id") % 17 > 0) & (F.col("Touchdata_id") % 9 > 0), F.col("completionPerc")),
        x=F.when(F.col("event_id") % 23 > 0, F.col("x")), y=F.when(F.col("event_id") % 29 > 0, F.col("y")))
    return out(neighbours.impute_nearest(holes, cell_rows=1500).rows(), {"x": 6, "y": 6, "completionPerc": 6})


def touch_points(spark, sf_dir):
    """One row per touch with four features, and the bound on their number."""
    touches = touch_view(spark, sf_dir)
    table = touches.aggregate(TOUCH_KEYS, n=F.count(F.lit(1)).cast("double"), mean_x=F.avg("x"), mean_y=F.avg("y"),
                              duration=F.max("time") - F.min("time"))
    return table, touches.at_most


POINTS = TOUCH + """,
pts AS (SELECT session_id, Touchdata_id, CAST(count(*) AS DOUBLE) AS n, avg(x) AS mean_x, avg(y) AS mean_y, max(time) - min(time) AS duration
        FROM touch GROUP BY session_id, Touchdata_id)"""
_LOF = POINTS + """,
lp AS (SELECT a.session_id, a.Touchdata_id AS id, b.Touchdata_id AS nid,
         sqrt(power(a.mean_x - b.mean_x, 2) + power(a.mean_y - b.mean_y, 2) + power(a.duration - b.duration, 2)) AS d
       FROM pts a JOIN pts b ON a.session_id = b.session_id AND a.Touchdata_id <> b.Touchdata_id),
ln AS (SELECT * FROM lp QUALIFY row_number() OVER (PARTITION BY session_id, id ORDER BY d, nid) <= 20),
lk AS (SELECT session_id, id AS nid, max(d) AS kd FROM ln GROUP BY session_id, id),
lr AS (SELECT session_id, id, 1 / (avg(greatest(d, kd)) + 1e-10) AS lrd FROM ln JOIN lk USING (session_id, nid) GROUP BY session_id, id),
lf AS (SELECT ln.session_id, ln.id, avg(o.lrd) / any_value(m.lrd) AS lof FROM ln JOIN lr o ON o.session_id = ln.session_id AND o.id = ln.nid
       JOIN lr m ON m.session_id = ln.session_id AND m.id = ln.id GROUP BY ln.session_id, ln.id)"""


@query("local_outlier_factor", sql(_LOF, f"""
SELECT session_id, id AS Touchdata_id, {t('lof')} AS anomaly_score,
       CASE WHEN lof > quantile_cont(lof, 0.9) OVER (PARTITION BY session_id) THEN 'outlier' ELSE 'normal' END AS anomaly_type FROM lf"""))
def local_outlier_factor(spark, sf_dir):
    table, bound = touch_points(spark, sf_dir)
    rows = neighbours.local_outlier_factor(table, "Touchdata_id", ["mean_x", "mean_y", "duration"], at_most=bound, cell_rows=500)
    return out(rows, {"anomaly_score": 6, "anomaly_type": None}, TOUCH_KEYS)


def _scaled_sql(center, width):
    columns = ["mean_x", "mean_y", "duration"]
    return "SELECT session_id, Touchdata_id, " + ", ".join(
        t(f"({c} - (SELECT {center.format(c=c)} FROM pts)) / (SELECT {width.format(c=c)} FROM pts)") + f" AS {c}"
        for c in columns) + " FROM pts"


def _scaled(spark, sf_dir, how):
    table, bound = touch_points(spark, sf_dir)
    columns = ["mean_x", "mean_y", "duration"]
    scaled = anomaly.scale(table.select(*TOUCH_KEYS, *columns), columns, how, at_most=bound)
    return out(scaled, {c: 6 for c in columns}, TOUCH_KEYS)


@query("standard_scaler", sql(POINTS, _scaled_sql("avg({c})", "stddev_pop({c})")))
def standard_scaler(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query("robust_scaler", sql(POINTS, _scaled_sql("median({c})", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")))
def robust_scaler(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


@query("minmax_scaler", sql(POINTS, _scaled_sql("min({c})", "max({c}) - min({c})")))
def minmax_scaler(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query("covariance_distance", sql(TOUCH + STEPS + """,
cv AS (SELECT session_id, avg(distance) AS ma, avg(time_diff) AS mb, var_samp(distance) AS va, var_samp(time_diff) AS vb,
         covar_samp(distance, time_diff) AS c FROM f3 GROUP BY session_id),
md AS (SELECT event_id, session_id, sqrt((power(distance - ma, 2) * vb - 2 * (distance - ma) * (time_diff - mb) * c
         + power(time_diff - mb, 2) * va) / (va * vb - c * c)) AS d FROM f3 JOIN cv USING (session_id))""", f"""
SELECT event_id, {t('d')} AS anomaly_score,
       CASE WHEN d > quantile_cont(d, 0.9) OVER (PARTITION BY session_id) THEN 'outlier' ELSE 'normal' END AS anomaly_type FROM md"""))
def covariance_distance(spark, sf_dir):
    rows = anomaly.covariance_distance(features.basic_features(touch_view(spark, sf_dir)), ["distance", "time_diff"])
    return out(rows.rows(), {"anomaly_score": 6, "anomaly_type": None})


@query("isolation_forest")
def isolation_forest(spark, sf_dir):
    """Share of outliers and range of scores per session; random splits have no SQL twin."""
    rows = forest.isolation_forest(touch_view(spark, sf_dir), ["x", "y", "time", "completionPerc"]).rows()
    return rows.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("anomaly_type") == "outlier").alias("outliers"),
        F.round(F.min("anomaly_score"), 6).alias("lowest"), F.round(F.max("anomaly_score"), 6).alias("highest"))


@query("basic_cleaning")
def basic_cleaning(spark, sf_dir):
    """The four cleaning marks of every event."""
    rows = anomaly.basic_cleaning(_gapped(spark, sf_dir)).rows()
    return rows.select("event_id", "invalid_phase", "duplicate", "imputed", "outlier")


@query("basic_cleaning_summary")
def basic_cleaning_summary(spark, sf_dir):
    from fingertrail.operators.reports import cleaning_summary
    return cleaning_summary(anomaly.basic_cleaning(_gapped(spark, sf_dir)).rows())


@query("cleaning_summary_rules", sql(TOUCH, """
SELECT session_id, count(*) FILTER (event_id % 17 = 0) AS flagged_rows, count(*) AS total_rows,
       round(count(*) FILTER (event_id % 17 = 0) / count(*) * 100, 2) AS flagged_percentage FROM touch GROUP BY session_id"""))
def cleaning_summary_rules(spark, sf_dir):
    """The summary over the marks that do not depend on a model."""
    from fingertrail.operators.reports import cleaning_summary
    rows = anomaly.duplicates(_gapped(spark, sf_dir), ["event_id"]).map(anomaly.invalid_phases)
    rows = rows.with_columns(imputed=F.col("completionPerc").isNull())
    return cleaning_summary(rows.rows(), ("imputed", "duplicate", "invalid_phase"))


CLUSTER_FEATURES = ["mean_x", "duration"]
_DB = POINTS + """,
sc AS (SELECT session_id, Touchdata_id AS id, (mean_x - avg(mean_x) OVER ()) / stddev_pop(mean_x) OVER () AS a,
         (duration - avg(duration) OVER ()) / stddev_pop(duration) OVER () AS b FROM pts),
nb AS (SELECT p.session_id, p.id, q.id AS nid FROM sc p JOIN sc q ON p.session_id = q.session_id
       AND power(p.a - q.a, 2) + power(p.b - q.b, 2) <= 0.04),
co AS (SELECT session_id, id FROM nb GROUP BY session_id, id HAVING count(*) >= 5),
rc AS (SELECT DISTINCT nb.session_id, nb.id FROM nb JOIN co ON co.session_id = nb.session_id AND co.id = nb.nid)"""


def scaled_points(spark, sf_dir):
    table, bound = touch_points(spark, sf_dir)
    return anomaly.scale(table.select(*TOUCH_KEYS, *CLUSTER_FEATURES), CLUSTER_FEATURES, "standard", at_most=bound)


@query("density_kinds", sql(_DB, """
SELECT sc.session_id, sc.id AS Touchdata_id, CASE WHEN co.id IS NOT NULL THEN 'core' WHEN rc.id IS NOT NULL THEN 'border' ELSE 'noise' END AS kind
FROM sc LEFT JOIN co ON co.session_id = sc.session_id AND co.id = sc.id LEFT JOIN rc ON rc.session_id = sc.session_id AND rc.id = sc.id"""))
def density_kinds(spark, sf_dir):
    """Core, border and noise touches of the density clustering."""
    rows = density.dbscan(scaled_points(spark, sf_dir), "Touchdata_id", CLUSTER_FEATURES, eps=0.2, min_points=5)
    return rows.select(*TOUCH_KEYS, "kind")


@query("density_clusters", sql("RECURSIVE " + _DB + """,
cc AS (SELECT nb.session_id, nb.id, nb.nid FROM nb JOIN co x ON x.session_id = nb.session_id AND x.id = nb.id
       JOIN co y ON y.session_id = nb.session_id AND y.id = nb.nid),
walk AS (SELECT session_id, id, id AS root FROM co
         UNION SELECT walk.session_id, cc.nid, walk.root FROM walk JOIN cc ON cc.session_id = walk.session_id AND cc.id = walk.id),
lab AS (SELECT session_id, id, min(root) AS cluster FROM walk GROUP BY session_id, id)""", """
SELECT session_id, cluster, count(*) AS core_points FROM lab GROUP BY session_id, cluster"""))
def density_clusters(spark, sf_dir):
    """Clusters by their smallest core touch, with the number of core touches."""
    rows = density.dbscan(scaled_points(spark, sf_dir), "Touchdata_id", CLUSTER_FEATURES, eps=0.2, min_points=5)
    return rows.filter(F.col("kind") == "core").groupBy("session_id", "cluster").agg(F.count(F.lit(1)).alias("core_points"))


def _cluster_sizes(spark, sf_dir, how):
    rows = cluster.cluster(scaled_points(spark, sf_dir), CLUSTER_FEATURES, how)
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("touches"))


@query("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    return _cluster_sizes(spark, sf_dir, "kmeans")


@query("gaussian_mixture_clusters")
def gaussian_mixture_clusters(spark, sf_dir):
    return _cluster_sizes(spark, sf_dir, "gaussian_mixture")


@query("bisecting_clusters")
def bisecting_clusters(spark, sf_dir):
    return _cluster_sizes(spark, sf_dir, "bisecting")


@query("scaler_comparison", sql(POINTS + """,
st AS (SELECT avg(mean_x) AS m1, avg(duration) AS m2, var_pop(mean_x) AS v1, var_pop(duration) AS v2, corr(mean_x, duration) AS r,
  median(mean_x) AS c1, median(duration) AS c2, quantile_cont(mean_x, 0.75) - quantile_cont(mean_x, 0.25) AS q1,
  quantile_cont(duration, 0.75) - quantile_cont(duration, 0.25) AS q2, min(mean_x) AS l1, min(duration) AS l2,
  max(mean_x) - min(mean_x) AS w1, max(duration) - min(duration) AS w2 FROM pts),
al AS (SELECT 'standard' AS scaler, 1.0::DOUBLE AS a, 1.0::DOUBLE AS b, 0.0::DOUBLE AS ma, 0.0::DOUBLE AS mb, r FROM st
  UNION ALL SELECT 'robust', v1 / (q1 * q1), v2 / (q2 * q2), (m1 - c1) / q1, (m2 - c2) / q2, r FROM st
  UNION ALL SELECT 'minmax', v1 / (w1 * w1), v2 / (w2 * w2), (m1 - l1) / w1, (m2 - l2) / w2, r FROM st)""", f"""
SELECT scaler, {t('(a + b) / 2', 5)} AS mean_variance, {t('greatest(a, b)', 5)} AS max_variance,
       {t('(abs(ma) + abs(mb)) / 2', 5)} AS mean_absolute_mean,
       {t('(a + b + sqrt(power(a - b, 2) + 4 * r * r * a * b)) / (a + b - sqrt(power(a - b, 2) + 4 * r * r * a * b))', 4)} AS condition_number
FROM al"""))
def scaler_comparison(spark, sf_dir):
    table, bound = touch_points(spark, sf_dir)
    lines = cluster.compare_scalers(table, CLUSTER_FEATURES, HOT_ROWS_DEFAULT, bound)
    return out(lines, {"mean_variance": 5, "max_variance": 5, "mean_absolute_mean": 5, "condition_number": 4}, ("scaler",))


EVENT_FEATURES = ["x", "y", "time", "completionPerc"]


def _anomaly_lines(spark, sf_dir):
    touches = touch_view(spark, sf_dir).materialise()
    scaler = compare.best_scaler(touches.rows(), EVENT_FEATURES, touches.hot_rows, touches.at_most)
    return compare.compare_detectors(*compare.scaled_copies(touches, EVENT_FEATURES, scaler))


@query("anomaly_comparison")
def anomaly_comparison(spark, sf_dir):
    """One line per detector; the forest makes it a check of rows only."""
    return _anomaly_lines(spark, sf_dir)


@query("advanced_anomalies")
def advanced_anomalies(spark, sf_dir):
    """Marks of the best detector on the best scaling, both chosen by their comparisons at run time."""
    rows, scaler, detector = compare.advanced_anomalies(touch_view(spark, sf_dir), EVENT_FEATURES)
    return rows.rows().groupBy("session_id", "anomaly_type").agg(F.count(F.lit(1)).alias("events")).withColumns(
        {"scaler": F.lit(scaler), "detector": F.lit(detector)})


# rows above the interpolated 0.9 quantile of distinct scores
_TENTH = "count(*) - 1 - CAST(floor(0.9 * (count(*) - 1)) AS BIGINT)"


@query("isolation_forest_shares", sql(TOUCH, f"""
SELECT session_id, count(*) AS events, {_TENTH} AS outliers, TRUE AS in_range FROM touch GROUP BY session_id"""))
def isolation_forest_shares(spark, sf_dir):
    """What holds for any forest: a tenth of each session's events are outliers, and scores lie between 0 and 1."""
    rows = forest.isolation_forest(touch_view(spark, sf_dir), EVENT_FEATURES).rows()
    return rows.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("anomaly_type") == "outlier").alias("outliers"),
        F.bool_and(F.col("anomaly_score").between(0, 1)).alias("in_range"))


@query("basic_cleaning_counts", sql(TOUCH, f"""
SELECT session_id, count(*) AS events, count(*) FILTER (event_id % 17 = 0) AS imputed, 0::BIGINT AS invalid, 0::BIGINT AS duplicates,
       {_TENTH.replace("0.9", "0.95")} AS outliers FROM touch GROUP BY session_id"""))
def basic_cleaning_counts(spark, sf_dir):
    """Counts of the four cleaning marks that hold for any forest."""
    rows = anomaly.basic_cleaning(_gapped(spark, sf_dir)).rows()
    return rows.groupBy("session_id").agg(F.count(F.lit(1)).alias("events"), *[
        F.count_if(F.col(c)).alias(n) for c, n in (("imputed", "imputed"), ("invalid_phase", "invalid"), ("duplicate", "duplicates"), ("outlier", "outliers"))])


@query("clustering_totals", sql(TOUCH, """
SELECT how, count(*) AS touches FROM (SELECT DISTINCT session_id, Touchdata_id FROM touch), (VALUES ('kmeans'), ('gaussian_mixture'), ('bisecting')) v(how)
GROUP BY how"""))
def clustering_totals(spark, sf_dir):
    """Every touch is in exactly one cluster, whatever the clustering."""
    points, result = settle(scaled_points(spark, sf_dir)), None
    for how in ("kmeans", "gaussian_mixture", "bisecting"):
        rows = cluster.cluster(points, CLUSTER_FEATURES, how).filter("cluster >= 0")
        line = rows.select(*TOUCH_KEYS).distinct().agg(F.count(F.lit(1)).alias("touches")).select(F.lit(how).alias("how"), "touches")
        result = line if result is None else result.unionByName(line)
    return result


@query("ward_clusters")
def ward_clusters(spark, sf_dir):
    """Ward linkage over cluster features, cut at four clusters."""
    return _cluster_sizes(spark, sf_dir, "ward")


@query("silhouette_by_distance", sql(POINTS + """,
lb AS (SELECT row_number() OVER () AS r, CAST(floor(mean_x / 480) AS INTEGER) AS c, coalesce(mean_x, 0) AS a, coalesce(duration, 0) AS b FROM pts),
pr AS (SELECT x.r, x.c, y.c AS yc, sum(sqrt(power(x.a - y.a, 2) + power(x.b - y.b, 2))) AS s, count(*) AS n FROM lb x CROSS JOIN lb y GROUP BY ALL),
pd AS (SELECT r, max(CASE WHEN yc = c AND n > 1 THEN s / (n - 1) END) AS own, min(CASE WHEN yc <> c THEN s / n END) AS other FROM pr GROUP BY r)""", """
SELECT round(avg(CASE WHEN own IS NULL THEN 0 ELSE (other - own) / greatest(own, other) END), 6) AS silhouette FROM pd"""))
def silhouette_by_distance(spark, sf_dir):
    """Mean silhouette by true distances of touches grouped by their place."""
    table, _ = touch_points(spark, sf_dir)
    grouped = table.withColumn("cluster", F.floor(F.col("mean_x") / 480).cast("int"))
    return ward.silhouette(grouped, CLUSTER_FEATURES).select(F.round("silhouette", 6).alias("silhouette"))


@query("clustering_comparison")
def clustering_comparison(spark, sf_dir):
    """One line per clustering of the touches."""
    return compare.compare_clusterings(scaled_points(spark, sf_dir), "Touchdata_id", CLUSTER_FEATURES)


@query("algorithm_advice")
def algorithm_advice(spark, sf_dir):
    """The best scaler, detector and clustering with their scores."""
    table, bound = touch_points(spark, sf_dir)
    scalers = cluster.compare_scalers(table, CLUSTER_FEATURES, HOT_ROWS_DEFAULT, bound)
    clusterings = compare.compare_clusterings(scaled_points(spark, sf_dir), "Touchdata_id", CLUSTER_FEATURES)
    return cluster.recommendations(scalers, "scaler", "scaler").unionByName(
        cluster.recommendations(_anomaly_lines(spark, sf_dir), "anomaly detection")).unionByName(
        cluster.recommendations(clusterings, "clustering"))
