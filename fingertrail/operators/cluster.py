"""Clustering with MLlib over touch rows, and the comparison of scalers, anomaly detectors and clusterings."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.numeric import finite_or_zero
from fingertrail.operators import ward
from fingertrail.session import settle

CLUSTERS = 4
SEED = 42


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    clean = df.withColumns({f"_v_{f}": finite_or_zero(F.col(f)) for f in features})
    assembler = VectorAssembler(inputCols=[f"_v_{f}" for f in features], outputCol="_features")
    return assembler.transform(clean).drop(*[f"_v_{f}" for f in features])


def cluster(df: DataFrame, features: list[str], how: str = "kmeans", k: int = CLUSTERS) -> DataFrame:
    """Rows with their ``cluster``: kmeans, gaussian_mixture, bisecting, or ward (over a bounded number of cluster features)."""
    if how == "ward":
        return ward.ward(df, features, k)
    models = {"kmeans": KMeans, "gaussian_mixture": GaussianMixture, "bisecting": BisectingKMeans}
    if how not in models:
        raise ValueError(f"unknown clustering {how}")
    estimator = models[how](k=k, seed=SEED, featuresCol="_features", predictionCol="cluster")
    vectors = _vectors(settle(df), features)  # every round of a fit reads them
    return Pipeline(stages=[estimator]).fit(vectors).transform(vectors).drop("probability")


def _lines(spark, rows: list[dict], schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def compare_scalers(df: DataFrame, features: list[str], hot_rows: int, at_most: int | None = None) -> DataFrame:
    """One line per scaler: mean and largest variance, mean absolute mean, condition, score."""
    import numpy as np

    from fingertrail.operators.anomaly import scale
    lines = []
    for how in ("standard", "robust", "minmax"):
        scaled = scale(df, features, how, hot_rows, at_most)
        stats = scaled.agg(
            *[F.var_pop(f).alias(f"v_{f}") for f in features], *[F.avg(f).alias(f"m_{f}") for f in features],
            *[F.covar_samp(a, b).alias(f"c_{i}_{j}") for i, a in enumerate(features) for j, b in enumerate(features)]).first()
        variances = np.array([stats[f"v_{f}"] or 0.0 for f in features])
        means = np.array([stats[f"m_{f}"] or 0.0 for f in features])
        matrix = np.array([[stats[f"c_{i}_{j}"] or 0.0 for j in range(len(features))] for i in range(len(features))])
        condition = float(np.linalg.cond(matrix))
        lines.append({
            "scaler": how, "mean_variance": float(variances.mean()), "max_variance": float(variances.max()),
            "mean_absolute_mean": float(np.abs(means).mean()), "condition_number": condition,
            "overall_score": float((1 / (1 + variances.mean()) + 1 / (1 + np.abs(means).mean())
                                    + 1 / (1 + np.log(condition))) / 3)})
    return _lines(df.sparkSession, lines, "scaler string, mean_variance double, max_variance double, "
                  "mean_absolute_mean double, condition_number double, overall_score double")


def anomaly_comparison_line(marked: DataFrame, name: str) -> DataFrame:
    """Outlier share, score range and spread of one detector's result, and its weighted score.

    The share counts 0.6 by closeness to a tenth, the range 0.2. Run time is left out: it is not a
    property of the result.
    """
    line = marked.agg(F.avg(F.when(F.col("anomaly_type") == "outlier", 1.0).otherwise(0.0)).alias("outlier_ratio"),
                      (F.max("anomaly_score") - F.min("anomaly_score")).alias("score_range"),
                      F.stddev_pop("anomaly_score").alias("score_std"))
    line = line.withColumn("ratio_score", F.lit(1.0) - F.abs(F.col("outlier_ratio") - 0.1))
    score = F.col("ratio_score") * 0.6 + F.col("score_range") / (F.col("score_range") + 1.0) * 0.2
    return line.select(F.lit(name).alias("algorithm"), "*", score.alias("overall_score"))


def clustering_comparison_line(clustered: DataFrame, features: list[str], name: str) -> DataFrame:
    """Clusters, noise share, silhouette, balance and weighted score of one clustering (-1 is noise).

    The silhouette is by true distances, exact for up to ``ward.LEAVES`` different points and within bounds beyond (see
    ``ward.silhouette``); noise counts as a cluster of its own there. For more clusters than a quarter of that it is the squared form.
    """
    clustered = settle(clustered.select("cluster", *features))
    counts = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    line = counts.agg(
        F.count_if(F.col("cluster") >= 0).alias("n_clusters"),
        (F.sum(F.when(F.col("cluster") < 0, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("noise_ratio"),
        F.avg(F.when(F.col("cluster") >= 0, F.col("_n"))).alias("_mean"),
        F.stddev_pop(F.when(F.col("cluster") >= 0, F.col("_n"))).alias("_std"))
    clusters = line.first()["n_clusters"]
    if clusters > ward.LEAVES // 4:  # more than a bounded table of leaves can hold
        evaluator = ClusteringEvaluator(featuresCol="_features", predictionCol="cluster")
        silhouette = evaluator.evaluate(_vectors(clustered, features).withColumn("cluster", F.col("cluster").cast("double")))
    else:
        silhouette = ward.silhouette(clustered, features).first()["silhouette"] if clusters > 1 else 0.0
    balance = F.when(F.col("n_clusters") > 1, F.greatest(F.lit(0.0), F.lit(1.0) - F.col("_std") / F.col("_mean"))).otherwise(0.0)
    line = line.withColumns({"silhouette_score": F.lit(silhouette), "cluster_balance": balance})
    score = (F.col("silhouette_score") * 0.4 + (F.lit(1.0) - F.col("noise_ratio")) * 0.3 + F.col("cluster_balance") * 0.2)
    return line.select(F.lit(name).alias("algorithm"), "n_clusters", "noise_ratio", "silhouette_score",
                       "cluster_balance", score.alias("overall_score"))


def recommendations(comparison: DataFrame, subject: str, name: str = "algorithm") -> DataFrame:
    """The best line of a comparison, as advice."""
    best = comparison.orderBy(F.desc("overall_score"), name).limit(1)
    return best.select(F.lit(subject).alias("subject"), F.col(name).alias("best"), F.format_string(
        "Use %s (score: %.3f)", F.col(name), F.col("overall_score")).alias("recommendation"))
