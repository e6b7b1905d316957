"""Customer segmentation with K-Means: F1-F12, A9.

Training data is the customer feature table (one row per customer/country).
The default fit is ``operators.kmeans``: aggregates whose result depends on the rows
alone. Spark ML's K-Means is the other choice (``method="ml"``); its result
depends on how rows are partitioned (k-means|| sampling is per
partition), so its input layout is pinned before every fit: a fixed number of
hash partitions on CustomerID, sorted within each. The prepared rows are first
written as a table under the session's reliable checkpoint directory, which
cuts the lineage the iterative fits would otherwise re-run (and survives a
lost executor); the layout is then pinned on the stored rows.
"""

from __future__ import annotations

import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import kmeans
from tillroll.session import materialize

# The features used for clustering, in vector order.
FEATURE_COLUMNS = [
    "recency_days",
    "frequency",
    "monetary",
    "avg_transaction_value",
    "unique_products",
    "customer_age_days_fe",
    "engagement_score_fe",
    "spending_last_30_days",
    "spending_last_90_days",
]

SEED = 42
SWEEP_ITER = 20
TRAIN_ITER = 100
DEFAULT_K = 5
# Partitions of the pinned K-Means input: k-means|| depends on them, so the number
# is a stated parameter and never follows the row count; set it once per table.
LAYOUT_PARTITIONS = 8

# Cluster naming rules on cluster means (ordered, first match wins).
CLUSTER_NAMES = [
    ("Champions", lambda r, f, m: (r < 60) & (f > 5) & (m > 500)),
    ("Loyal Customers", lambda r, f, m: (r < 90) & (f > 3)),
    ("Promising", lambda r, f, m: (r < 60) & (f <= 3)),
    ("At Risk", lambda r, f, m: (r >= 180) & (f > 3)),
    ("Hibernating", lambda r, f, m: r >= 180),
]
CLUSTER_DEFAULT_NAME = "Needs Attention"

# Output columns of the segments table.
SEGMENT_COLUMNS = [
    "CustomerID", "cluster_id", "segment_name", "recency_days", "frequency", "monetary",
    "customer_segment", "avg_transaction_value", "unique_products", "engagement_score_fe",
]


def prepare_features(cf: DataFrame, feature_cols=None) -> DataFrame:
    """customers with frequency > 0 and monetary > 0; NULL -> 0 in the
    feature columns."""
    cols = list(feature_cols or FEATURE_COLUMNS)
    return cf.where((F.col("frequency") > 0) & (F.col("monetary") > 0)).fillna(0, subset=cols)


def pin_layout(df: DataFrame, partitions: int = LAYOUT_PARTITIONS, checkpoint: bool = True) -> DataFrame:
    """Q22: a layout that does not depend on how the input was read.

    With ``checkpoint`` the rows are first stored (one write job) so the fits
    never re-run the feature pipeline; hash partitioning on CustomerID into
    ``partitions`` partitions and the sort inside each are functions of the rows
    only."""
    if checkpoint:
        df = materialize(df, "kmeans_input")
    return df.repartition(partitions, "CustomerID").sortWithinPartitions("CustomerID", "Country")


def _assembler(cols) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features_raw")


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)


def scaled_features(prepared: DataFrame, feature_cols=None) -> DataFrame:
    """``prepared`` with ``<feature>_scaled`` columns, (x - mean) / sample
    standard deviation as the assembler and scaler of the fit give them."""
    cols = list(feature_cols or FEATURE_COLUMNS)
    scaled = Pipeline(stages=[_assembler(cols), _scaler()]).fit(prepared).transform(prepared)
    values = vector_to_array("features")
    return scaled.select(*prepared.columns, *[values[i].alias(f"{c}_scaled") for i, c in enumerate(cols)])


def assign_to_centres(scaled: DataFrame, centres: dict[str, list[float]]) -> DataFrame:
    """F6 for centres given in scaled space (one list per feature, a value for
    each centre): + cluster_id of the nearest one, the first of equal ones."""
    k = len(next(iter(centres.values())))
    distances = F.array(*[
        sum(((F.col(f"{c}_scaled") - F.lit(float(v[i]))) * (F.col(f"{c}_scaled") - F.lit(float(v[i]))) for c, v in centres.items()), F.lit(0.0))
        for i in range(k)
    ])
    nearest = F.array_position(distances, F.array_min(distances)) - 1
    return scaled.withColumn("cluster_id", nearest.cast("int")).drop(*[c for c in scaled.columns if c.endswith("_scaled")])


def k_sweep(prepared: DataFrame, feature_cols=None, k_values=range(2, 11), max_iter: int = SWEEP_ITER) -> DataFrame:
    """every k fitted side by side, one scan per iteration for all of them:
    (k, cost, silhouette, chord_gap, is_knee, is_widest). ``recommended_k`` picks."""
    return kmeans.sweep(prepared, list(feature_cols or FEATURE_COLUMNS), list(k_values), max_iter)


def recommended_k(costs: DataFrame) -> int:
    """The k at the knee of the cost curve."""
    row = costs.where("is_knee").first()
    return row.k if row else DEFAULT_K


def ml_sweep(prepared: DataFrame, feature_cols=None, k_values=range(2, 11),
             max_iter: int = SWEEP_ITER, seed: int = SEED) -> DataFrame:
    """F4 with Spark ML, one fit after another: a table (k, cost)."""
    cols = list(feature_cols or FEATURE_COLUMNS)
    spark = prepared.sparkSession
    assembled = _assembler(cols).transform(prepared)
    scaled = _scaler().fit(assembled).transform(assembled).select("CustomerID", "features")
    scaled = scaled.persist()
    try:
        rows = []
        for k in k_values:
            model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                           predictionCol="cluster").fit(scaled)
            rows.append((int(k), float(model.summary.trainingCost)))
    finally:
        scaled.unpersist()
    return spark.createDataFrame(rows, "k int, cost double")


def train_kmeans(prepared: DataFrame, feature_cols=None, k: int = DEFAULT_K,
                 max_iter: int = TRAIN_ITER, seed: int = SEED,
                 extra_seeds: tuple[int, ...] = ()) -> PipelineModel:
    """F2+F3+F5 with Spark ML: assemble -> standard-scale -> K-Means(k) pipeline.

    With ``extra_seeds`` the K-Means stage is also fitted from those seeds on
    the same scaled rows and the fit with the lowest training cost is kept."""
    cols = list(feature_cols or FEATURE_COLUMNS)

    def kmeans(sd: int) -> KMeans:
        return KMeans(k=k, seed=sd, maxIter=max_iter, featuresCol="features",
                      predictionCol="cluster_id")

    if not extra_seeds:
        return Pipeline(stages=[_assembler(cols), _scaler(), kmeans(seed)]).fit(prepared)
    prep = Pipeline(stages=[_assembler(cols), _scaler()]).fit(prepared)
    scaled = prep.transform(prepared).select("features").persist()
    try:
        fits = [kmeans(sd).fit(scaled) for sd in (seed, *extra_seeds)]
    finally:
        scaled.unpersist()
    best = min(fits, key=lambda m: m.summary.trainingCost)
    return PipelineModel(stages=[*prep.stages, best])


def fit(prepared: DataFrame, feature_cols=None, k: int = DEFAULT_K, max_iter: int = TRAIN_ITER,
        method: str = "lloyd") -> kmeans.Centres | PipelineModel:
    """``lloyd`` (aggregates, the same on every layout) or ``ml``."""
    if method == "ml":
        return train_kmeans(prepared, feature_cols, k, max_iter)
    return kmeans.fit(prepared, list(feature_cols or FEATURE_COLUMNS), k, max_iter)


def assign_clusters(prepared: DataFrame, model: kmeans.Centres | PipelineModel) -> DataFrame:
    """+ cluster_id."""
    if isinstance(model, kmeans.Centres):
        return kmeans.assign(prepared, model)
    return model.transform(prepared).drop("features_raw", "features")


def cluster_stats(clustered: DataFrame) -> DataFrame:
    """mean recency, frequency, monetary per cluster (k rows)."""
    return clustered.groupBy("cluster_id").agg(
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("monetary").alias("avg_monetary"),
    )


def name_clusters(stats: DataFrame) -> DataFrame:
    """F8: ordered naming rules on the cluster means (never NULL)."""
    r, f, m = F.col("avg_recency"), F.col("avg_frequency"), F.col("avg_monetary")
    expr = None
    for label, rule in CLUSTER_NAMES:
        expr = F.when(rule(r, f, m), label) if expr is None else expr.when(rule(r, f, m), label)
    return stats.withColumn("segment_name", expr.otherwise(CLUSTER_DEFAULT_NAME))


def assign_segments(clustered: DataFrame) -> DataFrame:
    """segment_name by cluster_id through a k-row broadcast join (the
    name table is bounded by k)."""
    names = name_clusters(cluster_stats(clustered)).select("cluster_id", "segment_name")
    return clustered.join(F.broadcast(names), "cluster_id", "left")


def segment_profiles(segmented: DataFrame) -> DataFrame:
    """customers and six means per segment name, largest first."""
    return (
        segmented.groupBy("segment_name")
        .agg(
            F.count("CustomerID").alias("customer_count"),
            F.avg("recency_days").alias("avg_recency_days"),
            F.avg("frequency").alias("avg_frequency"),
            F.avg("monetary").alias("avg_monetary"),
            F.avg("avg_transaction_value").alias("avg_transaction_value"),
            F.avg("unique_products").alias("avg_unique_products"),
            F.avg("engagement_score_fe").alias("avg_engagement_score_fe"),
        )
        .orderBy(F.col("customer_count").desc(), "segment_name")
    )


def customer_segments(segmented: DataFrame) -> DataFrame:
    """the 10-column gold/customer_segments table."""
    return segmented.select(*SEGMENT_COLUMNS)


def model_metadata(spark: SparkSession, k: int, feature_cols=None) -> DataFrame:
    """A9 metadata as a one-row table (n_clusters, features, training_date)."""
    cols = list(feature_cols or FEATURE_COLUMNS)
    return spark.range(1).select(
        F.lit(int(k)).alias("n_clusters"),
        F.array(*[F.lit(c) for c in cols]).alias("features"),
        F.current_timestamp().alias("training_date"),
    )


def save_model(model: kmeans.Centres | PipelineModel, path: str, k: int, feature_cols=None) -> str:
    """The model (overwrite) + metadata next to it."""
    spark = SparkSession.getActiveSession()
    if isinstance(model, kmeans.Centres):
        kmeans.save(model, spark, os.path.join(path, "centres"))
    else:
        model.write().overwrite().save(os.path.join(path, "kmeans_pipeline"))
    model_metadata(spark, k, feature_cols).write.mode("overwrite").json(
        os.path.join(path, "metadata")
    )
    return path


def load_model(spark: SparkSession, path: str, method: str = "lloyd") -> kmeans.Centres | PipelineModel:
    """A saved model, ready for ``assign_clusters`` on any prepared rows."""
    if method == "ml":
        return PipelineModel.load(os.path.join(path, "kmeans_pipeline"))
    return kmeans.load(spark, os.path.join(path, "centres"))


def segment(cf: DataFrame, k: int = DEFAULT_K, feature_cols=None, partitions: int = LAYOUT_PARTITIONS,
            checkpoint: bool = True, method: str = "lloyd"):
    """F1 -> F5 -> F6 -> F9: returns (model, segmented DataFrame). Spark ML's
    layout is pinned to ``partitions``; the aggregates need none."""
    prepared = prepare_features(cf, feature_cols)
    if method == "ml":
        prepared = pin_layout(prepared, partitions, checkpoint)
    elif checkpoint:
        prepared = materialize(prepared, "kmeans_input")
    model = fit(prepared, feature_cols, k=k, method=method)
    return model, assign_segments(assign_clusters(prepared, model))


def run_segmentation(cf: DataFrame, k: int | None = DEFAULT_K, sweep=range(2, 11), feature_cols=None,
                     model_path: str | None = None, method: str = "lloyd"):
    """prepare, sweep k, train with ``k`` (None: the sweep's knee), name
    segments, profile them, save model. Returns (segments, profiles, costs)."""
    prepared = pin_layout(prepare_features(cf, feature_cols))
    costs = materialize(k_sweep(prepared, feature_cols, k_values=sweep), "k_sweep") if sweep else None
    if k is None:
        k = recommended_k(costs) if sweep else DEFAULT_K
    model = fit(prepared, feature_cols, k=k, method=method)
    segmented = assign_segments(assign_clusters(prepared, model))
    if model_path:
        save_model(model, model_path, k, feature_cols)
    return customer_segments(segmented), segment_profiles(segmented), costs
