"""K-Means segmentation: invariants of both fits (the default one also has SQL)."""

from __future__ import annotations

import pytest

from helpers import SF_SMALL
from tillroll.operators import features as FE
from tillroll.operators import segmentation as SG
from tillroll.operators import serving as SV
from tillroll.plans.registry import AS_OF, clean_df

ALLOWED = {name for name, _ in SG.CLUSTER_NAMES} | {SG.CLUSTER_DEFAULT_NAME}


@pytest.fixture(scope="module")
def features(spark):
    from tillroll.session import materialize

    return materialize(FE.customer_features(clean_df(spark, SF_SMALL), as_of=AS_OF), "test_cf")


def test_cluster_names_follow_rule_order(spark):
    means = [(0, 59.0, 6.0, 501.0), (1, 89.0, 4.0, 1.0), (2, 59.0, 3.0, 1.0),
             (3, 180.0, 4.0, 1.0), (4, 180.0, 3.0, 1.0), (5, 100.0, 3.0, 1.0)]
    df = spark.createDataFrame(means, "cluster_id int, avg_recency double, avg_frequency double, avg_monetary double")
    got = [r.segment_name for r in SG.name_clusters(df).orderBy("cluster_id").collect()]
    assert got == ["Champions", "Loyal Customers", "Promising", "At Risk", "Hibernating",
                   "Needs Attention"]


def test_segments_cover_every_prepared_customer_once(spark, features):
    prepared = SG.prepare_features(features)
    _, segmented = SG.segment(features)
    seg = SG.customer_segments(segmented)
    assert seg.columns == SG.SEGMENT_COLUMNS
    assert seg.count() == prepared.count()
    assert seg.where("segment_name IS NULL OR cluster_id IS NULL").count() == 0
    assert {r.segment_name for r in seg.select("segment_name").distinct().collect()} <= ALLOWED
    k = seg.select("cluster_id").distinct().count()
    assert 1 <= k <= SG.DEFAULT_K


@pytest.mark.parametrize("method", ["lloyd", "ml"])
def test_labels_do_not_depend_on_input_layout(spark, features, method):
    layouts = [features, features.orderBy("CustomerID"), features.repartition(7),
               features.repartition(13, "Country")]
    labels = []
    for df in layouts:
        _, segmented = SG.segment(df, method=method)
        labels.append(sorted((r.CustomerID, r.Country, r.cluster_id)
                             for r in segmented.select("CustomerID", "Country", "cluster_id").collect()))
    assert all(lab == labels[0] for lab in labels[1:])


def test_sweep_and_serving(spark, features):
    costs = SG.k_sweep(SG.pin_layout(SG.prepare_features(features)), k_values=[2, 3]).collect()
    assert [r.k for r in costs] == [2, 3] and all(r.cost > 0 for r in costs)
    _, segmented = SG.segment(features)
    seg = SG.customer_segments(segmented)
    summary = SV.segments_summary(seg).collect()
    assert sum(r.customer_count for r in summary) == seg.count()
    names = [r.segment_name for r in SV.list_segments(seg).collect()]
    assert names == sorted(names)
    detail = SV.segment_detail(seg, names[0]).collect()
    assert len(detail) == 1 and detail[0].customer_count > 0
    assert SV.segment_detail(seg, "no such segment").count() == 0
    cid = seg.select("CustomerID").first()[0]
    assert SV.customer_segment(seg, cid).count() == 1
    assert SV.customer_segment(seg, -1).count() == 0
    profiles = SG.segment_profiles(segmented).collect()
    assert sum(r.customer_count for r in profiles) == seg.count()


def test_silhouette_floor_and_best_of_seeds(spark, features):
    from pyspark.ml.evaluation import ClusteringEvaluator

    prepared = SG.pin_layout(SG.prepare_features(features))
    one = SG.train_kmeans(prepared)
    best = SG.train_kmeans(prepared, extra_seeds=(7, 11, 2024))
    cost = lambda m: m.stages[-1].summary.trainingCost
    assert cost(best) <= cost(one)
    scored = best.transform(prepared)
    sil = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id").evaluate(scored)
    assert sil > 0.2


def test_labels_do_not_depend_on_shuffle_setting(spark, features):
    def labels():
        _, segmented = SG.segment(features)
        return sorted((r.CustomerID, r.Country, r.cluster_id)
                      for r in segmented.select("CustomerID", "Country", "cluster_id").collect())

    base = labels()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert labels() == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("method", ["lloyd", "ml"])
def test_saved_model_scores_again(spark, features, tmp_path, method):
    prepared = SG.pin_layout(SG.prepare_features(features))
    model = SG.fit(prepared, k=3, method=method)
    path = SG.save_model(model, str(tmp_path / "model"), 3)
    again = SG.load_model(spark, path, method)
    key = ["CustomerID", "Country", "cluster_id"]
    want = sorted(map(tuple, SG.assign_clusters(prepared, model).select(*key).collect()))
    assert sorted(map(tuple, SG.assign_clusters(prepared, again).select(*key).collect())) == want
    few = prepared.limit(3)  # rows are scaled as the fit's were, not by themselves
    assert {tuple(r) for r in SG.assign_clusters(few, again).select(*key).collect()} <= set(want)


def test_exact_fit_on_clear_groups(spark):
    """Three clear groups: k = 3 is recommended both ways, and the fit finds them."""
    from tillroll.operators import kmeans as K

    rows = [(i, "UK", (i % 3) * 100.0 + i % 5, (i % 3 == 1) * 50.0 + i % 4) for i in range(90)]
    df = spark.createDataFrame(rows, "CustomerID int, Country string, a double, b double")
    costs = SG.k_sweep(df, ["a", "b"], k_values=range(1, 7))
    best = [r.k for r in costs.collect() if r.is_knee] + [r.k for r in costs.collect() if r.is_widest]
    assert best == [3, 3] and SG.recommended_k(costs) == 3
    cost = [r.cost for r in costs.collect()]
    assert cost == sorted(cost, reverse=True)
    labels = K.assign(df, K.fit(df, ["a", "b"], 3, 50)).select("CustomerID", "cluster_id").collect()
    groups = {}
    for r in labels:
        groups.setdefault(r.cluster_id, set()).add(r.CustomerID % 3)
    assert sorted(map(sorted, groups.values())) == [[0], [1], [2]]


def test_few_rows_and_flat_features(spark):
    from tillroll.operators import kmeans as K

    df = spark.createDataFrame([(1, "UK", 2.0, None), (2, None, 2.0, 5.0), (2, None, 2.0, 5.0)],
                               "CustomerID int, Country string, flat double, b double")
    got = K.assign(df, K.fit(df, ["flat", "b"], 3, 10))
    assert got.count() == 3 and {r.cluster_id for r in got.collect()} <= {0, 1, 2}
    empty = df.limit(0)
    assert K.assign(empty, K.fit(empty, ["flat", "b"], 2, 10)).count() == 0
    assert SG.k_sweep(empty, ["flat", "b"], k_values=[2, 3]).count() == 0 and SG.recommended_k(SG.k_sweep(empty, ["b"])) == SG.DEFAULT_K
