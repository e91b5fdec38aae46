import pytest
from frames import star
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillwise.plans import segments
from tillwise.sources.staging import stage

SCHEMA = "customer_id BIGINT, recency_days INT, frequency BIGINT, monetary DOUBLE, cluster INT"


@pytest.fixture(scope="module")
def rfm(spark):
    """Five well separated groups of customers."""
    centres = [(2, 50, 9000.0), (10, 30, 4000.0), (20, 2, 100.0), (200, 12, 1500.0), (350, 1, 20.0)]
    rows = [
        (group * 100 + i, recency + i % 3, frequency + i % 2, monetary + i)
        for group, (recency, frequency, monetary) in enumerate(centres)
        for i in range(40)
    ]
    return stage(spark.createDataFrame(rows, SCHEMA.removesuffix(", cluster INT")), "test")


def labelled(spark, *rows):
    done = segments.label_segments(spark.createDataFrame(list(rows), SCHEMA)).collect()
    return {r.cluster: r.segment for r in done}


def test_recency_counts_back_from_the_last_day_of_all(spark):
    s = star(spark, ("1", "A", 1, "2020-01-10", 2, 5.0), ("1", "B", 1, "2020-01-10", 1, 2.5),
             ("2", "A", 2, "2020-02-01", 1, 5.0))
    assert sorted(tuple(r) for r in segments.rfm_base(s).collect()) == [(1, 22, 1, 12.5), (2, 0, 1, 5.0)]


def test_scores_split_customers_evenly(spark, rfm):
    scores = segments.rfm_scores(rfm)
    for name in ("recency_score", "frequency_score", "monetary_score"):
        assert [r["count"] for r in scores.groupBy(name).count().collect()] == [50] * 4
    top = scores.first()
    assert (top.recency_score, top.frequency_score, top.monetary_score) == (4, 4, 4)


def test_scaled_features_are_standardised(spark, rfm):
    row = segments.rfm_scaled(rfm).agg(
        *(F.avg(m) for m in segments.METRICS), *(F.stddev_pop(m) for m in segments.METRICS)
    ).first()
    assert tuple(row) == pytest.approx((0, 0, 0, 1, 1, 1), abs=1e-9)


def test_constant_feature_becomes_zero(spark):
    df = spark.createDataFrame([(1, 5, 2, 1.0), (2, 5, 3, -4.0)], SCHEMA.removesuffix(", cluster INT"))
    assert [r.recency_days for r in segments.rfm_scaled(df).collect()] == [0.0, 0.0]
    assert [r.monetary for r in segments.rfm_features(df).orderBy("customer_id").collect()][1] == 0.0


def test_clusters_find_the_groups(spark, rfm):
    done = segments.segment_customers(rfm, starts=4).collect()
    assert len({r.customer_id for r in done}) == len(done) == 200
    assert len({(r.customer_id // 100, r.cluster) for r in done}) == 5
    assert {r.segment for r in done if r.customer_id < 100} == {"Champions"}
    assert {r.segment for r in done if r.customer_id >= 400} == {"Lost"}
    sizes = segments.segment_sizes(segments.segment_customers(rfm, starts=1)).collect()
    assert sum(r.customers for r in sizes) == 200


def test_labels_do_not_depend_on_cluster_numbers(spark):
    rows = [(1, 1, 9, 90.0), (2, 50, 5, 50.0), (3, 100, 1, 10.0)]
    first = labelled(spark, *[(*r, i) for i, r in enumerate(rows)])
    second = labelled(spark, *[(*r, 2 - i) for i, r in enumerate(rows)])
    assert first == {0: "Champions", 1: "Loyal", 2: "New"}
    assert second == {2: "Champions", 1: "Loyal", 0: "New"}


def test_one_cluster_and_equal_clusters(spark):
    assert labelled(spark, (1, 1, 1, 1.0, 3)) == {3: "Champions"}
    assert labelled(spark, (1, 1, 1, 1.0, 1), (2, 1, 1, 1.0, 0)) == {0: "Champions", 1: "Loyal"}


def test_six_clusters_are_an_error(spark, rfm):
    with pytest.raises(PySparkException, match="more clusters than segment names"):
        labelled(spark, *[(i, i, i, float(i), i) for i in range(6)])
    with pytest.raises(ValueError):
        segments.cluster_customers(rfm, k=6)


def test_profile_and_shares(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 10.0, "Loyal"), (2, 2, 2, 30.0, "Loyal"), (3, 9, 1, 60.0, "At Risk")],
        "customer_id BIGINT, recency_days INT, frequency BIGINT, monetary DOUBLE, segment STRING",
    )
    profile = {r.segment: tuple(r)[1:] for r in segments.segment_profile(df).collect()}
    assert profile == {"Loyal": (1.5, 1.5, 20.0), "At Risk": (9.0, 1.0, 60.0)}
    share = {r.segment: (r.customer_share, r.monetary_share) for r in segments.segment_share(df).collect()}
    assert share == {"Loyal": (2 / 3, 0.4), "At Risk": (1 / 3, 0.6)}
    assert [r.customer_id for r in segments.at_risk_customers(df.withColumn("cluster", F.lit(0))).collect()] == [3]


def test_segments_do_not_depend_on_the_layout(spark, rfm):
    def result(table):
        return sorted(map(tuple, segments.segment_customers(table).select("customer_id", "segment").collect()))

    assert result(rfm) == result(stage(rfm.repartition(7, "monetary"), "moved"))
