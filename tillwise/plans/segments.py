"""Recency, frequency and monetary value per customer; quartiles; clusters; segments."""

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.numeric import money_sum, money_total, round_half_even, round_half_up
from tillwise.operators.selection import with_ntiles
from tillwise.operators.star import Star

# Segment names from the best to the worst ranked cluster.
SEGMENT_NAMES = ("Champions", "Loyal", "New", "At Risk", "Lost")

# Customers in one partition while clustering.
POINTS_PER_PIECE = 100_000

# Names of the three metrics.
METRICS = ("recency_days", "frequency", "monetary")


def rfm_base(star: Star) -> DataFrame:
    """Days since the last order, number of orders and spend per customer.

    Lines are added up per order first, which also splits a customer holding a large
    share of the rows. Recency counts back from the latest day of the whole table.
    """
    orders = star.fact.groupBy("customer_id", "invoice_no").agg(
        F.max("date_key").alias("order_day"), money_total("revenue").alias("amount")
    )
    last_day = star.fact.agg(F.max("date_key")).scalar()
    return (
        orders.groupBy("customer_id")
        .agg(
            F.max("order_day").alias("last_order"),
            F.count("invoice_no").alias("frequency"),
            F.sum("amount").cast("double").alias("monetary"),
        )
        .select("customer_id", F.datediff(last_day, F.col("last_order")).alias("recency_days"), "frequency", "monetary")
    )


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Quartile scores 1..4; 4 is most recent, most frequent, highest spend.

    The customers where a quartile begins are found for all three scores in the same passes;
    nothing is sorted but the result. Ties are broken by customer. ``rfm`` should be a written table.
    """
    scored = with_ntiles(
        rfm, 4, "customer_id", recency_score=("recency_days", True), frequency_score="frequency", monetary_score="monetary"
    )
    return scored.withColumn("monetary", round_half_up(F.col("monetary"), 2)).orderBy(
        F.desc("monetary"), "customer_id"
    )


def _feature(name: str) -> Column:
    """Recency as it is, the two skewed metrics on a log scale."""
    if name == "recency_days":
        return F.col(name).cast("double")
    return F.log1p(F.greatest(F.col(name).cast("double"), F.lit(0.0)))


def rfm_features(rfm: DataFrame) -> DataFrame:
    return rfm.select("customer_id", *(_feature(name).alias(name) for name in METRICS))


def _scaled(rfm: DataFrame) -> dict[str, Column]:
    """Features with mean 0 and population deviation 1; a constant feature becomes 0."""
    moments = rfm.agg(
        *(F.round(F.avg(_feature(name)), 9).alias(f"{name}_mean") for name in METRICS),
        *(F.round(F.stddev_pop(_feature(name)), 9).alias(f"{name}_dev") for name in METRICS),
    ).first()
    return {
        name: (_feature(name) - F.lit(moments[f"{name}_mean"]).cast("double"))
        / F.lit(moments[f"{name}_dev"] or 1.0)
        for name in METRICS
    }


def rfm_scaled(rfm: DataFrame) -> DataFrame:
    return rfm.select("customer_id", *(column.alias(name) for name, column in _scaled(rfm).items()))


def cluster_customers(
    rfm: DataFrame, k: int = 5, seed: int = 42, starts: int = 10, max_iter: int = 300, parallelism: int = 5
) -> DataFrame:
    """Add ``cluster`` from the cheapest of several k-means runs.

    The runs share one persisted feature table and overlap, since a single run leaves
    a cluster idle between its many small jobs. ``rfm`` should be a written table.

    A run ends when the squared moves of all centres add up to no more than 1e-4; Spark
    looks at each centre by itself, so the bound is shared out among them.
    """
    if not 1 <= k <= len(SEGMENT_NAMES):
        raise ValueError(f"k must lie between 1 and {len(SEGMENT_NAMES)}, one name per cluster")
    tolerance = (1e-4 / k) ** 0.5
    inputs = {f"scaled_{name}": column for name, column in _scaled(rfm).items()}
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features")
    # Starting centres are drawn partition by partition, so rows get a fixed place first:
    # the result then depends on the customers and not on how their table is laid out.
    pieces = rfm.count() // POINTS_PER_PIECE + 1
    placed = rfm.repartition(pieces, "customer_id").sortWithinPartitions("customer_id")
    points = assembler.transform(placed.withColumns(inputs)).drop(*inputs)
    shared = points.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        shared.count()

        def run(offset: int):
            estimator = KMeans(k=k, seed=seed + offset, maxIter=max_iter, tol=tolerance, predictionCol="cluster")
            model = estimator.fit(shared)
            return model.summary.trainingCost, offset, model

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            runs = list(pool.map(inheritable_thread_target(rfm.sparkSession)(run), range(starts)))
    finally:
        shared.unpersist()
    best = min(runs, key=lambda result: result[:2])[2]
    return best.transform(points).drop("features")


def label_segments(clustered: DataFrame) -> DataFrame:
    """Add the segment name of each row's cluster.

    Clusters are ranked by their standardised mean metrics: frequency plus monetary
    minus recency. All of that works on one row per cluster, and a sixth cluster is
    an error, so the mapping joined back has at most five rows.
    """
    everyone = Window.partitionBy()
    centres = clustered.groupBy("cluster").agg(
        (F.sum("recency_days") / F.count("recency_days")).alias("recency_days"),
        (F.sum("frequency") / F.count("frequency")).alias("frequency"),
        (money_sum("monetary") / F.count("monetary")).alias("monetary"),
    )

    def z(name: str) -> Column:
        spread = F.stddev_pop(name).over(everyone)
        return (F.col(name) - F.avg(name).over(everyone)) / F.nullif(spread, F.lit(0.0))

    scored = centres.select("cluster", (z("frequency") + z("monetary") - z("recency_days")).alias("score"))
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("score"), "cluster"))
    names = F.array(*(F.lit(name) for name in SEGMENT_NAMES))
    mapping = scored.withColumn("place", place).select(
        "cluster",
        F.when(F.col("place") <= len(SEGMENT_NAMES), F.get(names, F.col("place") - 1))
        .otherwise(F.raise_error(F.lit("more clusters than segment names")))
        .alias("segment"),
    )
    return clustered.join(F.broadcast(mapping), "cluster").select(
        "customer_id", *METRICS, "cluster", "segment"
    )


def segment_customers(rfm: DataFrame, k: int = 5, seed: int = 42, starts: int = 10) -> DataFrame:
    """The whole chain from the metrics to named segments.

    ``rfm`` should be a written table, as it is read by every clustering run.
    """
    return label_segments(cluster_customers(rfm, k, seed, starts))


def segment_sizes(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.desc("customers"), "segment")
    )


def segment_profile(segments: DataFrame) -> DataFrame:
    """Mean metrics per segment, one decimal."""
    return segments.groupBy("segment").agg(
        round_half_even(F.sum("recency_days") / F.count("recency_days"), 1).alias("recency_days"),
        round_half_even(F.sum("frequency") / F.count("frequency"), 1).alias("frequency"),
        round_half_even(money_sum("monetary") / F.count("monetary"), 1).alias("monetary"),
    )


def segment_table(segments: DataFrame) -> DataFrame:
    """All customers, biggest spenders first; also the points of the scatter plot."""
    return segments.orderBy(F.desc("monetary"), "customer_id")


def segment_by_country(segments: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        segments.join(customers, "customer_id")
        .groupBy("segment", "country")
        .agg(F.count(F.lit(1)).alias("customers"), money_sum("monetary").alias("monetary"))
    )


def segment_share(segments: DataFrame) -> DataFrame:
    """Share of customers and of spend per segment; the window sees one row per segment."""
    totals = segments.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), money_sum("monetary").alias("monetary")
    )
    everyone = Window.partitionBy()
    return totals.select(
        "*",
        (F.col("customers") / F.sum("customers").over(everyone)).alias("customer_share"),
        (F.col("monetary") / F.sum("monetary").over(everyone)).alias("monetary_share"),
    )


def at_risk_customers(segments: DataFrame) -> DataFrame:
    """Candidates for winning back, most valuable first."""
    return segment_table(segments.where(F.col("segment") == "At Risk"))
