"""Recency / frequency / monetary scores and k-means segments."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import as_gmv, cond_sum
from ..schema import PURCHASE, USER_PROFILE
from ..session import scratch_path
from .clusters import Clusters, fit_clusters
from .quantiles import approx_quantiles, exact_quantiles

RFM_COLUMNS = ["recency_days", "frequency", "monetary"]
FEATURE_COLUMNS = ["recency_days", "log_f", "log_m"]
# The same features as SQL, for a model that is kept. Frequency and money are long-tailed.
FEATURES = ["CAST(recency_days AS DOUBLE)", "log1p(CAST(frequency AS DOUBLE))",
            "log1p(CAST(monetary AS DOUBLE))"]

# Segment names by rank, best first. Fixed values.
SEGMENT_NAMES = ("高价值客户", "潜力客户", "一般保持", "流失风险")
HIGH_VALUE = SEGMENT_NAMES[0]

CLUSTERS = 4
SEED = 42


def ref_date(events: DataFrame) -> DataFrame:
    """The newest event date: "today" for historical data."""
    return events.agg(F.max("event_date").alias("ref_date"))


def rfm_base(events: DataFrame) -> DataFrame:
    """One row per user, pinned with the last day, so events are read once: the reference date is the
    newest of those days, a scalar subquery over one column and not a collect."""
    kept = pinned(last_days(events))
    return recency(kept, kept.agg(F.max("last_date").alias("ref_date")).scalar())


def last_days(events: DataFrame) -> DataFrame:
    """One row per user with the last active day."""
    return events.groupBy("user_id").agg(
        F.max("event_date").alias("last_date"),
        F.count(F.lit(1)).alias("frequency"),
        cond_sum(PURCHASE).alias("monetary"))


def recency(users: DataFrame, today: Column) -> DataFrame:
    return users.select(
        "user_id", F.datediff(today, "last_date").alias("recency_days"),
        "frequency", "monetary")


def rfm_quantiles(users: DataFrame, relative_error: float = 0.01) -> DataFrame:
    """Cut points at 20/40/60/80 %; error 0 is exact."""
    if relative_error == 0:
        return exact_quantiles(users, RFM_COLUMNS)
    return approx_quantiles(users, RFM_COLUMNS, relative_error)


def rfm_scores(users: DataFrame, cuts: DataFrame, distinct_cuts: bool = False) -> DataFrame:
    """Scores 1-5 from the cut points, joined in as one scalar subquery.

    With most users at the same value several cuts coincide, and the first matching rule then
    gives everyone the top score. ``distinct_cuts`` compares strictly instead, so tied users
    fall to the score below.
    """
    row = cuts.select(F.struct(*RFM_COLUMNS)).scalar()
    holder = users.withColumn("cuts", row)
    return holder.withColumns({
        "r_score": _low_is_good("recency_days"),
        "f_score": _high_is_good("frequency", distinct_cuts),
        "m_score": _high_is_good("monetary", distinct_cuts),
    }).drop("cuts")


def _low_is_good(column: str) -> Column:
    value, cut = F.col(column), F.col("cuts")[column]
    return (F.when(value <= cut[0], 5).when(value <= cut[1], 4)
            .when(value <= cut[2], 3).when(value <= cut[3], 2).otherwise(1))


def _high_is_good(column: str, strict: bool) -> Column:
    value, cut = F.col(column), F.col("cuts")[column]

    def reaches(i: int) -> Column:
        return value > cut[i] if strict else value >= cut[i]

    return (F.when(reaches(3), 5).when(reaches(2), 4)
            .when(reaches(1), 3).when(reaches(0), 2).otherwise(1))


def rfm_features(users: DataFrame) -> DataFrame:
    """Frequency and money are long-tailed, so they enter the clustering as log1p."""
    return users.withColumns({
        "log_f": F.log1p(F.col("frequency").cast("double")),
        "log_m": F.log1p(F.col("monetary").cast("double")),
    })


def feature_stages() -> list:
    return [
        VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features",
                       withMean=True, withStd=True),
    ]


def rfm_kmeans(users: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> Clusters:
    return fit_clusters(users, FEATURES, "user_id", k, seed)


def pinned(users: DataFrame) -> DataFrame:
    """Users written once as a scratch table of the shared folder.

    Spares quantiles, scaling, each k-means round and the final write from making the per-user
    aggregate again, and survives a lost executor. A table and not a checkpoint, because passes that
    need three columns then read three. The layout is Spark's own choice: nothing that follows
    depends on it.
    """
    spark = users.sparkSession
    path = scratch_path(spark, "users")
    users.write.parquet(path)
    return spark.read.schema(users.schema).parquet(path)


def cluster_stats(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster_id").agg(
        F.avg("recency_days").alias("avg_r"),
        F.avg("frequency").alias("avg_f"),
        F.avg(F.col("monetary").cast("double")).alias("avg_m"),
        F.count(F.lit(1)).alias("cnt"))


def segment_names(stats: DataFrame) -> DataFrame:
    """Name clusters by rank of avg F - avg R + ln(1 + avg M), best first; later ranks share the
    last name. The window covers one row per cluster."""
    worth = F.col("avg_f") - F.col("avg_r") + F.log1p("avg_m")
    rank = F.row_number().over(Window.orderBy(worth.desc(), "cluster_id"))
    names = F.array(*[F.lit(n) for n in SEGMENT_NAMES])
    return stats.select(
        "cluster_id", F.element_at(names, F.least(rank, F.lit(len(SEGMENT_NAMES)))).alias("segment"))


def attach_segments(clustered: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Broadcast is bounded by the number of clusters."""
    names = segment_names(cluster_stats(clustered) if stats is None else stats)
    return clustered.join(F.broadcast(names), "cluster_id")


def named_clusters(model: Clusters, users: DataFrame) -> list[str]:
    """The clusters' segment names by cluster number, for a model that is kept."""
    names = {r.cluster_id: r.segment
             for r in segment_names(cluster_stats(model.clustered(users))).collect()}
    return [names.get(i, SEGMENT_NAMES[-1]) for i in range(len(model.centres))]


def user_profile(events: DataFrame, computed_at: Column | None = None,
                 relative_error: float = 0.01, k: int = CLUSTERS, seed: int = SEED,
                 distinct_cuts: bool = False) -> DataFrame:
    """The whole customer segmentation.

    Events are read once: the users of ``rfm_base`` are pinned.
    """
    users = rfm_base(events)
    scored = rfm_scores(users, rfm_quantiles(users, relative_error), distinct_cuts)
    stamped = attach_segments(rfm_kmeans(users, k, seed).clustered(scored)).withColumn(
        "computed_at", F.current_timestamp() if computed_at is None else computed_at)
    return USER_PROFILE.conform(stamped)


def segment_summary(profiles: DataFrame) -> DataFrame:
    """Users and averages per segment, largest total first."""
    users = F.count(F.lit(1))
    total = F.sum("monetary")
    summary = profiles.groupBy("segment").agg(
        users.alias("users"),
        F.round(F.avg("recency_days"), 1).alias("avg_recency_days"),
        F.round(F.avg("frequency"), 1).alias("avg_frequency"),
        F.round(total.cast("double") / users, 2).alias("avg_monetary"),
        as_gmv(total).alias("total_monetary"))
    return summary.orderBy(F.col("total_monetary").desc(), "segment")


def segment_totals(profiles: DataFrame) -> DataFrame:
    high = F.col("segment") == HIGH_VALUE
    zero = F.lit(0).cast("decimal(18,2)")
    return profiles.agg(
        F.count(F.lit(1)).alias("total_users"),
        as_gmv(F.coalesce(F.sum("monetary"), zero)).alias("total_monetary"),
        F.count_if(high).alias("high_value_users"),
        as_gmv(F.coalesce(F.sum(F.when(high, F.col("monetary"))), zero))
        .alias("high_value_monetary"))
