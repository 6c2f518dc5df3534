"""The driver views: daily statistics, activity times, activity score."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .feature_model import Catalog, Entity, FeatureView, OnDemandView, Source, column_name

# Names, field types and lifetimes of the views.
DRIVER = Entity("driver", ("driver_id",))
STATS_TTL = timedelta(days=365)
ACTIVITY_TTL = timedelta(days=30)
STATS_SCHEMA = T.StructType(
    [
        T.StructField("conv_rate", T.FloatType()),
        T.StructField("acc_rate", T.FloatType()),
        T.StructField("avg_daily_trips", T.IntegerType()),
    ]
)
TIME_FIELDS = ("event_timestamp", "created")


def activity_score(rows: DataFrame) -> dict[str, Column]:
    """conv_rate² + acc_rate · mean(trips of the rows asked for) / trips.

    The mean is a scalar subquery over the rows, NULLs left out; a window
    without a partition would move all rows to one task. Zero trips give
    NULL.
    """
    conv, acc, trips = (
        F.col(column_name("driver_stats", c)).cast("double") for c in STATS_SCHEMA.names
    )
    mean_trips = rows.agg(F.avg(trips)).scalar()
    return {"activity_score": conv * conv + F.try_divide(acc * mean_trips, trips)}


def activity_score_table(rows: DataFrame) -> DataFrame:
    """The same as a function from table to table."""
    return rows.withColumns(activity_score(rows))


def driver_catalog(
    source: Source,
    stats_ttl: timedelta | None = STATS_TTL,
    activity_ttl: timedelta | None = ACTIVITY_TTL,
    stats_schema: T.StructType = STATS_SCHEMA,
    time_type: T.DataType = T.TimestampType(),
    batch: bool = False,
) -> Catalog:
    """``batch`` takes the score as a function over a batch that is written
    once, which pays where the features are dear to look up."""
    tags = {"team": "driver"}
    stats = FeatureView("driver_stats", DRIVER, stats_schema, source, stats_ttl, tags)
    times = T.StructType([T.StructField(n, time_type) for n in TIME_FIELDS])
    activity = FeatureView("driver_activity", DRIVER, times, source, activity_ttl, tags)
    fields = T.StructType([T.StructField("activity_score", T.DoubleType())])
    score = OnDemandView("activity_score", (stats,), fields, activity_score_table if batch else activity_score, batch)
    return Catalog([stats, activity], [score])
