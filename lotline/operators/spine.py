"""Months: the spine of a range, coverage by scrape windows, window lists."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def month_spine(spark: SparkSession, start: datetime.date, end: datetime.date) -> DataFrame:
    """date_from, date_to of every month from start's to end's."""
    first = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(start), "month"), F.trunc(F.lit(end), "month"), F.expr("interval 1 month"))).alias("date_from"))
    return first.withColumn("date_to", F.last_day("date_from"))


def month_coverage(spine: DataFrame, windows: DataFrame, apps: DataFrame) -> DataFrame:
    """Per month the best status of windows that span exactly the month (pending if none), and applications lodged in it."""
    rank = F.array_position(F.array(*map(F.lit, ["aborted", "failed", "running", "completed"])), F.col("status"))
    best = windows.groupBy("date_from", "date_to").agg(F.max_by("status", rank).alias("status"))
    counts = apps.groupBy(F.trunc("lodged_date", "month").alias("date_from")).agg(F.count(F.lit(1)).alias("apps"), F.count("detail_fetched_at").alias("detail"))
    out = spine.join(best, ["date_from", "date_to"], "left").join(counts, "date_from", "left")
    return out.select("date_from", "date_to", F.coalesce("status", F.lit("pending")).alias("status"), F.coalesce("apps", F.lit(0)).alias("apps"), F.coalesce("detail", F.lit(0)).alias("detail"))


def scrape_windows(windows: DataFrame, as_of: datetime.datetime) -> DataFrame:
    """Windows with elapsed seconds; open ones run to as_of."""
    return windows.withColumn("elapsed_s", F.timestamp_diff("SECOND", "started_at", F.coalesce("finished_at", F.lit(as_of).cast("timestamp_ntz"))))


def completed_months(spine: DataFrame, windows: DataFrame) -> DataFrame:
    done = windows.where("status = 'completed'").groupBy("slug", "date_from", "date_to").agg(F.max("finished_at").alias("finished_at"))
    return spine.join(done, ["date_from", "date_to"])


MOST_BACKENDS = 10_000


def route_windows(windows: DataFrame, backends: DataFrame) -> DataFrame:
    """Windows with each backend that covers part of them, cut to its span as clip_from and clip_to.

    backends: name, valid_from, valid_to; open ends are null. It is a list of services and is broadcast;
    more than MOST_BACKENDS of them raise an error.
    """
    if backends.limit(MOST_BACKENDS + 1).count() > MOST_BACKENDS:
        raise ValueError(f"more than {MOST_BACKENDS} backends")
    hit = (F.col("date_from") <= F.coalesce("valid_to", "date_from")) & (F.col("date_to") >= F.coalesce("valid_from", "date_to"))
    return windows.join(F.broadcast(backends), hit).withColumns({"clip_from": F.greatest("date_from", "valid_from"), "clip_to": F.least("date_to", "valid_to")})
