"""Allele counts of a stream of calls.  Counts are sums, so they are kept up to date per
site and population; late calls only add."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import SITE


def running_counts(calls: DataFrame) -> DataFrame:
    """For ``writeStream.outputMode("update")``: chrom, pos, population, n_called, alt_n."""
    own = calls.filter("n_alt is not null")
    return own.groupBy(*SITE, "population").agg(F.count(F.lit(1)).alias("n_called"), F.sum("n_alt").alias("alt_n"))


def windowed_events(events: DataFrame, every: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events per window and type, with a watermark that bounds the state."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")
