"""Words and events as streams: late data, windows, and metrics that merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import match_levels


def word_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """New word files of a folder as they come."""
    return spark.readStream.schema(schema).parquet(path)


def delivered_once(words: DataFrame, late: str = "7 days") -> DataFrame:
    """Each word once within the lateness that is waited for; the state is dropped behind the watermark."""
    return words.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["word_id"])


def confidence_by_feed(words: DataFrame, window: str = "1 hour", late: str = "7 days") -> DataFrame:
    """Words and mean confidence of every feed and window of arrival."""
    return words.withWatermark("received_at", late).groupBy(F.window("received_at", window), "feed_id").agg(F.count(F.lit(1)).alias("n_words"), F.avg("confidence").alias("confidence"))


def event_windows(events: DataFrame, window: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts of events by tumbling or sliding windows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window, slide), "event_type").agg(F.count(F.lit(1)).alias("n"))


def event_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))


def running_text_match(pairs: DataFrame) -> DataFrame:
    """Text match counts that go on with every batch."""
    levels = match_levels(F.col("truth"), F.col("predicted"))
    return pairs.groupBy().agg(F.count(F.lit(1)).alias("n"), *(F.sum(v.cast("int")).alias(k) for k, v in levels.items()))
