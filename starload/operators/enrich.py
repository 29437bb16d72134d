"""Join the game list with its landed responses, and split the outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.operators.dedupe import last_wins
from starload.sources.payloads import DETAIL_COLUMNS


def enrich(top: DataFrame, details: DataFrame, counts: DataFrame) -> DataFrame:
    """Every list row with its detail and player count; `reject_reason` is NULL on rows to keep.

    No landed detail response means the request failed: the row is rejected. A response without
    usable data keeps the row with empty detail columns. A missing player count is 0. Of responses
    that landed more than once for a game one counts: a readable one before a rejected one, then the
    one with the greatest values, as responses carry no time.
    All three sides are keyed by `appid`, so one partitioning serves both joins.
    """
    details = details.withColumn("readable", F.col("reject_reason").isNull())
    details = last_wins(details, ["appid"], ["readable"])
    counts = last_wins(counts, ["appid"], [])
    details = details.select(
        "appid",
        F.lit(True).alias("answered"),
        "reject_reason",
        "has_name",
        "detail_name",
        *DETAIL_COLUMNS,
    )
    counts = counts.select("appid", F.lit(True).alias("counted"), F.col("ccu").alias("counted_ccu"))
    joined = top.join(details, "appid", "left").join(counts, "appid", "left")
    return joined.select(
        "payload_id",
        "pos",
        "appid",
        F.when(F.col("has_name"), F.col("detail_name")).otherwise(F.col("name")).alias("name"),
        "score",
        "userscore",
        "owners",
        "average_playtime",
        "median_playtime",
        F.when(F.col("counted"), F.col("counted_ccu")).otherwise(F.lit(0)).alias("ccu"),
        *DETAIL_COLUMNS,
        F.when(F.col("answered"), F.col("reject_reason"))
        .otherwise("request_failed")
        .alias("reject_reason"),
    )


def kept(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("reject_reason").isNull())


def rejected(enriched: DataFrame) -> DataFrame:
    """Rows that could not be read, with the reason and the list's name for the game."""
    return enriched.filter(F.col("reject_reason").isNotNull()).select(
        "appid", "name", "reject_reason"
    )


def has_store_data() -> Column:
    """A row belongs in the current-state table only with a price or a description."""
    return (
        F.col("price_initial").isNotNull()
        | F.col("price_final").isNotNull()
        | F.col("short_description").isNotNull()
    )
