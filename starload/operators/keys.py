"""Dense surrogate keys without a sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from starload.schemas import KEY_BUCKETS


def assign_keys(
    rows: DataFrame, natural_key: str, key: str, start: int = 0, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Add `key` = start+1 .. start+n to rows with distinct natural keys.

    The numbers depend only on the natural keys and `buckets`, never on how Spark happened to
    partition the rows, so a task that is run again hands out the same keys. Rows are hashed into
    buckets and numbered inside each; the natural keys are distinct, so no bucket is hot. The first
    row of a bucket, which knows its count, makes up the offsets: the rows are read and shuffled
    once, for the ranks and the offsets alike. The offsets table has one row per bucket, which is
    what bounds its broadcast and its one-task sum. A store records the number for each dimension when it is
    created; one whose new rows do not fit so many tasks is created with a larger one.
    """
    # Not nullable, so that no filter sets the two readers of the shuffle apart.
    bucket = F.coalesce(F.pmod(F.xxhash64(natural_key), F.lit(buckets)), F.lit(0))
    bucketed = rows.withColumn("_bucket", bucket)
    inside = Window.partitionBy("_bucket").orderBy(natural_key)
    ranked = bucketed.withColumn("_rank", F.row_number().over(inside))
    counts = ranked.groupBy("_bucket").agg(F.max("_rank").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        ranked.join(F.broadcast(offsets), "_bucket")
        .withColumn(key, (F.lit(start) + F.col("_offset") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_rank", "_offset")
    )


def highest_key(dim: DataFrame, key: str) -> int:
    """The largest key handed out so far, 0 for an empty dimension."""
    return dim.agg(F.max(key)).first()[0] or 0
