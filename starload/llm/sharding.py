"""Consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of cells. Each shard owns the cells up to each of its virtual nodes, each key has a cell,
and its home is the shard that owns the cell. No shard takes more than its capacity: it keeps the first keys along
the ring, the rest overflows and continues clockwise to the next virtual node of a shard with room. With slack 0 the
capacities are the floor or the ceiling of the mean, so row counts differ by at most one; more slack moves fewer keys
from home.

Only counts per cell decide, so whatever the number of rows, the walk runs over at most CELLS + 2 * virtual nodes
rows. Rows meet the plan in a join on the cell against that bounded table. A cell's order is by the key's hash, then by
ranges of the row's hash: ranks are taken inside one range of one key, and what comes before it in the cell is added
from counts, so that a key with many different rows is spread over PARTS groups.

Defined results: a null text has size 0 + 16 and checksum 0; rows are kept as often as they come, equal rows get
slots one after the other; a null key is one more key; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import checkpointed, whole_text

CELLS = 1 << 14
SHARDS = 40
NODES = 64  # virtual nodes to a shard
ROW_BYTES = 16
PARTS = 256  # ranges of the row's hash, for each key
STEP = 4096  # equal rows are written out in runs of at most so many


def _hash(key: Column) -> Column:
    return F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def _cell(hashed: Column) -> Column:
    return F.pmod(F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long"), F.lit(CELLS)).cast("int")


def ring(spark, shards: int, nodes: int) -> DataFrame:
    """cell and shard: the owner of each cell is the next virtual node at it or after it, around the end."""
    node = spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        _hash(F.concat_ws("/", F.lit("node"), F.col("id") % shards, F.floor(F.col("id") / shards))).alias("hash"),
    )
    first = node.groupBy(_cell(F.col("hash")).alias("cell")).agg(F.min_by("shard", F.struct("hash", "shard")).alias("shard"))
    cells = spark.range(CELLS).select(F.col("id").cast("int").alias("cell")).join(first, "cell", "left")
    after = W.orderBy("cell").rowsBetween(0, W.unboundedFollowing)
    everywhere = W.orderBy("cell").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    owner = F.coalesce(
        F.first("shard", ignorenulls=True).over(after), F.first("shard", ignorenulls=True).over(everywhere)
    )
    return cells.select("cell", owner.alias("shard"))


def _walk(stops: Column, room: Column) -> Column:
    """How many overflowing keys each stop takes, going around twice; the keys wait in ring order.

    stops: array of (shard, over), room: spare capacity by shard.
    """

    def step(state: Column, stop: Column) -> Column:
        waiting = state["waiting"] + stop["over"]
        taken = F.least(waiting, F.get(state["room"], stop["shard"]))
        left = F.transform(state["room"], lambda r, k: F.when(k == stop["shard"], r - taken).otherwise(r))
        return F.struct(
            (waiting - taken).alias("waiting"), left.alias("room"), F.concat(state["took"], F.array(taken)).alias("took")
        )

    nothing = F.array().cast("array<bigint>")
    start = F.struct(F.lit(0).cast("long").alias("waiting"), room.alias("room"), nothing.alias("took"))
    return F.aggregate(stops, start, step, lambda state: state["took"])


def _plan(counts: DataFrame, shards: int, nodes: int, slack: float) -> DataFrame:
    """cell, low, high, shard, slot: ranks low to high - 1 of the cell go to the shard, from that slot on.

    counts: cell and n. At most CELLS + 2 * (stops of the ring) + 1 rows.
    """
    spark = counts.sparkSession
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    owned = ring(spark, shards, nodes).join(counts, "cell", "left").na.fill(0, ["n"])
    if slack:
        limit = F.ceil((1 + slack) * F.col("total") / shards)
    else:
        limit = F.floor(F.col("total") / shards) + F.when(F.col("shard") < F.col("total") % shards, 1).otherwise(0)
    # One row of totals: broadcast is bounded.
    owned = owned.crossJoin(F.broadcast(total)).withColumn("limit", limit.cast("long"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    owned = owned.withColumn("slot", before).withColumn("kept", F.greatest(F.lit(0), F.least("n", F.col("limit") - F.col("slot"))))
    owned = owned.withColumn("over", F.col("n") - F.col("kept"))
    along = W.orderBy("cell")
    queue = F.coalesce(F.sum("over").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    turn = F.when(F.col("shard") == F.lag("shard").over(along), 0).otherwise(1)
    owned = owned.withColumn("queue", queue).withColumn("turn", turn).withColumn("arc", F.sum("turn").over(along))
    owned = checkpointed(owned.select("cell", "shard", "n", "limit", "slot", "kept", "over", "queue", "arc"))

    arcs = owned.groupBy("arc", "shard").agg(F.sum("over").alias("over"))
    stops = arcs.agg(F.sort_array(F.collect_list(F.struct("arc", "shard", "over"))).alias("stops"))
    by_shard = owned.groupBy("shard").agg((F.max("limit") - F.sum("kept")).alias("spare"), F.sum("kept").alias("kept"))
    room = by_shard.agg(F.array_sort(F.collect_list(F.struct("shard", "spare", "kept"))).alias("by_shard"))
    again = F.transform("stops", lambda s: F.struct(s["arc"], s["shard"], F.lit(0).cast("long").alias("over")))
    laps = stops.crossJoin(F.broadcast(room)).select(F.concat("stops", again).alias("stops"), "by_shard")
    took = _walk(F.col("stops"), F.transform("by_shard", lambda s: s["spare"]))
    taken = laps.select(F.col("by_shard"), F.posexplode(F.arrays_zip(F.col("stops"), took.alias("took"))).alias("at", "stop"))
    taken = taken.select("at", "stop.stops.shard", "stop.took", "by_shard").where("took > 0")
    upto = W.orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    of_shard = W.partitionBy("shard").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    start, placed = F.coalesce(F.sum("took").over(upto), F.lit(0)), F.coalesce(F.sum("took").over(of_shard), F.lit(0))
    taken = taken.select(
        start.alias("start"),
        (start + F.col("took")).alias("end"),
        "shard",
        (F.get(F.col("by_shard"), F.col("shard"))["kept"] + placed).alias("slot"),
    )
    all_taken = taken.agg(F.sort_array(F.collect_list(F.struct("start", "end", "shard", "slot"))).alias("taken"))

    home = owned.where("kept > 0").select("cell", F.lit(0).cast("long").alias("low"), F.col("kept").alias("high"), "shard", "slot")
    first, last = F.col("queue"), F.col("queue") + F.col("over")
    moved = owned.where("over > 0").crossJoin(F.broadcast(all_taken))
    moved = moved.select(
        "cell", "kept", "queue", "over", F.explode(F.filter("taken", lambda t: (t["start"] < last) & (t["end"] > first))).alias("t")
    )
    low, high = F.greatest("t.start", "queue"), F.least("t.end", F.col("queue") + F.col("over"))
    moved = moved.select(
        "cell",
        (low - F.col("queue") + F.col("kept")).alias("low"),
        (high - F.col("queue") + F.col("kept")).alias("high"),
        "t.shard",
        (F.col("t.slot") + low - F.col("t.start")).alias("slot"),
    )
    return checkpointed(home.unionByName(moved))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size in bytes with the overhead of a row, and the text's checksum."""
    text = whole_text()
    return docs.select(
        F.col("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )


def _ranked(counted: DataFrame) -> DataFrame:
    """Adds first: how many rows come before a row in its cell, by hash, part and row."""
    group = ["cell", "hash", "part"]
    along = W.partitionBy("cell").orderBy("hash", "part").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(*group).orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    # At most PARTS rows a key, whatever the number of its rows.
    parts = counted.groupBy(*group).agg(F.sum("n").alias("of_part"))
    parts = parts.select(*group, F.coalesce(F.sum("of_part").over(along), F.lit(0)).alias("before"))
    ranked = counted.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    # Merged in the order the ranks have; a broadcast of the ranked rows would bring those of a key to one task again.
    joined = ranked.hint("merge").join(parts, group)
    return joined.withColumn("first", F.col("before") + F.col("inside"))


def assign(rows: DataFrame, key: str, shards: int = SHARDS, nodes: int = NODES, slack: float = 0.0) -> DataFrame:
    """The columns of rows with shard and slot (gapless from 0 in each shard) and home_shard, where the ring points.

    Equal rows are counted first and written out last, so a key that holds many rows is one row in the shuffle.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    counted = rows.select(row.alias("row")).groupBy("row").agg(F.count("*").alias("n"))
    counted = counted.withColumn("hash", _hash(F.col(f"row.`{key}`")))
    part = F.pmod(F.xxhash64("row"), F.lit(PARTS)).cast("int")
    counted = checkpointed(counted.withColumn("cell", _cell(F.col("hash"))).withColumn("part", part))
    plan = _plan(counted.groupBy("cell").agg(F.sum("n").alias("n")), shards, nodes, slack)
    ranked = _ranked(counted)
    owners = ring(rows.sparkSession, shards, nodes).withColumnRenamed("shard", "home_shard")
    # Both tables are bounded by CELLS and the number of virtual nodes.
    placed = ranked.join(F.broadcast(plan), "cell").where("first < high and first + n > low")
    start, end = F.greatest("first", "low"), F.least(F.col("first") + F.col("n"), "high")
    placed = placed.withColumn("run", F.explode(F.sequence(start, end - 1, F.lit(STEP).cast("long"))))
    placed = placed.withColumn("rank", F.explode(F.sequence("run", F.least(F.col("run") + STEP, end) - 1)))
    return placed.join(F.broadcast(owners), "cell").select(
        "row.*",
        F.col("shard").cast("int").alias("shard"),
        (F.col("slot") + F.col("rank") - F.col("low")).cast("long").alias("slot"),
        "home_shard",
    )
