"""SimHash near-duplicates: fingerprints, an exact tiled comparison, components of linked fingerprints.

Fingerprints are compared tile against tile. A tile holds fingerprints whose four 16-bit quarters have the same
population counts; one differing bit changes one of these counts by one, so two fingerprints within the radius lie
in tiles whose counts differ by at most the radius in sum. All other tile pairs are skipped, the rest is compared
exactly (numpy exclusive-or and bit counts). Equal fingerprints are one vertex, and a tile pair reports a spanning
forest of its links, so a group of copies never turns into pairs.

Defined results: a null text is an empty one; a text without words has fingerprint zero, linked like any other;
a very long text is hashed whole, a strip of shingles at a time; rows are kept as often as they come; a null doc_id is
never the smallest one, and a component of null ids only has a null id; an empty table gives an empty result; other
columns are not looked at, and kept by one_of_each(), whatever they are called.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import checkpointed, written

SHINGLE = 3
RADIUS = 2
SEED = 42
TILE = 4096  # fingerprints to a tile; more of the same counts make several tiles
AT_ONCE = 1 << 20  # fingerprint pairs, or shingles, held at a time in a task


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 majority bits over the hashes of the word shingles; words are split and lower-cased as ASCII."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    starts, ends = starts[: len(ends)].tolist(), ends.tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(ends), AT_ONCE):
        spans = zip(starts[at : at + AT_ONCE], ends[at : at + AT_ONCE])
        hashes = np.array([hashed(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, keyed: bool = False) -> DataFrame:
    """doc_id, with keyed column key, and the fingerprint as a signed long, a row for each row of docs."""
    kept = ["doc_id", "key"] if keyed else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle, seed) for t in texts), np.uint64, len(texts))
            yield pa.record_batch([*batch.columns[: len(kept)], pa.array(found.view(np.int64))], [*kept, "fp"])

    picked = docs.select(F.col("doc_id").cast("long"), *kept[1:], "text")
    return picked.mapInArrow(run, "doc_id long, key string, fp long" if keyed else "doc_id long, fp long")


def _forest(pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Of these links, those that join what the earlier ones have not joined yet."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    for a, b in pairs:
        if (ra := root(a)) != (rb := root(b)):
            parent[ra] = rb
            yield a, b


def _near(left: np.ndarray, right: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Pairs within the radius, a strip of rows of the tile pair at a time."""
    rows = max(1, AT_ONCE // max(1, len(right)))
    for at in range(0, len(left), rows):
        strip = left[at : at + rows]
        i, j = np.nonzero(np.bitwise_count(strip[:, None] ^ right[None, :]) <= radius)
        a, b = strip[i], right[j]
        other = a != b
        yield from zip(a[other].view(np.int64).tolist(), b[other].view(np.int64).tolist())


def _offsets(radius: int) -> list[int]:
    """Differences of tile numbers, each unordered pair of tiles once (zero included)."""
    steps = range(-radius, radius + 1)
    near = [v for v in itertools.product(steps, repeat=4) if sum(map(abs, v)) <= radius and v >= (0, 0, 0, 0)]
    return [sum(x * BASE**k for k, x in enumerate(reversed(v))) for v in near]


BASE = 32  # over 16 + any radius in use, so that no step wraps into a neighbouring digit


def tile_pairs(tiles: DataFrame, parts: DataFrame, radius: int) -> DataFrame:
    """fps and others of every pair of tiles that may hold a link; a crowded cell's pairs are dealt out by tile.

    tiles: cell, part, fps; parts: how many parts each cell has.
    """
    visits = tiles.select(
        F.explode(F.array([F.col("cell") - F.lit(o) for o in _offsets(radius)])).alias("cell"),
        F.col("cell").alias("from_cell"),
        F.col("part").alias("from_part"),
        F.col("fps").alias("others"),
    )
    # Of two tiles of one cell each pair once.
    last = F.when(F.col("cell") == F.col("from_cell"), F.col("from_part")).otherwise(F.col("parts") - 1)
    visits = visits.join(F.broadcast(parts), "cell")
    visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return tiles.join(visits, ["cell", "part"])


def links(found: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of column fp within the radius."""
    if not 0 <= radius < BASE - 16:
        raise ValueError("the radius must be at least 0 and below 16")
    number = F.lit(0)
    for quarter in (3, 2, 1, 0):
        part = F.shiftrightunsigned("fp", 16 * quarter).bitwiseAND(F.lit(0xFFFF))
        number = number * BASE + F.bit_count(part)
    distinct = found.select("fp", number.cast("int").alias("cell"))
    # At most 17**4 rows, whatever the data: safe to broadcast.
    parts = distinct.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("parts"))
    tiles = (
        distinct.join(F.broadcast(parts), "cell")
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
        .groupBy("cell", "part")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = checkpointed(tiles)  # read from both sides of the join, which can then split a crowded cell
    pairs = tile_pairs(tiles, parts, radius)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mine, others in zip(batch.column(0), batch.column(1)):
                left, right = (np.asarray(x.values).view(np.uint64) for x in (mine, others))
                kept = list(_forest(_near(left, right, radius)))
                if kept:
                    yield pa.record_batch(list(map(pa.array, zip(*kept))), ["a", "b"])

    return pairs.select("fps", "others").mapInArrow(compare, "a long, b long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root (the smallest node reachable) of every node that has a link.

    Alternates large and small stars (connected components in logarithmically many rounds); each round is kept in
    the shared folder, and only two numbers of it come to the driver.
    """
    stars = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    stars = checkpointed(stars)
    before = None
    for _ in range(most_rounds):
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        stars = checkpointed(small)
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links within the radius) of every row."""
    found = checkpointed(fingerprints(docs, shingle, seed))
    return found.join(_by_print(found, radius), "fp").select("doc_id", "fp", "component_id")


def _by_print(found: DataFrame, radius: int) -> DataFrame:
    """fp, root (the same for all of a component) and component_id of each fingerprint."""
    classes = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp"), radius))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Kept apart first, so that the join can split the rows of a fingerprint with many copies.
    return checkpointed(rooted.join(ids, "root").select("fp", "root", "component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One row of each component, all columns kept: that with the smallest doc_id, one without doc_id only if all are.

    Of the rows of a component that share this doc_id, or have none, the one that comes first by its columns in order
    (nulls first) stays. Only such rows are gathered by component; the others are known by doc_id and text beforehand.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    sortable = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    key = F.concat_ws("/", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")))).alias("key")
    found = checkpointed(fingerprints(docs.select("doc_id", key, "text"), shingle, seed, keyed=True))
    least = found.join(_by_print(found, radius), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Plain tables of known size: the joins can split the rows of a key with many copies, and no text is moved to meet an
    # empty one.
    least = checkpointed(least.groupBy("root", "key").agg(F.count("*").alias("n")))
    several = least.groupBy("root").agg(F.sum("n").alias("n")).where("n > 1").select("root")
    several = written(least.join(several, "root", "left_semi").select("key", "root"), "several")
    single = written(least.join(several.select("root").distinct(), "root", "left_anti").select("key"), "single")
    rows = docs.select(key, F.struct(*own).alias("row"), F.struct(*sortable).alias("place"))
    first = rows.join(several, "key").groupBy("root").agg(F.min_by("row", "place").alias("row")).select("row.*")
    return rows.select("key", "row").join(single, "key", "left_semi").select("row.*").unionByName(first)
