"""Nearest neighbours by multiprobe p-stable hashing.

Each of TABLES tables hashes a vector by HASHES random projections, cut into cells WIDTH times the spread of the data
wide. A query looks into the cell it falls into and into PROBES - 1 perturbed ones, in the order of their expected
distance: a template of perturbation sets is made once for all queries and applied to the order of each query's
distances to its cell's walls. All rows are indexed; projections and spread are fitted on SAMPLE rows at most.

Equal vectors are one class: no more than the k + 1 smallest ids of a class can be among a query's k nearest, so only
these are carried, and a vector held by a third of all rows is one entry of the index. Where the tables are selective, only
ids go through them: those of rows and queries of a cell meet block by block, and each task packs what a query has found in
all its cells, once, by the block of vectors it lies in. Then each block of vectors meets the queries that have candidates
there, and exact distances are ranked in per-task top lists. Where a query shares cells with DENSE of the sample or more,
each block of vectors meets all queries instead, some at a time: the tables of a block are built and asked where its vectors
are, so no candidate is sent. Both ways find the same candidates. Queries that found fewer than k candidates are compared
with all classes, in blocks as well; mostly there are none.

Defined results: rows whose id or vector is null, whose vector is empty, zero or holds null or non-finite components
take no part, nor do vectors of another than the most frequent length (of equally frequent ones the shortest); an id
that comes with several vectors stands for the smallest one; ties go to the smaller id; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import checkpointed, written

TABLES = 12
HASHES = 8
WIDTH = 2.0
PROBES = 80
SAMPLE = 4096
BLOCK = 512  # entries of a cell at a time
VECTORS = 2048  # to a block that distances are computed with, about
QUERIES = 256  # that a block of vectors meets at a time, about
DENSE = 1 / 64  # of all vectors candidates of a query: from here on sending candidates costs more than meeting all blocks
WIDER = 8  # times VECTORS and QUERIES to a block where all blocks meet all queries
COMPONENTS = 1 << 20  # of the vectors of such a block at most, about
SEED = 7
NEAREST = 10


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and vector of the rows that take part, one for each id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vector = F.col("vector")
    sound = (F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
    found = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    found = found.where(F.col("vec_id").isNotNull() & vector.isNotNull()).where(sound)
    lengths = found.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "dim").limit(1).select("dim")  # one row
    found = found.join(F.broadcast(usual), F.size("vector") == F.col("dim")).drop("dim")
    return found.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def classes(found: DataFrame, asked: Column, k: int) -> DataFrame:
    """One row for each different vector: its smallest id, the k + 1 smallest ids, whether any row of it asks."""
    place = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    first = found.withColumn("place", place).where(F.col("place") <= k + 1)
    ids = first.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asking = found.where(asked).select("vector").distinct().withColumn("asks", F.lit(True))
    return ids.join(asking, "vector", "left").select(F.col("ids")[0].alias("cid"), "ids", "vector", F.coalesce("asks", F.lit(False)).alias("asks"))


def template(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Perturbation sets by expected score: ranks (from 0) among a query's 2 * hashes distances to its cell's walls.

    Ranks r and 2 * hashes - 1 - r are the two walls of one projection and exclude each other.
    """
    m, n = hashes, 2 * hashes
    low = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    high = [1 - (n + 1 - j) / (m + 1) + (n + 1 - j) * (n + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, n + 1)]
    score = low + high
    found: list[tuple[int, ...]] = [()]
    heap: list[tuple[float, tuple[int, ...]]] = [(score[0], (0,))]
    while heap and len(found) < probes:
        cost, ranks = heapq.heappop(heap)
        if not any(n - 1 - r in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < n:
            heapq.heappush(heap, (cost - score[last] + score[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (cost + score[last + 1], (*ranks, last + 1)))
    return found


class Hasher:
    """Projections of all tables, fitted on a sample of vectors."""

    def __init__(self, sample: np.ndarray, tables: int, hashes: int, width: float, probes: int, seed: int):
        rng = np.random.default_rng(seed)
        self.tables, self.hashes = tables, hashes
        self.mean = sample.mean(axis=0)
        self.width = width * float(np.sqrt(sample.var(axis=0).sum())) or 1.0
        self.directions = rng.standard_normal((sample.shape[1], tables * hashes))
        self.offsets = rng.uniform(0, 1, tables * hashes)
        self.factors = rng.integers(1, 1 << 62, (tables, hashes), np.int64) * 2 + 1
        self.salts = rng.integers(1, 1 << 62, tables, np.int64)
        ranks = template(hashes, probes)
        self.sets = np.zeros((len(ranks), 2 * hashes), np.int64)
        for k, chosen in enumerate(ranks):
            self.sets[k, list(chosen)] = 1

    def _placed(self, vectors: np.ndarray) -> np.ndarray:
        placed = (vectors - self.mean) @ self.directions / self.width + self.offsets
        return placed.reshape(len(vectors), self.tables, self.hashes)

    def _key(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.factors).sum(axis=-1) + self.salts

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """Rows x tables cell keys."""
        return self._key(np.floor(self._placed(vectors)))

    def visits(self, vectors: np.ndarray) -> np.ndarray:
        """Rows x tables x probes cell keys in the order of the template."""
        placed = self._placed(vectors)
        own = np.floor(placed)
        below = placed - own
        walls = np.concatenate([below, 1 - below], axis=-1)
        order = np.argsort(walls, axis=-1, kind="stable")
        step = np.where(order < self.hashes, -1, 1)
        with np.errstate(over="ignore"):
            factors = np.broadcast_to(self.factors, own.shape)
            change = np.take_along_axis(factors, order % self.hashes, axis=-1) * step
            return self._key(own)[..., None] + change @ self.sets.T

    def share(self, sample: np.ndarray) -> float:
        """Of the vectors of a sample the part that one of them shares a cell with, on average over its first 64."""
        tables, asking = Cells(self.cells(sample)), self.visits(sample[:64])
        return float(unpacked(tables.sharing(asking), len(asking)).mean())


class Cells:
    """The tables of a block of vectors."""

    def __init__(self, cells: np.ndarray):
        self.tables = [np.unique(cells[:, t], return_inverse=True) for t in range(cells.shape[1])]
        self.size = len(cells)

    def sharing(self, visits: np.ndarray) -> np.ndarray:
        """For each vector the queries that visit one of its cells, as bits; of at most 64 queries."""
        found = np.zeros(self.size, np.uint64)
        bits = np.uint64(1) << np.arange(len(visits), dtype=np.uint64)
        for t, (keys, cell) in enumerate(self.tables):
            at = np.minimum(np.searchsorted(keys, visits[:, t]), len(keys) - 1)
            query, probe = np.nonzero(keys[at] == visits[:, t])
            met = np.zeros(len(keys), np.uint64)
            np.bitwise_or.at(met, at[query, probe], bits[query])
            found |= met[cell]
        return found


def unpacked(bits: np.ndarray, queries: int) -> np.ndarray:
    """Vectors x queries, from the bits of each vector."""
    octets = bits.astype("<u8", copy=False).view(np.uint8).reshape(len(bits), 8)
    return np.unpackbits(octets, axis=1, count=queries, bitorder="little").view(bool)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equally long vectors, in double precision."""
    values = np.asarray(column.flatten(), np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _keyed(found: DataFrame, hasher, probing: bool) -> DataFrame:
    """cell, cid, block and place: a row for each table, or for each cell that a query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = hasher.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                vectors = _matrix(part.column(3))
                keys = own.visits(vectors) if probing else own.cells(vectors)
                cells = pa.array(list(keys.reshape(len(vectors), -1)), pa.list_(pa.int64()))
                yield pa.record_batch([cells, *part.columns[:3]], ["cells", "cid", "block", "place"])

    keyed = found.select("cid", "block", "place", "vector")
    keyed = keyed.mapInArrow(run, "cells array<bigint>, cid long, block long, place int")
    return keyed.select(F.explode(F.array_distinct("cells")).alias("cell"), "cid", "block", "place")


def _blocks(keyed: DataFrame, key: str, size: int) -> DataFrame:
    """The entries of each key as arrays; those of a key with more than size entries are dealt to several blocks.

    The keys with many entries are a plain table of known size, and blocks are dealt out by key and part, so that no
    task gets all entries of a crowded key.
    """
    large = keyed.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > size)
    large = written(large.select(key, F.ceil(F.col("n") / size).alias("parts")), "crowded")
    dealt = keyed.join(large, key, "left").withColumn("part", F.pmod(F.xxhash64("cid"), F.coalesce("parts", F.lit(1))))
    entry = F.struct(*[c for c in keyed.columns if c != key])
    return dealt.repartition(key, "part").groupBy(key, "part").agg(F.collect_list(entry).alias("entries")).select(key, "entries")


def pack(places: np.ndarray) -> bytes:
    """Ascending places in a block, as a list or, where that is shorter, as bits; the first byte says which."""
    last = int(places[-1])
    if 16 * len(places) < last:
        return b"s" + places.astype(np.uint16).tobytes() if last < 1 << 16 else b"l" + places.astype(np.uint32).tobytes()
    bits = np.zeros(last + 1, bool)
    bits[places] = True
    return b"b" + np.packbits(bits).tobytes()


def mark(packed: bytes, held: np.ndarray) -> None:
    """Set the places that were packed."""
    if packed[:1] == b"b":
        bits = np.unpackbits(np.frombuffer(packed, np.uint8, offset=1))[: len(held)]
        held[: len(bits)] |= bits.astype(bool)
    else:
        held[np.frombuffer(packed, np.uint16 if packed[:1] == b"s" else np.uint32, offset=1)] = True


def _candidates(pairs: DataFrame) -> DataFrame:
    """block, qid, packed: the classes of a block that a query shares a cell with, once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        held = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for qid, parts in found.items():
                keys = np.unique(np.concatenate(parts))
                blocks, places = keys >> PLACE_BITS, keys & ((1 << PLACE_BITS) - 1)
                starts = np.flatnonzero(np.diff(blocks, prepend=blocks[0] - 1))
                packed = [pack(places[a:b]) for a, b in zip(starts, [*starts[1:], len(places)])]
                columns = [pa.array(blocks[starts]), pa.array([qid] * len(starts), pa.int64()), pa.array(packed, pa.binary())]
                yield pa.record_batch(columns, ["block", "qid", "packed"])

        for batch in batches:
            asking, entries = batch.column(0), batch.column(1)
            q_ends, e_ends = (np.asarray(c.value_lengths()).cumsum().tolist() for c in (asking, entries))
            qids = np.asarray(asking.flatten().field("cid")).tolist()
            values = entries.flatten()
            classes = np.asarray(values.field("block")) << PLACE_BITS | np.asarray(values.field("place"))
            for q_at, q_end, e_at, e_end in zip([0, *q_ends], q_ends, [0, *e_ends], e_ends):
                own = classes[e_at:e_end]
                for qid in qids[q_at:q_end]:
                    found.setdefault(qid, []).append(own)
                    held += len(own)
                if held > MOST_PAIRS:
                    yield from rows()
                    found.clear()
                    held = 0
        yield from rows()

    return pairs.select("asking", "entries").mapInArrow(run, "block long, qid long, packed binary")


class Tops:
    """The k nearest classes of each query, as far as a task has seen."""

    def __init__(self, k: int):
        self.k = k
        self.best: dict[int, dict[int, float]] = {}
        self.worst: dict[int, float] = {}

    def add(self, qid: int, cids: np.ndarray, scores: np.ndarray) -> None:
        near = self.best.setdefault(qid, {})
        close = scores <= self.worst.get(qid, np.inf)
        near.update(zip(cids[close].tolist(), scores[close].tolist()))
        if len(near) > 4 * self.k:
            self.trim(qid)

    def trim(self, qid: int) -> None:
        kept = sorted(self.best[qid].items(), key=lambda x: (x[1], x[0]))[: self.k]
        self.best[qid] = dict(kept)
        if len(kept) == self.k:
            self.worst[qid] = kept[-1][1]

    def taken(self) -> pa.RecordBatch:
        """All rows; begins anew."""
        for qid in self.best:
            self.trim(qid)
        found = [(q, c, s) for q, near in self.best.items() for c, s in near.items()]
        columns = zip(*found) if found else ((), (), ())
        self.best.clear()
        self.worst.clear()
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds)], ["qid", "cid", "score"])


def _ranked(found: DataFrame, candidates: DataFrame, queries: int, k: int) -> DataFrame:
    """qid, cid, score: of each query the k nearest of its candidates, merged within a task.

    A block of vectors meets the queries that have candidates in it, some QUERIES at a time.
    """
    chunk = F.pmod(F.xxhash64("qid"), F.lit(1 + queries // QUERIES)).alias("chunk")
    asking = found.where("asks").select(F.col("cid").alias("qid"), F.col("vector").alias("query"))
    # With their size known, the planner sends them to all tasks where they are few.
    asking = written(asking.groupBy(chunk).agg(F.collect_list(F.struct("qid", "query")).alias("queries")), "asking")
    asked = candidates.groupBy("block", chunk).agg(F.collect_list(F.struct("qid", "packed")).alias("asking"))
    vectors = found.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("cid", "vector"))).alias("entries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = Tops(k)
        for batch in batches:
            for asking, queries, entries in zip(*batch.columns):
                ids, vectors = np.asarray(entries.values.field("cid")), _matrix(entries.values.field("vector"))
                known = zip(queries.values.field("qid").to_pylist(), _matrix(queries.values.field("query")))
                known = dict(known)
                held: dict[int, np.ndarray] = {}
                for qid, packed in zip(asking.values.field("qid").to_pylist(), asking.values.field("packed")):
                    mark(packed.as_py(), held.setdefault(qid, np.zeros(len(ids), bool)))
                for qid, places in held.items():
                    many = 2 * np.count_nonzero(places) > len(ids)  # then picking them out first costs more
                    near = vectors if many else vectors[places]
                    scores = np.sqrt(((near - known[qid]) ** 2).sum(axis=1))
                    tops.add(qid, ids[places], scores[places] if many else scores)
            if len(tops.best) > MOST_HELD:
                yield tops.taken()
        yield tops.taken()

    met = asked.join(asking, "chunk").join(vectors, "block").select("asking", "queries", "entries")
    return met.mapInArrow(run, "qid long, cid long, score double")


def near_ones(queries: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, held: np.ndarray, worst: np.ndarray, k: int):
    """Query and place of the candidates (held: vectors x queries) that can be among a query's k nearest.

    Squared distances by one product of matrices tell those that cannot; a bound of its rounding errors is allowed for.
    worst: the distance that a query's candidates must not exceed, infinite where k are not known yet. lengths: squared.
    """
    own = (queries**2).sum(axis=1)
    slack = 4 * (queries.shape[1] + 8) * np.finfo(float).eps * (lengths.max() + own)
    apart = vectors @ queries.T
    apart *= -2
    apart += lengths[:, None]
    limit = worst**2 - own
    unknown = np.flatnonzero(np.isinf(worst) & (np.count_nonzero(held, axis=0) > k))
    if len(unknown):
        some = slice(max(k, len(vectors) // 16))  # k of these are no nearer than k of all
        first = np.where(held[some, unknown].T, apart[some, unknown].T, np.inf)
        limit[unknown] = np.partition(first, k - 1)[:, k - 1]
    far = apart > limit + 2 * slack  # what cannot be told, as sums that overflow, is not far
    place, query = np.nonzero(held & ~far)
    order = np.argsort(query, kind="stable")
    return query[order], place[order]


def _compared(found: DataFrame, asking: DataFrame, total: int, queries: int, width: int, hasher, k: int) -> DataFrame:
    """qid, cid, score: of each query the k nearest of the classes it shares a cell with, or without a hasher of all.

    Every block of vectors meets the queries, some at a time; top lists are merged within a task.
    """
    size = max(1, min(WIDER * VECTORS, COMPONENTS // width))
    block = F.pmod(F.xxhash64("cid"), F.lit(1 + total // size)).alias("block")
    chunk = F.pmod(F.xxhash64("qid"), F.lit(1 + queries // (WIDER * QUERIES))).alias("chunk")
    # With their size known, the planner sends them to all tasks where they are few.
    asking = asking.select(F.col("cid").alias("qid"), F.col("vector").alias("query"))
    asking = asking.groupBy(chunk).agg(F.collect_list(F.struct("qid", "query")).alias("asking"))
    asking = written(asking.select("asking"), "asking")
    vectors = found.groupBy(block).agg(F.collect_list(F.struct("cid", "vector")).alias("entries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = hasher and hasher.value
        tops, last = Tops(k), None
        for batch in batches:
            for number, entries, asking in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if number != last:  # a block meets one chunk after the other
                    last, cids = number, np.asarray(entries.values.field("cid"))
                    vectors = _matrix(entries.values.field("vector"))
                    lengths = (vectors**2).sum(axis=1)
                    tables = own and Cells(own.cells(vectors))
                qids, asked = asking.values.field("qid").to_pylist(), _matrix(asking.values.field("query"))
                for at in range(0, len(qids), 64):
                    part, these = asked[at : at + 64], qids[at : at + 64]
                    if own:
                        held = unpacked(tables.sharing(own.visits(part)), len(these))
                    else:
                        held = np.ones((len(cids), len(these)), bool)
                    worst = np.array([tops.worst.get(q, np.inf) for q in these])
                    query, place = near_ones(part, vectors, lengths, held, worst, k)
                    ends = np.searchsorted(query, np.arange(len(these) + 1)).tolist()
                    for qid, vector, a, b in zip(these, part, ends, ends[1:]):
                        if a < b:
                            near = vectors[place[a:b]]
                            tops.add(qid, cids[place[a:b]], np.sqrt(((near - vector) ** 2).sum(axis=1)))
                            tops.trim(qid)
                    if len(tops.best) > MOST_HELD:
                        yield tops.taken()
        yield tops.taken()

    met = vectors.crossJoin(asking).select("block", "entries", "asking")
    return met.mapInArrow(run, "qid long, cid long, score double")


MOST_HELD = 100_000  # queries with a top list in a task
MOST_PAIRS = 4_000_000  # candidates held in a task before they are packed
PLACE_BITS = 24  # of a class' place in its block


def _merged(near: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query from the lists of all tasks."""
    near = near.groupBy("qid", "cid").agg(F.min("score").alias("score"))
    near = near.withColumn("place", F.row_number().over(W.partitionBy("qid").orderBy("score", "cid")))
    return near.where(F.col("place") <= k).drop("place")


def _expanded(near: DataFrame, found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score from the nearest classes of each asking class."""
    ids = near.join(found.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("vec_id"))
    # Of a class no more than k + 1 can be needed: one of them may be the query itself.
    place = F.row_number().over(W.partitionBy("qid").orderBy("score", "vec_id"))
    ids = ids.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    listed = ids.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    rows = queries.join(listed, "qid").withColumn("near", F.filter("near", lambda x: x["vec_id"] != F.col("query_id")))
    rows = rows.select("query_id", F.posexplode(F.slice("near", 1, k)).alias("place", "x"))
    return rows.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def _probed(found: DataFrame, total: int, queries: int, hasher, k: int) -> DataFrame:
    """qid, cid, score: of each query the k nearest of the classes it shares a cell with, found through the tables."""
    found = found.withColumn("block", F.pmod(F.xxhash64("cid"), F.lit(1 + total // VECTORS)))
    place = F.row_number().over(W.partitionBy("block").orderBy("cid")) - 1
    found = checkpointed(found.withColumn("place", place))
    visits = _blocks(_keyed(found.where("asks"), hasher, probing=True), "cell", BLOCK).withColumnRenamed("entries", "asking")
    index = _blocks(_keyed(found, hasher, probing=False), "cell", BLOCK)
    return _ranked(found, _candidates(visits.join(index, "cell")), queries, k)


def search(
    rows: DataFrame,
    asked: Column,
    k: int = NEAREST,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows found for each row for which asked (over vec_id) holds."""
    spark = rows.sparkSession
    members = checkpointed(usable(rows, id_column, vector_column))
    found = checkpointed(classes(members, asked, k))
    total = members.count()
    fitted = members.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    if not fitted:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r.vector for r in fitted], np.float64)
    own = Hasher(sample, tables, hashes, width, probes, seed)
    hasher = spark.sparkContext.broadcast(own)

    asking = found.where("asks")
    number, dimension = asking.count(), sample.shape[1]
    if own.share(sample) >= DENSE:
        near = _compared(found, asking, total, number, dimension, hasher, k + 1)
    else:
        near = _probed(found, total, number, hasher, k + 1)
    near = checkpointed(_merged(near, k + 1))
    askers = members.where(asked).select(F.col("vec_id").alias("query_id"), "vector")
    queries = askers.join(asking.select(F.col("cid").alias("qid"), "vector"), "vector").select("query_id", "qid")
    queries = checkpointed(queries)

    # Classes that found too few ids: with all classes, block by block.
    sizes = found.select("cid", F.size("ids").alias("n"))
    held = near.join(sizes, "cid").groupBy("qid").agg(F.sum("n").alias("n"))
    enough = F.least(F.lit(k + 1), F.lit(total))
    few = asking.join(held.where(F.col("n") >= enough).select(F.col("qid").alias("cid")), "cid", "left_anti")
    few = checkpointed(few)
    if not (number := few.count()):
        return _expanded(near, found, queries, k)
    rest = _compared(found, few, total, number, dimension, None, k + 1)
    return _expanded(_merged(near.union(rest), k + 1), found, queries, k)
