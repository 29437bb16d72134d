"""Ranked lexical search by Block-Max MaxScore over an index in shards.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, with only A-Z lower-cased. A document's
score is the sum, over the terms of an item, of a weight that falls with the term's document frequency times an impact
that rises with its occurrences and falls with the document's length; all integers but for the weights' logarithm.

Index: each task cuts its documents into shards of some SHARD terms. A shard holds a list for each of its terms: gaps
between its documents and occurrences in one or two bytes each, in blocks of BLOCK, with the last document and the
greatest impact of each block and of the list. The index is a table in the shared folder; texts are never shuffled.

Search: the lists of the items' terms are dealt out by shard. In a shard, an item's lists are ordered by the most that
each can add. Those whose bounds add up to less than the score of the last document in the item's list of the best are
not essential: only documents of the others are candidates. Candidates are looked up in the lists that are not
essential, the greatest bound first; one whose score so far, block maximum and remaining bounds cannot reach the list of
the best is dropped before the block is unpacked. The lists of the best go on from shard to shard of a task; those of all
tasks are merged in two steps. Items are taken in blocks of some ITEM_TERMS terms, which bounds what is broadcast.

Defined results: a null or empty text has no terms; every row of documents and of items counts on its own, also if an
id is repeated or null (a null doc_id comes after the others among equal scores); an item without terms, or whose terms
no document has, finds nothing; a text of any length is indexed whole, one longer than a shard is a shard of its own; no
documents or no items give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starload.llm.common import written

BEST = 10
SHARD = 1 << 21  # terms, repeats included
SHARD_DOCUMENTS = 1 << 15  # a gap fits two bytes
BLOCK = 64
STRIP = 2048  # documents of a shard scored at a time
ITEM_TERMS = 200_000
MERGERS = 64
SPACES = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
SCHEMA = """shard long, term binary, n long, top long, ends array<int>, tops array<long>, gaps binary, counts binary,
    doc_ids array<long>, marks array<long>"""


def terms(text: bytes) -> list[bytes]:
    return text.translate(SPACES).split()


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def _impact(counts: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * counts // (1000 * counts + 8 * marks)


@dataclass(frozen=True)
class Index:
    lists: DataFrame
    documents: int  # with at least one term
    terms: int  # of all documents, repeats included


# Building -------------------------------------------------------------------------------------


def _totals(docs: DataFrame) -> tuple[int, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(terms(t.as_py() or b"")) for t in batch.column(0).cast(pa.binary())]
            yield pa.record_batch([pa.array([sum(map(bool, sizes))]), pa.array([sum(sizes)])], ["documents", "terms"])

    found = docs.select("text").mapInArrow(run, "documents long, terms long")
    row = found.agg(F.sum("documents"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def _lists_of(split: list[list[bytes]], marks: np.ndarray, shard: int) -> pa.RecordBatch:
    """The lists of a shard, all terms at once."""
    number = dict.fromkeys(chain.from_iterable(split))
    for k, term in enumerate(number):
        number[term] = k
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    keys = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
    keys *= len(split)
    keys += np.repeat(np.arange(len(split)), sizes)
    keys, counts = np.unique(keys, return_counts=True)
    term, doc = np.divmod(keys, len(split))
    starts = np.searchsorted(term, np.arange(len(number) + 1))
    held = np.diff(starts)
    gaps = np.diff(doc, prepend=-1)
    gaps[starts[:-1]] = doc[starts[:-1]] + 1
    blocks = -(-held // BLOCK)
    block_at = np.concatenate([[0], np.cumsum(blocks)])
    place = np.arange(block_at[-1]) - np.repeat(block_at[:-1], blocks)
    first = np.repeat(starts[:-1], blocks) + place * BLOCK
    last = np.minimum(first + BLOCK, np.repeat(starts[1:], blocks)) - 1
    impacts = _impact(counts, marks[doc])
    narrow = np.uint8 if counts.max(initial=0) < 256 else np.uint32

    def packed(values: np.ndarray) -> pa.Array:
        offsets = pa.array(starts * values.itemsize, pa.int32())
        return pa.Array.from_buffers(pa.binary(), len(held), [None, offsets.buffers()[1], pa.py_buffer(values.tobytes())])

    def listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(block_at, pa.int32()), pa.array(values, kind))

    none = pa.nulls(len(held), pa.list_(pa.int64()))
    tops = np.maximum.reduceat(impacts, first) if len(first) else first
    columns = [
        pa.array(np.full(len(held), shard)),
        pa.array(list(number), pa.binary()),
        pa.array(held),
        pa.array(np.maximum.reduceat(impacts, starts[:-1]) if len(held) else held),
        listed(doc[last], pa.int32()),
        listed(tops, pa.int64()),
        packed(gaps.astype(np.uint16)),
        packed(counts.astype(narrow)),
        none,
        none,
    ]
    return pa.record_batch(columns, NAMES)


def _documents_of(doc_ids: list[int | None], marks: np.ndarray, shard: int) -> pa.RecordBatch:
    """The row of a shard that holds its documents."""
    row = {"shard": shard, "n": len(doc_ids), "doc_ids": doc_ids, "marks": marks.tolist()}
    return pa.RecordBatch.from_pylist([row], ROWS)


ROWS = pa.schema(
    [
        ("shard", pa.int64()),
        ("term", pa.binary()),
        ("n", pa.int64()),
        ("top", pa.int64()),
        ("ends", pa.list_(pa.int32())),
        ("tops", pa.list_(pa.int64())),
        ("gaps", pa.binary()),
        ("counts", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("marks", pa.list_(pa.int64())),
    ]
)
NAMES = ROWS.names


def build(docs: DataFrame) -> Index:
    """The index of all rows of documents (doc_id, text). The texts are read twice: for the mean length, and for the lists."""
    documents, length = _totals(docs)
    shard_terms, shard_documents = SHARD, SHARD_DOCUMENTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        doc_ids, split, held = [], [], 0
        for row in chain(chain.from_iterable(map(_rows, batches)), [None]):
            found = row and terms(row[1])
            full = held and (row is None or held + len(found) > shard_terms or len(split) == shard_documents)
            if full:
                marks = np.array([10 + 90 * len(x) * documents // length for x in split], np.int64)
                yield _documents_of(doc_ids, marks, shard)
                yield _lists_of(split, marks, shard)
                doc_ids, split, held, shard = [], [], 0, shard + 1
            if found:
                doc_ids.append(row[0])
                split.append(found)
                held += len(found)

    picked = docs.select(F.col("doc_id").cast("long"), "text")
    return Index(written(picked.mapInArrow(run, SCHEMA), "lexical-index"), documents, length)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
        yield doc_id, text.as_py() or b""


# Searching ------------------------------------------------------------------------------------


class Postings:
    """One list of a shard, unpacked block by block."""

    def __init__(self, n: int, top: int, ends: np.ndarray, tops: np.ndarray, gaps: bytes, counts: bytes):
        self.n, self.top, self.ends, self.tops = n, top, ends, tops
        self.gaps = np.frombuffer(gaps, np.uint16)
        self.counts = np.frombuffer(counts, np.uint8 if len(counts) == n else np.uint32)

    def unpack(self, blocks: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents, ascending, and impacts of these blocks."""
        place = blocks[:, None] * BLOCK + np.arange(BLOCK)
        real = place < self.n
        place = np.minimum(place, self.n - 1)
        before = np.where(blocks > 0, self.ends[blocks - 1], -1)
        docs = (np.cumsum(np.where(real, self.gaps[place], 0), axis=1, dtype=np.int64) + before[:, None])[real]
        return docs, _impact(self.counts[place][real].astype(np.int64), marks[docs])


class Best:
    """The best documents of one item so far: scores, whether the id is null, ids."""

    def __init__(self, k: int):
        self.k = k
        self.rows = np.empty((3, 0), np.int64)

    @property
    def least(self) -> int:
        """What a score must reach."""
        return int(self.rows[0, -1]) if self.rows.shape[1] == self.k else 1

    def add(self, scores: np.ndarray, nameless: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([scores, nameless, ids])], axis=1)
        self.rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]]


def search_shard(lists: list[tuple[int, Postings]], marks: np.ndarray, ids: np.ndarray, nameless: np.ndarray, best: Best) -> None:
    """Add to the best documents of an item those of a shard; lists: weight and postings of the item's terms there."""
    lists = sorted((x for x in lists if x[0] * x[1].top), key=lambda x: x[0] * x[1].top)
    sums = np.cumsum([w * p.top for w, p in lists]).tolist()  # the most that a list and all smaller ones add
    for start in range(0, len(marks), STRIP):
        least = best.least
        essential = sum(s < least for s in sums)
        if essential == len(lists):
            return
        scores = np.zeros(min(STRIP, len(marks) - start), np.int64)
        for w, postings in lists[essential:]:
            lo, hi = np.searchsorted(postings.ends, [start, start + len(scores) - 1])
            blocks = np.arange(lo, min(hi + 1, len(postings.ends)))
            docs, impacts = postings.unpack(blocks, marks)
            here = slice(*np.searchsorted(docs, [start, start + len(scores)]))
            scores[docs[here] - start] += w * impacts[here]
        found = np.flatnonzero(scores)
        for k in range(essential - 1, -1, -1):
            found = found[scores[found] + sums[k] >= least]
            if not len(found):
                break
            w, postings = lists[k]
            block = np.searchsorted(postings.ends, found + start)
            inside = block < len(postings.ends)
            block[~inside] = 0
            most = np.where(inside, w * postings.tops[block], 0) + (sums[k - 1] if k else 0)
            hopeful = scores[found] + most >= least
            found, block, inside = found[hopeful], block[hopeful], inside[hopeful]
            if inside.any():
                docs, impacts = postings.unpack(np.unique(block[inside]), marks)
                at = np.minimum(np.searchsorted(docs, found + start), len(docs) - 1)
                hit = docs[at] == found + start
                scores[found[hit]] += w * impacts[at[hit]]
        found = found[scores[found] >= least]
        if len(found):
            best.add(scores[found], nameless[found + start], ids[found + start])


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict[bytes, Postings], np.ndarray, np.ndarray, np.ndarray]]:
    """Lists by term, marks, ids and which ids are null, of each shard; the rows come sorted by shard."""
    shard, lists, documents = None, {}, None
    for batch in batches:
        columns = [batch.column(name) for name in NAMES]
        numbers = columns[0].to_pylist()
        for k in range(batch.num_rows):
            if numbers[k] != shard:
                if documents is not None:
                    yield lists, *documents
                shard, lists, documents = numbers[k], {}, None
            if (term := columns[1][k].as_py()) is None:
                own = columns[8][k].values
                ids = own.fill_null(0).to_numpy(zero_copy_only=False)
                nameless = own.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                documents = columns[9][k].values.to_numpy(zero_copy_only=False), ids, nameless
            else:
                arrays = (c[k].values.to_numpy(zero_copy_only=False) for c in columns[4:6])
                figures = (c[k].as_py() for c in columns[2:4])
                lists[term] = Postings(*figures, *arrays, *(c[k].as_py() for c in columns[6:8]))
    if documents is not None:
        yield lists, *documents


def _found(index: Index, items: list[tuple[object, list[bytes]]], k: int, number: int, kind: T.DataType) -> DataFrame:
    """item, part, item_id, doc_id and score of the best documents of each task, for one block of items."""
    spark = index.lists.sparkSession
    asked = sorted(set(chain.from_iterable(t for _, t in items)))
    # Bounded: the terms of one block of items.
    table = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in asked], "term binary"))
    wanted = index.lists.join(table, "term", "left_semi").select(*NAMES)
    frequency = {bytes(r[0]): r[1] for r in wanted.groupBy("term").agg(F.sum("n")).collect()}
    weights = {t: weight(index.documents, n) for t, n in frequency.items()}
    id_type = to_arrow_type(kind)
    sent = spark.sparkContext.broadcast([(i, [(weights[t], t) for t in found if t in weights]) for i, found in items])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in sent.value]
        for lists, marks, ids, nameless in _shards(batches):
            for own, (_, weighted) in zip(best, sent.value):
                present = [(w, lists[t]) for w, t in weighted if t in lists]
                if present:
                    search_shard(present, marks, ids, nameless, own)
        part = TaskContext.get().partitionId() % MERGERS
        for place, (own, (item_id, _)) in enumerate(zip(best, sent.value)):
            scores, nameless, ids = own.rows
            if len(scores):
                columns = [
                    pa.array([(number << 32) + place] * len(scores), pa.int64()),
                    pa.array([part] * len(scores), pa.int32()),
                    pa.array([item_id] * len(scores), id_type),
                    pa.array(ids, mask=nameless.astype(bool)),
                    pa.array(scores),
                ]
                yield pa.record_batch(columns, ["item", "part", "item_id", "doc_id", "score"])

    rows = wanted.union(index.lists.where("term is null").select(*NAMES))
    dealt = rows.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, f"item long, part int, item_id {kind.simpleString()}, doc_id long, score long")


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The items' ids and different terms, some ITEM_TERMS at a time."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + total // (2 * ITEM_TERMS)  # a term and its end take two bytes at least
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    for number in range(count):
        rows = dealt.where(F.col("block") == number).collect()
        yield [(r.item_id, sorted(set(terms((r.text or "").encode())))) for r in rows]


def search(index: Index, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents, with a score above 0, of each row of items."""
    spark: SparkSession = items.sparkSession
    items = items.select("item_id", "text")
    kind = items.schema["item_id"].dataType
    parts = [_found(index, block, k, n, kind) for n, block in enumerate(_blocks(items)) if block and index.documents]
    if not parts:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "part"], ["item"]):  # a merger sees the lists of some tasks, the last one those of the mergers
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
held AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals
),
items AS (
  SELECT item_id,
         unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM benchmark
),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // len)))))::BIGINT AS score
  FROM items JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id) CROSS JOIN totals GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
