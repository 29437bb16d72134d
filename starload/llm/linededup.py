"""Line dedup: lines whose key many documents hold lose all their copies; the others are put together again.

A line's key is the line without the six blanks at its ends and with A-Z lower-cased. Keys are compared by their
128-bit digest. Only digests and positions are shuffled for counting; the text moves once, to meet the positions
that it loses, and equal texts share one set of positions.

Defined results: a null or empty text is one empty line and stays as it is, an empty key is never dropped, a text that
loses every line becomes the empty text; documents are told apart by doc_id (null is one more id), so a line repeated in one document,
or in repeated rows of it, counts once; every row comes back with all its columns, also if they are called like the
columns used here; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import BLANKS, checkpointed, whole_text, written

IN_DOCUMENTS = 10
KEY_LENGTH = 1
STRIPPED = BLANKS.encode()
ROWS = 512  # texts handed on at a time


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).lower()  # of bytes: ASCII only


def _keyed(docs: DataFrame, key_length: int) -> DataFrame:
    """doc_id, the text's digest and the digests of its lines' keys in order, null where the key is too short."""

    def digests(text: bytes) -> list[bytes | None]:
        keys = map(line_key, text.split(b"\n"))
        long_enough = (k if len(k) >= key_length and len(k.decode()) >= key_length else None for k in keys)
        return [None if k is None else hashlib.md5(k).digest() for k in long_enough]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = (digests(t.as_py()) for t in batch.column(2).cast(pa.binary()))
            column = pa.array(lines, pa.list_(pa.binary()))
            yield pa.record_batch([batch.column(0), batch.column(1), column], ["doc_id", "digest", "keys"])

    text = whole_text()
    picked = docs.select("doc_id", F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, digest binary, keys array<binary>")


def frequent_keys(docs: DataFrame, in_documents: int = IN_DOCUMENTS, key_length: int = KEY_LENGTH) -> DataFrame:
    """Digest of each line key that at least in_documents documents hold."""
    lines = _keyed(docs, key_length).select("doc_id", F.explode(F.array_distinct("keys")).alias("key"))
    counted = lines.where("key is not null").groupBy("key").agg(F.count_distinct(F.struct("doc_id")).alias("n"))
    return counted.where(F.col("n") >= in_documents).select("key")


def dedupe_lines(docs: DataFrame, in_documents: int = IN_DOCUMENTS, key_length: int = KEY_LENGTH) -> DataFrame:
    """The columns of docs, text without the lines that go, then n_lines (before) and n_dropped."""
    return _deduped(docs, in_documents, key_length).select(*_own(docs), "n_lines", "n_dropped")


def deduped_text(docs: DataFrame, in_documents: int = IN_DOCUMENTS, key_length: int = KEY_LENGTH) -> DataFrame:
    """The columns of docs, text without the lines that go."""
    return _deduped(docs, in_documents, key_length).select(*_own(docs))


def _own(docs: DataFrame) -> list[Column]:
    return [F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns]


def _deduped(docs: DataFrame, in_documents: int, key_length: int) -> DataFrame:
    """rest (the other columns of docs), text, n_lines, n_dropped.

    What the lines and the texts are joined with is kept apart first, so that the joins can split the rows of a frequent
    line or of a text with many copies. The frequent keys, few, are a plain table of known size.
    """
    frequent = written(frequent_keys(docs, in_documents, key_length), "frequent")
    lines = _keyed(docs, key_length).select("digest", F.posexplode("keys").alias("at", "key"))
    dropped = lines.where("key is not null").join(frequent, "key", "left_semi")
    dropped = dropped.groupBy("digest").agg(F.collect_set("at").alias("dropped"))
    dropped = checkpointed(dropped)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    whole = docs.select(rest.alias("rest"), "text", F.unhex(F.md5(whole_text())).alias("digest"))
    joined = whole.join(dropped, "digest", "left").select("rest", "text", "dropped")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                counts, losses, texts = [], [], []
                for text, gone in zip(part.column(1).cast(pa.binary()), part.column(2)):
                    data, positions = text.as_py(), set(gone.as_py() or ())
                    rows = (data or b"").split(b"\n")
                    counts.append(len(rows))
                    losses.append(len(positions))
                    texts.append(b"\n".join([x for k, x in enumerate(rows) if k not in positions]) if positions else data)
                kept = pa.array(texts, pa.binary()).cast(pa.string())
                found = [kept, pa.array(counts, pa.int64()), pa.array(losses, pa.int64())]
                yield pa.record_batch([part.column(0), *found], ["rest", "text", "n_lines", "n_dropped"])

    schema = T.StructType(joined.schema.fields[:2]).add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(run, schema)


ORACLE = r"""
WITH blanks AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS b),
split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split
),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, (SELECT b FROM blanks)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
"""
