"""Byte-pair encoding with reuse of content-defined chunks, and decoding.

A rolling hash over the last WINDOW bytes cuts each text where its content says so, hence a passage that many
documents share is cut into the same chunks wherever it stands. A chunk is encoded once and kept; so is each blank-
separated piece inside it. A cut may fall inside a piece: the two halves at a join are then set aside and the whole
piece is encoded again, carried over as many chunks as it spans, so the ids are those of the uncut text exactly.

Chunks and pieces are kept by task, in caches of bounded size. Encoding them once for the whole cluster would
shuffle every text and its ids, which costs more than the encoding it saves; blank-separated pieces, of which a few
hundred thousand cover most of a corpus, carry nearly all of the reuse.

Only tokenizers that treat blank-separated pieces independently can be used. That is read off the tokenizer's own
description when it is loaded (see proofs()): steps that are not known to keep pieces apart make it refused. Two shortcuts
leave fewer different pieces to encode, each taken only where the description proves it. If all texts are lower-cased,
A-Z are beforehand, but in texts where a composing character might follow one of them. If words are always parted from
full stops and commas, a piece that ends in one is put together from its word and the mark.

Defined results: a null text is an empty one and has no ids and an empty decoded text; strings of special tokens in a
text are those tokens, as in the library; rows are kept as often as they come; an empty table gives an empty result; a
very long text is encoded whole, in memory that grows with its length; other columns than those to be kept are not
looked at, and a kept one must not be called like a result.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

WINDOW = 16  # bytes that decide a cut
MEAN_CHUNK = 1024
SLICE = 1 << 20  # bytes of text, or of hashes, worked on at a time
MOST_CHUNKS = 4096
MOST_PIECES = 400_000
LONGEST_PIECE = 64  # longer pieces are not kept
if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are built as little-endian 32-bit integers")
GEAR = np.random.default_rng(20240501).integers(0, 1 << 32, 256, np.uint32)
BLANKS = b" \t\n\x0b\x0c\r"
MARKS = b".,"
COMPOSED = re.compile(rb"[A-Z][\x80-\xff]")  # where lower-casing first could let characters compose that else do not

# Splits into apostrophe endings, words, digits and runs of the rest, none of which holds a blank.
WORD_SPLITS = {r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def _steps(part: dict | None, listed: str) -> list[dict]:
    if part is None:
        return []
    return [x for step in part[listed] for x in _steps(step, listed)] if part["type"] == "Sequence" else [part]


def proofs(description: dict) -> tuple[bool, bool, bool]:
    """What a tokenizer's description proves: that blank-separated pieces are independent, that A-Z are lower-cased
    whatever stands around them (but for composing characters), that words are parted from a mark that follows them."""
    model, tokens = description["model"], description["added_tokens"]
    normal = _steps(description["normalizer"], "normalizers")
    split = _steps(description["pre_tokenizer"], "pretokenizers")

    def keeps_apart(step: dict) -> bool:
        """Letters are lower-cased one by one, no blank composes with anything, and a blank stays one."""
        blanks = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        return step["type"] in ("NFC", "NFD", "Lowercase") or step == blanks

    def at_words(step: dict) -> bool:
        known = step["type"] == "Split" and step["pattern"].get("Regex") in WORD_SPLITS
        return known and step["behavior"] == "Removed" and step["invert"]

    def inside(step: dict) -> bool:
        """Looks at each piece alone."""
        plain = step["type"] == "ByteLevel" and not step["add_prefix_space"] and not step["use_regex"]
        return plain or step["type"] in ("Digits", "Punctuation")

    first = split[0]["type"] if split else ""
    apart = first in ("WhitespaceSplit", "Whitespace", "BertPreTokenizer") or bool(split) and at_words(split[0])
    strict = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1 for t in tokens)
    bpe = model["type"] == "BPE" and not model.get("dropout") and description["decoder"] is None
    independent = apart and strict and bpe and all(map(keeps_apart, normal)) and all(map(inside, split[1:]))
    folds = independent and any(step["type"] == "Lowercase" for step in normal)
    return independent, folds, independent and first != "WhitespaceSplit"


def cuts(data: bytes, mean: int = MEAN_CHUNK) -> list[int]:
    """Ends of the content-defined chunks; the last is the end of the data."""
    found = []
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, len(raw), SLICE):
        before = min(at, WINDOW - 1)
        h = GEAR[raw[at - before : at + SLICE]]
        width = 1
        while width < WINDOW:  # doubles the bytes that each hash covers
            h[width:] += h[:-width] << np.uint32(width)
            width *= 2
        found.append(np.flatnonzero(h[before:] < np.uint32((1 << 32) // mean)) + at + 1)
    ends = np.concatenate(found).tolist() if found else []
    return ends if ends and ends[-1] == len(data) else [*ends, len(data)]


def split(chunk: bytes) -> tuple[bytes, list[bytes], bytes] | None:
    """The piece open on the left (maybe empty), the closed ones, the piece open on the right; None if all is one piece."""
    pieces = chunk.split()
    left, right = chunk[0] not in BLANKS, chunk[-1] not in BLANKS
    if left and right and len(pieces) == 1:
        return None
    return pieces[0] if left else b"", pieces[left : len(pieces) - right], pieces[-1] if right else b""


class Encoder:
    """A tokenizer with its caches."""

    def __init__(self, tokenizer_json: str, mean: int = MEAN_CHUNK):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.mean = mean
        self.tokens = [self.tokenizer.id_to_token(k) for k in range(self.tokenizer.get_vocab_size())]
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.long: list[bytes] = []
        self.ids: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple] = {}
        independent, self.folds, self.parts = proofs(json.loads(tokenizer_json))
        if not independent:
            raise ValueError("this tokenizer is not known to treat blank-separated pieces independently")

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _keep(self, piece: bytes, ids: bytes) -> None:
        if len(piece) > LONGEST_PIECE:
            self.long.append(piece)
        self.ids[piece] = ids

    def learn(self, pieces: Iterable[bytes]) -> None:
        """Encode the pieces not known yet, all at once."""
        new = [p for p in pieces if p not in self.ids]
        marked = []
        if self.parts:
            marked = [p for p in new if p[-1] in MARKS and p[-2:-1].isalpha()]  # of bytes: after A-Z, a-z
            whole = set(marked)
            new = [p for p in new if p not in whole]
            new += [p for p in {p[:-1]: None for p in marked} | {p[-1:]: None for p in marked} if p not in self.ids]
            new = list(dict.fromkeys(new))
        found = self.tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
        for piece, encoding in zip(new, found):
            self._keep(piece, array("I", encoding.ids).tobytes())
        for piece in marked:
            self._keep(piece, self.ids[piece[:-1]] + self.ids[piece[-1:]])

    def forget(self) -> None:
        """Bring the caches back under their bounds, oldest entries first."""
        for piece in self.long:
            del self.ids[piece]
        self.long.clear()
        if len(self.ids) > MOST_PIECES:
            for piece in list(islice(self.ids, len(self.ids) - MOST_PIECES // 2)):
                del self.ids[piece]
        if len(self.chunks) > MOST_CHUNKS:
            for chunk in list(islice(self.chunks, len(self.chunks) - MOST_CHUNKS // 2)):
                del self.chunks[chunk]

    def _chunk(self, split: tuple[bytes, list[bytes], bytes]) -> tuple[bytes, bytes, bytes]:
        """Open piece on the left, ids of the closed ones, open piece on the right."""
        left, closed, right = split
        return left, b"".join(map(self.ids.__getitem__, closed)), right

    def _folded(self, data: bytes) -> bytes:
        """Lower-cased, unless that could make or unmake a special token or a composed character."""
        lower = data.lower()
        return data if any(token in lower for token in self.special) or COMPOSED.search(data) else lower

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def clear(self) -> None:
        """Give the memory back: a worker that has nothing to encode is kept for other work."""
        self.ids.clear()
        self.chunks.clear()
        self.long.clear()
        pa.default_memory_pool().release_unused()

    def encode(self, texts: list[bytes]) -> Iterator[tuple[bytes, str]]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text, of each text."""
        cut = []
        for data in map(self._folded, texts) if self.folds else texts:
            start, chunks = 0, []
            for end in cuts(data, self.mean) if data else ():
                chunks.append(data[start:end])
                start = end
            cut.append(chunks)
        new = {c: split(c) for c in dict.fromkeys(c for chunks in cut for c in chunks) if c not in self.chunks}
        self.learn({p: None for found in new.values() if found for p in found[1]})
        for chunk, found in new.items():
            self.chunks[chunk] = found and self._chunk(found)
        for chunks in cut:
            ids = self._joined(chunks)
            yield ids, self.decode(ids)
        self.forget()

    def _joined(self, chunks: list[bytes]) -> bytes:
        ids, carried = [], []

        def close() -> None:
            """The piece that the last joins have cut, encoded whole."""
            if piece := b"".join(carried):
                if piece not in self.ids:
                    self._keep(piece, array("I", self._plain(piece.decode())).tobytes())
                ids.append(self.ids[piece])
            carried.clear()

        for chunk in chunks:
            if (found := self.chunks[chunk]) is None:
                carried.append(chunk)
                continue
            left, inner, right = found
            carried.append(left)
            close()
            ids.append(inner)
            carried.append(right)
        close()
        return b"".join(ids)


@lru_cache(maxsize=2)
def encoder(tokenizer_json: str, mean: int) -> Encoder:
    return Encoder(tokenizer_json, mean)


def slices(texts: Iterable[bytes], size: int = SLICE) -> Iterator[list[bytes]]:
    """The texts in order, grouped up to the size, at least one to a group."""
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def encode_documents(docs: DataFrame, tokenizer_file: str, keep: list[str], text: str = "text", mean: int = MEAN_CHUNK) -> DataFrame:
    """The kept columns with n_tokens, ids (little-endian unsigned 32-bit integers) and decoded text.

    tokenizer_file is read by the driver only; the executors get its content, whose size is that of a vocabulary.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(content.value, mean)
        for batch in batches:
            at = 0
            for group in slices(x.as_py() or b"" for x in batch.column(batch.num_columns - 1).cast(pa.binary())):
                found = list(own.encode(group))
                columns = [batch.column(k).slice(at, len(group)) for k in range(batch.num_columns - 1)]
                at += len(group)
                columns += [
                    pa.array([len(ids) // 4 for ids, _ in found], pa.int64()),
                    pa.array([ids for ids, _ in found], pa.binary()),
                    pa.array([decoded for _, decoded in found], pa.string()),
                ]
                yield pa.record_batch(columns, schema_names)
        own.clear()

    picked = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"])
    schema = T.StructType(picked.schema.fields[:-1]).add("n_tokens", "long").add("ids", "binary").add("decoded", "string")
    schema_names = schema.names
    return picked.mapInArrow(run, schema)
