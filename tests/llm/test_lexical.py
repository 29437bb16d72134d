import math
import random
import re
from collections import Counter

import pytest

from starload.llm import lexical

DOCS = "doc_id long, text string, term string, score long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    held = [(d, c) for d, c in held if c]
    count, length = len(held), sum(sum(c.values()) for _, c in held)
    frequency = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in held:
            m = 10 + 90 * sum(c.values()) * count // length
            score = 0
            for t in set(terms(text)) & c.keys():
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * frequency[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        best = sorted(found)[:k]
        out += [(item_id, r, None if none else d, -s) for r, (s, none, d) in enumerate(best, 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, parts=4, **more):
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS).repartition(parts)
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    found = lexical.search(lexical.build(rows), table, **more)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, count, words=60, longest=80):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    text = lambda: " ".join(pick.choices(vocabulary, weights, k=pick.randint(0, longest)))
    ids = list(range(count))
    pick.shuffle(ids)
    return [(i, text()) for i in ids], [(k, text()[: pick.randint(0, 90)]) for k in range(25)]


@pytest.fixture
def small(monkeypatch):
    """Many shards, strips and blocks in few documents."""
    for name, value in [("SHARD", 3000), ("SHARD_DOCUMENTS", 150), ("BLOCK", 4), ("STRIP", 16), ("MERGERS", 2)]:
        monkeypatch.setattr(lexical, name, value)


def special():
    docs = [(k, "Same text, twice-told 42") for k in range(30)]  # ties go to the smaller id
    docs += [(100, None), (101, ""), (102, " .,-"), (103, "É é É ÀB"), (104, "a_b a\xa0b"), (105, "x" * 5000)]
    docs += [(5, "same other"), (5, "same other"), (None, "same text"), (None, "told same"), (-3, "SAME")]
    docs += [(200, "rare " + "filler " * 30000), (201, "rare " * 300)]
    items = [(1, "same TEXT"), (2, None), (3, ""), (4, "nowhere"), (5, "rare filler"), (6, "É"), (7, "a\xa0b x 42")]
    return docs, items + [(7, "told"), (None, "told"), (9, "same same"), (9, "same same")]


def test_equals_brute_force(spark):
    docs, items = special()
    assert searched(spark, docs, items) == brute(docs, items)
    assert searched(spark, docs, items, k=2) == brute(docs, items, 2)


def test_many_shards(spark, small):
    docs, items = special()
    assert searched(spark, docs, items) == brute(docs, items)
    for seed, words in [(1, 60), (2, 400), (3, 8)]:
        docs, items = corpus(seed, 900, words)
        assert searched(spark, docs, items) == brute(docs, items)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_TERMS", 100)
    docs, items = corpus(5, 300)
    assert searched(spark, docs, items) == brute(docs, items)


def test_nothing(spark):
    assert searched(spark, [], [(1, "a")]) == searched(spark, [(1, "a")], []) == searched(spark, [(1, " ")], [(1, "a")]) == []


def shard(split):
    import numpy as np

    marks = np.full(len(split), 100)
    batch = lexical._lists_of(split, marks, 1)
    documents = lexical._documents_of(list(range(len(split))), marks, 1)
    [(lists, marks, ids, nameless)] = lexical._shards([documents, batch])
    return lists, marks, ids, nameless


def test_lists_come_back_whole():
    import numpy as np

    split = [[b"a"] * (k % 300 + 1) + [b"b"] * (k % 7 == 0) for k in range(1000)]
    lists, marks, _, _ = shard(split)
    docs, impacts = lists[b"a"].unpack(np.arange(len(lists[b"a"].ends)), marks)
    assert docs.tolist() == list(range(1000))
    assert impacts.tolist() == [10**9 * (k % 300 + 1) // (1000 * (k % 300 + 1) + 800) for k in range(1000)]
    docs, _ = lists[b"b"].unpack(np.array([1, 2]), marks)
    assert docs.tolist() == [7 * k for k in range(64, 143)]


def test_blocks_are_skipped(monkeypatch):
    """Once the best are known, blocks of common terms stay packed."""
    often = lambda k: 9 if k < 2000 else 2
    split = [[b"rare"] * often(k) + [b"common"] if k % 100 == 0 else [b"common"] for k in range(20000)]
    lists, marks, ids, nameless = shard(split)
    unpacked = []
    whole = lexical.Postings.unpack
    monkeypatch.setattr(lexical.Postings, "unpack", lambda self, blocks, marks: (unpacked.append((self.n, len(blocks))), whole(self, blocks, marks))[1])
    best = lexical.Best(10)
    lexical.search_shard([(9000, lists[b"rare"]), (10, lists[b"common"])], marks, ids, nameless, best)
    assert best.rows[2].tolist() == list(range(0, 1000, 100))
    common = sum(n for held, n in unpacked if held == 20000)
    assert 0 < common < len(lists[b"common"].ends) // 3
