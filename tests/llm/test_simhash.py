import random

import pytest
import xxhash
from pyspark.sql import functions as F

from starload.llm import simhash

SCHEMA = "doc_id long, text string, fp string, part string"


def print_of(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    prints = [print_of(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if label[j] < label[i] and (prints[i] ^ prints[j]).bit_count() <= radius:
                    label[i], changed = label[j], True
    least = {}
    for k, (doc_id, _) in zip(label, rows):
        if doc_id is not None:
            least[k] = min(least.get(k, doc_id), doc_id)
    return sorted(((d, p, least.get(k)) for (d, _), p, k in zip(rows, prints, label)), key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    texts = []
    for _ in range(40):
        words = [rng.choice("ab cd ef gh ij kl mn op qr st".split()) + str(rng.randrange(50)) for _ in range(200)]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(200)] = "new"
            texts.append(" ".join(words).upper())
    texts += [None, "", " \n", "one", "one two", "ONE two", "é É", texts[0], texts[0]]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[1]), (None, "alone in the world")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)


def test_components_equal_brute_force(spark):
    rows = corpus()
    found = simhash.near_duplicates(frame(spark, rows).repartition(3))
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found.collect()), key=str)
    assert got == brute(rows)


def test_fingerprint_in_strips(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    monkeypatch.setattr(simhash, "AT_ONCE", 64)
    assert simhash.fingerprint(text.encode()) == print_of(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_links_connect_what_brute_force_connects(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base * 6} | set(base) | {0, 2**64 - 1}
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    found = simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"), radius, tile=4))
    root = {r.node % 2**64: r.root for r in found.collect()}
    for a in prints:
        near = [b for b in prints if b != a and (a ^ b).bit_count() <= radius]
        assert (a in root) == bool(near)
        assert all(root[a] == root[b] for b in near)
    assert len(set(root.values())) == count_components(prints, radius)


def count_components(prints, radius):
    left, n = set(prints), 0
    while left:
        todo, size = [left.pop()], 1
        while todo:
            near = [b for b in left if (todo[-1] ^ b).bit_count() <= radius]
            todo.pop()
            left -= set(near)
            todo += near
            size += len(near)
        n += size > 1
    return n


def test_long_chain_is_one_component(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in simhash.components(chain).collect()} == {0}


def test_one_of_each_keeps_columns_and_ids(spark):
    rows = [(2, "a b c d"), (1, "A b c d"), (1, "A b c d"), (None, "a b c d"), (7, None), (8, "")]
    kept = simhash.one_of_each(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "part"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "A b c d"), (7, None)]


def test_one_of_each_with_a_map_column(spark):
    docs = spark.createDataFrame([(1, "a b c", {"x": 1}), (1, "a b c", {"x": 1}), (2, "A b c", None)], "doc_id long, text string, row map<string,int>")
    assert [tuple(r) for r in simhash.one_of_each(docs).collect()] == [(1, "a b c", {"x": 1})]


def test_empty_table(spark):
    empty = frame(spark, [])
    assert simhash.near_duplicates(empty).count() == simhash.one_of_each(empty).count() == 0


def test_one_of_each_of_groups_without_ids(spark):
    rows = [(None, "a b c d")] * 5 + [(None, "A b c d")] * 3 + [(None, "other words of this text")]
    kept = simhash.one_of_each(frame(spark, rows).repartition(3))
    assert sorted(r.text for r in kept.collect()) == ["A b c d", "other words of this text"]


def test_one_of_each_of_groups_that_share_an_id(spark):
    rows = [(1, "a b c d"), (1, "A b c d"), (1, "other words of this text"), (2, "other words of this TEXT")]
    kept = simhash.one_of_each(frame(spark, rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "A b c d"), (1, "other words of this text")]


def test_one_of_each_equals_brute_force(spark):
    rows = corpus() + [(None, t) for _, t in corpus()[:20]]
    groups = {}
    labels = component_labels([t for _, t in rows])
    for (doc_id, text), k in zip(rows, labels):
        groups.setdefault(k, []).append((doc_id is None, doc_id or 0, text is not None, text or "", doc_id, text))
    kept = simhash.one_of_each(frame(spark, rows).repartition(4)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted((min(g)[4:] for g in groups.values()), key=str)


def component_labels(texts, radius=2):
    prints = [print_of(t) for t in texts]
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if label[j] < label[i] and (a ^ b).bit_count() <= radius:
                    label[i], changed = label[j], True
    return label


def test_a_crowded_cell_is_compared_in_several_tasks(spark):
    """Twenty tiles of one cell: 210 pairs of tiles, dealt out by tile."""
    tiles = spark.createDataFrame([(5, k, [k]) for k in range(20)], "cell int, part long, fps array<long>")
    parts = spark.createDataFrame([(5, 20)], "cell int, parts long")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        pairs = simhash.tile_pairs(tiles, parts, 2).select("fps", "others", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted((r.fps[0], r.others[0]) for r in pairs) == [(a, b) for a in range(20) for b in range(a, 20)]
    assert len({r.task for r in pairs}) == 4  # all that the session has
