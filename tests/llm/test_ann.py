import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm import ann

SCHEMA = "vec_id long, embedding array<float>, cell string, ids int"


def brute(rows, asked, k=10):
    best = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        best[i] = min(best.get(i, tuple(v)), tuple(v))
    lengths = [len(v) for v in best.values()]
    usual = min(set(lengths), key=lambda n: (-lengths.count(n), n), default=0)
    best = {i: np.array(v, np.float64) for i, v in best.items() if len(v) == usual}
    out = {}
    for q in best:
        if asked(q):
            near = sorted((float(np.sqrt(((best[q] - v) ** 2).sum())), i) for i, v in best.items() if i != q)
            out[q] = near[:k]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def frame(spark, rows):
    f32 = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v], "c", 1) for i, v in rows]
    return spark.createDataFrame(f32, SCHEMA), [(i, v) for i, v, _, _ in f32]


def unit(n, d=16, seed=0):
    x = np.random.default_rng(seed).standard_normal((n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).tolist()


def test_recall_and_exact_scores(spark):
    vectors = unit(3000, 64)
    df, rows = frame(spark, list(enumerate(vectors)))
    found, want = got(ann.search(df.repartition(4), F.col("vec_id") % 100 == 0)), brute(rows, lambda q: q % 100 == 0)
    assert found.keys() == want.keys() and all(len(x) == 10 for x in found.values())
    by_id = {i: np.array(v) for i, v in rows}
    hits = 0
    for q, near in found.items():
        assert near == sorted(near)
        for score, i in near:
            assert score == pytest.approx(float(np.sqrt(((by_id[q] - by_id[i]) ** 2).sum())), rel=1e-12)
        hits += len({i for _, i in near} & {i for _, i in want[q]})
    assert hits >= 0.9 * 10 * len(want)


def test_copies_and_rows_that_take_no_part(spark):
    vectors = unit(40)
    rows = list(enumerate(vectors)) + [(100 + k, vectors[3]) for k in range(60)] + [(200, vectors[5]), (200, vectors[5])]
    rows += [(300, vectors[7]), (300, vectors[8]), (None, vectors[1]), (301, None), (302, []), (303, [0.0] * 16)]
    rows += [(304, [None] + vectors[0][1:]), (305, [float("nan")] + vectors[0][1:]), (400, [float("inf")] * 16), (500, [1.0, 2.0])]
    df, plain = frame(spark, rows)
    asked = lambda q: q % 50 == 0
    found, want = got(ann.search(df, F.col("vec_id") % 50 == 0, probes=4000)), brute(plain, asked)
    assert found.keys() == want.keys()
    for q in want:
        assert [i for _, i in found[q]] == [i for _, i in want[q]]
        assert [s for s, _ in found[q]] == pytest.approx([s for s, _ in want[q]], abs=1e-12)


def test_few_rows_are_all_found(spark):
    far = [[float(10**k), 1.0] for k in range(6)]
    df, rows = frame(spark, list(enumerate(far)))
    found = got(ann.search(df, F.col("vec_id") % 2 == 0, probes=1))
    assert {q: [i for _, i in near] for q, near in found.items()} == {
        q: [i for _, i in near] for q, near in brute(rows, lambda q: q % 2 == 0).items()
    }


def test_candidates_come_back_from_their_packing():
    for places in ([0], [5], [3, 900], range(1000), [*range(0, 70_000, 7), 70_001], [1, 70_000]):
        held = np.zeros(80_000, bool)
        ann.mark(ann.pack(np.array(places)), held)
        assert np.flatnonzero(held).tolist() == list(places)
    assert [ann.pack(np.array(p))[:1] for p in ([3, 900], range(1000), [1, 70_000])] == [b"s", b"b", b"l"]


def test_crowded_cells_are_dealt_to_blocks(spark, monkeypatch):
    for name, value in [("BLOCK", 8), ("MOST_HELD", 3), ("MOST_PAIRS", 50), ("VECTORS", 16), ("QUERIES", 3)]:
        monkeypatch.setattr(ann, name, value)
    close = (np.array(unit(300, 8)) * 1e-3 + 1).tolist() + unit(50, 8, 3)
    df, rows = frame(spark, list(enumerate(close)))
    found = got(ann.search(df, F.col("vec_id") % 10 == 0, probes=4000))
    want = brute(rows, lambda q: q % 10 == 0)
    assert found.keys() == want.keys()
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)


def test_template_is_in_order_and_complete():
    m = 3
    found = ann.template(m, 1000)
    valid = [s for n in range(m + 1) for s in itertools.combinations(range(2 * m), n) if not any(2 * m - 1 - r in s for r in s)]
    assert sorted(found) == sorted(valid)


def test_nothing(spark):
    df, _ = frame(spark, [(303, [0.0] * 4), (1, None)])
    assert ann.search(df, F.col("vec_id") > 0).count() == 0
    one, _ = frame(spark, [(100, [1.0, 2.0])])
    assert ann.search(one, F.col("vec_id") % 100 == 0).count() == 0


def test_where_candidates_are_many_none_is_sent_and_the_same_are_found(spark, monkeypatch):
    monkeypatch.setattr(ann, "VECTORS", 16)
    monkeypatch.setattr(ann, "QUERIES", 1)
    rows = [*enumerate(unit(700, 8)), *((1000 + k, v) for k, v in enumerate(unit(5, 8)))]
    df, _ = frame(spark, rows)
    search = lambda: got(ann.search(df.repartition(4), F.col("vec_id") % 20 == 0, probes=3))
    sent, candidates = [], ann._candidates
    monkeypatch.setattr(ann, "_candidates", lambda pairs: sent.append(1) or candidates(pairs))
    met = search()
    assert not sent and len(met) == 36
    monkeypatch.setattr(ann, "DENSE", 2)
    assert search() == met and sent


@pytest.mark.parametrize("at, spread", [(0, 1), (1e6, 1e-3), (0, 1e160), (1e8, 0)])
def test_none_that_can_be_near_is_taken_for_far(at, spread):
    rng = np.random.default_rng(0)
    vectors, queries = (at + spread * rng.standard_normal((n, 6)) for n in (400, 5))
    held = rng.random((400, 5)) < 0.5
    held[:, 4] = np.arange(400) < 3
    with np.errstate(all="ignore"):
        exact = np.sqrt(((vectors[:, None] - queries) ** 2).sum(axis=2))
        nearest = [sorted((d, i) for i, d in enumerate(exact[:, q]) if held[i, q])[:10] for q in range(5)]
        for worst in (np.full(5, np.inf), np.array([near[-1][0] for near in nearest])):
            query, place = ann.near_ones(queries, vectors, (vectors**2).sum(axis=1), held, worst, 10)
            assert held[place, query].all() and sorted(query) == list(query)
            for q, near in enumerate(nearest):
                assert sorted((exact[i, q], i) for i in place[query == q])[:10] == near


def test_a_block_tells_who_shares_a_cell():
    vectors = np.array(unit(300, 8))
    hasher = ann.Hasher(vectors, 4, 5, 1.0, 20, 1)
    cells, visits = hasher.cells(vectors), hasher.visits(vectors[:64])
    want = [[any(np.isin(cells[i, t], visits[q, t]) for t in range(4)) for q in range(64)] for i in range(300)]
    for n in (1, 9, 64):
        found = ann.unpacked(ann.Cells(cells).sharing(visits[:n]), n)
        assert found.tolist() == [row[:n] for row in want]
    assert hasher.share(vectors) == np.mean(want)
