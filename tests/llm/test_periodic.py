import hashlib
import random
import zlib

import numpy as np
import pytest

from starload.llm import periodic, registry
from starload.llm.common import BLANKS

SCHEMA = "doc_id long, text string, runs string, at int"


def split(text):
    for c in BLANKS:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(words, least=6, power=4):
    """(start, length, period) of all runs."""
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, power * q):
                found.setdefault((start, length), q)  # the smallest period comes first
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def best(runs):
    from fractions import Fraction

    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def random_words(pick):
    """Runs of many kinds, one beside and inside another."""
    words = []
    for _ in range(pick.randint(1, 5)):
        letters = "ab" if pick.random() < 0.5 else "abcdefgh"
        root = [pick.choice(letters) for _ in range(pick.randint(1, 7))]
        if pick.random() < 0.3:
            root = root * pick.randint(1, 6) + [pick.choice("abx")]
        words += root * pick.choice([0, 1, 2, 3, 4, 5, 9, 20])
        words += [pick.choice(letters) for _ in range(pick.randint(0, 6))]
    return words


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "a a a a a",
    "a a a a a a",
    "A a a a a a a",
    "a b a b a b a b",
    "a b a b a b a",
    "a\nb\ta\x0bb a\x0cb\ra b a",
    "a\xa0b " * 9,
    "a\x1cb\x85 " * 9,
    "x " + "a " * 7 + "b " * 6,
    "a b c " * 4 + "d " + "a b c " * 5,
    "é ü " * 400 + "z " + "é " * 300,
    "a " * 20000,
    " ".join(fibonacci(3000)),
    " ".join("ab"[bin(i).count("1") % 2] for i in range(5000)),
    " ".join("ab"[bin(i).count("1") % 2] for i in range(64)) * 5,
    " ".join(f"w{i % 700}" for i in range(4000)),
    " ".join(f"w{i}" for i in range(3000)),
    ("a " * 5 + "b ") * 60,
    (("a " * 6 + "b ") * 5 + "c ") * 30,
]


def check(spark, texts, **more):
    rows = [(k, t, "r", 1) for k, t in enumerate(texts)]
    found = periodic.runs(spark.createDataFrame(rows, SCHEMA).repartition(3), ["doc_id", "at"], **more)
    assert found.columns == ["doc_id", "at", "runs", "best", "collapsed"]
    got = {r.doc_id: r for r in found.collect()}
    for k, text in enumerate(texts):
        words = split(text or "")
        expected = brute(words, **more)
        assert [tuple(r) for r in got[k].runs] == expected
        assert got[k].best is None and not expected or tuple(got[k].best) == best(expected)
        assert got[k].collapsed == collapsed(words, expected)


def test_equals_brute_force(spark):
    check(spark, TEXTS)


def test_random_words_equal_brute_force(spark):
    pick = random.Random(11)
    check(spark, [" ".join(random_words(pick)) for _ in range(1500)])
    check(spark, [" ".join(random_words(pick)) for _ in range(200)], least=9, power=5)


def test_pieces_of_work_of_any_size(monkeypatch):
    pick = random.Random(3)
    texts = [" ".join(random_words(pick)).encode() for _ in range(100)]
    whole = periodic._of_group(texts, 6, 4)
    monkeypatch.setattr(periodic, "AT_ONCE", 7)
    small = periodic._of_group(texts, 6, 4)
    assert [a.to_pylist() for a in whole] == [a.to_pylist() for a in small]
    apart = [periodic._of_group([t], 6, 4) for t in texts]
    for k, array in enumerate(whole):
        assert array.to_pylist() == [x for a in apart for x in a[k].to_pylist()]


def test_grammar_derives_the_words():
    pick = random.Random(4)
    texts = [random_words(pick) for _ in range(60)]
    names = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
    numbers = np.array([names[w] for t in texts for w in t])
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    found = periodic.grammar(numbers, text)

    def derived(symbol):
        if symbol < found.terminals:
            return [symbol]
        rule = symbol - found.terminals
        return derived(found.left[rule]) + derived(found.right[rule])

    words = [w for root in found.roots for w in derived(root)]
    assert words == numbers.tolist() and len(found.roots) == sum(map(bool, texts))
    for rule, (at, size) in enumerate(zip(found.at, found.size)):
        assert derived(rule + found.terminals) == numbers[at : at + size].tolist()


def test_repeats_become_few_rules():
    """A text of one word over and over has rules in proportion to the logarithm of its length."""
    found = periodic.grammar(np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64))
    assert len(found.size) == 16
    assert periodic.find(np.zeros(1 << 20, np.int64), np.zeros(1 << 20, np.int64)).tolist() == [[0], [1 << 20], [1]]


def test_hashes_that_collide_are_noticed(monkeypatch):
    numbers = np.array([0, 1, 0, 2, 0, 3, 0, 4, 0, 5] * 3)
    monkeypatch.setattr(periodic.Prefixes, "equal", lambda self, i, q, n: np.ones(len(i), bool))
    with pytest.raises(RuntimeError):
        periodic.find(numbers, np.zeros(len(numbers), np.int64))
    with pytest.raises(ValueError):
        periodic.find(numbers, np.zeros(len(numbers), np.int64), power=3)


def expected_row(doc_id, text):
    words = split(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    top = best(runs)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    figures = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *figures, digest(listed), digest(collapsed(words, runs)))


def test_query(spark, tmp_path):
    pick = random.Random(8)
    rows = [(k, pick.choice([None, "", " ".join(random_words(pick)), " ".join(f"w{i}" for i in range(400))])) for k in range(300)]
    rows += [(7, "a " * 9), (7, "a " * 9), (None, "b " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = registry.op13_periodic_runs(spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == names and [t for _, t in found.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected_row(*r) for r in rows), key=str)


def test_empty_table(spark):
    assert periodic.runs(spark.createDataFrame([], SCHEMA), ["doc_id"]).count() == 0
