import itertools
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm import langid, registry
from starload.llm.common import table

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "doc_id long, text string, lang string, score string, runs int"


def small(size=3, seed=0):
    rng = np.random.default_rng(seed)
    return langid.Model([f"l{k}" for k in range(size)], np.zeros((langid.TABLE, size)), rng.standard_normal((size, size)), rng.standard_normal(size))


def enumerate_marginals(emitted, model):
    n, size = emitted.shape
    out = np.zeros((n, size))
    for path in itertools.product(range(size), repeat=n):
        score = model.start[path[0]] + sum(emitted[t, y] for t, y in enumerate(path))
        score += sum(model.transitions[a, b] for a, b in zip(path, path[1:]))
        for t, y in enumerate(path):
            out[t, y] += np.exp(score)
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_marginals_equal_sums_over_all_paths(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    model, rng = small(), np.random.default_rng(4)
    lengths = [1, 5, 2, 7, 1, 1, 6]
    emitted = rng.standard_normal((sum(lengths), 3)) * 3
    first = np.zeros(len(emitted), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    got = langid.marginals(emitted, first, model)
    at = 0
    for n in lengths:
        assert got[at : at + n] == pytest.approx(enumerate_marginals(emitted[at : at + n], model))
        at += n


def test_expectations_of_training_windows():
    model, rng = small(2), np.random.default_rng(1)
    emitted = rng.standard_normal((2, 4, 2))
    there = np.array([[True] * 4, [True, True, False, False]])
    single, pairs, first = langid._expected(emitted, there, model.transitions, model.start)
    assert single[0] == pytest.approx(enumerate_marginals(emitted[0], model))
    assert single[1, :2] == pytest.approx(enumerate_marginals(emitted[1, :2], model))
    assert pairs.sum() == pytest.approx(4) and first.sum() == pytest.approx(2)
    assert pairs.sum(axis=1) == pytest.approx(single[0, :3].sum(axis=0) + single[1, 0])


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(table(spark, DATA, "documents"))


def test_held_out_accuracy(spark, model):
    docs = table(spark, DATA, "documents")
    found = registry.op4_langid(spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 and r.lang_pred in [*model.languages, "und"] for r in found)
    tested = [r for r in found if r.held_out]
    assert len(tested) > 150
    assert sum(r.lang_pred == r.lang for r in tested) / len(tested) > 0.97


def test_switched_text_is_labelled_word_by_word(spark, model):
    docs = {r.lang: r.text for r in table(spark, DATA, "documents").where("n_chars between 500 and 900").collect()}
    parts = {lang: langid.words_of(text)[:60] for lang, text in docs.items()}
    assert len(parts) > 2
    a, b = sorted(parts)[:2]
    words = parts[a] + parts[b]
    [(lang, score, runs)] = langid.Labeller(model).label([words])
    assert lang in (a, b) and 0.3 < score < 0.7 and sum(n for _, n in runs) == len(words)
    labels = [x for x, n in runs for _ in range(n)]
    truth = [a] * len(parts[a]) + [b] * len(parts[b])
    assert sum(x == y for x, y in zip(labels, truth)) > 0.95 * len(truth)


def test_lang_and_source_are_no_inputs(spark, model):
    rows = [(1, "the thing that is of", "xx", "s", 0), (2, None, "en", "s", 0), (3, "123 ² Ⅷ _", "en", "s", 0), (None, "", None, "s", 0)]
    rows += [(1, "the thing that is of", "en", "t", 1), (4, "the " * 150_000, "fr", "s", 0), (5, "É" * 3000, "fr", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = langid.identify(docs.repartition(2), model, ["doc_id"]).collect()
    assert len(found) == len(rows)
    named = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert named[2] == named[3] == named[None] == ("und", 0.0)
    assert named[1][0] == "en" and named[4][0] == "en"
    assert len({(r.lang_pred, r.score) for r in found if r.doc_id == 1}) == 1


def test_slices_and_caches_do_not_matter(spark, model, monkeypatch):
    texts = [langid.words_of(r.text) for r in table(spark, DATA, "documents").limit(60).collect()]
    whole = langid.Labeller(model).label(texts)
    monkeypatch.setattr(langid, "MOST_WORDS", 50)
    own = langid.Labeller(model)
    parts = [x for k in range(0, 60, 7) for x in own.label(texts[k : k + 7])]
    for (a, s, runs), (b, t, others) in zip(whole, parts):
        assert a == b and s == pytest.approx(t) and runs == others


def test_nothing_to_learn_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text", None, "s", 0)], SCHEMA)
    model = langid.learn(docs)
    assert [(r.lang_pred, r.score) for r in langid.identify(docs, model, ["doc_id"]).collect()] == [("und", 0.0)]
    assert langid.identify(docs.limit(0), langid.learn(docs.limit(0)), ["doc_id"]).count() == 0


def test_language_of_long_texts_only_is_learned(spark):
    long = "\n".join(f"zorgu blam quiv {n} zorgu" for n in range(langid.LONGEST // 10))
    rows = [(k, "the thing that is of " * 30 + f"a{k}", "en", "s", 0) for k in range(8)]
    rows += [(k, long + f" quiv{k}", "zz", "s", 0) for k in range(100, 108)]
    found = langid.learn(spark.createDataFrame(rows, SCHEMA))
    assert found.languages == ["en", "zz"]
    [(lang, _, _)] = langid.Labeller(found).label([["zorgu", "blam", "quiv"] * 5])
    assert lang == "zz"


def test_run_of_a_long_text_is_bounded():
    words = [f"w{n}" for n in range(5000)]
    for place in (-7, 0, 3, 10**12):
        part = langid.run_of(words, place, 400)
        assert 390 <= len(" ".join(part)) <= 400 and part == words[words.index(part[0]) :][: len(part)]
    assert langid.run_of(words[:9], 5, 400) == words[:9] and langid.run_of([], 5, 400) == []
    assert langid.run_of(["x" * 900], 5, 400) == ["x" * 400]


def test_copies_do_not_push_other_languages_out(spark):
    texts = spark.createDataFrame([(f"copied text number{n}",) for n in range(300)], "text string")
    text = texts.orderBy(F.xxhash64("text")).first().text
    rows = [(None, text, "aa", "s", 0)] * 200 + [(4 * k, f"other words here{k}", "bb", "s", 0) for k in range(20)]
    assert langid.learn(spark.createDataFrame(rows, SCHEMA), sample=2, most_languages=2).languages == ["aa", "bb"]


def test_no_language_is_left_out(spark, monkeypatch):
    """More languages than have a full sample: each has fewer texts, all can be predicted."""
    monkeypatch.setattr(langid, "LANGUAGES", 4)
    rows = [(k, f"{'abcdefghij'[k % 10] * 3} word{k % 10} {'abcdefghij'[k % 10]}x{k}", f"l{k % 10}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs, sample=20)
    assert model.languages == [f"l{k}" for k in range(10)] and len(model.weights) == langid.TABLE >> 2
    found = langid.identify(docs, model, ["doc_id", "lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.95 * len(found)
