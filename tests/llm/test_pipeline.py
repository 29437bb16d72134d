"""The pipeline on a small fixture, stage by stage and as a whole, against the operators' brute-force versions."""

import random

from test_bpe import brute as encode_brute
from test_linededup import brute as lines_brute
from test_mixing import brute as mixing_brute
from test_mixing import cell
from test_quality import brute as quality_brute
from test_simhash import brute as simhash_brute

import corpus_pipeline
from starload.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(21)
    fresh = lambda n: " ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) + str(rng.randrange(3000)) for _ in range(n))
    rows = []
    for k in range(150):
        text = "\n".join(fresh(30) for _ in range(4))
        if k % 5 == 0:
            text += "\nCommon footer line"
        if k % 11 == 0:
            text += "\n  spread OVER hosts"
        if k % 30 == 1:
            text = fresh(20)
        if k % 30 == 2:
            text = "again and again " * 60
        rows.append((k, text, rng.choice(["en", "fr"]), ["hot", "hot", "a", "b"][k % 4]))
        if k % 10 == 3:
            rows += [(1000 + k, text, "en", "a"), (2000 + k, text.replace(" ", "  "), "en", "b")]
    return rows + [(3000, None, "en", "a"), (3001, "", None, None)]


def expected(rows):
    judged = quality_brute([(i, t, s) for i, t, _, s in rows], 10)
    texts = {w[0]: w[-1] for w in judged if w[-2]}
    rows = [(i, texts[i], lang, s) for i, _, lang, s in rows if i in texts]
    yield rows
    texts = {i: kept for i, _, _, kept in lines_brute([(i, t) for i, t, _, _ in rows], 10)}
    rows = [(i, texts[i], lang, s) for i, _, lang, s in rows]
    yield rows
    least = {i for i, _, component in simhash_brute([(i, t) for i, t, _, _ in rows]) if i == component}
    rows = [r for r in rows if r[0] in least]
    yield rows
    rates, _, _ = mixing_brute(rows, mixing.BUDGET)
    rows = [r for r in rows if cell(r)[2] < rates[cell(r)[0]]]
    yield rows
    yield [(i, lang, s, *encode_brute(t)[:1]) for i, t, lang, s in rows]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows], SCHEMA)


def test_each_stage_on_what_the_last_one_kept(spark, tmp_path):
    rows = corpus()
    (tmp_path / "sf").mkdir()
    frame(spark, rows).write.parquet(str(tmp_path / "sf/documents.parquet"))
    docs = frame(spark, rows).repartition(4)
    *stages, last = expected(rows)
    for (_, stage), want in zip(corpus_pipeline.STAGES, stages):
        docs = stage(spark, docs, str(tmp_path / "sf"))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(docs.collect()) == sorted((*w, len(w[1])) for w in want)
    assert len(stages[0]) < len(rows) and len(stages[2]) < len(stages[1]) and len(stages[3]) < len(stages[2])
    assert stages[1] != stages[0]
    found = corpus_pipeline.run(spark, str(tmp_path / "sf")).collect()
    got = sorted(((r.doc_id, r.lang, r.source, bytes(r.ids)) for r in found), key=str)
    assert got == sorted(last, key=str) and all(r.n_tokens == len(r.ids) // 4 for r in found)


def test_odd_rows(spark):
    """Extra columns, ids that several texts share, null ids, very long texts."""
    rng = random.Random(2)
    fresh = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))
    long, other, shared = fresh(40_000), fresh(80), fresh(90)
    rows = [(1, long, "en", "a"), (1, other, "en", "a"), (2, shared, "en", "a"), (2, shared, "en", "b"), (None, shared, "en", "a")]
    rows += [(None, fresh(60), None, None), (None, None, None, None)]
    docs = frame(spark, rows)
    extra = docs.withColumns({"row": docs["doc_id"], "key": docs["lang"], "fp": docs["source"], "lines": docs["text"]})
    kept, wider = docs, extra
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        kept, wider = stage(spark, kept, ""), stage(spark, wider, "")
        assert kept.columns == wider.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(kept.collect(), key=str) == sorted(wider.collect(), key=str)
        if k == 2:
            assert sorted((str(r.doc_id), r.n_chars) for r in kept.collect()) == sorted(
                [("1", len(long)), ("1", len(other)), ("2", len(shared)), ("None", len(rows[5][1]))]
            )


def test_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stage_list():
    assert len(corpus_pipeline.STAGES) == 5
