import hashlib
import itertools
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from starload.llm import chat
from starload.llm.common import table

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "conv_id long, turn int, role string, text string, state string, line int"


@pytest.fixture(scope="module")
def pieces(spark):
    return chat.transcribed(table(spark, DATA, "conversations"))


@pytest.fixture(scope="module")
def model(pieces):
    return chat.learned(pieces)


def test_viterbi_equals_the_best_of_all_paths(model):
    rng = np.random.default_rng(3)
    for n in (1, 2, 4):
        scores, into, out = rng.standard_normal((n, 6)) * 4, rng.standard_normal(6), rng.standard_normal(6)

        def total(path, into, out):
            start = model.start[path[0]] if into is None else max(into[s] + model.steps[s, path[0]] for s in range(6))
            steps = sum(model.steps[a, b] for a, b in zip(path, path[1:]))
            return start + steps + sum(scores[t, s] for t, s in enumerate(path)) + (0 if out is None else out[path[-1]])

        for a, b in [(None, None), (into, None), (None, out), (into, out)]:
            best = max(itertools.product(range(6), repeat=n), key=lambda p: total(p, a, b))
            assert total(tuple(chat.viterbi(scores, model, a, b)), a, b) == pytest.approx(total(best, a, b))


def plain_turns(texts, model):
    """One run of Viterbi over a whole transcript, in plain Python."""
    lines = [(k, at, line, parts) for k, t in enumerate(texts) for parts in [(t or "").split("\n")] for at, line in enumerate(parts)]
    seen = {name: [] for name in chat.SHOWN}
    for _, at, line, parts in lines:
        word = re.match("(?i)" + chat.MARKER, line)
        role = next((k for k, r in enumerate(chat.ROLES, 1) if word and word[1].lower() in chat.SPEAKERS[r]), 0)
        seen["marker"].append(role)
        seen["blank"].append(int(at > 0 and parts[at - 1].strip(" ") == ""))
        seen["size"].append(sum(len(line) > n for n in (0, 20, 60, 150, 400)))
        seen["asks"].append(int(line.rstrip(" ").endswith("?")))
    states = chat.viterbi(model.scores({n: np.array(v) for n, v in seen.items()}), model)
    out = []
    for (_, _, line, _), s in zip(lines, states):
        role, begins = chat.STATES[s]
        if begins or not out:
            out.append([role, [re.sub("(?i)" + chat.MARKER, "", line) if begins else line]])
        else:
            out[-1][1].append(line)
    return [(k, role, len(ls), f"<|{role}|>\n{'\n'.join(ls).strip()}\n<|end|>") for k, (role, ls) in enumerate(out)]


def parsed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.conv_id), r.turn)):
        out.setdefault(r.conv_id, []).append((r.turn, r.role, r.n_lines, r.rendered))
    return out


def test_roles_are_recovered(spark, pieces, model):
    found = parsed(chat.parse(pieces, model))
    truth = {}
    for r in sorted(pieces.where(chat.held_out()).collect(), key=lambda r: (r.conv_id, r.turn)):
        truth.setdefault(r.conv_id, []).append(r.role)
    assert len(truth) > 10
    right = sum([role for _, role, _, _ in found[c]] == roles for c, roles in truth.items())
    assert right / len(truth) > 0.9
    assert found.keys() == {r.conv_id for r in pieces.select("conv_id").distinct().collect()}


@pytest.mark.parametrize("size, fan", [(4096, 64), (8, 3), (2, 2)])
def test_blocks_do_not_matter(spark, model, monkeypatch, size, fan):
    monkeypatch.setattr(chat, "LINES", size)
    monkeypatch.setattr(chat, "FAN", fan)
    rng = random.Random(size)
    rows, want = [], {}
    for conv in range(6):
        texts = []
        for turn in range(rng.choice([1, 4, 30]) if conv else 45):
            marker = rng.choice(["User: ", "Assistant: ", "\n", "\n\n", "### System: ", "", "Q : ", "<|assistant|>"])
            texts.append(marker + "\n".join(rng.choice(["why is that?", "no " * 30, "", "ok"]) for _ in range(rng.randrange(1, 4))))
        start = -20 if conv == 3 else 0
        rows += [(conv, start + k, None, t, "x", 1) for k, t in enumerate(texts)]
        want[conv] = plain_turns(texts, model)
    rng.shuffle(rows)
    assert parsed(chat.parse(spark.createDataFrame(rows, SCHEMA).repartition(3), model)) == want


def test_odd_rows(spark, model):
    rows = [(1, 0, "user", "User: hi\nthere?", "s", 0)] * 3 + [(1, 1, None, None, "s", 0), (2, 0, None, "", "s", 0)]
    rows += [(None, 0, None, "User: a", "s", 0), (None, 0, None, "User: b", "s", 0), (3, None, None, "Human: x", "s", 0)]
    rows += [(4, 0, None, "User: " + "word " * 40_000, "s", 0)]
    found = chat.parse(spark.createDataFrame(rows, SCHEMA), model).collect()
    by = {}
    for r in found:
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    assert by[1][0] == ("user", "hi\nthere?") and by[2][0][1] == ""
    assert sorted(by[None]) == [("user", "a"), ("user", "b")] and by[3] == [("user", "x")]
    assert len(by[4][0][1]) == 5 * 40_000 - 1


def test_empty_table(spark, model):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.parse(chat.transcribed(empty), chat.empty_model(spark)).count() == 0


def test_turns_that_differ_in_role_only(spark, model):
    rows = [(1, 0, role, "\nsame", "s", 0) for role in ("user", "assistant", None)] * 2
    rows += [(None, 0, role, "User: a", "s", 0) for role in ("user", "assistant")]
    found = chat.parse(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert sum(r.n_lines for r in found if r.conv_id == 1) == 6
    assert [(r.role, r.text) for r in found if r.conv_id is None] == [("user", "a")] * 2


def test_rows_that_share_a_turn_number_are_spread(spark, model, monkeypatch):
    """All rows of the table are one conversation and one turn; they follow each other by digest."""
    monkeypatch.setattr(chat, "LINES", 32)
    monkeypatch.setattr(chat, "CROWD", 64)
    rng = random.Random(9)
    marks = ["User: ", "Assistant: ", "\n", "", "Q : "]
    texts = {rng.choice(marks) + f"row {k}\n" + rng.choice(["why?", "no " * 30, "ok"]) for k in range(2500)}
    rows = [(1, 7, "user", t, "x", 1) for t in texts]
    pieces = spark.createDataFrame(rows, SCHEMA).repartition(4)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        labelled = chat.label(chat.lines_of(pieces), model)
        tasks = labelled.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 3500
    assert labelled.groupBy("block").count().agg(F.max("count")).first()[0] <= 32
    ordered = sorted(texts, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert parsed(chat.parse(pieces, model)) == {1: plain_turns(ordered, model)}
    assert chat.fit(chat.lines_of(pieces)).steps.shape == model.steps.shape
