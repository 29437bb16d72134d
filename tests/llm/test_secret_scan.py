import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starload.llm import automaton, secret_scan

PATTERNS = {
    "assign": r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "github": r"gh[pousr]_[A-Za-z0-9]+",
    "slack": r"xox[abprs]-[A-Za-z0-9-]+",
    "jwt": r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
}
LONGEST = {"access": 20, "hex": 24, "github": 40, "slack": 20, "jwt": 40}


def brute(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m[1]) >= 6 if kind == "assign" else len(m[0]) >= LONGEST[kind]:
                found.append((m.start(), k, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


@pytest.fixture(scope="module")
def machine():
    return automaton.build(secret_scan.RULES)


parts = st.sampled_from(
    "password passWD secret token api_key APIkey AKIA ghp_ xoxb- eyJ . .eyJ : = \" ' a f 0 9 é \n _ - T zz "
    "0123456789abcdef01234567 ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789ABCDEFGHIJ abcdef pass tok".split(" ") + [" "]
)


@settings(max_examples=600, deadline=None)
@given(texts=st.lists(st.lists(parts, max_size=14).map("".join), max_size=4))
def test_spans_equal_regular_expressions(machine, texts):
    assert secret_scan.spans_of([t.encode() for t in texts], machine) == [brute(t) for t in texts]


@pytest.mark.parametrize("lane", [2, 7, 64])
def test_lanes_do_not_matter(machine, monkeypatch, lane):
    monkeypatch.setattr(automaton, "LANE", lane)
    rng = random.Random(lane)
    parts = ["AKIA", "A" * 300, "f" * 90, "token=", " ", "é", "password : ", "x", "eyJabc.eyJdef.ghijklmnopqrstuvwxyzabcdefghijkl"]
    texts = ["".join(rng.choice(parts) for _ in range(30)) for _ in range(20)]
    assert secret_scan.spans_of([t.encode() for t in texts], machine) == [brute(t) for t in texts]


def test_states_equal_a_plain_run(machine):
    rng = np.random.default_rng(1)
    data = rng.choice(np.frombuffer(b"AKIAtoken=: 0f\xff", np.uint8), 3000)
    state, plain = 0, []
    for b in data:
        state = machine.table[state * machine.classes + machine.class_of[b]] // machine.classes
        plain.append(state)
    assert machine.states(data).tolist() == plain


def test_automaton_is_minimal(machine):
    rows = machine.table.reshape(-1, machine.classes)
    keys = {(*r, c, p) for r, c, p in zip(rows.tolist() and map(tuple, rows.tolist()), machine.consumed, machine.reported)}
    assert len(keys) == len(rows)


def test_documents(spark):
    texts = ["token = abc123def", None, "", "é PASSWORD='secret=abcdef'", "x" * 100_000 + "AKIA" + "Z" * 16, "token=token =abcdef"]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(0, texts[0], "s"), (None, texts[3], "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = secret_scan.scan(docs.repartition(3), ["doc_id"]).collect()
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in found), key=str)
    assert got == sorted(((i, brute(t or "")) for i, t, _ in rows), key=str)
    assert secret_scan.scan(docs.limit(0), ["doc_id"]).count() == 0
