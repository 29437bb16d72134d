"""Secrets in texts: all rules as one automaton, all texts of a slice in one pass over their bytes.

The base kinds are assign (a credential word with a value), access (an access key id) and hex (a long run of hex
digits); github, slack and jwt are added to them. Matches of a kind are leftmost, greedy and do not overlap; one that
is too short is dropped but still consumed.

Defined results: a null text is an empty one and has no spans; positions are code points, ends exclusive; spans are
ordered by start, then by kind as listed; a very long text is scanned whole, in memory that grows with its length; rows
are kept as often as they come; an empty table gives an empty result; columns that are not to be kept are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm import automaton
from starload.llm.automaton import Rule, alt, literal, one_of, optional, plus, seq, span, star

DIGITS, LOWER, UPPER = span("09"), span("az"), span("AZ")
ALNUM = UPPER + LOWER + DIGITS
QUOTE, BLANK = optional(one_of(b"\"'")), star(one_of(b" "))

# Words that introduce a credential, and the value's characters.
WORDS = alt(
    *[literal(w, any_case=True) for w in ("password", "passwd", "secret", "token")],
    seq(literal("api", any_case=True), optional(literal("_")), literal("key", any_case=True)),
)
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", seq(WORDS, QUOTE, BLANK, one_of(b":="), BLANK, QUOTE), ALNUM + b"+/_.=-", least=6),
    Rule("access", literal("AKIA"), UPPER + DIGITS, shortest=20),
    Rule("hex", seq(), DIGITS + span("af"), least=24),
    Rule("github", seq(literal("gh"), one_of(b"pousr"), literal("_")), ALNUM, shortest=40),
    Rule("slack", seq(literal("xox"), one_of(b"abprs"), literal("-")), ALNUM + b"-", shortest=20),
    Rule(
        "jwt",
        seq(literal("eyJ"), plus(one_of(ALNUM + b"_-")), literal(".eyJ"), plus(one_of(ALNUM + b"_-")), literal(".")),
        ALNUM + b"_-",
        shortest=40,
    ),
)

SLICE = 1 << 22  # bytes scanned at a time, or one longer text
SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))


def spans_of(texts: list[bytes], machine: automaton.Automaton) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) in code points of every match of each text."""
    found: list[list] = [[] for _ in texts]
    data = b"".join(t + bytes([automaton.SEPARATOR]) for t in texts)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    by_text: dict[int, list] = {}
    for rule, start, end in machine.matches(data):
        by_text.setdefault(int(np.searchsorted(starts, start, "right")) - 1, []).append((rule, start, end))
    for k, matches in by_text.items():
        raw = np.frombuffer(texts[k], np.uint8)
        points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        at = starts[k]
        ordered = sorted((int(points[start - at]), rule, int(points[end - at])) for rule, start, end in matches)
        found[k] = [(machine.rules[rule].name, start, end) for start, rule, end in ordered]
    return found


def scan(docs: DataFrame, keep: list[str], rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The kept columns with spans: array of (kind, start, end)."""
    machine = docs.sparkSession.sparkContext.broadcast(automaton.build(rules))  # as large as the rules make it
    picked = docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"])
    schema = T.StructType(picked.schema.fields[:-1]).add("spans", SPANS)
    names = schema.names
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def slices(texts: pa.Array) -> Iterator[list[bytes]]:
        group, held = [], 0
        for value in texts:
            group.append(value.as_py() or b"")
            held += len(group[-1])
            if held >= SLICE:
                yield group
                group, held = [], 0
        yield group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for group in slices(batch.column(batch.num_columns - 1).cast(pa.binary())):
                found += spans_of(group, machine.value)
            rows = [[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in found]
            yield pa.record_batch([*batch.columns[:-1], pa.array(rows, kind)], names)

    return picked.mapInArrow(run, schema)


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def joined(spans: Column) -> Column:
    """kind:start:end of the spans, with commas between them."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _oracle() -> str:
    """Pieces between matches and the matches themselves give the positions."""
    patterns = {  # the rules once more, as regular expressions
        "assign": r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        "access": r"AKIA[A-Z0-9]+",
        "hex": r"[0-9a-f]+",
        "github": r"gh[pousr]_[A-Za-z0-9]+",
        "slack": r"xox[abprs]-[A-Za-z0-9-]+",
        "jwt": r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
    }
    passes = {
        "assign": r"regexp_matches(m, '[:=]\x20*[\"'']?[A-Za-z0-9+/_.=-]{6,}$')",
        "access": "length(m) >= 20",
        "hex": "length(m) >= 24",
        "github": "length(m) >= 40",
        "slack": "length(m) >= 20",
        "jwt": "length(m) >= 40",
    }
    kinds = []
    for k, (kind, pattern) in enumerate(patterns.items()):
        quoted = pattern.replace("'", "''")
        kinds.append(
            f"SELECT doc_id, {k} AS k, '{kind}' AS kind, regexp_extract_all(t, '{quoted}') AS ms,"
            f" regexp_split_to_array(t, '{quoted}') AS gaps FROM texts"
        )
    test = " ".join(f"WHEN '{kind}' THEN {t}" for kind, t in passes.items())
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(kinds)}),
each AS (
  SELECT doc_id, k, kind, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, unnest(range(1, len(ms) + 1)) AS pos
  FROM found WHERE len(ms) > 0
),
placed AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY pos) AS stop FROM each
),
spans AS (
  SELECT doc_id, k, kind, (stop - length(m))::BIGINT AS start, stop::BIGINT AS stop FROM placed
  WHERE CASE kind {test} END
),
texted AS (SELECT *, kind || ':' || start || ':' || stop AS s FROM spans)
SELECT texts.doc_id,
       count(*) FILTER (WHERE kind = 'assign') AS n_assign,
       count(*) FILTER (WHERE kind = 'access') AS n_access,
       count(*) FILTER (WHERE kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(s, ',' ORDER BY start, k) FILTER (WHERE k < 3), '')) AS base_sha256,
       coalesce(string_agg(s, ',' ORDER BY start, k), '') AS spans
FROM texts LEFT JOIN texted ON texts.doc_id = texted.doc_id GROUP BY texts.doc_id
"""


ORACLE = _oracle()
