import hashlib
from collections import defaultdict

from starload.llm import linededup

SCHEMA = "doc_id long, text string, key string, digest string, row long"


def brute(rows, in_documents, key_length=1):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(doc_id)
    gone = {k for k, ids in held.items() if len(ids) >= in_documents and len(k) >= key_length}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows_with_cases():
    rows = [(k, f"Start {k}\n  COMMON line\t\nown {k}\ncommon LINE\n\n") for k in range(12)]
    rows += [(100, None), (101, ""), (102, "\n"), (103, "É common"), (104, "é common"), (105, "common line")]
    rows += [(0, rows[0][1]), (0, rows[0][1]), (None, "common line\nx"), (None, "Common Line")]
    rows += [(200, "\n".join(f"l{i % 50}\ncommon line" for i in range(3000)))]
    return rows + [(300 + k, "seen\nby nine") for k in range(9)] + [(300, "by nine"), (320 + 1, "é common\r\x1c")]


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "k", "d", 1) for d, t in rows], SCHEMA)


def test_equals_brute_force(spark):
    rows = rows_with_cases()
    for least, length in [(10, 1), (2, 1), (2, 5), (1, 1)]:
        found = linededup.dedupe_lines(frame(spark, rows).repartition(5), least, length)
        assert found.columns == ["doc_id", "text", "key", "digest", "row", "n_lines", "n_dropped"]
        assert got(found) == brute(rows, least, length)


def test_key_is_ascii_only():
    assert linededup.line_key(" \x0b ÉA\xa0".encode()) == "Éa\xa0".encode()


def test_stage_keeps_columns_and_nulls(spark):
    rows = rows_with_cases()
    found = linededup.deduped_text(frame(spark, rows))
    assert found.columns == ["doc_id", "text", "key", "digest", "row"]
    kept = {r.doc_id: r.text for r in found.collect()}
    assert kept[100] is None and kept[105] == "" and kept[3] == "Start 3\nown 3\n\n"


def test_empty_table(spark):
    assert linededup.dedupe_lines(frame(spark, [])).count() == linededup.deduped_text(frame(spark, [])).count() == 0


def test_digest_of_kept_text(spark):
    from pyspark.sql import functions as F

    text = linededup.dedupe_lines(frame(spark, [(1, "é\nb")])).select(F.sha2("text", 256)).first()[0]
    assert text == hashlib.sha256("é\nb".encode()).hexdigest()


def test_columns_named_like_the_figures(spark):
    docs = spark.createDataFrame([(1, "a\nb", 7)], "doc_id long, text string, n_lines long")
    assert [tuple(r) for r in linededup.deduped_text(docs, 1).collect()] == [(1, "", 7)]
    assert [tuple(r) for r in linededup.dedupe_lines(docs).collect()] == [(1, "a\nb", 7, 2, 0)]
