"""Quality rules: counts inside each text, and line frequency across the documents of a host.

Counts, all native expressions over whole texts: words are runs of characters other than the six blanks. A text fails
the base rules with fewer than FEWEST_WORDS words, or if more than half of them are in three-word windows that occur
twice or more. Windows are compared by 64-bit hashes: the hashes, with their positions in the low bits, are sorted
inside the row, equal neighbours are repeats. Where different hashes share all bits above the positions, pairs of
whole hash and position are sorted instead, so that equal hashes are always neighbours.

Line frequency: lines are stripped, lower-cased and hashed; for each host (column source) the distinct documents that
hold a line are counted, equal texts as one document, so that a group of copies does not make its own lines frequent.
A line is above the limit if at least LEAST documents of the host hold it, however many the host has. Such lines are
removed, and a document that loses more than half of its characters this way is depleted and rejected.

Defined results: a null text has no words and fails; a null source is the host ''; rows are kept as often as they
come, equal texts of one host get equal verdicts; blank lines are never removed; an empty table gives an empty
result; a text is one row of a task, whose memory grows with its length; further columns, whatever they are called, are
kept by clean() and not looked at by the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import BLANKS, checkpointed, whole_text, words, written

FEWEST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
SYMBOLS = "#*$%&|<>"
LEAST = 10
WINDOW = 3


def _stripped(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def _host(source: str = "source") -> Column:
    return F.coalesce(F.col(source), F.lit(""))


def _repeated(df: DataFrame) -> DataFrame:
    """Column words becomes n_repeat_words: words in windows that occur twice or more, each word once.

    Every array that a lambda looks into is a column of its own, so it is made once for each row.
    """
    window = F.transform("words", lambda w, k: F.xxhash64(w, *[F.get("words", k + n) for n in range(1, WINDOW)]))
    df = df.withColumn("hashes", F.slice(window, F.lit(1), F.greatest(F.lit(0), F.size("words") - (WINDOW - 1))))
    # A power of two above every position: the low bits of a packed hash are the position.
    df = df.withColumn("base", F.pow(F.lit(2.0), F.ceil(F.log2(F.size("hashes") + 1.0))).cast("long")).drop("words")
    packed = F.transform("hashes", lambda h, k: h - F.pmod(h, F.col("base")) + k)
    df = df.withColumn("packed", F.sort_array(packed))

    def full(value: Column) -> Column:
        return F.get("hashes", F.pmod(value, F.col("base")).cast("int"))

    def mixes(value: Column, k: Column) -> Column:
        after = F.get("packed", k + 1)
        return (value - F.pmod(value, F.col("base")) == after - F.pmod(after, F.col("base"))) & (full(value) != full(after))

    df = df.withColumn("mixed", F.size(F.filter("packed", mixes)) > 0)
    pairs = F.sort_array(F.transform("hashes", lambda h, k: F.struct(h.alias("h"), k.cast("long").alias("at"))))
    df = df.withColumn("pairs", F.when(F.col("mixed"), pairs))

    def repeats(value: Column, k: Column) -> Column:
        return (full(value) == full(F.get("packed", k - 1))) | (full(value) == full(F.get("packed", k + 1)))

    def pair_repeats(pair: Column, k: Column) -> Column:
        return (pair["h"] == F.get("pairs", k - 1)["h"]) | (pair["h"] == F.get("pairs", k + 1)["h"])

    positions = F.transform(F.filter("packed", repeats), lambda v: F.pmod(v, F.col("base")))
    whole = F.transform(F.filter("pairs", pair_repeats), lambda p: p["at"])
    positions = F.when(F.col("mixed"), whole).otherwise(positions)
    df = df.withColumn("positions", F.sort_array(positions)).drop("packed", "pairs", "mixed", "hashes", "base")

    def adds(at: Column, k: Column) -> Column:
        """Words that a window covers and the one before it does not."""
        return F.least(F.lit(WINDOW).cast("long"), F.coalesce(at - F.get("positions", k - 1), F.lit(WINDOW).cast("long")))

    total = F.aggregate(F.transform("positions", adds), F.lit(0).cast("long"), lambda a, b: a + b)
    return df.withColumn("n_repeat_words", total).drop("positions")


def profile(docs: DataFrame) -> DataFrame:
    """doc_id, host, digest of the text, the counts, and hash and length of each line (null if blank), in order."""
    df = docs.select("doc_id", _host().alias("host"), whole_text().alias("text"))
    df = df.withColumn("digest", F.unhex(F.md5("text"))).withColumn("text_lines", F.split("text", "\n", -1))
    df = df.withColumn("own_words", words(F.col("text")))
    df = df.withColumn("worded", F.filter("text_lines", lambda x: _stripped(x) != ""))

    def line(x: Column) -> Column:
        stripped = _stripped(x)
        return F.when(stripped != "", F.struct(F.xxhash64(F.lower(stripped)).alias("hash"), F.char_length(stripped).alias("chars")))

    df = df.select(
        "doc_id",
        "host",
        "digest",
        F.size("own_words").cast("long").alias("n_words"),
        F.char_length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        F.transform("text_lines", line).alias("lines"),
        F.col("own_words").alias("words"),
    )
    return _repeated(df)


def removed_lines(found: DataFrame, least: int = LEAST) -> DataFrame:
    """host, digest, positions (ascending) and characters of the lines above the limit, where a text has any.

    found: host, digest and lines of profile(). A group of copies is one row before its lines are written out.
    """
    texts = found.groupBy("host", "digest").agg(F.first("lines").alias("lines"))
    lines = texts.select("host", "digest", F.posexplode("lines").alias("at", "line")).where("line is not null")
    lines = lines.select("host", "digest", "at", "line.hash", "line.chars")
    held = lines.groupBy("host", "hash").agg(F.count_distinct("digest").alias("n"))
    frequent = held.where(F.col("n") >= least).select("host", "hash")
    return lines.join(frequent, ["host", "hash"]).groupBy("host", "digest").agg(
        F.sort_array(F.collect_list("at")).alias("removed"), F.sum("chars").alias("removed_chars")
    )


def judge(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The counts of every row with base_failed, n_removed_lines, removed_chars, depleted and kept."""
    found = checkpointed(profile(docs))
    # Kept apart first, so that the join can split the rows of a text with many copies.
    removed = checkpointed(removed_lines(found, least))
    joined = found.join(removed, ["host", "digest"], "left")
    line_chars = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["chars"], F.lit(0)))
    base_failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    removed_chars = F.coalesce("removed_chars", F.lit(0).cast("long"))
    return (
        joined.withColumn("removed_chars", removed_chars)
        .withColumn("n_removed_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long"))
        .withColumn("base_failed", base_failed)
        .withColumn("depleted", 2 * removed_chars > line_chars)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .drop("lines")
    )


def clean(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The columns of docs for the documents that are kept, their text without the lines above the limit."""
    verdicts = judge(docs, least).where("kept").groupBy("host", "digest").agg(F.first("removed").alias("removed"))
    verdicts = written(verdicts, "verdicts")  # a plain table: the join can split the rows of a text with many copies
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, _host().alias("host"), F.unhex(F.md5(whole_text())).alias("digest"))
    joined = keyed.join(verdicts, ["host", "digest"]).withColumn("lines", F.split("row.text", "\n", -1))
    # The runs of lines between removed positions, one slice each.
    ends = joined.withColumn("ends", F.concat("removed", F.array(F.size("lines"))))

    def run(end: Column, k: Column) -> Column:
        start = F.coalesce(F.get("ends", k - 1) + 1, F.lit(0))
        return F.slice("lines", start + 1, end - start)

    left = F.array_join(F.flatten(F.transform("ends", run)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(left).alias("text")
    return ends.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


ORACLE = r"""
WITH blanks AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS b),
docs AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
worded AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         string_split(t, chr(10)) AS ls
  FROM docs
),
word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM worded),
grams AS (
  SELECT doc_id, pos, w AS a, lead(w, 1) OVER of_doc AS b, lead(w, 2) OVER of_doc AS c
  FROM word WINDOW of_doc AS (PARTITION BY doc_id ORDER BY pos)
),
counted AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM grams WHERE c IS NOT NULL),
covered AS (
  SELECT doc_id, count(DISTINCT pos + d) AS n FROM counted CROSS JOIN (SELECT unnest([0, 1, 2]) AS d) WHERE n > 1 GROUP BY doc_id
),
line AS (
  SELECT doc_id, host, t, line, trim(line, (SELECT b FROM blanks)) AS s
  FROM (SELECT doc_id, host, t, unnest(ls) AS line FROM worded) WHERE trim(line, (SELECT b FROM blanks)) <> ''
),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n, sum(length(s)) AS chars FROM line GROUP BY doc_id),
held AS (SELECT host, lower(s) AS key, count(DISTINCT t) AS n FROM line GROUP BY ALL),
frequent AS (SELECT host, key FROM held WHERE n >= 10),
removed AS (
  SELECT doc_id, count(*) AS n, sum(length(s)) AS chars
  FROM line JOIN frequent ON line.host = frequent.host AND lower(s) = key GROUP BY doc_id
),
judged AS (
  SELECT worded.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         coalesce(removed.n, 0)::BIGINT AS n_removed_lines, coalesce(removed.chars, 0)::BIGINT AS removed_chars,
         2 * coalesce(removed.chars, 0) > coalesce(dups.chars, 0) AS depleted
  FROM worded LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN removed USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT depleted AS kept
FROM judged
"""
