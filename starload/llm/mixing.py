"""Mixing sources to target weights: iterative proportional fitting on cells, then sampling by the fitted rates.

A document weighs its words, at least one. The corpus is summed by cell (source, language, topic). The tokens to take
are BUDGET times those of the corpus; of them, each source, language and topic is to get a share: the one that the caller's
targets give it, or by default one in proportion to its tokens to the power of TEMPER, which lifts small values against
large ones. Fitting multiplies the cells of each value by what its margin lacks, margin after margin, ROUNDS times. A rate
never exceeds one, as no document is taken twice: cells at one are whole, and the others of the margin make up for them as
far as they can. A factor is held at HIGHEST: one that reaches it belongs to a value whose documents are all taken and do
not fill its share, and would else grow with every round; the share it cannot fill is left to no other value.

A document is taken if a uniform number drawn from its id is below its cell's rate, so a run repeated, or repeated in
part after a lost executor, takes the same documents; one whose number equals the rate is left.

Fitting touches the cells only, never the documents, and stays a DataFrame: there may be as many sources as there are.
The topic of a document is the column that the caller names, or that of the first rule of TOPICS one of whose strings its
text holds, else "prose".

Defined results: a null text weighs one, a very long one all its words; a null source, language or topic is the value '';
a value that given targets do not name gets nothing; shares need not add up to one; rows that repeat a doc_id are taken
or left together, rows without one by their text; an empty table gives an empty result; sample() keeps all columns,
whatever they are called.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import checkpointed, whole_text, words, written

MARGINS = ("source", "lang", "topic")
TEMPER = {"source": 0.7, "lang": 0.8, "topic": 0.9}
BUDGET = 0.6
ROUNDS = 10
HIGHEST = 1e6  # of a factor whose margin cannot be met
SEED = 17
TOPICS = (
    ("legal", ("License", "licensed under", "All rights reserved")),
    ("table", (" | ",)),
    ("contact", ("@",)),
)


def _topic(text: Column) -> Column:
    found = F.lit("prose")
    for name, strings in reversed(TOPICS):
        held = F.lit(False)
        for s in strings:
            held = held | F.contains(text, F.lit(s))
        found = F.when(held, name).otherwise(found)
    return found


def _uniform(seed: int) -> Column:
    """A number from [0, 1) with 52 bits, from the id or else the text."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(whole_text()))
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), own).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def weighed(seed: int = SEED, topic: str | None = None) -> dict[str, Column]:
    """What a document is sampled by. topic: a column to take topics from, instead of the rules."""
    text = whole_text()
    return {
        "_source": F.coalesce("source", F.lit("")),
        "_lang": F.coalesce("lang", F.lit("")),
        "_topic": F.coalesce(F.col(f"`{topic}`").cast("string"), F.lit("")) if topic else _topic(text),
        "_tokens": F.greatest(F.lit(1), F.size(words(text))).cast("long"),
        "_u": _uniform(seed),
    }


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """value and share: in proportion to the value's tokens to the power."""
    raised = cells.groupBy(F.col(margin).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("raised"))
    total = raised.agg(F.sum("raised").alias("total"))
    return raised.crossJoin(F.broadcast(total)).select("value", (F.col("raised") / F.col("total")).alias("share"))  # one row


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """source, lang, topic, tokens and rate of each cell; targets: value and share for each margin."""
    total = cells.agg(F.sum("tokens").alias("total"))
    fitted = cells.crossJoin(F.broadcast(total))  # one row
    for margin, shares in targets.items():
        shares = shares.select(F.col("value").alias(margin), (F.col("share") * budget).alias(f"share_{margin}"))
        fitted = fitted.join(shares, margin, "left").withColumn(
            f"share_{margin}", F.coalesce(F.col(f"share_{margin}"), F.lit(0.0)) * F.col("total")
        )
    fitted = checkpointed(fitted.withColumn("factor", F.lit(budget)))
    for _ in range(rounds):
        for margin in targets:
            taken = F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("factor")))
            now = fitted.groupBy(margin).agg(taken.alias("taken"))
            factor = F.least(F.lit(HIGHEST), F.col("factor") * F.col(f"share_{margin}") / F.col("taken"))
            # A value whose target is zero is not taken at all, and stays so.
            factor = F.when(F.col("taken") > 0, factor).otherwise(0.0)
            fitted = fitted.join(now, margin).withColumn("factor", factor).drop("taken")
        fitted = checkpointed(fitted)
    return fitted.select(*MARGINS, "tokens", F.least(F.lit(1.0), "factor").alias("rate"))


def rates(
    docs: DataFrame,
    temper: Mapping[str, float] = TEMPER,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    targets: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The fitted cells of docs, which carries the columns of weighed(). targets: value and share of some margins."""
    targets = targets or {}
    if wrong := targets.keys() - set(MARGINS):
        raise ValueError(f"no margins: {sorted(wrong)}")
    cells = docs.groupBy(*[F.col(f"_{m}").alias(m) for m in MARGINS]).agg(F.sum("_tokens").alias("tokens"))
    cells = checkpointed(cells)
    given = {m: targets[m] if m in targets else tempered(cells, m, temper[m]) for m in MARGINS}
    return rake(cells, given, budget, rounds)


def mix(
    docs: DataFrame,
    temper: Mapping[str, float] = TEMPER,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    seed: int = SEED,
    targets: Mapping[str, DataFrame] | None = None,
    topic: str | None = None,
) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, rate and sampled of every row. targets and topic: see rates(), weighed()."""
    own = docs.select("doc_id", "source", "lang", *[c.alias(name) for name, c in weighed(seed, topic).items()])
    own = checkpointed(own)
    return _joined(own, rates(own, temper, budget, rounds, targets)).select(
        "doc_id",
        "source",
        "lang",
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_rate").alias("rate"),
        (F.col("_u") < F.col("_rate")).alias("sampled"),
    )


def sample(
    docs: DataFrame,
    temper: Mapping[str, float] = TEMPER,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    seed: int = SEED,
    targets: Mapping[str, DataFrame] | None = None,
    topic: str | None = None,
) -> DataFrame:
    """The sampled rows of docs, all columns.

    The rates are written first: with their size known, they meet the texts without a shuffle wherever they are small.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    own = docs.select(row.alias("row"), *[c.alias(name) for name, c in weighed(seed, topic).items()])
    found = written(rates(own, temper, budget, rounds, targets), "rates")
    return _joined(own, found).where("_u < _rate").select("row.*")


def _joined(own: DataFrame, fitted: DataFrame) -> DataFrame:
    keys = [f"_{m}" for m in MARGINS]
    fitted = fitted.select(*[F.col(m).alias(f"_{m}") for m in MARGINS], F.col("rate").alias("_rate"))
    return own.join(fitted, keys)


def _oracle() -> str:
    topics = " ".join(f"WHEN {' OR '.join(f"contains(t, '{s}')" for s in strings)} THEN '{name}'" for name, strings in TOPICS)
    steps, last = [], "r0"
    for k in range(ROUNDS):
        for m in MARGINS:
            name = f"r{k}_{m}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT * REPLACE (least({HIGHEST}, factor * target_{m} /"
                f" sum(tokens * least(1.0, factor)) OVER (PARTITION BY {m})) AS factor) FROM {last})"
            )
            last = name
    shares = ",\n".join(
        f"s_{m} AS (SELECT {m}, pow(sum(tokens), {TEMPER[m]}) / sum(pow(sum(tokens), {TEMPER[m]})) OVER () AS share FROM cells GROUP BY {m})"
        for m in MARGINS
    )
    joins = " ".join(f"JOIN s_{m} USING ({m})" for m in MARGINS)
    targets = ", ".join(f"{BUDGET} * s_{m}.share * (SELECT sum(tokens) FROM cells) AS target_{m}" for m in MARGINS)
    return rf"""
WITH docs AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
own AS (
  SELECT doc_id, source AS own_source, lang AS own_lang, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE {topics} ELSE 'prose' END AS topic,
         greatest(1, len(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS tokens,
         ('0x' || substr(md5('{SEED}:' || doc_id), 1, 13))::BIGINT / {float(1 << 52)} AS u
  FROM docs
),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM own GROUP BY ALL),
{shares},
r0 AS (SELECT source, lang, topic, tokens, {targets}, {BUDGET}::DOUBLE AS factor FROM cells {joins}),
{', '.join(steps)}
SELECT doc_id, own_source AS source, own_lang AS lang, topic, own.tokens::BIGINT AS n_tokens,
       round(least(1.0, factor), 6) AS rate, u < least(1.0, factor) AS sampled
FROM own JOIN {last} USING (source, lang, topic)
"""


ORACLE = _oracle()
