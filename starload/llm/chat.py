"""Chat transcripts: roles by a hidden Markov model over the lines, then turns in one canonical form.

A state is a role together with whether a line begins a turn or goes on with one. A line shows a speaker marker (or
none), whether a blank line came before it, its length and whether it asks; each is counted by state over all labelled
lines, as are the steps from state to state, so fitting is one aggregation. Viterbi then finds the best states of each
transcript. Where a state begins a turn, a turn is cut; its text loses the marker and is rendered canonically.

All lines are sorted by transcript and place, in ranges, and cut into blocks of at most LINES lines, whatever the turn
numbers: a transcript of any length, or one whose rows share a turn number, is spread over tasks. Each block is a matrix
of best scores from the state before it to the state at its end; blocks are combined FAN by FAN until one is left, and
scores from both sides are handed back down. The result is that of one run over the whole transcript, though no task ever
holds a whole one. For fitting, steps are counted inside stretches of TURNS turns; crowded ones are split by their rows.

Defined results: rows repeated exactly count once; several texts under one turn number follow each other in order of
role (null first) and of the text's digest; a null text is one empty line; a row without conversation or turn number is a transcript
of its own, told apart by role and text; of equally good states the one listed first wins; an empty table gives an
empty result; a text of any length is split into its lines; other columns, whatever they are called, are not looked at.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starload.llm.common import checkpointed, written

ROLES = ("system", "user", "assistant")
STATES = tuple(itertools.product(ROLES, (True, False)))  # role, begins a turn
TURNS = 64
CROWD = 4096  # lines of a stretch of turns that are counted together
LINES = 4096  # to a block; a power of two
FAN = 64
# Words that name a speaker.
SPEAKERS = {
    "system": ("system", "instructions"),
    "user": ("user", "human", "customer", "q"),
    "assistant": ("assistant", "ai", "bot", "a"),
}
MARKER = r"^\s*(?:#+\s*|\*\*|<\|)?(" + "|".join(w for ws in SPEAKERS.values() for w in ws) + r")(?:\|>|\s*\*\*:|\s*:)\s*"
SHOWN = {"marker": len(ROLES) + 1, "blank": 2, "size": 6, "asks": 2}  # what a line shows, and how many values it takes
NEVER = -1e9  # log-probability of a step to another role's running turn
KEY = ["conv", "block"]
ORDER = ["turn", "role", "digest", "at"]


def shown(lines: DataFrame) -> DataFrame:
    """Adds what the line shows."""
    word = F.lower(F.regexp_extract("line", "(?i)" + MARKER, 1))
    marker = F.lit(0)
    for k, role in enumerate(ROLES, 1):
        marker = F.when(word.isin(*SPEAKERS[role]), k).otherwise(marker)
    length = F.char_length("line")
    size = sum(((length > n).cast("int") for n in (0, 20, 60, 150, 400)), F.lit(0))
    return lines.withColumns(
        {
            "marker": marker,
            "blank": F.coalesce(F.trim("before") == "", F.lit(False)).cast("int"),
            "size": size,
            "asks": F.endswith(F.rtrim("line"), F.lit("?")).cast("int"),
        }
    ).drop("before")


def lines_of(rows: DataFrame) -> DataFrame:
    """The lines of transcript pieces (conv_id, turn, role, text), with what they show."""
    pieces = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).distinct()
    digest = F.md5("text")
    alone = F.col("conv_id").isNull() | F.col("turn").isNull()
    own = F.concat_ws("/", F.coalesce(F.col("conv_id"), F.col("turn")).cast("string"), F.lit("alone"), "role", digest)
    split = pieces.select(
        F.when(alone, own).otherwise(F.col("conv_id").cast("string")).alias("conv"),
        F.floor(F.coalesce("turn", F.lit(0)) / TURNS).cast("long").alias("block"),
        "conv_id",
        "turn",
        "role",
        digest.alias("digest"),
        F.split("text", "\n", -1).alias("lines"),
    )
    each = split.select("*", F.posexplode("lines").alias("at", "line"))
    before = F.when(F.col("at") > 0, F.get("lines", F.col("at") - 1))
    return shown(each.withColumn("before", before).drop("lines"))


@dataclass
class Model:
    start: np.ndarray
    steps: np.ndarray
    emitted: dict[str, np.ndarray]  # states x values

    def scores(self, shown: dict[str, np.ndarray]) -> np.ndarray:
        return sum(self.emitted[name][:, values].T for name, values in shown.items())


def fit(lines: DataFrame) -> Model:
    """Counted over all lines of lines_of() with a known role; steps within blocks."""
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    known = lines.where(F.col("role").isin(*ROLES)).withColumn("state", 2 * role + (F.col("at") > 0).cast("int"))
    known = known.select(*KEY, *ORDER, "state", *SHOWN)
    crowds = known.groupBy(*KEY).agg(F.ceil(F.count("*") / CROWD).alias("parts")).where("parts > 1")
    known = known.join(written(crowds, "crowds"), KEY, "left")
    part = F.pmod(F.xxhash64("turn", "role", "digest"), F.coalesce("parts", F.lit(1))).alias("part")
    known = known.select(*KEY, part, *ORDER, "state", *SHOWN).repartition(*KEY, "part")
    known = known.withColumn("last", F.lag("state").over(W.partitionBy(*KEY, "part").orderBy(*ORDER)))
    counts = known.groupBy("last", "state", *SHOWN).agg(F.count("*").alias("n"))
    size = len(STATES)
    start, steps = np.ones(size), np.ones((size, size))
    emitted = {name: np.ones((size, values)) for name, values in SHOWN.items()}
    for row in counts.collect():  # at most (states + 1) * states * 96 rows
        if row["last"] is None:
            start[row.state] += row.n
        else:
            steps[row["last"], row.state] += row.n
        for name in SHOWN:
            emitted[name][row.state, row[name]] += row.n

    def logs(x: np.ndarray) -> np.ndarray:
        return np.log(x / x.sum(axis=-1, keepdims=True))

    start, steps = logs(start), logs(steps)
    for (a, (from_role, _)), (b, (to_role, begins)) in itertools.product(enumerate(STATES), repeat=2):
        if from_role != to_role and not begins:
            steps[a, b] = NEVER
    for b, (_, begins) in enumerate(STATES):
        if not begins:
            start[b] = NEVER
    return Model(start, steps, {name: logs(x) for name, x in emitted.items()})


def _through(scores: np.ndarray, model: Model) -> np.ndarray:
    """Best score from each state before these lines to each state at their end."""
    best = model.steps + scores[0]
    for row in scores[1:]:
        best = _times(best, model.steps) + row
    return best


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best sums over the state in between."""
    return (a[..., :, None] + b).max(axis=-2)


def viterbi(scores: np.ndarray, model: Model, into: np.ndarray | None = None, out_of: np.ndarray | None = None) -> np.ndarray:
    """Best states of the lines, given scores of the states before them (None: nothing before) and after them."""
    now = (model.start if into is None else _times(into, model.steps)) + scores[0]
    back = np.zeros((len(scores), len(STATES)), np.int64)
    for t in range(1, len(scores)):
        through = now[:, None] + model.steps
        back[t] = through.argmax(axis=0)
        now = through.max(axis=0) + scores[t]
    states = np.empty(len(scores), np.int64)
    states[-1] = (now if out_of is None else now + out_of).argmax()
    for t in range(len(scores) - 1, 0, -1):
        states[t - 1] = back[t, states[t]]
    return states


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by KEY, as tables of whole groups, with where each group begins and the end."""
    held: list[pa.RecordBatch] = []  # of a group that may go on

    def whole(parts: list[pa.RecordBatch]) -> pa.Table:
        return pa.Table.from_batches(parts).combine_chunks()

    for batch in batches:
        if not batch.num_rows:
            continue
        differs = np.zeros(batch.num_rows, bool)
        for name in KEY:
            column = batch.column(name)
            differs[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            if held:
                differs[0] |= held[-1].column(name)[-1] != column[0]
        cuts = np.flatnonzero(differs)
        if len(cuts):  # the last group may go on in the next batch
            table = whole([*held, batch.slice(0, cuts[-1])])
            if table.num_rows:
                before = table.num_rows - int(cuts[-1])
                begins = np.unique(np.concatenate([[0], before + cuts]))
                yield table, begins
            held = []
        held.append(batch.slice(cuts[-1] if len(cuts) else 0))
    if held:
        table = whole(held)
        yield table, np.array([0, table.num_rows])


def _scores(table: pa.Table, model: Model) -> np.ndarray:
    return model.scores({name: table.column(name).to_numpy() for name in SHOWN})


def blocked(lines: DataFrame) -> DataFrame:
    """The lines, sorted over all tasks, with their block: consecutive lines of one task, at most LINES of them.

    Kept in the shared folder at once: where the ranges end is drawn from a sample, so it must not be drawn again.
    """
    ordered = lines.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER)
    number = F.shiftright(F.monotonically_increasing_id(), LINES.bit_length() - 1)
    return checkpointed(ordered.withColumn("block", number))


def _summaries(lines: DataFrame, shared) -> DataFrame:
    """conv, block, through (matrix by rows) and first (scores at its end if the transcript begins with it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for table, begins in _groups(batches):
            scores, through, first = _scores(table, model), [], []
            for a, b in zip(begins, begins[1:]):
                through.append(_through(scores[a:b], model).ravel())
                opened = model.start + scores[a]
                first.append(_times(opened, _through(scores[a + 1 : b], model)) if b > a + 1 else opened)
            keys = [table.column(k).combine_chunks().take(pa.array(begins[:-1])) for k in KEY]
            yield pa.record_batch([*keys, pa.array(through), pa.array(first)], [*KEY, "through", "first"])

    picked = lines.sortWithinPartitions(*KEY, *ORDER).select(*KEY, *SHOWN)
    return picked.mapInArrow(run, "conv string, block long, through array<double>, first array<double>")


def _matrix(values) -> np.ndarray:
    return np.asarray(values, float).reshape(len(STATES), len(STATES))


def _combined(level: DataFrame) -> DataFrame:
    """Summaries of FAN neighbouring blocks each."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        first, through = np.asarray(group["first"].iat[0]), _matrix(group["through"].iat[0])
        for matrix in map(_matrix, group["through"].iloc[1:]):
            first, through = _times(first, matrix), _times(through, matrix)
        row = {"conv": [group["conv"].iat[0]], "block": [group["parent"].iat[0]]}
        return pd.DataFrame(row | {"through": [through.ravel()], "first": [first]})

    grouped = level.withColumn("parent", F.floor(F.col("block") / FAN)).groupBy("conv", "parent")
    return grouped.applyInPandas(run, level.schema)


def _handed_down(level: DataFrame, above: DataFrame | None) -> DataFrame:
    """conv, block, into and out_of for each block of a level, from those of the level above (None: nothing)."""
    kind = "conv string, block long, into array<double>, out_of array<double>"
    keyed = level.withColumn("parent", F.floor(F.col("block") / FAN) if above is not None else F.lit(0))
    if above is None:
        nothing = F.lit(None).cast("array<double>")
        keyed = keyed.withColumns({"into": nothing, "out_of": nothing})
    else:
        keyed = keyed.join(above.withColumnRenamed("block", "parent"), ["conv", "parent"])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        into, out_of = group["into"].iat[0], group["out_of"].iat[0]
        out = np.zeros(len(STATES)) if out_of is None else np.asarray(out_of)
        matrices = list(map(_matrix, group["through"]))
        intos, outs = [], [out]
        for first, matrix in zip(group["first"], matrices):
            intos.append(into)
            into = np.asarray(first) if into is None else _times(np.asarray(into), matrix)
        for matrix in matrices[:0:-1]:
            outs.append((matrix + outs[-1]).max(axis=1))
        return pd.DataFrame({"conv": group["conv"], "block": group["block"], "into": intos, "out_of": outs[::-1]})

    return keyed.groupBy("conv", "parent").applyInPandas(run, kind)


def _boundaries(lines: DataFrame, shared) -> DataFrame:
    """conv, block, into and out_of of the transcripts that have several blocks."""
    several = lines.groupBy("conv").agg(F.min("block").alias("a"), F.max("block").alias("b")).where("a < b")
    several = written(several.select("conv"), "several")
    summaries = checkpointed(_summaries(lines.join(several, "conv", "left_semi"), shared))
    # Blocks of a transcript numbered from 0: one row for some LINES lines.
    place = F.row_number().over(W.partitionBy("conv").orderBy("block")) - 1
    numbers = checkpointed(summaries.select(*KEY, place.cast("long").alias("number")))
    numbered = summaries.join(numbers, KEY).select("conv", F.col("number").alias("block"), "through", "first")
    levels = [checkpointed(numbered)]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        levels.append(checkpointed(_combined(levels[-1])))
    found = _handed_down(levels[-1], None)
    for level in levels[-2::-1]:
        found = _handed_down(level, found)
    found = found.withColumnRenamed("block", "number").join(numbers, ["conv", "number"])
    return written(found.select(*KEY, "into", "out_of"), "boundaries")


def label(lines: DataFrame, model: Model) -> DataFrame:
    """The lines of lines_of() with state, a place in STATES, and inside, the turns begun in the block so far."""
    lines = blocked(lines)
    shared = lines.sparkSession.sparkContext.broadcast(model)
    joined = lines.join(_boundaries(lines, shared), KEY, "left")
    columns = [*KEY, "conv_id", *ORDER, "line"]
    opens = np.array([begins for _, begins in STATES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for table, begins in _groups(batches):
            scores, states, inside = _scores(table, model), [], []
            intos, outs = table.column("into"), table.column("out_of")
            for a, b in zip(begins.tolist(), begins[1:].tolist()):
                into, out_of = (None if (x := c[a].as_py()) is None else np.array(x) for c in (intos, outs))
                states.append(viterbi(scores[a:b], model, into, out_of))
                inside.append(np.cumsum(opens[states[-1]]))
            found = table.select(columns).append_column("state", pa.array(np.concatenate(states)))
            yield from found.append_column("inside", pa.array(np.concatenate(inside))).to_batches()

    schema = """conv string, block long, conv_id long, turn long, role string, digest string, at int, line string, state long,
        inside long"""
    # A block lies in one task, as the lines were dealt out, or if the boundaries are many, by its key.
    return joined.sortWithinPartitions(*KEY, *ORDER).select(*columns, *SHOWN, "into", "out_of").mapInArrow(run, schema)


def turns(labelled: DataFrame) -> DataFrame:
    """conv_id, turn (from 0), role, n_lines, text and rendered of each turn that label() has found."""
    labelled = checkpointed(labelled)  # read twice: for the turns of each block and for their lines
    begins = F.element_at(F.array(*[F.lit(b) for _, b in STATES]), (F.col("state") + 1).cast("int"))
    role = F.element_at(F.array(*[F.lit(r) for r, _ in STATES]), (F.col("state") + 1).cast("int"))
    blocks = labelled.groupBy(*KEY).agg(F.max("inside").alias("n"))
    earlier = F.sum("n").over(W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    blocks = written(blocks.select(*KEY, earlier.alias("earlier")).where("earlier is not null"), "earlier")
    named = labelled.withColumn("begins", begins).withColumn("found_role", role).join(blocks, KEY, "left")
    number = F.greatest(F.lit(0), F.coalesce("earlier", F.lit(0)) + F.col("inside") - 1)
    line = F.when(F.col("begins"), F.regexp_replace("line", "(?i)" + MARKER, "")).otherwise(F.col("line"))
    place = F.struct("block", *ORDER)
    gathered = named.groupBy("conv", "conv_id", number.alias("number")).agg(
        F.min_by("found_role", place).alias("role"),
        F.count("*").alias("n_lines"),
        F.array_sort(F.collect_list(F.struct(place.alias("place"), line.alias("line")))).alias("lines"),
    )
    text = F.regexp_replace(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), r"^\s+|\s+$", "")
    return gathered.select("conv_id", F.col("number").cast("int").alias("turn"), "role", "n_lines", text.alias("text")).withColumn(
        "rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>"))
    )


def transcribed(conversations: DataFrame) -> DataFrame:
    """Conversations as raw transcript pieces: markers in one of five styles by conversation, a quarter of the turns
    without a marker, after a blank line. The columns stay; a turn without a role has no marker."""
    styles = F.array(
        F.concat(F.initcap("role"), F.lit(": ")),
        F.concat(F.lit("### "), F.initcap("role"), F.lit(": ")),
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>")),
        F.concat(F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise("System"), F.lit(": ")),
        F.concat(F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise("Instructions"), F.lit(" : ")),
    )
    marker = F.element_at(styles, (F.pmod(F.xxhash64("conv_id"), F.lit(5)) + 1).cast("int"))
    without = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0) | F.col("role").isNull()
    text = F.concat(F.when(without, "\n").otherwise(marker), F.coalesce("text", F.lit("")))
    return conversations.withColumn("text", text)


def held_out(conv_id: str = "conv_id"):
    """A quarter of the conversations, never learned from."""
    return F.coalesce(F.crc32(F.col(conv_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def parse(pieces: DataFrame, model: Model) -> DataFrame:
    """Turns of the transcripts that the pieces make up.

    A role that a piece carries tells it apart from others and orders those of one turn number; the model does not see it.
    """
    return turns(label(lines_of(pieces), model))


def learned(pieces: DataFrame) -> Model:
    return fit(lines_of(pieces.where(~held_out())))


def empty_model(spark: SparkSession) -> Model:
    """What is known before anything is counted."""
    return fit(lines_of(spark.createDataFrame([], "conv_id long, turn long, role string, text string")))
