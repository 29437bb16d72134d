"""Tables under one shared folder, published all or nothing.

A run writes each table it changes to new folders, never to one that exists, then one small state that names every
folder in force. Readers take the newest state, so they see every table of a run or none. The state is written under a
name of its own and renamed to its number; of two publishers only one finds that number free. A run that dies before
that leaves the previous state as it was and can be repeated under the same run id.

Large tables are kept in parts, months or hash buckets, and a run rewrites only the parts it touches. To a table in
buckets a small batch is added as a delta: whole rows that replace those of the same key. Deltas are read over the
buckets and folded into them when they have grown to a tenth of the table, or to DELTAS of them.

Unique keys and references are checked for all that a run has staged, in one job, before it is published.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.functions.dates import date_key
from starload.operators.checks import CheckFailed, reference_violations, unique_violations
from starload.operators.dedupe import last_wins
from starload.schemas import (
    BUCKETED,
    KEY_BUCKETS,
    MAX_LENGTHS,
    MONTHLY,
    REFERENCES,
    REQUIRED,
    SCHEMAS,
    UNIQUE_KEYS,
)

KEPT_RUNS = 1000  # ids of runs that are remembered though nothing of theirs is in force any more
DELTAS = 30  # in force at a time
SMALL = 10  # a batch this many times smaller than its table, deltas included, is a delta
MOST_SENT = 100_000  # rows that the planner may broadcast because their files are small

_renaming = threading.Lock()  # for file systems that look first and rename then; others need none


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """No rows, and known to be so when planning: joins and unions with it cost nothing."""
    fields = StructType.fromDDL(SCHEMAS[table])
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in fields]
    return spark.range(1).select(*nulls).filter(F.lit(False))


def bucket_of(table: str, buckets: int | None = None) -> Column:
    """The part of a bucketed table that a row belongs to; `buckets` is what the store has recorded."""
    key, default = BUCKETED[table]
    return F.pmod(F.xxhash64(key), F.lit(buckets or default)).cast("int")


def by_key(side: DataFrame, rows: int) -> DataFrame:
    """A side of so many rows of a join by key: shuffled where it has many.

    The planner judges by the size of the files. Keys in order are packed to a byte or two, so millions of rows can look
    small enough to be broadcast, for which the driver has to hold them all, at about a hundred bytes each.
    """
    return side.hint("merge") if rows > MOST_SENT else side


def observed(seen: Observation, written: DataFrame, figures: list[Column]) -> dict:
    """What was counted while writing; from the files where the planner has cut an empty plan short."""
    try:
        return seen.get
    except Py4JJavaError:
        return written.agg(*figures).first().asDict()


class Overlap(ValueError):
    """Another run has replaced what this one was derived from; nothing was published."""


@dataclass(frozen=True)
class Staged:
    """One table written by a run, not visible yet."""

    table: str
    path: str
    appended: bool
    whole: bool = False  # replaces the whole table, not only the parts it holds
    base: int = 0  # the state it was derived from
    rows: int = 0
    first_day: int | None = None  # smallest and largest day, as date keys, of facts and snapshots
    last_day: int | None = None
    delta: bool = False


@dataclass(frozen=True)
class Entry:
    seq: int
    run_id: str
    table_name: str
    path: str
    part: int | None
    rows: float  # of a run's parts the mean
    last_day: int | None = None


@dataclass
class State:
    seq: int = 0
    entries: list[Entry] = field(default_factory=list)  # in force, oldest first
    runs: list[str] = field(default_factory=list)  # ids of published runs
    layout: dict[str, int] = field(default_factory=dict)  # numbers of buckets, fixed once they are in use

    def after(
        self, seq: int, run_id: str, staged: list[Staged], parts: dict[str, list[int | None]], layout: dict[str, int]
    ) -> State:
        entries = list(self.entries)
        for item in staged:
            held = parts[item.path]
            if not item.appended:
                gone = lambda e: e.table_name == item.table and (item.whole or e.part in held)  # noqa: B023, E731
                entries = [e for e in entries if not gone(e)]
            for part in held:
                last = item.last_day
                if last is not None and part is not None:
                    last = min(last, part * 100 + 31)
                entries.append(Entry(seq, run_id, item.table, _folder(item, part), part, item.rows / len(held), last))
        return State(seq, entries, [*self.runs, run_id][-KEPT_RUNS:], self.layout | layout)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> State:
        found = json.loads(text)
        return State(**found | {"entries": [Entry(**e) for e in found["entries"]]})


def _folder(item: Staged, part: int | None) -> str:
    return item.path if part is None else f"{item.path}/{part_column(item.table)}={part}"


def part_column(table: str) -> str | None:
    return "ym" if table in MONTHLY else "bucket" if table in BUCKETED else None


class Store:
    """One view of the published tables: what was published when it was last refreshed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(conf)
        where = self._files.makeQualified(self._path(self.root)).toUri()
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where, conf)
        self._state = State()
        self.refresh()

    # Reading ------------------------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        try:
            return [status.getPath().getName() for status in self._files.listStatus(self._path(folder))]
        except Py4JJavaError as error:
            if "FileNotFoundException" not in error.java_exception.getClass().getName():
                raise
            return []

    def _states(self) -> list[int]:
        names = self._names(f"{self.root}/_published")
        return sorted(int(name.removeprefix("seq=")) for name in names if name.startswith("seq="))

    def _state_of(self, seq: int) -> State:
        stream = self._files.open(self._path(f"{self.root}/_published/seq={seq}"))
        try:
            return State.from_json(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def refresh(self) -> None:
        """See what other runs have published. A state never changes, so a known one is not read again."""
        newest = max(self._states(), default=0)
        if newest != self._state.seq:
            self._state = self._state_of(newest) if newest else State()

    def _live(self, table: str) -> dict[int | None, list[str]]:
        """Folders that make up a table, by part."""
        live: dict[int | None, list[str]] = {}
        for entry in self._state.entries:
            if entry.table_name == table:
                live.setdefault(entry.part, []).append(entry.path)
        return live

    def read(self, table: str, parts: list[int] | None = None) -> DataFrame:
        """The published table, or these months or buckets of it, with its declared schema."""
        live = self._live(table)
        deltas = live.pop(None, []) if table in BUCKETED else []
        chosen = live if parts is None else [p for p in live if p in parts]
        rows = self._load(table, [path for part in chosen for path in live[part]])
        if not deltas:
            return rows
        key = BUCKETED[table][0]
        changed = [self._plain(table, path).withColumn("_age", F.lit(k)) for k, path in enumerate(deltas)]
        changed = last_wins(reduce(DataFrame.unionByName, changed), [key], ["_age"]).drop("_age")
        if parts is not None:
            changed = changed.filter(bucket_of(table, self.buckets(table)).isin(parts))
        return rows.join(changed.select(key), key, "left_anti").select(*rows.columns).unionByName(changed)

    def rows(self, table: str, parts: list[int] | None = None) -> int:
        """The rows stored, those that deltas replace included, or those of these months, from the state."""
        own = [e for e in self._state.entries if e.table_name == table and (parts is None or e.part in parts)]
        return round(sum(e.rows for e in own))

    def side(self, table: str) -> DataFrame:
        """The published table as a side of a join by key."""
        return by_key(self.read(table), self.rows(table))

    def buckets(self, table: str) -> int:
        """How many buckets a table is kept in, from its creation on."""
        return self._state.layout.get(f"{table}.buckets", BUCKETED[table][1])

    def key_buckets(self, table: str) -> int:
        """How many buckets the keys of a dimension are handed out in, from its creation on."""
        return self._state.layout.get(f"{table}.key_buckets", KEY_BUCKETS)

    def last_day(self, table: str, months: list[int] | None = None) -> int | None:
        """The largest day stored, or of these months no smaller than that, as a date key, from the state."""
        own = [e for e in self._state.entries if e.table_name == table and (months is None or e.part in months)]
        return max((e.last_day for e in own if e.last_day is not None), default=None)

    def deltas(self, table: str) -> int:
        return len(self._live(table).get(None, []))

    def is_small(self, table: str, rows: int) -> bool:
        """Whether so many rows are a delta of a bucketed table, rather than a reason to write its buckets again."""
        own = [e for e in self._state.entries if e.table_name == table]
        added = rows + sum(e.rows for e in own if e.part is None)
        return self.deltas(table) < DELTAS and added * SMALL <= sum(e.rows for e in own if e.part is not None)

    def months(self, table: str) -> list[int]:
        """The months, or buckets, that hold rows."""
        return sorted(part for part in self._live(table) if part is not None)

    def register_views(self, prefix: str = "") -> None:
        """Every table as a temporary view of its name, for SQL. Call again to see later runs.

        Facts are stored by month: join `dim_date` on `date_key` and `ym` to read only the months
        a date filter asks for.
        """
        for table in SCHEMAS:
            self.read(table).createOrReplaceTempView(f"{prefix}{table}")

    def read_staged(self, staged: Staged) -> DataFrame:
        return self._plain(staged.table, staged.path) if staged.delta else self._load(staged.table, [staged.path])

    def after(self, staged: Staged) -> DataFrame:
        """The table as it will be once this is published."""
        rows = self.read_staged(staged)
        if staged.whole:
            return rows
        if staged.delta:
            key = BUCKETED[staged.table][0]
            rest = self.read(staged.table).join(rows.select(key), key, "left_anti").select(*rows.columns)
        elif staged.appended:
            rest = self.read(staged.table)
        else:
            gone = self.staged_months(staged)
            rest = self.read(staged.table, [p for p in self.months(staged.table) if p not in gone])
        return rest.unionByName(rows)

    def _plain(self, table: str, path: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[table]).parquet(path)

    def _load(self, table: str, paths: list[str]) -> DataFrame:
        if not paths:
            return empty_table(self.spark, table)
        column = part_column(table)
        # The month comes from the folder name; folders of several runs are one scan.
        schema = SCHEMAS[table] if table in MONTHLY or not column else f"{SCHEMAS[table]}, {column} int"
        reader = self.spark.read.schema(schema)
        if not column:
            return reader.parquet(*paths)
        rows = reader.option("basePath", f"{self.root}/{table}").parquet(*paths).drop("run")
        return rows if table in MONTHLY else rows.drop(column)

    def is_published(self, run_id: str) -> bool:
        """Remembered, or something of it is in force."""
        return run_id in self._state.runs or any(entry.run_id == run_id for entry in self._state.entries)

    # Writing ------------------------------------------------------------------------------

    def work(self, run_id: str, name: str, df: DataFrame, **counts: Column) -> tuple[DataFrame, dict]:
        """Write an intermediate result once and read it back, with figures counted meanwhile."""
        path = f"{self.root}/_work/{self._new(run_id)}/{name}"
        seen, figures = Observation(), [F.count("*").alias("rows"), *[c.alias(n) for n, c in counts.items()]]
        df.observe(seen, *figures).write.parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        return written, observed(seen, written, figures)

    @staticmethod
    def _new(run_id: str) -> str:
        """The name of a folder that no other attempt has."""
        return f"run={run_id}-{uuid.uuid4().hex[:12]}"

    def stage(
        self,
        run_id: str,
        table: str,
        df: DataFrame,
        appended: bool = False,
        whole: bool | None = None,
        delta: bool = False,
    ) -> Staged:
        """Write a table to a new folder, counting its rows and checking its columns.

        `appended` adds to what is published; else months are replaced one by one and other tables as
        a whole, unless `whole` says otherwise. A `delta` holds rows that replace those of the same key of a
        table in buckets. A required column with NULLs, a text longer than declared or a row without a
        part ends the run. Buckets that a delta may lie over can only be replaced as a whole.
        """
        if self.is_published(run_id):
            raise ValueError(f"run {run_id} is already published")
        path, column = f"{self.root}/{table}/{self._new(run_id)}", None if delta else part_column(table)
        if delta and table not in BUCKETED:
            raise ValueError(f"{table} is not kept in buckets")
        if column and table in BUCKETED:
            df = df.withColumn(column, bucket_of(table, self.buckets(table)))
        faults = {
            **{f"{c}: required": F.col(c).isNull() for c in REQUIRED.get(table, [])},
            **{f"{c}: text too long": F.char_length(c) > n for c, n in MAX_LENGTHS.get(table, {}).items()},
        }
        if column:
            faults[f"{column}: required"] = F.col(column).isNull()
        figures = [F.count("*").alias("rows"), *[F.count_if(fault).alias(name) for name, fault in faults.items()]]
        if table in MONTHLY:
            day = F.col("date_key") if "date_key" in df.columns else date_key(F.col("recorded_date"))
            figures += [F.min(day).alias("first_day"), F.max(day).alias("last_day")]
        seen = Observation()
        df = df.observe(seen, *figures)
        if column:
            # Whole parts to a task, big ones split by AQE: few, even files and no hot writer.
            sort = [c for c in (column, "game_key", "appid", "date_key") if c in df.columns]
            df = df.hint("rebalance", column).sortWithinPartitions(*sort)
            df.write.partitionBy(column).parquet(path)
        else:
            df.write.parquet(path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        found = observed(seen, self.spark.read.schema(schema).parquet(path), figures)
        wrong = {name: found[name] for name in faults if found[name]}
        if wrong:
            raise CheckFailed(f"{table}: {wrong}")
        replaces = not appended and not delta and (table not in MONTHLY if whole is None else whole)
        days = found.get("first_day"), found.get("last_day")
        return Staged(table, path, appended or delta, replaces, self._state.seq, found["rows"], *days, delta)

    def merge(
        self, run_id: str, table: str, batch: DataFrame, rows: int, merged: Callable[[DataFrame], DataFrame]
    ) -> Staged:
        """Stage a table in buckets with a batch of so many rows merged in, as a delta if that is small for the table.

        `merged` makes, of the stored rows that the batch may touch, those to be stored.
        """
        key = BUCKETED[table][0]
        if self.is_small(table, rows):
            old = self.read(table).join(batch.select(key), key, "left_semi")
            return self.stage(run_id, table, merged(old), delta=True)
        if self.deltas(table):
            return self.stage(run_id, table, merged(self.read(table)))
        # At most one row per bucket; only these are read, merged and written again.
        buckets = [row[0] for row in batch.select(bucket_of(table, self.buckets(table))).distinct().collect()]
        return self.stage(run_id, table, merged(self.read(table, buckets)), whole=False)

    def staged_months(self, staged: Staged) -> list[int]:
        """Parts a staged table holds, from its folder names."""
        column = part_column(staged.table)
        names = self._names(staged.path)
        return sorted(int(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}="))

    def _violations(self, staged: list[Staged]) -> list[tuple[str, DataFrame]]:
        """What the staged rows break of the declared keys and references; references to tables in use only."""
        new = {item.table: item for item in staged}
        found = []
        for item in staged:
            rows, table = self.read_staged(item), item.table
            fresh = not item.appended or item.delta or not self._live(table)
            if item.first_day is not None and (self.last_day(table) or 0) < item.first_day:
                fresh = True  # every day is later than every stored one
            for keys in UNIQUE_KEYS.get(table, []):
                what = f"{table}: more than one row for {', '.join(keys)}"
                if fresh:
                    found.append((what, unique_violations(rows, keys)))
                else:
                    stored = self.read(table, self.staged_months(item) if table in MONTHLY else None)
                    found.append((what, unique_violations(rows, keys, stored)))
            for column, parent, parent_column in REFERENCES.get(table, []):
                if parent in new or self._live(parent):
                    parents = self.after(new[parent]) if parent in new else self.read(parent)
                    parents = by_key(parents, self.rows(parent) + (new[parent].rows if parent in new else 0))
                    lost = reference_violations(rows, parents, column, parent_column)
                    found.append((f"{table}: {column} without a row of {parent}", lost))
        return found

    def check(self, staged: list[Staged]) -> None:
        """Fail if the staged rows break a unique key or a reference; one job for all of them."""
        found = [
            broken.limit(3).select(F.lit(what).alias("what"), F.to_json(F.struct("*")).alias("example"))
            for what, broken in self._violations([item for item in staged if item.rows])
        ]
        if found and (rows := reduce(DataFrame.union, found).collect()):
            raise CheckFailed("; ".join(f"{r.what}: {r.example}" for r in rows))

    def publish(self, run_id: str, staged: list[Staged], layout: dict[str, int] | None = None) -> None:
        """Make every staged table visible at once, if keys and references hold.

        Refused if another run has meanwhile replaced, or added to, what a staged table replaces. `layout` fixes
        numbers of buckets (`games.buckets`, `dim_games.key_buckets`); those of a table in use cannot be changed.
        """
        if not staged:
            return
        self.refresh()
        parts = {i.path: self.staged_months(i) if part_column(i.table) and not i.delta else [None] for i in staged}
        for item in staged:
            touched = [
                e
                for e in self._state.entries
                if e.table_name == item.table
                and (item.whole or item.delta or e.part in parts[item.path] or (e.part is None and item.table in BUCKETED))
            ]
            if (item.delta or not item.appended) and any(e.seq > item.base for e in touched):
                raise Overlap(f"run {run_id}: {item.table} has changed since state {item.base}")
            if item.table in BUCKETED and not (item.delta or item.whole or item.appended) and self.deltas(item.table):
                raise ValueError(f"{item.table} has deltas: its buckets are replaced together")
        self.check(staged)
        used = {t: self.buckets(t) for t in {i.table for i in staged} & BUCKETED.keys()}
        fixed = {f"{t}.buckets": n for t, n in used.items()} | (layout or {})
        for name, number in fixed.items():
            if self._state.layout.get(name, number) != number:
                raise ValueError(f"{name} is {self._state.layout[name]} already")
        seq = self._state.seq + 1
        state = self._state.after(seq, run_id, staged, parts, fixed)
        self._commit(run_id, state)
        self._state = state

    def _commit(self, run_id: str, state: State) -> None:
        """Write the state and give it its number, unless another publisher has taken that."""
        folder = f"{self.root}/_published"
        draft, name = (self._path(f"{folder}/{n}") for n in (f"draft-{uuid.uuid4().hex}", f"seq={state.seq}"))
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(state.to_json().encode()))
        finally:
            stream.close()
        jvm = self.spark._jvm
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            with _renaming:
                self._context.rename(draft, name, plain)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            self._files.delete(draft, False)
            raise Overlap(f"run {run_id}: another run has published state {state.seq}") from error

    # Upkeep -------------------------------------------------------------------------------

    def compact(self, table: str, part: int | None, run_id: str) -> None:
        """Write one month or bucket that several runs have added to as a single folder; deltas go into the buckets."""
        self.refresh()
        if self.is_published(run_id):
            return
        if self.deltas(table):
            self.publish(run_id, [self.stage(run_id, table, self.read(table))])
        elif len(self._live(table).get(part, [])) > 1:
            self.publish(run_id, [self.stage(run_id, table, self.read(table, [part]), whole=False)])

    def clean(self, states: int = 10) -> list[str]:
        """Remove run folders that none of the newest states names, older states and all intermediate results.

        Call it while no run is under way: what a run has staged is not named yet.
        """
        self.refresh()
        known = self._states()
        kept = known[-states:]
        named = {f"{e.table_name}/{e.path.split('/run=')[1].split('/')[0]}" for seq in kept for e in self._state_of(seq).entries}
        gone = [f"_published/seq={seq}" for seq in known if seq not in kept]
        gone += [f"_published/{n}" for n in self._names(f"{self.root}/_published") if n.startswith("draft-")]
        for table in SCHEMAS:
            for name in self._names(f"{self.root}/{table}"):
                if name.startswith("run=") and f"{table}/{name.removeprefix('run=')}" not in named:
                    gone.append(f"{table}/{name}")
        if self._names(f"{self.root}/_work"):
            gone.append("_work")
        for name in gone:
            self._files.delete(self._path(f"{self.root}/{name}"), True)
        return gone
