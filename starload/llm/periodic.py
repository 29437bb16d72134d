"""Periodic runs of words, found in a grammar of the texts.

A run is a stretch of words with smallest period q (words q apart are identical) that no neighbour extends, at least
LEAST words and POWER periods long.

1. Re-Pair: the words of a group of texts become numbers, and pairs of neighbours that a text holds twice or more are
   replaced by a new symbol, the most frequent first; each round replaces side by side all pairs that are more frequent
   than the pairs they overlap. What is left of a text is paired in a balanced tree. So every stretch of two or more words
   of a text crosses the boundary between the two halves of just one node above it, within that node.
2. Each rule, however often it is used, is looked at once, where it first stands: a run of POWER = 4 periods that crosses
   the boundary has two periods on one side of it, which is a square that starts or ends there. Squares are told by
   hashes of prefixes, the shortest of each family is kept (multiples of its period inside the same run say nothing new),
   and both ends are found by bisection.
3. The runs are carried to every place where a rule stands, down from the texts through rules that have any, and of one
   period only those not inside another are kept. Each is then held against the words themselves, its ends included.

Tasks hold one group of texts at a time, some BATCH bytes or one longer text. Work and memory of a text of n words are in
proportion to n log n, also where all its words are equal. Nothing is shuffled.

Defined results: a null or empty text has no words, no run and the empty collapsed text; the run with the greatest exact
length / period is the best, of equal ones the one that starts first, then the one with the smaller period; rows are
kept as often as they come; an empty table gives an empty result; of further columns only those named are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import in_groups, whole_text, words

LEAST = 6  # words
POWER = 4  # periods; the search for squares relies on four or more
BATCH = 1 << 20  # bytes of text compressed together
AT_ONCE = 1 << 21  # candidates held at a time
PRIMES = (2147483647, 2147483629)
TRIES = 5

RUN = "struct<start:bigint,length:bigint,period:bigint>"


@dataclass
class Grammar:
    """Rules in order; the children of a rule are words (below `terminals`) or earlier rules (number + terminals)."""

    terminals: int
    left: np.ndarray
    right: np.ndarray
    at: np.ndarray  # where the text of a rule first stands
    size: np.ndarray  # in words
    middle: np.ndarray  # words in its left half
    rounds: list[tuple[int, int]]  # the rules made together
    roots: np.ndarray  # top symbol of each text with words
    root_at: np.ndarray


class _Builder:
    def __init__(self, numbers: np.ndarray):
        self.terminals = int(numbers.max(initial=-1)) + 1
        self.sizes = np.ones(self.terminals, np.int64)
        self.rules: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rounds: list[tuple[int, int]] = []

    def replace(self, symbols, at, text, chosen, shared: bool):
        """One symbol for each chosen pair of neighbours; equal pairs get the same one if shared."""
        a, b = symbols[chosen], symbols[chosen + 1]
        if shared:
            codes, _ = pd.factorize(a << 32 | b)
            first = np.empty(codes.max() + 1, np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
        else:
            codes = first = np.arange(len(chosen))
        before = len(self.sizes)
        self.rules.append((a[first], b[first], at[chosen[first]]))
        self.rounds.append((before - self.terminals, before - self.terminals + len(first)))
        self.sizes = np.concatenate([self.sizes, self.sizes[a[first]] + self.sizes[b[first]]])
        symbols = symbols.copy()
        symbols[chosen] = before + codes
        stays = np.ones(len(symbols), bool)
        stays[chosen + 1] = False
        return symbols[stays], at[stays], text[stays]


def _repeated_pairs(symbols: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places of pairs that their text holds twice or more and that come before the pairs they overlap."""
    inside = np.flatnonzero(text[1:] == text[:-1])
    if not len(inside):
        return inside
    pair, _ = pd.factorize(symbols[inside] << 32 | symbols[inside + 1])
    pair, _ = pd.factorize(pair.astype(np.int64) << 32 | text[inside])
    often = np.bincount(pair)
    rank = np.full(len(symbols), -1, np.int64)  # of the pair that starts here: first by its count
    rank[inside] = np.where(often[pair] > 1, often[pair] * len(often) + pair, -1)
    # In a row of one symbol the same pair overlaps itself: every second one counts.
    place = np.arange(len(symbols))
    again = np.zeros(len(symbols), bool)
    again[1:] = (rank[1:] == rank[:-1]) & (rank[1:] >= 0)
    offset = place - np.maximum.accumulate(np.where(again, 0, place))
    rank[offset % 2 == 1] = -1
    wins = rank >= 0
    wins[1:] &= rank[1:] > rank[:-1]
    wins[:-1] &= rank[:-1] > rank[1:]
    return np.flatnonzero(wins)


def grammar(numbers: np.ndarray, text: np.ndarray) -> Grammar:
    """Of the words of several texts in a row (text: which one, ascending)."""
    build = _Builder(numbers)
    symbols, at, done = numbers.astype(np.int64), np.arange(len(numbers)), []
    while len(symbols):
        chosen = _repeated_pairs(symbols, text)
        live = np.isin(text, np.unique(text[chosen]))
        done.append((symbols[~live], at[~live], text[~live]))
        if not len(chosen):
            break
        stays = np.delete(live, chosen + 1)
        symbols, at, text = (x[stays] for x in build.replace(symbols, at, text, chosen, True))
    symbols, at, text = map(np.concatenate, zip(*done)) if done else (symbols, at, text)
    order = np.argsort(at)
    symbols, at, text = symbols[order], at[order], text[order]
    while True:
        place = np.arange(len(symbols))
        first = np.ones(len(symbols), bool)
        first[1:] = text[1:] != text[:-1]
        offset = place - np.maximum.accumulate(np.where(first, place, 0))
        chosen = np.flatnonzero((offset[:-1] % 2 == 0) & ~first[1:])
        if not len(chosen):
            break
        symbols, at, text = build.replace(symbols, at, text, chosen, False)
    none = np.empty(0, np.int64)
    left, right, places = map(np.concatenate, zip(*build.rules)) if build.rules else (none, none, none)
    sizes = build.sizes
    return Grammar(
        build.terminals, left, right, places, sizes[build.terminals :], sizes[left], build.rounds, symbols, at
    )


class Prefixes:
    """Tells whether two stretches of the words are equal, by polynomial hashes with two moduli."""

    def __init__(self, numbers: np.ndarray, seed: int):
        draw = np.random.default_rng(seed)
        self.hashes, self.powers = [], []
        for prime in PRIMES:
            powers = np.ones(1, np.int64)
            step = int(draw.integers(1 << 20, prime))
            while len(powers) <= len(numbers):
                powers = np.concatenate([powers, powers * step % prime])
                step = step * step % prime
            value = draw.integers(1, prime, int(numbers.max(initial=0)) + 1)
            terms = value[numbers] * powers[: len(numbers)] % prime
            self.hashes.append(np.concatenate([[0], np.cumsum(terms) % prime]))
            self.powers.append(powers)

    def equal(self, i: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Are the n words from i the same as those from i + q?"""
        same = np.ones(len(i), bool)
        for h, powers, prime in zip(self.hashes, self.powers, PRIMES):
            here, there = (h[i + n] - h[i]) % prime, (h[i + q + n] - h[i + q]) % prime
            same &= here * powers[q] % prime == there
        return same

    def reach(self, i: np.ndarray, q: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words from i on (step 1) or up to i (step -1) are the same q words on, at most `most`."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            n = (low[open_] + high[open_] + 1) // 2
            start = i[open_] if step > 0 else i[open_] - n
            same = self.equal(start, q[open_], n)
            low[open_] = np.where(same, n, low[open_])
            high[open_] = np.where(same, high[open_], n - 1)
        return low


def _squares(numbers: np.ndarray, prefixes: Prefixes, boundary: np.ndarray, most: np.ndarray, side: int):
    """(rule, q) by rule and q: a square of period q, at most `most`, starts (side 1) or ends (-1) at the boundary."""
    ends = np.cumsum(most)
    total = int(ends[-1]) if len(ends) else 0
    rules, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, total, AT_ONCE):
        until = min(at + AT_ONCE, total)
        lo, hi = np.searchsorted(ends, at, "right"), np.searchsorted(ends, until - 1, "right") + 1
        upto = np.minimum(ends[lo:hi], until)
        from_ = np.maximum(ends[lo:hi] - most[lo:hi], at)
        rule = np.repeat(np.arange(lo, hi), upto - from_)
        q = np.arange(at, until) - np.repeat(ends[lo:hi] - most[lo:hi], upto - from_) + 1
        edge = boundary[rule] - (side < 0)
        close = numbers[edge] == numbers[edge + side * q]
        rule, q = rule[close], q[close]
        start = boundary[rule] if side > 0 else boundary[rule] - 2 * q
        same = prefixes.equal(start, q, q)
        rules.append(rule[same])
        periods.append(q[same])
    return np.concatenate(rules), np.concatenate(periods)


def boundary_runs(numbers: np.ndarray, prefixes: Prefixes, found: Grammar, least: int, power: int) -> np.ndarray:
    """Columns rule, start (from where the rule stands), length, period of the runs that cross each rule's boundary."""
    rows = [np.empty((4, 0), np.int64)]
    for side in (1, -1):
        half = found.size - found.middle if side > 0 else found.middle
        most = np.where(found.size >= least, np.minimum(half // 2, found.size // power), 0)
        rule, q = _squares(numbers, prefixes, found.at + found.middle, most, side)
        while len(rule):
            first = np.ones(len(rule), bool)
            first[1:] = rule[1:] != rule[:-1]
            r, p = rule[first], q[first]  # the shortest left of each rule
            at, end = found.at[r], found.at[r] + found.size[r]
            edge = at + found.middle[r]
            turn = edge if side > 0 else edge - p  # words match p on, around here
            start = turn - prefixes.reach(turn, p, turn - at, -1)
            stop = turn + p + prefixes.reach(turn, p, end - turn - p, 1)
            good = (start < edge) & (stop > edge) & (stop - start >= np.maximum(least, power * p))
            rows.append(np.stack([r, start - at, stop - start, p])[:, good])
            group = np.cumsum(first) - 1
            inside = q * 2 <= (stop - edge if side > 0 else edge - start)[group]
            over = first | (inside & (q % p[group] == 0))
            rule, q = rule[~over], q[~over]
    runs = np.concatenate(rows, axis=1)
    runs = runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]
    new = np.ones(runs.shape[1], bool)  # of one stretch the smallest period
    new[1:] = (runs[:3, 1:] != runs[:3, :-1]).any(axis=0)
    return runs[:, new]


def _everywhere(found: Grammar, runs: np.ndarray) -> np.ndarray:
    """Columns start, end, period of the runs at all places of their rules, only those not inside another."""
    count = len(found.size)
    low, high = (np.searchsorted(runs[0], np.arange(count), side) for side in ("left", "right"))
    holds = high > low
    below = lambda child: (child >= found.terminals) & holds[np.maximum(child - found.terminals, 0)]
    for lo, hi in found.rounds:
        holds[lo:hi] |= below(found.left[lo:hi]) | below(found.right[lo:hi])
    rows = [np.empty((3, 0), np.int64)]
    symbol, at = found.roots, found.root_at
    while len(symbol):
        kept = below(symbol) if count else np.zeros(len(symbol), bool)
        rule, at = symbol[kept] - found.terminals, at[kept]
        own = high[rule] - low[rule]
        place = np.repeat(at, own)
        which = np.repeat(low[rule], own) + np.arange(len(place)) - np.repeat(np.cumsum(own) - own, own)
        start = place + runs[1][which]
        rows.append(np.stack([start, start + runs[2][which], runs[3][which]]))
        symbol = np.concatenate([found.left[rule], found.right[rule]])
        at = np.concatenate([at, at + found.middle[rule]])
    placed = np.concatenate(rows, axis=1)
    placed = placed[:, np.lexsort((-placed[1], placed[0], placed[2]))]
    if placed.shape[1]:
        top = int(placed[1].max()) + 1
        period = pd.factorize(placed[2])[0].astype(np.int64)  # ascending, as the columns are
        reached = np.maximum.accumulate(period * top + placed[1])
        outer = np.ones(placed.shape[1], bool)
        outer[1:] = period[1:] * top + placed[1][1:] > reached[:-1]
        placed = placed[:, outer]
    return placed[:, np.lexsort((placed[2], placed[0]))]


def _holds(numbers: np.ndarray, text: np.ndarray, placed: np.ndarray) -> bool:
    """Do the words repeat as the runs say, and do the runs end where they must?"""
    start, end, q = placed
    for a, b, p in zip(start.tolist(), end.tolist(), q.tolist()):
        if not np.array_equal(numbers[a : b - p], numbers[a + p : b]):
            return False
    before, after = np.maximum(start - 1, 0), np.minimum(end, len(numbers) - 1)
    longer = (start > 0) & (text[before] == text[start]) & (numbers[before] == numbers[before + q])
    longer |= (end < len(numbers)) & (text[after] == text[start]) & (numbers[after] == numbers[after - q])
    return not longer.any()


def find(numbers: np.ndarray, text: np.ndarray, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """Columns start, end, period of all runs of several texts in a row, by start, then period."""
    if power < POWER:
        raise ValueError(f"runs of fewer than {POWER} periods cannot be found")
    if not len(numbers):
        return np.empty((3, 0), np.int64)
    found = grammar(numbers, text)
    for seed in range(TRIES):
        placed = _everywhere(found, boundary_runs(numbers, Prefixes(numbers, seed), found, least, power))
        if _holds(numbers, text, placed):
            return placed
    raise RuntimeError("hashes of different words agree")


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Of (start, length, period) by start, then period, the first with the greatest exact length / period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _of_group(texts: list[bytes], least: int, power: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Runs, best run and collapsed text of each text."""
    split = [t.split() for t in texts]  # of bytes: the six blanks only
    number = dict.fromkeys(chain.from_iterable(split))
    for k, word in enumerate(number):
        number[word] = k
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    total = int(sizes.sum())
    numbers = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, total)
    text = np.repeat(np.arange(len(split)), sizes)
    start, end, period = find(numbers, text, least, power)
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    gone = np.cumsum(change[:-1]) > 0
    first = np.cumsum(sizes) - sizes
    home = text[start]
    offsets = np.searchsorted(home, np.arange(len(split) + 1))
    columns = start - first[home], end - start, period
    names = ["start", "length", "period"]
    runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
    collapsed, best = [], []
    for k, own in enumerate(split):
        lo, hi = offsets[k], offsets[k + 1]
        if hi > lo:
            lost = gone[first[k] : first[k] + sizes[k]]
            own = [own[i] for i in np.flatnonzero(~lost)]
            best.append(dict(zip(names, best_of(list(zip(*(c[lo:hi].tolist() for c in columns)))))))
        else:
            best.append(None)
        collapsed.append(b" ".join(own))
    listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)
    return listed, pa.array(best, runs.type), pa.array(collapsed, pa.binary()).cast(pa.string())


def runs(docs: DataFrame, keep: list[str], text: str = "text", least: int = LEAST, power: int = POWER) -> DataFrame:
    """The kept columns, then runs (start, length and period in words, by start, then period), best (one of them, or
    null) and collapsed: the words, joined by one space, without those that any run holds after its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in in_groups((x.as_py() or b"" for x in batch.column(len(keep)).cast(pa.binary())), BATCH):
                columns = [batch.column(k).slice(at, len(group)) for k in range(len(keep))]
                at += len(group)
                yield pa.record_batch([*columns, *_of_group(group, least, power)], schema.names)

    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"))
    run_type = T._parse_datatype_string(RUN)
    schema = T.StructType(picked.schema.fields[:-1]).add("runs", T.ArrayType(run_type)).add("best", run_type).add("collapsed", "string")
    return picked.mapInArrow(run, schema)


def with_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; of a tenth of the ids (by crc32) the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    df = docs.select("doc_id", whole_text().alias("text"), h.alias("h"))
    df = df.withColumn("words", F.when(F.col("h") % 10 == 0, words(F.col("text"))))
    df = df.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    df = df.withColumn("a", F.when(F.col("n") > 0, F.pmod(F.col("g"), F.col("n"))).cast("int"))
    df = df.withColumn("p", (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    turned = F.transform(
        "words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + F.pmod(i - F.col("a"), F.col("p"))))
    )
    return df.select("doc_id", F.when(F.col("n") > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))
