"""Declared constraints as checks: each returns the violations, empty when all is well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


class CheckFailed(ValueError):
    """A constraint does not hold; nothing was published."""


def unique_violations(df: DataFrame, keys: list[str], stored: DataFrame | None = None) -> DataFrame:
    """Keys that occur more than once, and how often. Counted map-side, so a hot key is one row.

    With `stored` rows, which are counted along in the same shuffle, keys of `df` that occur more than once in both
    together. Rows with a NULL key part are left out: a unique constraint lets NULLs repeat.
    """
    present = df.dropna(subset=keys)
    if stored is None:
        return present.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    old = stored.dropna(subset=keys).select(*keys, F.lit(0).alias("new"))
    both = present.select(*keys, F.lit(1).alias("new")).unionByName(old)
    counted = both.groupBy(*keys).agg(F.count("*").alias("n"), F.max("new").alias("new"))
    return counted.filter((F.col("n") > 1) & (F.col("new") == 1)).drop("new")


def _per_column(df: DataFrame, aggregates: dict[str, list], names: list[str]) -> DataFrame:
    """One pass over `df`, one result row per column with at least one violation."""
    rows = [
        F.struct(F.lit(column).alias("column"), *[a.alias(n) for a, n in zip(values, names)])
        for column, values in aggregates.items()
    ]
    result = df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    return result.filter(F.col(names[0]) > 0)


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Required columns holding NULLs: column, n."""
    return _per_column(df, {c: [F.count_if(F.col(c).isNull())] for c in columns}, ["n"])


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Text longer than declared: column, n, longest."""
    return _per_column(
        df,
        {
            c: [F.count_if(F.char_length(c) > limit), F.max(F.char_length(c))]
            for c, limit in limits.items()
        },
        ["n", "longest"],
    )


def range_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers that do not fit 32 bits: column, n."""
    return _per_column(
        df, {c: [F.count_if(~F.col(c).between(INT_MIN, INT_MAX))] for c in columns}, ["n"]
    )


def reference_violations(
    child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None
) -> DataFrame:
    """Child keys without a parent row, and how many rows carry each: `column`, n.

    The child is counted by key before the join, so a key holding a third of the rows is one row.
    NULL references are allowed.
    """
    parents = parent.select(F.col(parent_column or column).alias(column))
    counted = child.dropna(subset=[column]).groupBy(column).agg(F.count("*").alias("n"))
    return counted.join(parents, column, "left_anti")


def required_violations(parsed: DataFrame, columns: tuple[str, ...] = ("appid", "name", "ccu")):
    """Parsed rows lacking a required field, with the first field missing."""
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return parsed.withColumn("missing", missing).filter(F.col("missing").isNotNull())


def cascade_delete(child: DataFrame, deleted: DataFrame, keys: list[str]) -> DataFrame:
    """What is left of `child` once the parents in `deleted` are gone."""
    return child.join(deleted.select(*keys).distinct(), keys, "left_anti").select(*child.columns)


def require_none(violations: DataFrame, what: str, show: int = 5) -> None:
    """Fail the load, naming the first few violations."""
    found = violations.limit(show).collect()
    if found:
        raise CheckFailed(f"{what}: {[row.asDict() for row in found]}")
