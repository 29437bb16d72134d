"""What the operators share: tables, text pieces as native expressions, cutting lineage."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import checkpointed, scratch_root, settle  # noqa: F401

# The six characters of [\x20\x09-\x0D], as a set for trim() and as a Java pattern.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

# Columns of the table of documents, which every pipeline stage but the last returns.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


# Where Python workers find this package if it is not installed and they start in another folder.
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settle(spark)
    workers = spark.sparkContext.environment
    if ROOT not in (paths := workers.get("PYTHONPATH", "").split(os.pathsep)):
        workers["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than the six blanks, in order; an empty array where there is none."""
    return F.filter(F.split(text, BLANK_RUN), lambda w: w != "")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, read back, so that its true size is known to the planner."""
    folder = f"{scratch_root(df.sparkSession)}/{name}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def in_groups(texts: Iterable[bytes], size: int) -> Iterator[list[bytes]]:
    """The texts in order, grouped until they reach the size, at least one to a group."""
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group
