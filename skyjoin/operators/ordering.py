"""Ordered results: a complete order, and each row's place in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyjoin.sources.staging import staged


def ordered(df: DataFrame, keys: list[str], ties: list[str] = ["filename"]) -> DataFrame:
    """Rows in the order of ``keys``; ``ties`` make it complete. Spark sorts by ranges, in all tasks."""
    return df.orderBy(*keys, *ties)


def with_position(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """Place of each row, from 1, in the order of ``order``.

    Ranges of the order are sorted by one task each and stored, which is the only time that
    ``df`` is computed beside the sample that the ranges come from. A stored file is one
    range, so a row's place is its number in the file after the rows of the files before
    it; these are counted from file footers, one row a file. The ranges come from the data:
    a complete order keeps them even, whatever its first columns are like. Rows alike in all
    of ``order`` follow each other in no set order. Reads rows by file and number, so a
    column of ``df`` can't be called ``_metadata``.
    """
    return with_stored_position(staged(df.repartitionByRange(*order).sortWithinPartitions(*order), "ordered"), name)


def with_stored_position(stored: DataFrame, name: str = "position") -> DataFrame:
    """Place of each row, from 1, of a table read from Parquet files, as the files hold them.

    Files follow each other by folder, by the number of the task that wrote them and by the number of
    the file among that task's; files not written by Spark come first in their folder, by name.
    """
    path, file = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    # part-<task>-<job>-c<number>: a task may cut its rows into several files
    numbers = [F.regexp_extract(file, pattern, 1).try_cast("int") for pattern in (r"^part-(\d+)", r"-c(\d+)\.")]
    cut = F.struct(F.regexp_replace(path, r"[^/]*$", ""), *numbers, path)
    before = Window.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    files = stored.groupBy(path.alias("_file"), cut.alias("_cut")).agg(F.count(F.lit(1)).alias("_n"))
    first = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    rows = stored.withColumns({"_name": path, "_row": F.col("_metadata.row_index")})
    # a row for each stored file
    placed = rows.join(F.broadcast(first), F.col("_name") == F.col("_file"))
    return placed.select(*[F.col(f"`{c}`") for c in stored.columns], (F.col("_first") + F.col("_row") + 1).alias(name))
