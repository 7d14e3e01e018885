"""Creating, filling and correcting stored tables."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyjoin.sources.staging import staged

log = logging.getLogger(__name__)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether ``table`` or ``owner.table`` is known to the catalogue."""
    return spark.catalog.tableExists(name)


def input_table_name(root: str, tag: str) -> str:
    return f"{root}_{tag}".lower()


def create_table(df: DataFrame, name: str, clobber: bool = False) -> bool:
    """Stores the frame as a table; an existing one is kept unless ``clobber``.

    The rows are written under another name first, and the tables change places only when all are there.
    So a frame may read the table that it replaces, and one that fails midway leaves it as it was.
    """
    spark = df.sparkSession
    exists = table_exists(spark, name)
    if exists and not clobber:
        log.warning("table %s exists; use clobber to replace it", name)
        return False
    owner, _, plain = name.rpartition(".")

    def beside(kind: str) -> str:
        return f"{owner}." * bool(owner) + f"{plain}__{kind}_{uuid.uuid4().hex}"

    new, old = beside("new"), beside("old")
    try:
        df.write.mode("errorifexists").saveAsTable(new)
        if exists:
            _rename(spark, name, old)
        try:
            _rename(spark, new, name)
        except Exception:
            if exists:
                _rename(spark, old, name)
            raise
    except Exception:
        spark.sql(f"drop table if exists {_quoted(new)}")
        raise
    if exists:
        spark.sql(f"drop table {_quoted(old)}")
    return True


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _rename(spark: SparkSession, name: str, other: str) -> None:
    spark.sql(f"alter table {_quoted(name)} rename to {_quoted(other)}")


def append_rows(df: DataFrame, name: str) -> None:
    """All rows in one job, matched to the table's columns by name.

    They are computed before the table is touched: a frame may read the table that it adds to, and one that
    fails midway adds nothing.
    """
    columns = df.sparkSession.table(name).columns
    staged(df.select(*columns), "append").write.mode("append").insertInto(name)


def upsert(base: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``base`` whose key is not in ``new``, and the rows of ``new``, one for each key."""
    new = one_per_key(new, key).select(*base.columns)
    return base.join(new.select(*key), key, "left_anti").unionByName(new)


def one_per_key(df: DataFrame, key: list[str]) -> DataFrame:
    """Of rows with one key the smallest, by all other columns in order; combined before the shuffle."""
    others = [c for c in df.columns if c not in key]
    if not others:
        return df.distinct()
    return df.groupBy(*key).agg(F.min(F.struct(*others)).alias("_row")).select(*key, "_row.*").select(*df.columns)


def update_columns(base: DataFrame, changes: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """``base`` with the named columns taken from ``changes`` where it has the key.

    Of changes with one key the smallest counts; a NULL there leaves the old value.
    """
    new = one_per_key(changes.select(*key, *[F.col(n).alias(f"_new_{n}") for n in names]), key)
    joined = base.join(new, key, "left")
    return joined.withColumns({n: F.coalesce(f"_new_{n}", n) for n in names}).select(*base.columns)


def lookup_tiles(tiles: DataFrame, names) -> DataFrame:
    """Tile rows by name: one name, a list of names, or a table of names."""
    if isinstance(names, str):
        return tiles.filter(F.col("tilename") == names)
    if isinstance(names, DataFrame):
        return tiles.join(names.select("tilename").distinct(), "tilename", "left_semi")
    return tiles.filter(F.col("tilename").isin(*names))
