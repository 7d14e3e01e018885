"""Comparing data products and checking table constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyjoin.operators import ordering, stats
from skyjoin.sources.staging import staged

# -- catalogues --------------------------------------------------------------------------


def _same(a: Column, b: Column, dtype: T.DataType, nan_equal: bool) -> Column:
    """Equality of one cell; NaN differs from NaN unless ``nan_equal``."""
    same = a.eqNullSafe(b)
    if nan_equal:
        return same
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return same & ~F.coalesce(F.isnan(a), F.lit(False))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.DoubleType, T.FloatType)):
        return same & ~F.coalesce(F.exists(a, F.isnan), F.lit(False))
    return same


def column_names_differ(a: DataFrame, b: DataFrame) -> list[str]:
    return sorted({c.lower() for c in a.columns} ^ {c.lower() for c in b.columns})


def compare_catalogs(a: DataFrame, b: DataFrame, key: list[str], nan_equal: bool = False) -> DataFrame:
    """One row per column of ``a``: how many rows differ, and whether it passes.

    Rows pair up by ``key``; a row with no partner differs in every column. A column that
    only one side has does not pass. The row with column ``*`` gives the overall result.
    """
    names = [f for f in a.schema.fields if f.name not in key]
    other = {c.lower() for c in b.columns}
    shared = [f for f in names if f.name.lower() in other]
    left = a.select(*key, F.struct(F.lit(1).alias("_in"), *[F.col(f.name) for f in shared]).alias("a"))
    right = b.select(*key, F.struct(F.lit(1).alias("_in"), *[F.col(f.name) for f in shared]).alias("b"))
    joined = left.join(right, key, "full_outer")
    lonely = F.col("a").isNull() | F.col("b").isNull()
    counts = [
        F.count_if(lonely | ~_same(F.col(f"a.{f.name}"), F.col(f"b.{f.name}"), f.dataType, nan_equal)).alias(f.name)
        for f in shared
    ]
    row = joined.agg(F.count_if(lonely).alias("*key"), *counts)
    entries = [F.struct(F.lit("+".join(key)).alias("column"), F.col("`*key`").alias("n_different"), (F.col("`*key`") == 0).alias("is_equal"))]
    for f in shared:
        n = F.col(f"`{f.name}`")
        entries.append(F.struct(F.lit(f.name).alias("column"), n.alias("n_different"), (n == 0).alias("is_equal")))
    for name in column_names_differ(a, b):
        entries.append(F.struct(F.lit(name).alias("column"), F.lit(None).cast("bigint").alias("n_different"), F.lit(False).alias("is_equal")))
    everything = reduce(lambda x, y: x & y, [e.getField("is_equal") for e in entries])
    total = F.struct(F.lit("*").alias("column"), F.lit(None).cast("bigint").alias("n_different"), everything.alias("is_equal"))
    return row.select(F.explode(F.array(*entries, total)).alias("e")).select("e.*")


def compare_catalogs_by_row(a: DataFrame, b: DataFrame, order: list[str] | None = None, nan_equal: bool = False) -> DataFrame:
    """``compare_catalogs`` of tables without a key: rows pair up by their number.

    Rows are numbered in the order of ``order``, which both tables must have and which should be complete, or,
    without one, as the Parquet files that the tables were read from hold them. The row with column ``row``
    counts the rows that one table has more; they differ in every column, too.
    """
    number = "row"
    sides = [ordering.with_position(t, order, number) if order else ordering.with_stored_position(t, number) for t in (a, b)]
    return compare_catalogs(*sides, [number], nan_equal)


# -- image planes ---------------------------------------------------------------------------

PIXEL = ["file", "hdu", "y", "x"]


def plane_difference(a: DataFrame, b: DataFrame, value: str = "value") -> DataFrame:
    """Pixel by pixel first minus second plane; NULL where only one plane has the pixel."""
    other = b.select(*PIXEL, F.col(value).alias("_b"))
    return a.join(other, PIXEL, "full_outer").select(*PIXEL, (F.col(value) - F.col("_b")).alias("diff"))


def plane_statistics(difference: DataFrame) -> DataFrame:
    """Per file and HDU: pixels, those in one plane only, differing pixels, their share and statistics.

    Minimum, maximum, mean and median are those of the differences other than zero. All
    follow from the counts of each difference, which are stored: the planes are joined once.
    """
    keys = ["file", "hdu"]
    counted = staged(difference.groupBy(*keys, "diff").agg(F.count(F.lit(1)).alias("n")), "differences")
    differs = F.col("diff") != 0
    d, n = F.when(differs, F.col("diff")), F.when(differs, F.col("n")).otherwise(F.lit(0))
    base = counted.groupBy(*keys).agg(
        F.sum("n").alias("n_pix"), F.sum(F.when(F.col("diff").isNull(), F.col("n")).otherwise(F.lit(0))).alias("n_unpaired"),
        F.sum(n).alias("n_diff"), (F.sum(n) / F.sum("n")).alias("fraction"),
        F.min(d).alias("diff_min"), F.max(d).alias("diff_max"), F.try_divide(F.sum(d * n), F.sum(n)).alias("diff_mean"),
    )
    median = stats.median_of_counts(counted, keys, "diff", "diff_median", weight=n)
    return base.join(median.drop("upper_diff_median"), keys, "left")


def missing_pairs(pairs: DataFrame, inventory: DataFrame, first: str = "file1", second: str = "file2", name: str = "filename") -> DataFrame:
    """Pairs of a list with at least one file absent from the inventory."""
    have = inventory.select(name).distinct()
    a = have.select(F.col(name).alias(first), F.lit(True).alias("exists1"))
    b = have.select(F.col(name).alias(second), F.lit(True).alias("exists2"))
    joined = pairs.join(a, first, "left").join(b, second, "left")
    return joined.select(
        first, second,
        F.coalesce("exists1", F.lit(False)).alias("exists1"), F.coalesce("exists2", F.lit(False)).alias("exists2"),
    ).filter(~(F.col("exists1") & F.col("exists2")))


def existing_pairs(pairs: DataFrame, inventory: DataFrame, first: str = "file1", second: str = "file2", name: str = "filename") -> DataFrame:
    """Pairs whose files are both in the inventory."""
    have = inventory.select(name)
    return (
        pairs.join(have, F.col(first) == have[name], "left_semi")
        .join(have, F.col(second) == have[name], "left_semi")
    )


def mask_by_plane(image: DataFrame, mask: DataFrame) -> DataFrame:
    """Pixel value times the mask's value at the same (y, x); NULL where the mask has no pixel."""
    m = mask.select("y", "x", F.col("value").alias("_m"))
    return image.join(m, ["y", "x"], "left").select(*PIXEL, (F.col("value") * F.col("_m")).alias("value"))


def mask_by_rectangles(image: DataFrame, rectangles: DataFrame, cell: int = 64) -> DataFrame:
    """Pixels inside any rectangle [x1, x2) x [y1, y2) keep their value, others become 0.

    Rectangles are cut into square cells and met on the cell, so the test is a hash join
    whatever their number; one pass asks of each pixel whether there is one.
    """
    # rectangles can be long in one axis only: number the cells by row of cells
    def span(lo, hi):
        return F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor((F.col(hi) - 1) / cell)))

    r = rectangles.filter((F.col("x1") < F.col("x2")) & (F.col("y1") < F.col("y2")))
    r = r.select("x1", "x2", "y1", "y2", span("y1", "y2").alias("_cy"))
    r = r.select("*", span("x1", "x2").alias("_cx"))
    i = image.withColumns({"_py": F.floor(F.col("y") / cell), "_px": F.floor(F.col("x") / cell)})
    met = r.where(
        (F.col("_py").outer() == F.col("_cy")) & (F.col("_px").outer() == F.col("_cx"))
        & (F.col("x").outer() >= F.col("x1")) & (F.col("x").outer() < F.col("x2"))
        & (F.col("y").outer() >= F.col("y1")) & (F.col("y").outer() < F.col("y2")))
    blank = F.lit(0).cast(image.schema["value"].dataType)
    return i.withColumn("_in", met.exists()).select(*PIXEL, F.when(F.col("_in"), F.col("value")).otherwise(blank).alias("value"))


# -- configurations ---------------------------------------------------------------------------


def config_difference(new: DataFrame, reference: DataFrame) -> DataFrame:
    """Keys of the new configuration whose value differs from or misses in the reference."""
    ref = reference.select("key", F.col("value").alias("value_ref"))
    joined = new.select("key", F.col("value").alias("value_new")).join(ref, "key", "left")
    return joined.filter(~F.col("value_new").eqNullSafe(F.col("value_ref")))


# -- constraints --------------------------------------------------------------------------------


def constraint_violations(
    df: DataFrame, not_null: list[str] = [], unique: list[list[str]] = [], checks: dict[str, Column] = {},
) -> DataFrame:
    """Rows (kind, name, key, n) for every broken constraint.

    NOT NULL and CHECK conditions share one pass; each unique key costs one aggregation,
    combined on the map side, so a key with very many copies is no burden. A CHECK holds
    where its condition is true or NULL.
    """
    out = []
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [("check", name, ~F.coalesce(condition, F.lit(True))) for name, condition in checks.items()]
    if tests:
        row = df.agg(*[F.count_if(bad).alias(f"_{k}") for k, (_, _, bad) in enumerate(tests)])
        entries = F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"),
                     F.lit(None).cast("string").alias("key"), F.col(f"_{k}").alias("n"))
            for k, (kind, name, _) in enumerate(tests)
        ])
        out.append(row.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("n") > 0))
    for key in unique:
        repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        out.append(repeated.select(
            F.lit("unique").alias("kind"), F.lit("+".join(key)).alias("name"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in key]).alias("key"), "n"))
    if not out:
        raise ValueError("no constraint given")
    return reduce(DataFrame.unionByName, out)


def require_non_empty(df: DataFrame, message: str = "no rows") -> DataFrame:
    """The frame itself; raises where it has no rows (asks for one row only)."""
    if df.isEmpty():
        raise ValueError(message)
    return df
