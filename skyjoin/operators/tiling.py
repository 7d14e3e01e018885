"""The all-sky tile grid, tile identifiers and consistency checks.

A handful of Dec rows follows from a recurrence; every tile of a row then has a closed
form, so the grid is one lazy plan over the row table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyjoin.functions import naming, sphere, wcs


@dataclass(frozen=True)
class TilingPlan:
    """Parameters of a tiling; the defaults are the fixed values of the survey."""

    pixelscale: float = 0.263
    naxis: int = 10000
    ra_ini: float = 275.0
    ra_range: float = 360.0
    dec_ini: float = 30.0
    dec_end: float = -85.0
    prefix: str = naming.TILE_PREFIX

    @property
    def width(self) -> float:
        return self.pixelscale * self.naxis / 3600.0

    def rows(self) -> list[tuple[int, float, float]]:
        """(row number, Dec, overlap) from the first row down to ``dec_end``."""
        out, dec = [], float(self.dec_ini)
        while dec >= self.dec_end or not out:
            overlap = sphere.tile_overlap_value(dec)
            out.append((len(out), dec, overlap))
            dec = dec - (self.width - overlap)
        return out


    def tiles(self) -> int:
        """Number of tiles of all rows."""
        return sum(math.ceil(self.ra_range / ((self.width - o) / math.cos(math.radians(dec)))) for _, dec, o in self.rows())


#: Tiles up to which a generated grid may be broadcast: some 100 MB with a few columns and three cells a tile.
BROADCAST_TILES = 500_000


def _sized(grid: DataFrame, plan: TilingPlan) -> DataFrame:
    """Spark takes a generated grid for tiny and would always broadcast it; a large one asks for a merge join."""
    return grid if plan.tiles() <= BROADCAST_TILES else grid.hint("merge")


def dec_rows(spark: SparkSession, plan: TilingPlan = TilingPlan()) -> DataFrame:
    """One row per Dec row: number, Dec, overlap, RA step and number of tiles.

    The rows are literals of one row: their number follows from the plan, not from data.
    """
    rows = _literals(spark, plan.rows(), ("dec_row", "dec_cent", "overlap"))
    step = (plan.width - F.col("overlap")) / F.cos(F.radians("dec_cent"))
    return rows.withColumn("ra_step_deg", step).withColumn(
        "n_tiles", F.ceil(F.lit(plan.ra_range) / F.col("ra_step_deg")).cast("int"))


def _literals(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _grid(spark: SparkSession, plan: TilingPlan) -> DataFrame:
    """Tile centres: RA before (``ra_run``) and after folding below 360."""
    df = dec_rows(spark, plan).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("ra_step"))
    df = df.withColumn("ra_run", F.lit(plan.ra_ini) + F.col("ra_step") * F.col("ra_step_deg"))
    run = F.col("ra_run")
    return df.withColumn("ra_cent", F.when(run > 360, run - 360).when(run < 0, run + 360).otherwise(run))


def _last(plan: TilingPlan) -> Column:
    if plan.ra_range < 360:
        return F.lit(False)
    return F.col("ra_step") == F.col("n_tiles") - 1


def sky_tiling(spark: SparkSession, plan: TilingPlan = TilingPlan()) -> DataFrame:
    """The tile table without identifiers: names, corners, sizes, unique bounds, header."""
    half = F.col("ra_step_deg") / 2
    first_left = F.lit(plan.ra_ini) - half

    def fold(x):
        return F.when(x > 360, x - 360).otherwise(x)

    df = _grid(spark, plan)
    df = df.withColumns({
        "uramin": fold(F.col("ra_run") - half),
        "uramax": F.when(_last(plan), first_left).otherwise(fold(F.col("ra_run") + half)),
        "udecmin": F.col("dec_cent") - (plan.width - F.col("overlap")) / 2,
        "udecmax": F.col("dec_cent") + (plan.width - F.col("overlap")) / 2,
        "pixelscale": F.lit(plan.pixelscale), "naxis1": F.lit(plan.naxis), "naxis2": F.lit(plan.naxis),
        "tilename": naming.tile_name(prefix=plan.prefix),
    })
    flag = sphere.crosses_ra0_by_bounds("uramin", "uramax", F.lit(plan.width), "dec_cent")
    df = wcs.with_tile_geometry(df, crossra0=flag)
    return _sized(df.drop("ra_run", "n_tiles", "overlap", "ra_step_deg"), plan)


# Fixed value: the older geometry runs on to the pole.
FLAT_DEC_END = -89.99


def flat_tiling(spark: SparkSession, plan: TilingPlan = TilingPlan(dec_end=FLAT_DEC_END)) -> DataFrame:
    """Older geometry: corners from half widths at the upper and lower Dec edge."""
    half, w = F.col("ra_step_deg") / 2, plan.width
    upper, lower = F.col("dec_cent") + w / 2, F.col("dec_cent") - w / 2
    upper_half = F.lit(w) / F.cos(F.radians(upper)) / 2
    lower_half = F.lit(w) / F.cos(F.radians(lower)) / 2
    run = F.col("ra_run")
    raw = {
        "raul": run - upper_half, "raur": run + upper_half,
        "rall": run - lower_half, "ralr": run + lower_half,
        "ural": run - half, "urau": run + half,
    }
    past = F.least(*raw.values()) > 360
    df = _grid(spark, plan)
    df = df.withColumns({name: F.when(past, x - 360).otherwise(x) for name, x in raw.items()})
    flat = df.withColumns({
        "urau": F.when(_last(plan), F.lit(plan.ra_ini) - half).otherwise(F.col("urau")),
        "decul": upper, "decur": upper, "decll": lower, "declr": lower,
        "udecl": F.col("dec_cent") - (w - F.col("overlap")) / 2,
        "udecu": F.col("dec_cent") + (w - F.col("overlap")) / 2,
        "pixelscale": F.lit(plan.pixelscale), "naxis1": F.lit(plan.naxis), "naxis2": F.lit(plan.naxis),
        "tilename": naming.tile_name(prefix=plan.prefix),
    }).select(
        "dec_row", "ra_step", "tilename", "ra_cent", "dec_cent", "pixelscale", "naxis1", "naxis2",
        "rall", "decll", "raul", "decul", "raur", "decur", "ralr", "declr",
        "ural", "urau", "udecl", "udecu",
    )
    return _sized(flat, plan)


def home_tile(df: DataFrame, plan: TilingPlan = TilingPlan(), ra: str = "ra_cent", dec: str = "dec_cent") -> DataFrame:
    """DEC_ROW and RA_STEP of the tile whose unique area holds each position.

    The row comes from the short row table, the step by arithmetic; both are NULL for
    positions outside the tiled declinations. The row table has about 180 / width rows, so it
    is joined by broadcast on one-degree Dec bands.
    """
    bounds, above = [], None
    for number, centre, overlap in plan.rows():
        half = (plan.width - overlap) / 2
        bounds.append((number, centre - half, centre + half if above is None else above))
        above = centre - half
    spark = df.sparkSession
    rows = dec_rows(spark, plan).select("dec_row", "ra_step_deg", "n_tiles").join(
        F.broadcast(_literals(spark, bounds, ("dec_row", "_lo", "_hi"))), "dec_row")
    rows = rows.select("*", F.explode(F.sequence(F.floor("_lo"), F.floor("_hi"))).alias("_band"))
    rows = rows.withColumnRenamed("_band", "_at")
    within = (F.floor(F.col(dec)) == F.col("_at")) & (F.col(dec) >= F.col("_lo")) & (F.col(dec) < F.col("_hi"))
    joined = df.join(F.broadcast(rows), within, "left")
    start = F.lit(plan.ra_ini) - F.col("ra_step_deg") / 2
    offset = F.pmod(F.col(ra) - start, F.lit(360.0))
    step = F.when(F.col("n_tiles").isNotNull(), F.least(F.floor(offset / F.col("ra_step_deg")), F.col("n_tiles") - 1)).cast("int")
    return joined.withColumn("ra_step", step).drop("_at", "_lo", "_hi", "ra_step_deg", "n_tiles")


# -- identifiers ---------------------------------------------------------------------------


def id_range(known: DataFrame, column: str = "id") -> DataFrame:
    return known.agg(F.min(column).alias("id_min"), F.max(column).alias("id_max"))


def with_ids(
    tiles: DataFrame, known: DataFrame, row: str = "dec_row", step: str = "ra_step",
) -> DataFrame:
    """ID from ``known`` (tilename, id); unknown tiles get max+1, +2, .. in scan order.

    Counts per cell of the tiling (Dec row and step), combined before the shuffle, give
    each cell its first number; numbering then goes on within the cell, in name order.
    The running sums see counts only: one row per Dec row, and one per step of a row.
    """
    joined = tiles.join(known.select("tilename", "id"), "tilename", "left")
    cells = joined.groupBy(row, step).agg(F.count_if(F.col("id").isNull()).alias("_n"))
    per_row = cells.groupBy(row).agg(F.sum("_n").alias("_n"))

    def before(order: str, *by: str):
        running = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(running), F.lit(0))

    row_offset = per_row.select(row, before(row).alias("_rows"))
    offsets = cells.select(row, step, before(step, row).alias("_steps")).join(row_offset, row)
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    in_cell = F.sum(F.when(F.col("id").isNull(), 1).otherwise(0)).over(
        Window.partitionBy(row, step).orderBy("tilename").rowsBetween(Window.unboundedPreceding, 0))
    joined = joined.join(offsets, [row, step])
    new_id = top + F.col("_rows") + F.col("_steps") + in_cell
    return (
        joined.withColumn("_new", new_id)
        .withColumns({"is_new": F.col("id").isNull(), "id": F.coalesce("id", "_new").cast("bigint")})
        .drop("_new", "_rows", "_steps")
    )


def inconsistent_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles whose unique bounds are out of order, with the reason."""
    bad_ra = (F.col("uramin") > F.col("uramax")) & (F.col("crossra0") == "N")
    bad_dec = F.col("udecmin") > F.col("udecmax")
    reasons = F.concat_ws(",", F.when(bad_ra, F.lit("ura")), F.when(bad_dec, F.lit("udec")))
    return tiles.filter(bad_ra | bad_dec).withColumn("reason", reasons)


# -- comparison with a stored tile table -------------------------------------------------------


def compare_tiles(new: DataFrame, stored: DataFrame, tolerance: float = 1e-5, scale_ra: bool = True) -> DataFrame:
    """Tiles whose centre or unique bounds differ from the stored ones.

    RA tolerance widens by 1/cos(dec) unless ``scale_ra`` is off (the older check, used
    with 1e-3). Stored unique bounds above 360 are folded first. Tiles without a stored
    row are reported with reason ``missing``.
    """
    names = ["ra_cent", "dec_cent", "uramin", "uramax", "udecmin", "udecmax"]
    s = stored.select("tilename", *[F.col(n).alias(f"s_{n}") for n in names])

    def fold(x):
        return F.when(x > 360, x - 360).otherwise(x)

    ra_tol = F.lit(tolerance) / F.cos(F.radians("s_dec_cent")) if scale_ra else F.lit(tolerance)
    stored_value = {n: fold(F.col(f"s_{n}")) if n.startswith("ura") and scale_ra else F.col(f"s_{n}") for n in names}
    diff = {n: F.abs(F.col(n) - stored_value[n]) for n in names}

    def beyond(ra_names, dec_names):
        return sphere.any_of([diff[n] > ra_tol for n in ra_names] + [diff[n] > tolerance for n in dec_names])

    missing = F.col("s_ra_cent").isNull()
    reason = F.concat_ws(
        ",", F.when(missing, F.lit("missing")),
        F.when(beyond(["ra_cent"], ["dec_cent"]), F.lit("centre")),
        F.when(beyond(["uramin", "uramax"], []), F.lit("ura")),
        F.when(beyond([], ["udecmin", "udecmax"]), F.lit("udec")),
    )
    return (
        new.join(s, "tilename", "left").withColumns({f"d_{n}": d for n, d in diff.items()})
        .withColumn("reason", reason).filter(F.col("reason") != "")
        .drop(*[f"s_{n}" for n in names])
    )


def compare_corners(computed: DataFrame, stored: DataFrame, key: str = "tilename") -> DataFrame:
    """Computed minus stored, corner by corner."""
    names = sphere.corner_names("rac") + sphere.corner_names("decc")
    s = stored.select(key, *[F.col(n).alias(f"s_{n}") for n in names])
    return computed.join(s, key).select(key, *[(F.col(n) - F.col(f"s_{n}")).alias(f"d_{n}") for n in names])
