import math

import pytest
from pyspark.sql import functions as F

from skyjoin.operators import overlap, tiling


@pytest.fixture(scope="module")
def tiles(spark):
    return tiling.sky_tiling(spark).cache()


def test_numbers_of_the_survey(spark, tiles):
    row = tiles.agg(
        F.count("*").alias("n"), F.count_distinct("dec_row").alias("rows"), F.count_distinct("tilename").alias("names"),
        F.count_if(F.col("crossra0") == "Y").alias("crossing"), F.min("dec_cent").alias("south")).first()
    assert (row["n"], row["rows"], row["names"], row["crossing"]) == (60943, 162, 60943, 162)
    assert row["south"] == pytest.approx(-84.5361111, abs=1e-7)
    last = tiles.filter("dec_row = 161").agg(F.count("*"), F.median("ra_size")).first()
    assert last[0] == 53 and 7 < last[1] < 9
    assert tiling.inconsistent_tiles(tiles).count() == 0


def test_unique_bounds_close_the_circle(tiles):
    rows = tiles.filter("dec_row = 40").orderBy("ra_step").collect()
    assert rows[-1]["uramax"] == pytest.approx(rows[0]["uramin"], abs=1e-9)
    for a, b in zip(rows, rows[1:]):
        assert a["uramax"] == pytest.approx(b["uramin"], abs=1e-9)
    assert {"DES2246-4457", "DES0002+0001", "DES2359+0043"} <= {
        r["tilename"] for r in tiles.filter(F.col("tilename").isin("DES2246-4457", "DES0002+0001", "DES2359+0043")).collect()}


def test_home_tile_holds_the_position(spark, tiles):
    points = spark.range(3000).select(
        "id", F.round(F.rand(3) * 360, 4).alias("ra_cent"), F.round(F.rand(4) * 110 - 82, 4).alias("dec_cent"))
    home = tiling.home_tile(points)
    joined = home.join(tiles.select("dec_row", "ra_step", "uramin", "uramax", "udecmin", "udecmax"), ["dec_row", "ra_step"])
    rows = joined.collect()
    assert len(rows) == 3000
    for r in rows:
        ra, lo, hi = r["ra_cent"], r["uramin"], r["uramax"]
        inside = lo - 1e-9 <= ra <= hi + 1e-9 if lo <= hi else (ra >= lo - 1e-9 or ra <= hi + 1e-9)
        assert inside, r
        assert r["udecmin"] - 1e-9 <= r["dec_cent"]


def test_flat_tiling(spark):
    flat = tiling.flat_tiling(spark, tiling.TilingPlan(dec_end=-10.0))
    row = flat.filter("dec_row = 0 and ra_step = 0").first()
    width = 0.263 * 10000 / 3600
    assert row["decul"] == pytest.approx(30 + width / 2) and row["ra_cent"] == 275.0
    assert row["raur"] - row["raul"] == pytest.approx(width / math.cos(math.radians(30 + width / 2)))
    assert tiling.TilingPlan(dec_end=tiling.FLAT_DEC_END).rows()[-1][1] >= -89.99


def test_new_ids_follow_scan_order(spark):
    tiles = spark.createDataFrame(
        [("a", 0, 0), ("b", 0, 1), ("c", 0, 2), ("d", 1, 0), ("e", 1, 1), ("f", 2, 0)], "tilename string, dec_row int, ra_step int")
    known = spark.createDataFrame([("b", 7), ("d", 41)], "tilename string, id int")
    got = {r["tilename"]: (r["id"], r["is_new"]) for r in tiling.with_ids(tiles, known).collect()}
    assert got == {"a": (42, True), "b": (7, False), "c": (43, True), "d": (41, False), "e": (44, True), "f": (45, True)}
    none = spark.createDataFrame([], "tilename string, id int")
    assert sorted(r["id"] for r in tiling.with_ids(tiles, none).collect()) == [1, 2, 3, 4, 5, 6]


def test_compare_tiles(spark, tiles):
    some = tiles.filter("dec_row in (10, 100)")
    assert tiling.compare_tiles(some, some).count() == 0
    moved = some.withColumn("udecmax", F.col("udecmax") + F.when(F.col("ra_step") == 3, 1e-4).otherwise(0))
    rows = tiling.compare_tiles(some, moved).collect()
    assert [r["reason"] for r in rows] == ["udec", "udec"]
    assert tiling.compare_tiles(some, moved, tolerance=1e-3, scale_ra=False).count() == 0
    assert tiling.compare_tiles(some, some.filter("ra_step > 0")).filter("reason = 'missing'").count() == 2


def test_filters_stay_above_the_projection(spark):
    """A filter on derived columns does not repeat the projection's formulas."""
    df = tiling.sky_tiling(spark, tiling.TilingPlan(dec_end=20.0)).filter("ra_size > 180 or racmax < 1")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert not any("ATAN2" in c for c in conditions)
    assert df.count() > 0


def test_no_tile_spans_the_sky(tiles):
    """Tiles whose flag and corners disagree about RA = 0 keep their flag and have true sizes."""
    assert tiles.filter("ra_size > 180").count() == 0
    one = tiles.filter("tilename = 'DES2358+0917'").first()
    assert one["crossra0"] == "N" and one["racmin"] > one["racmax"] and one["ra_size"] == pytest.approx(0.74, abs=0.01)


def test_positions_outside_the_grid_stay(spark):
    home = tiling.home_tile(spark.createDataFrame([(1, 10.0, 89.0), (2, 10.0, 0.0)], "id int, ra_cent double, dec_cent double"))
    rows = {r["id"]: r for r in home.collect()}
    assert rows[1]["dec_row"] is None and rows[1]["ra_step"] is None and rows[2]["dec_row"] is not None


def test_generated_tiles_are_broadcast(spark):
    """Images are not exchanged for the join with the tile grid."""
    images = spark.range(100_000_000).select(
        F.col("id").alias("filename"), (F.col("id") % 360).cast("double").alias("ra_cent"), (F.col("id") % 60 - 50).cast("double").alias("dec_cent"),
        F.lit(0.25).alias("ra_size"), F.lit(0.125).alias("dec_size"))
    small = tiling.sky_tiling(spark).select("tilename", "ra_cent", "dec_cent", "ra_size", "dec_size")
    plan = overlap.overlap_join(images, small)._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "Exchange hashpartitioning" not in plan
    fine = tiling.TilingPlan(naxis=2000)
    assert fine.tiles() > tiling.BROADCAST_TILES > tiling.TilingPlan().tiles() == 60943
    large = tiling.sky_tiling(spark, fine).select("tilename", "ra_cent", "dec_cent", "ra_size", "dec_size")
    plan = overlap.overlap_join(images, large)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
