import math
import random

import pytest
from pyspark.sql import functions as F

from skyjoin.operators import quality
from skyjoin.plans import builders, lineage, select
from tests_support import images_and_tile  # noqa: F401  (fixture)


def names(df):
    return sorted(r["filename"] for r in df.select("filename").collect())


def test_zero_points_and_blacklist(spark, images_and_tile):
    images, tile = images_and_tile
    zp = spark.createDataFrame([
        ("a", "FGCM", "v2.0", 0, 30.0), ("a", "FGCM", "v2.0", 3, 31.0), ("b", "FGCM", "v2.0", 16, 30.0),
        ("c", "PGCM", "v2.0", 0, 30.0), ("d", "FGCM", "v2.0", 15, 30.0)],
        "imagename string, source string, version string, flag int, mag_zero double")
    black = spark.createDataFrame([(1, 2, "bad"), (1, 2, "worse")], "expnum long, ccdnum int, reason string")
    got = select.select_inputs(tile, images, zeropoint=zp, blacklist=black)
    assert names(got) == ["a", "a"]  # two zero points fan out; b has a flag, c another source, d is blacklisted
    assert names(select.select_inputs(tile, images, zeropoint=zp)) == ["a", "a", "d"]
    assert names(select.without_zeropoint(images, zp)) == ["b", "c", "far"]
    assert names(select.select_inputs(tile, images, blacklist=black)) == ["a", "b", "c"]
    assert names(select.select_inputs(tile, images, ccdnum=2)) == ["d"]
    assert names(select.exclude_by_name(images, black, images)) == ["a", "b", "c", "far"]
    assert {r["compression"] for r in got.collect()} == {""}


def test_extras(spark, images_and_tile):
    images, tile = images_and_tile
    tags = spark.createDataFrame([("a", "SN"), ("c", "SN"), ("c", "OTHER")], "filename string, tag string")
    assert names(select.select_inputs(tile, select.with_tag(images, tags, "SN"))) == ["a", "c"]
    extras = select.Extras(select=[F.lit(1).alias("one")], joins=[(tags.filter("tag = 'SN'").select("filename"), "filename", "inner")], where="expnum > 1")
    got = select.select_inputs(tile, images, extras=extras)
    assert names(got) == ["c"] and got.first()["one"] == 1


def test_catalogs(spark, images_and_tile):
    images, tile = images_and_tile
    cats = spark.createDataFrame([("x", 1), ("y", 2), ("z", 9)], "filename string, expnum long")
    exposures = select.selected_exposures(tile, images)
    assert names(select.catalogs_of_exposures(cats, exposures)) == ["x", "y"]
    assert names(select.catalogs_of_any(cats, exposures)) == ["x", "y"]


def test_archive_roots_and_polygons(spark):
    archives = spark.createDataFrame([("home", "/arc"), ("away", "/b")], "name string, root string")
    values = spark.createDataFrame([("home", "root_https", "https://h"), ("home", "root_http", "http://h")], "name string, key string, val string")
    assert tuple(select.archive_root(archives, values, "home").first()) == ("home", "/arc", "https://h")
    assert select.archive_root(archives, values, "away").first()["root_https"] is None
    files = spark.createDataFrame([("Y3A1v1_tiles_10s.124050.pol", "p"), ("Y3A1v1_tolys_10s.124050.pol", "p"), ("other", "p")], "filename string, path string")
    got = select.polygon_files(files, spark.createDataFrame([(124050,)], "tile_id int"))
    assert sorted(r["kind"] for r in got.collect()) == ["poltiles", "poltolys"]


def test_backfill_takes_the_smallest_match(spark):
    images = spark.createDataFrame([("f1", 155285, 1), ("f2", 155285, 2)], "filename string, expnum long, ccdnum int")
    location = spark.createDataFrame([
        ("DECam_00155285_01.fits", "r1", "red", "9"), ("DECam_00155285_01.fits", "r2", "red", "3"), ("DECam_00155285_01.fits", "r3", "red", "1")],
        "filename string, run string, filetype string, id string")
    runs = spark.createDataFrame([("r1", "SVA1_FINALCUT"), ("r2", "Y1A1_FINALCUT"), ("r3", "OTHER")], "run string, tag string")
    zp = spark.createDataFrame([("9", 30.0), ("3", 31.0), ("3", 30.5), ("1", 29.0)], "imageid string, mag_zero double")
    rows = {r["filename"]: r for r in lineage.backfill_zeropoints(images, location, runs, zp, "NEW").collect()}
    assert (rows["f1"]["imageid"], rows["f1"]["mag_zero"], rows["f1"]["imagename"]) == ("3", 30.5, "DECam_00155285_01.fits")
    assert rows["f2"]["mag_zero"] is None and rows["f2"]["tag"] == "NEW"


def test_plane_inputs_with_geometry(spark):
    geometry = ", ".join(f"{c} double" if c != "crossra0" else "crossra0 string" for c in builders.GEOMETRY)
    values = ["Y", 359.9, 0.1, -1.0, 1.0, 0.0, 0.0, 0.1, 0.1, 359.9, 359.9, -1.0, 1.0, 1.0, -1.0]
    image = spark.createDataFrame(
        [("red", "red_immask", 5, 3, "g", 77, *values), ("bkg", "red_bkg", 5, 3, "g", 77, *values), ("bkg2", "red_bkg", 5, 4, "g", 77, *values)],
        f"filename string, filetype string, pfw_attempt_id long, ccdnum int, band string, expnum long, {geometry}")
    misc = spark.createDataFrame([("seg", "red_segmap", 5, 3)], "filename string, filetype string, pfw_attempt_id long, ccdnum int")
    archive = spark.createDataFrame([(n, None if n == "bkg" else ".fz", f"p/{n}") for n in ("red", "bkg", "seg", "bkg2")], "filename string, compression string, path string")
    tags = spark.createDataFrame([(5, "T"), (6, "T")], "pfw_attempt_id long, tag string")
    rows = builders.build_plane_inputs(image, misc, archive, tags, "T").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["filename"], r["filename_bkg"], r["filename_seg"], r["compression_bkg"]) == ("red", "bkg", "seg", None)
    assert r["ra_size"] == pytest.approx(0.2) and r["dec_size"] == 2.0


def test_catalog_comparison_and_nan(spark):
    a = spark.createDataFrame([(1, math.nan, [1.0, 2.0]), (2, 1.0, [1.0, math.nan])], "id int, x double, v array<double>")
    result = {r["column"]: (r["n_different"], r["is_equal"]) for r in quality.compare_catalogs(a, a, ["id"]).collect()}
    assert result == {"id": (0, True), "x": (1, False), "v": (1, False), "*": (None, False)}
    same = {r["column"]: r["is_equal"] for r in quality.compare_catalogs(a, a, ["id"], nan_equal=True).collect()}
    assert all(same.values())
    fewer = {r["column"]: r["n_different"] for r in quality.compare_catalogs(a, a.filter("id = 1"), ["id"], nan_equal=True).collect()}
    assert fewer["id"] == 1 and fewer["x"] == 1


def test_rectangle_mask(spark):
    rng = random.Random(4)
    rects = [(x, x + rng.randrange(1, 40), y, y + rng.randrange(1, 40)) for x, y in ((rng.randrange(0, 150), rng.randrange(0, 150)) for _ in range(12))]
    image = spark.range(200 * 200).select(
        F.lit("f").alias("file"), F.lit(1).alias("hdu"), F.floor(F.col("id") / 200).cast("int").alias("y"), (F.col("id") % 200).cast("int").alias("x"), F.lit(7).alias("value"))
    r = spark.createDataFrame(rects + rects[:2], "x1 int, x2 int, y1 int, y2 int")
    df = quality.mask_by_rectangles(image, r, cell=32)
    kept = {(p["y"], p["x"]) for p in df.filter("value = 7").select("y", "x").collect()}
    want = {(y, x) for x1, x2, y1, y2 in rects for y in range(y1, min(y2, 200)) for x in range(x1, min(x2, 200))}
    assert kept == want and df.count() == 40_000
    assert "BroadcastNestedLoopJoin" not in df._jdf.queryExecution().toString()


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", "N"), (1, "a", "X"), (None, "b", None)], "id int, tilename string, crossra0 string")
    rows = {(r["kind"], r["name"], r["key"]): r["n"] for r in quality.constraint_violations(
        df, not_null=["id", "tilename"], unique=[["tilename"], ["id", "tilename"]], checks={"flag": F.col("crossra0").isin("Y", "N")}).collect()}
    assert rows == {("not_null", "id", None): 1, ("check", "flag", None): 1, ("unique", "tilename", "a"): 2, ("unique", "id+tilename", "1|a"): 2}
    with pytest.raises(ValueError):
        quality.require_non_empty(df.limit(0))
    assert quality.require_non_empty(df) is df


def zeropoints(spark, *rows):
    return spark.createDataFrame([(name, "FGCM", "v2.0", 0, value) for name, value in rows], "imagename string, source string, version string, flag int, mag_zero double")


def test_unique_zero_points(spark, images_and_tile):
    images, tile = images_and_tile
    twice = zeropoints(spark, ("a", 30.0), ("b", 30.5), ("b", 30.6), ("nowhere", 1.0), ("nowhere", 2.0))
    with pytest.raises(Exception, match="2 usable zero points for image b"):
        # whatever is asked of the result
        select.with_zeropoints(images, twice, unique=True).select("expnum").collect()
    with pytest.raises(Exception, match="2 usable zero points for image b"):
        select.select_inputs(tile, images, zeropoint=twice, zp_unique=True).count()
    # zero points of images that are not asked for don't matter
    assert names(select.with_zeropoints(images.filter("filename <> 'b'"), twice, unique=True)) == ["a"]
    once = zeropoints(spark, ("a", 30.0), ("b", 30.5))
    got = {r["filename"]: r["mag_zero"] for r in select.select_inputs(tile, images, zeropoint=once, zp_unique=True).collect()}
    assert got == {"a": 30.0, "b": 30.5}


def test_counts_come_with_the_rows(spark, images_and_tile, tmp_path):
    images, tile = images_and_tile
    zp = zeropoints(spark, ("a", 30.0), ("a", 31.0), ("c", 30.0), ("far", 30.0))
    black = spark.createDataFrame([(2, 1), (2, 1)], "expnum long, ccdnum int")
    counts = select.SelectionCounts()
    df = select.select_inputs(tile, images, zeropoint=zp, blacklist=black, ccdnum=1, counts=counts)
    path = str(tmp_path / "inputs")
    tracker, before = spark.sparkContext.statusTracker(), spark.range(1).count()
    spark.sparkContext.setJobGroup("counts", "one write")
    df.write.parquet(path)
    spark.sparkContext.setJobGroup("after", "")
    assert before == 1 and len(tracker.getJobIdsForGroup("counts")) >= 1 and tracker.getJobIdsForGroup("after") == []
    # a: two zero points; b, d: other detectors; c: blacklisted; far: off the tile
    assert counts.values() == {"n_images": 5, "n_other_detector": 2, "n_blacklisted": 1, "n_without_zeropoint": 0, "n_candidates": 3, "n_pairs": 2}
    assert tracker.getJobIdsForGroup("after") == []
    assert counts.messages() == ["Found 2 input images of tiles", "Dropped 2 of 5 images: other detectors", "Dropped 1 of 5 images: blacklisted"]
    plain = select.select_inputs(tile, images, zeropoint=zp, blacklist=black, ccdnum=1)
    assert sorted(map(tuple, spark.read.parquet(path).select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_counts_of_nothing_found(spark, images_and_tile):
    images, tile = images_and_tile
    counts = select.SelectionCounts()
    select.select_inputs(tile, images, zeropoint=zeropoints(spark, ("x", 1.0)), counts=counts).collect()
    assert counts.values() == {"n_images": 5, "n_other_detector": 0, "n_blacklisted": 0, "n_without_zeropoint": 5, "n_candidates": 0, "n_pairs": 0}
    assert counts.messages()[0] == "No input images found" and len(counts.messages()) == 2
