import random
import statistics

import pytest
from pyspark.sql import functions as F

from skyjoin.operators import lists, ordering, quality, sampling, stats


def test_exact_median_small_groups(spark):
    rng = random.Random(1)
    rows = [(f"g{k % 7}", None if k % 50 == 0 else rng.choice([rng.gauss(0, 1), 0.0, 1.5])) for k in range(900)]
    got = {r["g"]: r for r in stats.exact_median(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()}
    for g in {r[0] for r in rows}:
        values = [v for name, v in rows if name == g and v is not None]
        assert got[g]["median"] == statistics.median(values)
        assert got[g]["upper_median"] == statistics.median_high(values)


@pytest.mark.parametrize("n", [40_001, 50_000])
def test_exact_median_of_large_groups(spark, n):
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("v"))
    got = {r["g"]: r["median"] for r in stats.exact_median(df, ["g"], "v", accuracy=500).collect()}
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got == pytest.approx(want, rel=1e-15)


def test_exact_median_without_keys_and_with_ties(spark):
    df = spark.range(30_000).select((F.col("id") % 2).cast("double").alias("v"))
    assert stats.exact_median(df, [], "v", accuracy=100).first()["median"] == 0.5
    constant = spark.range(5000).select(F.lit(3.0).alias("v"))
    assert stats.exact_median(constant, [], "v", accuracy=100).first()["median"] == 3.0
    assert stats.exact_median(constant.filter("v > 9"), [], "v").count() in (0, 1)


def test_reconcile(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "expnum int")
    b = spark.createDataFrame([(2,), (3,)], "expnum int")
    assert sorted(map(tuple, stats.reconcile_exposures(a, b).collect())) == [(1, "catalog"), (3, "image")]


def test_draws_repeat_and_keep_exposures_whole(spark):
    rows = [("t", "g" if k % 4 else "r", f"D{k % 30:08d}_c{k:04d}") for k in range(1200)]
    df = spark.createDataFrame(rows, "tilename string, band string, filename string")
    drawn = sampling.random_exposures(df, n=4, seed=1)
    assert drawn.groupBy("band").agg(F.count_distinct(F.substring("filename", 1, 9)).alias("n")).filter("n <> 4").count() == 0
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, sampling.random_exposures(df, n=4, seed=1).collect()))
    assert sorted(map(tuple, drawn.collect())) != sorted(map(tuple, sampling.random_exposures(df, n=4, seed=2).collect()))
    images = sampling.random_images(df, {"g": 64, "r": 7}, seed=3)
    assert {r["band"]: r["count"] for r in images.groupBy("band").count().collect()} == {"g": 64, "r": 7}
    few = sampling.random_images(df.limit(3), {"g": 64, "r": 7})
    assert few.count() == 3
    plan = images._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2  # ranks are cut before the shuffle


def test_band_sets(spark):
    df = spark.createDataFrame([("a", "g"), ("a", "i"), ("a", "r"), ("b", "z"), ("b", "Y"), ("c", "z"), ("c", "i"), ("c", "g"), ("c", "r")], "tilename string, band string")
    bands = lists.bands_present(df)
    plan = {r["tilename"]: r for r in lists.band_plan(bands).withColumns({
        "det": lists.detection_bands(), "triple": lists.color_triple()}).collect()}
    assert plan["a"]["do_bands"] == ["g", "i", "r"] and plan["a"]["d_bands"] == ["g", "i", "r", "det"]
    assert plan["a"]["triple"] == ["i", "r", "g"] and plan["b"]["triple"] is None and plan["b"]["det"] == ["z"]
    chosen = lists.band_plan(bands, ["g", "det"]).first()
    assert chosen["do_bands"] == ["g"] and chosen["d_bands"] == ["g", "det"]


def test_labels(spark):
    same = spark.createDataFrame([("/a/x_c1_immasked.fits.fz",), ("/b/y_immasked.fits",)], "filepath_local string")
    assert lists.require_unique_label(same) == "immasked"
    with pytest.raises(ValueError):
        lists.require_unique_label(same.unionByName(spark.createDataFrame([("/a/x_cat.fits",)], "filepath_local string")))
    with pytest.raises(ValueError):
        lists.require_unique_label(same.limit(0))


def test_planes_are_joined_once(spark):
    a = spark.range(640).select(
        F.concat(F.lit("f"), (F.col("id") % 2).cast("string")).alias("file"), F.lit(1).alias("hdu"), (F.col("id") / 2 / 16).cast("int").alias("y"),
        ((F.col("id") / 2).cast("int") % 16).alias("x"), (F.col("id") % 7).cast("int").alias("value"))
    b = a.filter("x <> 3").withColumn("value", F.when(F.col("y") % 2 == 0, F.col("value") + F.col("x")).otherwise(F.col("value")))
    difference = quality.plane_difference(a, b)
    got = {r["file"]: r for r in quality.plane_statistics(difference).collect()}
    for file in ("f0", "f1"):
        rows = [r["diff"] for r in difference.filter(F.col("file") == file).collect()]
        differing = [d for d in rows if d]
        assert (got[file]["n_pix"], got[file]["n_unpaired"], got[file]["n_diff"]) == (len(rows), rows.count(None), len(differing))
        assert got[file]["diff_median"] == statistics.median(differing) and got[file]["diff_mean"] == pytest.approx(statistics.mean(differing))
    same = quality.plane_statistics(quality.plane_difference(a, a)).first()
    assert same["n_diff"] == 0 and same["diff_median"] is None and same["diff_mean"] is None


def test_positions(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1.25, 1.5, 2.0, 77.0]), rng.choice("gri"), f"f{k}") for k in range(300)]
    df = spark.createDataFrame(rows, "ra double, band string, filename string")
    order = ["ra", "band", "filename"]
    got = ordering.with_position(df, order).orderBy("position").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert [tuple(r)[:3] for r in got] == want and [r["position"] for r in got] == list(range(1, 301))
    assert list(map(tuple, ordering.ordered(df, ["ra", "band"]).collect())) == want


def test_positions_of_ranges_cut_into_files(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("k"), F.lit("x").alias("a b"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    try:
        got = ordering.with_position(df, [F.col("k").desc()])
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert got.columns == ["k", "a b", "position"] and len(got.inputFiles()) >= 50
    assert got.filter("position <> 5000 - k").count() == 0 and got.count() == 5_000


def test_positions_compute_the_input_once(spark):
    rows = spark.range(100).select(F.col("id"), F.rand(1).alias("drawn"))
    plan = ordering.with_position(rows, ["drawn", "id"])._jdf.queryExecution().toString()
    assert "Range (" not in plan and "rand(" not in plan
    assert ordering.with_position(rows.limit(0), ["drawn", "id"]).collect() == []
