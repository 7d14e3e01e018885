import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyjoin.functions import sphere
from skyjoin.operators import overlap

IMAGE = "filename string, ra_cent double, dec_cent double, ra_size double, dec_size double"
TILE = "tilename string, ra_cent double, dec_cent double, ra_size double, dec_size double"


def boxes(df):
    """Corners and extremes of flat boxes."""
    half = F.col("ra_size") / 2
    east, west = sphere.wrap_ra(F.col("ra_cent") + half), sphere.wrap_ra(F.col("ra_cent") - half)
    south, north = F.col("dec_cent") - F.col("dec_size") / 2, F.col("dec_cent") + F.col("dec_size") / 2
    return df.withColumns({
        "rac1": east, "rac2": east, "rac3": west, "rac4": west, "decc1": south, "decc2": north, "decc3": north, "decc4": south,
        "racmin": west, "racmax": east, "deccmin": south, "deccmax": north,
        "crossra0": F.when(west > east, "Y").otherwise("N")})


def random_boxes(n, seed, size, name):
    rng = random.Random(seed)
    return [(f"{name}{k}", rng.choice([rng.uniform(0, 360), rng.uniform(-2, 2) % 360]), rng.uniform(-88, 88),
             rng.uniform(0.05, size), rng.uniform(0.05, min(size, 5))) for k in range(n)]


def separation(a, b):
    d = abs(a - b)
    return min(d, 360 - d)


def brute(images, tiles, pad=0.5):
    return sorted(
        (i[0], t[0]) for i in images for t in tiles
        if separation(i[1], t[1]) < 0.5 * t[3] + pad * i[3] and abs(i[2] - t[2]) < 0.5 * t[4] + pad * i[4])


def found(df):
    return sorted((r["filename"], r["tilename"]) for r in df.select("filename", "tilename").collect())


@pytest.mark.parametrize("size,cell,salts", [(1.0, 1.0, 1), (1.0, 1.0, 5), (9.0, 1.0, 1), (9.0, 4.0, 3), (200.0, 10.0, 1), (355.0, 30.0, 2)])
def test_join_equals_brute_force(spark, size, cell, salts):
    images, tiles = random_boxes(400, 1, size, "i"), random_boxes(150, 2, size, "t")
    df = overlap.overlap_join(spark.createDataFrame(images, IMAGE), spark.createDataFrame(tiles, TILE), cell=cell, salts=salts)
    assert found(df) == brute(images, tiles)


def test_padding_and_rotation(spark):
    images, tiles = random_boxes(300, 3, 2.0, "i"), random_boxes(200, 4, 2.0, "t")
    i, t = spark.createDataFrame(images, IMAGE), spark.createDataFrame(tiles, TILE)
    assert found(overlap.overlap_join(i, t, pad=0.505)) == brute(images, tiles, 0.505)
    turned = [df.withColumn("ra_cent", sphere.wrap_ra(F.col("ra_cent") + 137)) for df in (i, t)]
    assert found(overlap.overlap_join(*turned)) == brute(images, tiles)


def test_crowded_cell_without_adaptive_execution(spark):
    """A third and more of all images in one place; the shuffled join splits them."""
    images = [(f"h{k}", 10.2 + (k % 50) / 1000, 5.1, 0.1, 0.1) for k in range(2000)] + random_boxes(2000, 5, 1.0, "i")
    tiles = random_boxes(100, 6, 1.0, "t") + [("hot", 10.3, 5.0, 1.0, 1.0)]
    i, t = spark.createDataFrame(images, IMAGE), spark.createDataFrame(tiles, TILE)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        df = overlap.overlap_join(i, t, salts=32)
        assert "_i_salt" in df._jdf.queryExecution().toString()
        assert found(df) == brute(images, tiles)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_plan_is_a_hash_or_merge_join(spark):
    i, t = spark.createDataFrame(random_boxes(10, 1, 1, "i"), IMAGE), spark.createDataFrame(random_boxes(10, 2, 1, "t"), TILE)
    plan = overlap.overlap_join(i, t)._jdf.queryExecution().toString()
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "ArrowEvalPython"):
        assert bad not in plan


def brute_corners(images, tiles):
    def between(v, lo, hi):
        return lo <= v <= hi if lo <= hi else v >= lo or v <= hi

    both, any_one = [], []
    for i in images:
        for t in tiles:
            ra = [between(i[c], t["racmin"], t["racmax"]) for c in ("racmin", "racmax")]
            dec = [t["deccmin"] <= i[c] <= t["deccmax"] for c in ("deccmin", "deccmax")]
            if any(ra) and any(dec):
                both.append((i["filename"], t["tilename"]))
            if any(between(i[f"rac{k}"], t["racmin"], t["racmax"]) and t["deccmin"] <= i[f"decc{k}"] <= t["deccmax"] for k in (1, 2, 3, 4)):
                any_one.append((i["filename"], t["tilename"]))
    return sorted(both), sorted(any_one)


def test_corner_searches(spark):
    i = boxes(spark.createDataFrame(random_boxes(300, 7, 2.0, "i"), IMAGE))
    t = boxes(spark.createDataFrame(random_boxes(150, 8, 2.0, "t"), TILE))
    both, any_one = brute_corners(i.collect(), t.collect())
    assert found(overlap.overlap_join(i, t, "corners")) == both
    assert found(overlap.overlap_join(i, t, "any_corner")) == any_one
    with pytest.raises(ValueError):
        overlap.overlap_join(i, t, "nearest")


def test_edge_cases(spark):
    tile = [("t", 0.06, 0.0, 1.0, 1.0)]
    images = [("west", 359.90, 0.0, 0.1, 0.1), ("east", 0.30, 0.0, 0.1, 0.1), ("touch", 0.0625 + 0.5625, 0.0, 0.125, 0.1)]
    df = overlap.overlap_join(spark.createDataFrame(images[:2], IMAGE), spark.createDataFrame(tile, TILE))
    assert [r[0] for r in found(df)] == ["east", "west"]
    # boxes that just touch: outside for the distance search, inside for the edge search
    touching = boxes(spark.createDataFrame([("touch", 11.0, 0.0, 1.0, 0.5)], IMAGE))
    plain = boxes(spark.createDataFrame([("t", 10.0, 0.0, 1.0, 1.0)], TILE))
    assert found(overlap.overlap_join(touching, plain)) == []
    assert found(overlap.overlap_join(touching, plain, "corners")) == [("touch", "t")]
    # a tile inside one image is met by the distance search only
    large = boxes(spark.createDataFrame([("large", 10.0, 0.0, 2.0, 2.0)], IMAGE))
    small = boxes(spark.createDataFrame([("t", 10.0, 0.0, 0.5, 0.5)], TILE))
    assert found(overlap.overlap_join(large, small)) == [("large", "t")]
    assert found(overlap.overlap_join(large, small, "corners")) == []
    assert found(overlap.overlap_join(large, small, "any_corner")) == []
    # empty and NULL inputs
    empty = spark.createDataFrame([], IMAGE)
    assert overlap.overlap_join(empty, spark.createDataFrame(tile, TILE)).count() == 0
    unknown = spark.createDataFrame([("n", None, 0.0, 1.0, 1.0)], IMAGE)
    assert overlap.overlap_join(unknown, spark.createDataFrame(tile, TILE)).count() == 0


def test_compatible_wrap(spark):
    """Raw comparison off RA=0, folded comparison for tiles that cross it."""
    tiles = boxes(spark.createDataFrame([("cross", 0.1, 0.0, 1.0, 1.0), ("near", 0.6, 0.0, 1.0, 1.0)], TILE))
    images = boxes(spark.createDataFrame([("i", 359.95, 0.0, 0.5, 0.5)], IMAGE))
    assert found(overlap.overlap_join(images, tiles, wrap="by_tile")) == [("i", "cross")]
    assert found(overlap.overlap_join(images, tiles)) == [("i", "cross"), ("i", "near")]


def test_one_tile_filters_reach_the_scan(spark, tmp_path):
    images = random_boxes(500, 9, 1.0, "i") + [("huge", 180.0, 0.0, 300.0, 100.0)]
    path = str(tmp_path / "images")
    spark.createDataFrame(images, IMAGE).write.parquet(path)
    stored = spark.read.parquet(path)
    for name, ra, dec, ra_size, dec_size in random_boxes(5, 10, 1.0, "t"):
        tile = {"RA_CENT": ra, "DEC_CENT": dec, "RA_SIZE": ra_size, "DEC_SIZE": dec_size}
        df = overlap.overlap_of_tile(stored, tile)
        want = [i for i, _ in brute(images, [(name, ra, dec, ra_size, dec_size)])]
        assert sorted(r["filename"] for r in df.collect()) == want
        plan = df._jdf.queryExecution().toString()
        assert "PushedFilters: [" in plan and "PushedFilters: []" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("salts", [1, 4])
def test_stored_cells_are_not_moved(spark, tmp_path, salts):
    rng = random.Random(5)
    # a third of the images in one cell
    rows = [(f"f{k}", 10.5 if k % 3 == 0 else rng.uniform(0, 360), 0.5 if k % 3 == 0 else rng.uniform(-60, 60), 0.3, 0.2) for k in range(3000)]
    images = spark.createDataFrame(rows, "filename string, ra_cent double, dec_cent double, ra_size double, dec_size double")
    tiles = spark.createDataFrame([(f"T{k}", rng.uniform(0, 360), rng.uniform(-60, 60), 2.0, 1.0) for k in range(200)] + [("D", 10.0, 0.0, 2.0, 2.0)],
                                  "tilename string, ra_cent double, dec_cent double, ra_size double, dec_size double")
    name = f"cells_{salts}"
    overlap.store_cells(images, name, buckets=4, salts=salts, path=str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = overlap.overlap_join_stored(spark.table(name), tiles, salts=salts).select("tilename", "filename")
        pairs = Counter(map(tuple, got.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert pairs == Counter(map(tuple, overlap.overlap_join(images, tiles).select("tilename", "filename").collect())) and len(pairs) > 1000
    # one exchange, of the tiles; the images come as they lie
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan
    spark.sql(f"drop table {name}")
