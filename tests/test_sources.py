import glob
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyjoin import schemas
from skyjoin.functions import wcs
from skyjoin.operators import lists, quality, tiling
from skyjoin.plans import builders
from skyjoin.sources import readers, tables, writers


def write(path, text):
    path.write_text(text)
    return str(path)


def parts(path):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_tile_json_round_trip(spark, tmp_path):
    tiles = wcs.custom_tiles(
        spark.createDataFrame([("A", 30.0, -40.0), ("B", 0.0, 10.0)], "tilename string, ra_cent double, dec_cent double"),
        naxis1=F.lit(1000), naxis2=F.lit(2000))
    path = str(tmp_path / "tiles")
    writers.write_tile_json(tiles, path)
    text = open(glob.glob(f"{path}/tilename=A/part-*")[0]).read()
    assert list(json.loads(text)["tileinfo"]) == sorted(json.loads(text)["tileinfo"])
    back = readers.read_tile_json(spark, [f"{path}/tilename=A", f"{path}/tilename=B"])
    a = {r["tilename"]: r for r in back.collect()}
    b = {r["tilename"]: r for r in tiles.collect()}
    for name in ("A", "B"):
        for column in ("ra_cent", "dec_cent", "rac3", "decc1", "racmin", "ra_size", "naxis2", "crossra0", "pixelscale"):
            assert a[name][column] == b[name][column]


def test_older_tile_json(spark, tmp_path):
    text = json.dumps({"tileinfo": {"RA": 341.5, "DEC": -44.9, "CROSSRAZERO": "N", "NAXIS1": 10000, "NAXIS2": 10000, "PIXELSCALE": 0.263}, "tilename": "T"}, indent=4)
    row = readers.read_tile_json(spark, write(tmp_path / "t.json", text)).first()
    assert row["ra_cent"] == 341.5 and row["dec_cent"] == -44.9 and row["crossra0"] == "N" and row["naxis1"] == 10000


def test_tile_json_with_declared_types(spark):
    record = {"RA_CENT": 1.5, "DEC_CENT": -2, "NAXIS1": 10000.0, "ID": None, "CROSSRA0": "Y", "other": [1, 2]}
    docs = [
        json.dumps({"tileinfo": record, "tilename": "A"}), json.dumps({"tileinfo": {"ra": 3.5, "ra_cent": 4.5, "naxis1": 10.5}, "TILENAME": "B"}),
        json.dumps({"tileinfo": {"RA": "east", "DEC": 7}, "tilename": "C"}), '{"tileinfo": {"RA": 1', "[1]", "", json.dumps({"tilename": "D"}), None]
    df = readers.parse_tile_json(spark.createDataFrame([(d,) for d in docs], "value string"))
    assert dict(df.dtypes)["naxis1"] == "int" and dict(df.dtypes)["ra_cent"] == "double" and df.columns[-2:] == ["tilename", "misfit"]
    got = [(r["tilename"], r["ra_cent"], r["dec_cent"], r["naxis1"], r["crossra0"], r["misfit"]) for r in df.collect()]
    assert got[0] == ("A", 1.5, -2.0, 10000, "Y", None)
    assert got[1] == ("B", 4.5, None, None, None, docs[1])  # 10.5 pixels
    assert got[2] == ("C", None, 7.0, None, None, docs[2])
    assert [g[0] for g in got[3:]] == [None, None, None, "D", None] and [g[5] for g in got[3:]] == docs[3:]


def test_tile_dump_misfits(spark, tmp_path):
    flat = tiling.flat_tiling(spark, tiling.TilingPlan(dec_end=28.0)).limit(3)
    line = writers.tile_dump_lines(flat).first()["line"]
    full = line[:12] + " " + "-179.123456"[:10] + line[23:]  # a column that fills its width
    bad = [line.replace(" 10000", "     x"), line + " 1", "T,1,2", "name only"]
    df = readers.parse_tile_dump(spark.createDataFrame([(v,) for v in (line, full, "# comment", " ", *bad)], "value string"))
    got = df.collect()
    assert [r["misfit"] for r in got] == [None, None, *bad] and got[1]["ra_cent"] == -179.12345
    assert [r["tilename"] for r in got[4:]] == ["T", "name"] and got[4]["ra_cent"] == 1.0 and got[4]["udecu"] is None
    assert got[2]["naxis1"] is None and got[2]["ra_cent"] == got[0]["ra_cent"]


def test_one_file_a_list(spark, tmp_path):
    """Groups of one row and of thousands: a file each, in order, with a header; awkward values come back."""
    rng = random.Random(4)
    rows = [("big", "g", f"/a/{rng.randrange(10**6):06d}.fits", 30.0 + k % 7) for k in range(5000)]
    rows += [("small", "r", "/a/one.fits", 31.0), ("a/b =c", "g", "/b/2.fits", 1.0), ("a/b =c", "g", "/b/1.fits", 2.0)]
    df = spark.createDataFrame(rows, "tilename string, band string, FILEPATH_LOCAL string, MAG_ZERO double")
    path = str(tmp_path / "lists")
    writers.write_list_files(df.repartition(7), path, ["tilename", "band"], ["FILEPATH_LOCAL", "MAG_ZERO"], names=("FILEPATH_LOCAL", "MAG_ZERO"))
    files = {(r["tilename"], r["band"]): r for r in writers.list_files(spark, path, ["tilename", "band"]).collect()}
    assert set(files) == {("big", "g"), ("small", "r"), ("a/b =c", "g")}
    for group, found in files.items():
        with open(found["file"].removeprefix("file:").replace("///", "/")) as file:
            lines = file.read().splitlines()
        want = sorted((r[2], r[3]) for r in rows if r[:2] == group)
        assert lines[0] == "FILEPATH_LOCAL MAG_ZERO" and lines[1:] == [f"{p} {m}" for p, m in want]
        assert found["n_bytes"] == len("\n".join(lines)) + 1


def test_list_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("/a/x.fits", "g", 30.5), ("/a/y.fits", "r", 31.25)], "FILEPATH_LOCAL string, BAND string, MAG_ZERO double")
    path = str(tmp_path / "assoc")
    writers.write_list(df, path)
    assert sorted(map(tuple, readers.read_list(spark, path, schemas.ASSOC).collect())) == sorted(map(tuple, df.collect()))
    by = str(tmp_path / "by")
    writers.write_list(df.withColumn("band", F.col("BAND")), by, names=("FILEPATH_LOCAL", "MAG_ZERO"), by=["band"])
    assert readers.read_list(spark, f"{by}/band=g", T.StructType([T.StructField("FILEPATH_LOCAL", T.StringType()), T.StructField("MAG_ZERO", T.DoubleType())])).count() == 1


def test_commented_list(spark, tmp_path):
    text = "# FILEPATH BAND MAG_ZERO \n/a/x.fits r 30.16990662 \n/a/y.fits g 31.5 \n"
    schema = T.StructType([T.StructField("filepath", T.StringType()), T.StructField("band", T.StringType()), T.StructField("mag_zero", T.DoubleType())])
    rows = readers.read_commented_list(spark, write(tmp_path / "l.assoc", text), schema).collect()
    assert sorted(map(tuple, rows)) == [("/a/x.fits", "r", 30.16990662), ("/a/y.fits", "g", 31.5)]


def test_assoc_json(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f'/a/{rng.randrange(300):05d}"x".fits', rng.choice("gr"), rng.choice([30.5, None, 31.0])) for _ in range(500)]
    rows += [rows[0]] * 3 + [min(rows)] * 2
    df = spark.createDataFrame(rows, "FILEPATH_LOCAL string, BAND string, MAG_ZERO double")
    path = str(tmp_path / "assoc")
    writers.write_assoc_json(df, path)
    doc = json.loads(parts(path))["assoc"]
    assert list(doc) == ["FILEPATH_LOCAL", "BAND", "MAG_ZERO"]
    got = list(zip(doc["FILEPATH_LOCAL"], doc["BAND"], doc["MAG_ZERO"]))
    order = lambda r: (r[0], r[1], r[2] or 0)
    assert sorted(got, key=order) == sorted(rows, key=order)  # columns stay aligned row by row
    assert doc["FILEPATH_LOCAL"] == sorted(doc["FILEPATH_LOCAL"])


def test_config(spark, tmp_path):
    ref = readers.read_config(spark, write(tmp_path / "ref.conf", "# comment\nA 1 # one\nB  two\n  # C 3\nlonely\nA 5\n"))
    assert sorted(map(tuple, ref.collect())) == [("A", "5"), ("B", "two")]
    folder = tmp_path / "several"
    folder.mkdir()
    for name, text in (("1.conf", "A 1\n" * 50 + "B 1\n"), ("2.conf", "A 2\nA 3\n"), ("3.conf", "C 9\n")):
        write(folder / name, text)
    assert sorted(map(tuple, readers.read_config(spark, str(folder)).collect())) == [("A", "3"), ("B", "1"), ("C", "9")]
    new = readers.read_config(spark, write(tmp_path / "new.conf", "A 5\nB three\nD 4\n"))
    rows = sorted(map(tuple, quality.config_difference(new, ref).collect()))
    assert rows == [("B", "three", "two"), ("D", "4", None)]


def test_names(spark, tmp_path):
    plain = readers.read_names(spark, write(tmp_path / "a.list", "DES0000+0209\nDES0000-0207\n"))
    quoted = readers.read_names(spark, write(tmp_path / "b.dat", "tiles = ['DES2251-4331',\n         'DES2251-4414',\n  ]\n"))
    assert plain.count() == 2 and sorted(r[0] for r in quoted.collect()) == ["DES2251-4331", "DES2251-4414"]


def test_detector_sections(spark, tmp_path):
    text = "#\n# made by hand\n#\nD_01.fits    [2049:4096,8193:12288]          1        13423.20      6307.33   342.05607027   -44.64526368\n"
    df = readers.read_detector_sections(spark, write(tmp_path / "s.dat", text))
    row = df.first()
    assert (row["x1"], row["x2"], row["y1"], row["y2"], row["ccdnum"], row["crval2"]) == (2049, 4096, 8193, 12288, 1, -44.64526368)
    assert tuple(readers.section_rectangles(df).first()) == (1, 2048, 4096, 8192, 12288)


@pytest.mark.parametrize("csv", [False, True])
def test_tile_dump_round_trip(spark, tmp_path, csv):
    flat = tiling.flat_tiling(spark, tiling.TilingPlan(dec_end=25.0))
    path = str(tmp_path / "dump")
    writers.write_tile_dump(flat, path, csv=csv)
    first = parts(path).splitlines()[0]
    assert (first.count(",") == 17) if csv else (len(first.split()) == 18)
    back = readers.read_tile_dump(spark, path)
    joined = back.join(flat.select("tilename", F.col("rall").alias("r"), F.col("udecu").alias("u")), "tilename")
    worst = joined.agg(F.count("*"), F.max(F.abs(F.col("rall") - F.col("r"))), F.max(F.abs(F.col("udecu") - F.col("u")))).first()
    assert worst[0] == flat.count() and max(worst[1:]) < 1e-6


def test_list_files_are_sorted(spark, tmp_path):
    rng = random.Random(3)
    # a third of all lines in one band
    rows = [("t", "g" if k % 3 == 0 else rng.choice("riz"), f"/a/{rng.random()}.fits", 30.0) for k in range(2000)]
    df = spark.createDataFrame(rows, "tilename string, band string, filepath_nwg string, mag_zero double")
    path = str(tmp_path / "lists")
    writers.write_lists(lists.coadd_lists(df), path)
    lines = parts(f"{path}/tilename=t/band=g/kind=sci").splitlines()
    assert lines == sorted(r[2] + "[0]" for r in rows if r[1] == "g")
    assert len(glob.glob(f"{path}/tilename=t/band=*")) == 4


def test_clustered_layout(spark, tmp_path):
    df = spark.range(4000).select(
        F.col("id").cast("string").alias("filename"), (F.rand(1) * 360).alias("ra_cent"), (F.rand(2) * 120 - 60).alias("dec_cent"))
    path = str(tmp_path / "images")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_clustered(builders.with_healpix(df), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("hpix_32").alias("lo"), F.max("hpix_32").alias("hi")).orderBy("lo").collect()
    assert len(spans) > 1 and all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))


def test_tables(spark):
    spark.sql("create database if not exists sky")
    name = "sky." + tables.input_table_name("me_images", "Y2T9")
    first = spark.createDataFrame([(1, "a")], "id int, tilename string")
    second = spark.createDataFrame([("b", 2)], "tilename string, id int")
    assert not tables.table_exists(spark, name)
    assert tables.create_table(first, name) and tables.table_exists(spark, name)
    assert not tables.create_table(second, name) and spark.table(name).first()["tilename"] == "a"
    tables.append_rows(second, name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "b")]
    assert tables.create_table(second, name, clobber=True) and spark.table(name).count() == 1
    spark.sql("drop database sky cascade")


def test_replace_a_table_from_itself(spark):
    spark.sql("create database if not exists sky2")
    name = "sky2.images"
    assert tables.create_table(spark.range(10).selectExpr("id", "cast(id as string) as name"), name)
    assert tables.create_table(spark.table(name).filter("id >= 4"), name, clobber=True)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [4, 5, 6, 7, 8, 9]
    tables.append_rows(spark.table(name).filter("id > 7"), name)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [4, 5, 6, 7, 8, 8, 9, 9]
    assert [r["tableName"] for r in spark.sql("show tables in sky2").collect()] == ["images"]
    spark.sql("drop database sky2 cascade")


def test_a_failed_replacement_leaves_the_table(spark):
    spark.sql("create database if not exists sky3")
    name = "sky3.images"
    tables.create_table(spark.range(5), name)
    midway = spark.range(0, 100, 1, 10).select(F.when(F.col("id") == 95, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        tables.create_table(midway, name, clobber=True)
    with pytest.raises(Exception, match="midway"):
        tables.append_rows(midway, name)
    with pytest.raises(Exception, match="midway"):
        tables.create_table(midway, "sky3.fresh")
    assert spark.table(name).count() == 5 and [r["tableName"] for r in spark.sql("show tables in sky3").collect()] == ["images"]
    spark.sql("drop database sky3 cascade")


def test_compare_catalogs_by_row(spark, tmp_path):
    """Paired by the rows' numbers in their files; numbers of rows differ."""
    rows = [(k % 3, float(k), [float(k), 0.5]) for k in range(500)]
    a = spark.createDataFrame(rows, "flag int, mag double, pair array<double>").coalesce(1)
    b = spark.createDataFrame([(f, m + (0.5 if m == 77 else 0), p) for f, m, p in rows] + [(0, 1.0, None)] * 2, a.schema).coalesce(1)
    for df, name in ((a, "a"), (b, "b")):
        df.write.option("maxRecordsPerFile", 90).parquet(str(tmp_path / name))
    stored = [spark.read.parquet(str(tmp_path / n)) for n in "ab"]
    assert len(stored[0].inputFiles()) == 6
    got = {r["column"]: (r["n_different"], r["is_equal"]) for r in quality.compare_catalogs_by_row(*stored).collect()}
    assert got == {"row": (2, False), "flag": (2, False), "mag": (3, False), "pair": (2, False), "*": (None, False)}
    same = {r["column"]: r["is_equal"] for r in quality.compare_catalogs_by_row(stored[0], stored[0]).collect()}
    assert same == {"row": True, "flag": True, "mag": True, "pair": True, "*": True}
    # in an order both have
    shuffled = stored[0].repartition(5, "mag")
    ordered = {r["column"]: r["is_equal"] for r in quality.compare_catalogs_by_row(stored[0], shuffled, ["mag"]).collect()}
    assert ordered["*"] and ordered["pair"]


def test_upsert_update_lookup(spark):
    base = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 2.0)], "tilename string, id int, rac1 double")
    new = spark.createDataFrame([("b", 9, 9.0), ("c", 3, 3.0)], "tilename string, id int, rac1 double")
    assert sorted(map(tuple, tables.upsert(base, new, ["tilename"]).collect())) == [("a", 1, 1.0), ("b", 9, 9.0), ("c", 3, 3.0)]
    assert sorted(map(tuple, tables.update_columns(base, new, ["tilename"], ["rac1"]).collect())) == [("a", 1, 1.0), ("b", 2, 9.0)]
    twice = new.union(spark.createDataFrame([("b", 8, 7.0)], new.schema))
    assert sorted(map(tuple, tables.upsert(base, twice, ["tilename"]).collect())) == [("a", 1, 1.0), ("b", 8, 7.0), ("c", 3, 3.0)]
    assert tables.update_columns(base, twice, ["tilename"], ["rac1"]).filter("tilename = 'b'").first()["rac1"] == 7.0
    assert tables.lookup_tiles(base, "a").count() == tables.lookup_tiles(base, ["b", "x"]).count() == 1
    assert tables.lookup_tiles(base, new).first()["tilename"] == "b"


def test_schema_and_comments(spark, tmp_path):
    tiles = tiling.sky_tiling(spark, tiling.TilingPlan(dec_end=29.0)).withColumn("id", F.col("dec_row") * 1000 + F.col("ra_step"))
    df = schemas.conform(tiles, schemas.COADDTILE)
    assert len(df.columns) == 36 and df.columns == [f.name for f in schemas.COADDTILE]
    stored = schemas.to_sink_types(df, "coaddtile")
    assert stored.schema["ra_cent"].dataType == T.DecimalType(15, 10) and stored.schema["pixelscale"].dataType == T.DecimalType(10, 5)
    commented = schemas.with_comments(stored)
    path = str(tmp_path / "tiles")
    commented.write.parquet(path)
    fields = {f.name: f.metadata.get("comment") for f in spark.read.parquet(path).schema}
    assert fields["rac2"] == "RA of corner 2 (deg)" and fields["cd1_2"] and fields["naxis1"] and fields["crossra0"]
    assert all(fields.values())
    half = schemas.to_sink_types(spark.createDataFrame([("t", 0.000125, 0.5)], "tilename string, d1 double, dmedian double"), "tiledepth").first()
    assert str(half["d1"]) == "0.00013" and str(half["dmedian"]) == "0.50000"
