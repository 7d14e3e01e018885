import math
import random

import pytest
from pyspark.sql import functions as F

from skyjoin.functions import healpix, naming, photometry, sphere, wcs

# Corners of one survey tile from its centre.
CENTRE = (341.584624919, -44.9583333333)
CORNERS = [
    (342.1040711674, -45.3223923637), (341.0651786706, -45.3223923637),
    (341.0717494532, -44.5919493974), (342.0975003848, -44.5919493974),
]


def test_tile_corners(spark):
    df = spark.createDataFrame([CENTRE], "ra_cent double, dec_cent double")
    row = wcs.custom_tiles(df, naxis1=F.lit(10000), naxis2=F.lit(10000)).first()
    for k, (ra, dec) in enumerate(CORNERS, 1):
        assert row[f"rac{k}"] == pytest.approx(ra, abs=2e-10)
        assert row[f"decc{k}"] == pytest.approx(dec, abs=2e-10)
    assert row["crossra0"] == "N" and row["racmin"] == row["rac2"] and row["deccmax"] == row["decc4"]
    assert row["crpix1"] == 5000.5 and row["ctype1"] == "RA---TAN"


def test_custom_tile_size_and_crossing(spark):
    df = spark.createDataFrame([(342.18448, -44.529918), (0.01, 10.0)], "ra_cent double, dec_cent double")
    df = df.withColumns({"xsize": F.lit(43.834), "ysize": F.lit(43.834)})
    a, b = wcs.custom_tiles(df).orderBy(F.desc("ra_cent")).collect()
    assert a["naxis1"] == 10000 and a["naxis2"] == 10000 and a["crossra0"] == "N"
    assert b["crossra0"] == "Y" and b["racmin"] > 359 and b["racmax"] < 1 and 0.7 < b["ra_size"] < 0.8


@pytest.mark.parametrize("units,expected", [("arcsec", 38022), ("arcmin", 2281368), ("degree", 136882129), ("pixel", 10000)])
def test_image_size_units(spark, units, expected):
    df = spark.range(1).select(wcs.image_size(F.lit(10000), F.lit(0.263), units).alias("n"))
    assert df.first()["n"] == expected
    with pytest.raises(ValueError):
        wcs.image_size(F.lit(1), F.lit(1), "parsec")


def test_sky_and_back(spark):
    rng = random.Random(5)
    rows = [(rng.uniform(0, 360), rng.uniform(-85, 85), rng.uniform(1, 4096), rng.uniform(1, 4096)) for _ in range(500)]
    w = wcs.Wcs("ra0", "dec0", F.lit(2000.0), F.lit(1000.0), F.lit(1e-6), F.lit(7e-5), F.lit(-7.1e-5), F.lit(2e-6))
    df = spark.createDataFrame(rows, "ra0 double, dec0 double, x double, y double")
    df = wcs.with_sky(df, {("ra", "dec"): ("x", "y")}, w)
    df = wcs.with_pixels(df, {("x2", "y2"): ("ra", "dec")}, w)
    worst = df.agg(
        F.max(F.abs(F.col("x") - F.col("x2"))), F.max(F.abs(F.col("y") - F.col("y2")))).first()
    assert max(worst) < 1e-6


def test_identity_polynomial_changes_nothing(spark):
    df = spark.createDataFrame([(10.0, -30.0, 100.0, 900.0)], "ra0 double, dec0 double, x double, y double")
    plain = wcs.Wcs("ra0", "dec0", F.lit(1.0), F.lit(1.0), F.lit(1e-4), F.lit(0.0), F.lit(0.0), F.lit(1e-4))
    same = wcs.Wcs("ra0", "dec0", F.lit(1.0), F.lit(1.0), F.lit(1e-4), F.lit(0.0), F.lit(0.0), F.lit(1e-4),
                   pv1={1: F.lit(1.0)}, pv2={1: F.lit(1.0)})
    a = wcs.with_sky(df, {("ra", "dec"): ("x", "y")}, plain).first()
    b = wcs.with_sky(df, {("ra", "dec"): ("x", "y")}, same).first()
    assert (a["ra"], a["dec"]) == pytest.approx((b["ra"], b["dec"]), abs=1e-12)


def ring_centre(nside, pixel):
    """Centre of a ring-scheme pixel (north cap and belt), from the published formulas."""
    cap = 2 * nside * (nside - 1)
    if pixel < cap:
        ph = (pixel + 1) / 2
        ring = int(math.sqrt(ph - math.sqrt(int(ph)))) + 1
        place = pixel + 1 - 2 * ring * (ring - 1)
        return math.asin(1 - ring * ring / (3 * nside * nside)), math.pi / (2 * ring) * (place - 0.5)
    p = pixel - cap
    ring, place = p // (4 * nside) + nside, p % (4 * nside) + 1
    s = (ring - nside + 1) % 2
    return math.asin(4 / 3 - 2 * ring / (3 * nside)), math.pi / (2 * nside) * (place - s / 2)


# Published pairs of ring and nested numbers.
RING_TO_NEST = [(2, k, n) for k, n in enumerate([3, 7, 11, 15, 2, 1, 6, 5, 10, 9])]
RING_TO_NEST += [(2, 11, 13), (4, 11, 61), (8, 11, 253), (16, 1504, 1130)]


def test_healpix_numbers(spark):
    for nside in (2, 4, 8, 16):
        rows = []
        for ring, nest in [(r, k) for n, r, k in RING_TO_NEST if n == nside]:
            dec, ra = ring_centre(nside, ring)
            rows.append((math.degrees(ra), math.degrees(dec), nest))
        df = spark.createDataFrame(rows, "ra_cent double, dec_cent double, nest int")
        got = healpix.with_nested_index(df, "pixel", nside=nside).collect()
        assert [r["pixel"] for r in got] == [r["nest"] for r in got]


def test_healpix_equal_areas(spark):
    df = spark.range(200_000).select(
        (F.rand(1) * 360).alias("ra_cent"), F.degrees(F.asin(2 * F.rand(2) - 1)).alias("dec_cent"))
    counts = healpix.with_nested_index(df, "p", nside=4).groupBy("p").count()
    row = counts.agg(F.count("*"), F.min("p"), F.max("p"), F.min("count"), F.max("count")).first()
    assert row[0] == 192 and row[1] == 0 and row[2] == 191 and row[3] > 850 and row[4] < 1250
    with pytest.raises(ValueError):
        healpix.with_nested_index(df, "p", nside=12)


def test_overlap_by_declination(spark):
    decs = [0.0, 73.99, -74.0, 82.49, -82.5, 87.59, 87.6, -90.0]
    df = spark.createDataFrame([(d,) for d in decs], "dec double")
    got = [r[0] * 60 for r in df.select(sphere.tile_overlap("dec")).collect()]
    assert got == pytest.approx([1, 1, 2, 2, 5, 5, 10, 10])
    assert [sphere.tile_overlap_value(d) * 60 for d in decs] == pytest.approx(got)


def test_names(spark):
    df = spark.createDataFrame(
        [(341.584624919, -44.9583333333), (0.5, -0.6972), (0.0, 30.0), (359.999, 0.0)], "ra_cent double, dec_cent double")
    short = [r[0] for r in df.select(naming.tile_name()).collect()]
    assert short == ["DES2246-4457", "DES0002-0041", "DES0000+3000", "DES2359+0000"]
    long = [r[0] for r in df.select(naming.long_tile_name()).collect()]
    assert long[0] == "DESJ224620.31-445730.00" and long[2] == "DESJ000000.00+300000.00"


def test_paths(spark):
    df = spark.createDataFrame(
        [("D1_r_c03_p01_immasked.fits", ".fz", "OPS/a", "D1_bkg.fits", None, "OPS/b")],
        "filename string, compression string, path string, filename_bkg string, compression_bkg string, path_bkg string")
    row = naming.with_image_paths(df, "/arc/", "https://x.org/arc").first()
    assert row["filepath_local"] == "/arc/OPS/a/D1_r_c03_p01_immasked.fits.fz"
    assert row["filepath_https"] == "https://x.org/arc/OPS/a/D1_r_c03_p01_immasked.fits.fz"
    assert naming.with_image_paths(df, "/arc", "h", "bkg").first()["filepath_local"] == "/arc/OPS/b/D1_bkg.fits"
    local = naming.with_image_paths(df, "/arc", "https://x.org/arc")
    got = local.select(
        naming.prepared_image_name(F.col("filepath_local"), "T1", "/tiles/T1").alias("red"),
        naming.head_file_name(F.col("filepath_local"), "T1", "/tiles/T1", F.lit("immasked")).alias("head"),
        naming.file_label("filepath_local").alias("label"),
        naming.https_from_local("filepath_local", "/arc", "https://x.org/arc").alias("url")).first()
    assert got["red"] == "/tiles/T1/inputs/T1_D1_r_c03_p01_immasked-me.fits"
    assert got["head"] == "/tiles/T1/inputs/T1_D1_r_c03_p01_immasked-me.ohead"
    assert got["label"] == "immasked" and got["url"] == "https://x.org/arc/OPS/a/D1_r_c03_p01_immasked.fits.fz"


def test_product_files(spark):
    df = spark.createDataFrame([("T1", "r", 77)], "tilename string, band string, expnum int")
    cases = {
        "sci_list": "/t/list/coadd/T1_r_sci.list", "mef": "/t/coadd/T1_r.fits", "scamp_xml": "/t/align/T1_scamp.xml",
        "expcat": "/t/align/T1_77_scampcat.fits", "meds_fits": "/t/meds/T1_r_meds.fits", "depth_fraction": "/t/aux/T1_depth.json"}
    for kind, path in cases.items():
        assert df.select(naming.product_path(kind, band="band", exposure="expnum", tiledir="/t")).first()[0] == path
    rows = spark.createDataFrame([("T1", "g", k) for k in naming.PRODUCT_FILES], "base string, band string, kind string")
    assert naming.with_product_paths(rows, "/t").count() == len(naming.PRODUCT_FILES) < 200


def test_product_paths_put_pieces_side_by_side(spark):
    """As field after field filled in, for every kind, for missing fields and for texts with braces."""
    values = [("T1", "r", 77, "v3"), (None, None, None, None), ("a{band}b{exposure}", "{suffix}", 5, "{base}"), ("x}", "", 1, "{")]
    rows = spark.createDataFrame([(*v, k) for v in values for k in [*naming.PRODUCT_FILES, "no such kind", None]], "base string, band string, exposure int, suffix string, kind string")

    def filled(base, band, exposure, suffix, kind, fields=("base", "band", "exposure", "suffix")):
        if kind not in naming.PRODUCT_FILES:
            return "/t"
        subdir, name = naming.PRODUCT_FILES[kind]
        for key, value in zip(("base", "band", "exposure", "suffix"), (base, band, exposure, suffix)):
            if key in fields:
                name = name.replace("{%s}" % key, "" if value is None else str(value))
        return f"/t/{subdir}/{name}"

    got = naming.with_product_paths(rows, "/t/")
    assert [c for c in got.columns if c.startswith("_")] == []
    keys = ("base", "band", "exposure", "suffix", "kind")
    for r in got.collect():
        assert r["product_path"] == filled(*[r[k] for k in keys]), r
    for r in naming.with_product_paths(rows.drop("exposure"), "/t").collect():
        assert r["product_path"] == filled(r["base"], r["band"], None, r["suffix"], r["kind"], ("base", "band", "suffix")), r
    # formats are cut once a kind
    assert "_field0" in got._jdf.queryExecution().optimizedPlan().toString()


def test_roots_are_trimmed_where_they_end_in_a_slash(spark):
    rows = spark.createDataFrame([("/a", "b"), ("/a//", "b"), ("/", "b"), ("", "b"), (None, "b"), ("/a/", None)], "r string, n string")
    got = [r[0] for r in rows.select(naming.join_path("r", F.lit("m/"), "n")).collect()]
    assert got == ["/a/m/b", "/a/m/b", "/m/b", "/m/b", "m/b", "/a/m"]


def test_flux_scale_and_default_zero_point(spark):
    df = spark.createDataFrame([("a",)], "filename string")
    row = photometry.with_zero_point(df).select("mag_zero", photometry.flux_scale().alias("s")).first()
    assert row["mag_zero"] == 32.2 and row["s"] == pytest.approx(10 ** (0.4 * (30 - 32.2)))
