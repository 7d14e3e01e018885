"""The queries: each reads the given tables of a directory and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.standins import table
from skyjoin import schemas
from skyjoin.functions import healpix, naming, photometry, sphere, wcs
from skyjoin.operators import coverage, depth, lists, ordering, overlap, quality, sampling, stats, tiling
from skyjoin.plans import builders, lineage, select
from skyjoin.sources import readers, staging, tables, writers

LOCAL, HTTPS = "/archive", "https://archive.example.org/files"
TILEDIR = "/tiles"
TAGS = ("Y2A1_FINALCUT", "Y2T9_FINALCUT")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Tables:
    """``t.sky_image`` is the table of that name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self._spark, self._dir, name)


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


def rounded(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(F.col(n), digits).alias(n) for n in names]


# -- inputs of tiles -------------------------------------------------------------------------

IMAGE_OUT = ["tilename", "filename", "band", "expnum", "ccdnum"]


@query
def tile_inputs_distance(t):
    images = t.sky_image.filter(F.col("tag").isin(*TAGS))
    df = select.select_inputs(t.sky_tile, images, zeropoint=t.sky_zeropoint, blacklist=t.sky_blacklist)
    df = naming.with_image_paths(df, LOCAL, HTTPS)
    return df.select(*IMAGE_OUT, "mag_zero", "ra_cent", "dec_cent", "compression", "filepath_local", "filepath_https")


@query
def tile_inputs_wrap(t):
    tiles = t.sky_tile.filter(F.col("crossra0") == "Y")
    df = select.select_inputs(tiles, t.sky_image, wrap="by_tile")
    return df.select(*IMAGE_OUT, *rounded("ra_cent", "rac1", "rac3", "racmin", "racmax", "dec_cent"))


@query
def tile_inputs_corners(t):
    return select.select_inputs(t.sky_tile, t.sky_image, search="corners").select(*IMAGE_OUT)


@query
def tile_inputs_any_corner(t):
    return select.select_inputs(t.sky_tile, t.sky_image, search="any_corner").select(*IMAGE_OUT)


@query
def tile_inputs_padded(t):
    return select.select_inputs(t.sky_tile, t.sky_image, pad=0.505).select(*IMAGE_OUT)


@query
def tile_inputs_corner_sizes(t):
    return select.select_inputs(t.sky_tile, t.sky_image, search="corner_sizes").select(*IMAGE_OUT)


@query
def tile_inputs_ccdnum(t):
    return select.select_inputs(t.sky_tile, t.sky_image, ccdnum=3).select(*IMAGE_OUT)


@query
def tile_inputs_subset_tag(t):
    images = select.with_tag(t.sky_image, t.sky_tag, "SN_DEEP")
    return select.select_inputs(t.sky_tile, images).select(*IMAGE_OUT)


@query
def tile_inputs_extras(t):
    attempts = t.sky_proctag.filter(F.col("tag") == "Y2A1_FINALCUT").select("pfw_attempt_id", F.col("tag").alias("proctag"))
    extras = select.Extras(
        select=[F.upper("band").alias("band_upper")],
        joins=[(attempts, ["pfw_attempt_id"], "inner")], where="dec_cent > -30 and ccdnum < 5")
    return select.select_inputs(t.sky_tile, t.sky_image, extras=extras).select(*IMAGE_OUT, "band_upper", "proctag")


@query
def tile_inputs_zp_force(t):
    df = photometry.with_zero_point(select.select_inputs(t.sky_tile, t.sky_image, blacklist=t.sky_blacklist))
    return df.select(*IMAGE_OUT, "mag_zero")


@query
def images_without_zeropoint(t):
    return select.without_zeropoint(t.sky_image, t.sky_zeropoint).select("filename", "expnum", "ccdnum", "band")


@query
def images_not_blacklisted_by_name(t):
    return select.exclude_by_name(t.sky_image, t.sky_blacklist, t.sky_image).select("filename", "expnum", "ccdnum")


# a tile across RA = 0
ONE_TILE = {"ra_cent": 0.0625, "dec_cent": -29.46875, "ra_size": 1.0, "dec_size": 1.0, "crossra0": "Y"}


@query
def inputs_of_one_tile(t):
    return overlap.overlap_of_tile(t.sky_image, ONE_TILE).select("filename", "band", "expnum", "ccdnum")


# a tile in the south
STORED_TILE = {"ra_cent": 235.5625, "dec_cent": -53.46875, "ra_size": 1.0, "dec_size": 1.0, "crossra0": "N"}


@query
def inputs_of_stored_tile(t):
    """Out of images stored by HEALPix pixel: the scan gets the tile's pixel ranges."""
    path = f"{staging.shared_folder(t._spark)}/images-{uuid.uuid4().hex}"
    images = healpix.with_nested_index(t.sky_image, "hpix_256", nside=256)
    writers.write_clustered(images, path, order=("hpix_256", "filename"))
    stored = t._spark.read.parquet(path)
    return coverage.inputs_of_tile(stored, STORED_TILE).select("filename", "band", "expnum", "ccdnum")


@query
def images_centred_in_tiles(t):
    """Images met on the pixels of each tile, then tested exactly."""
    tiles = overlap.tile_columns(t.sky_tile.select("tilename", "ra_cent", "dec_cent", "ra_size", "dec_size"))
    pixels = coverage.tile_pixels(t.sky_tile, nside=64)
    images = healpix.with_nested_index(t.sky_image, "hpix", nside=64)
    # tiles meet their pixels first, so that the images travel once and no pair does
    near = pixels.join(tiles.hint("merge"), "tilename").withColumnRenamed("hpix", "_hpix").hint("merge")
    inside = (sphere.ra_separation("ra_cent", "tile_ra_cent") < 0.5 * F.col("tile_ra_size")) & (F.abs(F.col("dec_cent") - F.col("tile_dec_cent")) < 0.5 * F.col("tile_dec_size"))
    return images.join(near, (F.col("hpix") == F.col("_hpix")) & inside).select("tilename", "filename")


@query
def tile_inputs_stored_cells(t):
    """Out of images stored by sky cell: the join moves the tiles only."""
    name = f"cells_{uuid.uuid4().hex}"
    overlap.store_cells(t.sky_image, name, buckets=8, path=f"{staging.shared_folder(t._spark)}/{name}")
    return overlap.overlap_join_stored(t._spark.table(name), t.sky_tile).select(*IMAGE_OUT)


@query
def selection_counts(t):
    """What an input selection found and dropped, counted by the job that stores it."""
    counts = select.SelectionCounts()
    pairs = select.select_inputs(t.sky_tile, t.sky_image, zeropoint=t.sky_zeropoint, blacklist=t.sky_blacklist, ccdnum=2, counts=counts)
    staging.staged(pairs.select("tilename", "filename", "mag_zero"), "inputs")
    return t._spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.values().items()])


@query
def tile_inputs_unique_zeropoint(t):
    one = t.sky_zeropoint.groupBy("imagename", "source", "version", "flag").agg(F.max("mag_zero").alias("mag_zero"))
    one = one.groupBy("imagename").agg(F.min(F.struct("source", "version", "flag", "mag_zero")).alias("z")).select("imagename", "z.*")
    return select.select_inputs(t.sky_tile, t.sky_image, zeropoint=one, zp_unique=True).select(*IMAGE_OUT, "mag_zero")


@query
def tile_inputs_by_file(t):
    rows = _pairs(t).select("tilename", "band", "filename")
    return ordering.with_position(rows, ["tilename", "band", "filename"])


@query
def images_by_ra(t):
    rows = t.sky_image.select("ra_cent", "band", "filename")
    return ordering.with_position(rows, ["ra_cent", "band", "filename"])


@query
def tile_inputs_by_detector(t):
    rows = _pairs(t).select("ccdnum", "tilename", "filename")
    return ordering.with_position(rows, ["ccdnum", "tilename", "filename"])


def _pairs(t):
    return overlap.overlap_join(t.sky_image, t.sky_tile)


@query
def inputs_per_tile_band(t):
    return stats.inputs_per_tile_band(_pairs(t))


@query
def coadd_inputs_per_tile_band(t):
    return lineage.inputs_per_tile_band(t.sky_coadd, t.sky_coadd_src, t.sky_run, "Y1A1_COADD_STRIPE82")


@query
def inputs_mean_median_by_band(t):
    df = lineage.inputs_per_tile_band(t.sky_coadd, t.sky_coadd_src, t.sky_run, "Y1A1_COADD")
    df = stats.mean_median_inputs(df, "n_inputs")
    return df.select("band", "n_tiles", *rounded("mean_inputs"), "median_inputs", F.col("upper_median_inputs").cast("double").alias("upper_median_inputs"))


@query
def footprint_bounds(t):
    return stats.footprint_bounds(t.sky_image)


@query
def images_in_sky_window(t):
    df = t.sky_image.withColumns({"ra_180": sphere.fold_ra("ra_cent"), "ra_275": sphere.recentre_ra("ra_cent")})
    df = df.filter(sphere.in_sky_window("ra_275", "dec_cent", -30, 30, -30, 30, margin=1))
    return df.select("filename", *rounded("ra_180", "ra_275", "dec_cent"))


@query
def image_sizes(t):
    df = t.sky_image.withColumns({
        "ra_extent": sphere.ra_extent(), "dec_extent": sphere.dec_extent(),
        "dec_extent_corners": sphere.dec_extent_from_corners(), "flag": sphere.crosses_ra0_by_corners()})
    return df.select("filename", "flag", *rounded("ra_extent", "dec_extent", "dec_extent_corners"))


# -- catalogues and exposures -----------------------------------------------------------------


@query
def catalogs_of_exposures(t):
    exposures = select.selected_exposures(t.sky_tile, t.sky_image)
    return select.catalogs_of_exposures(t.sky_catalog, exposures).select("tilename", "filename", "path", "band", "ccdnum", "expnum")


@query
def exposure_catalogs(t):
    exposures = select.selected_exposures(t.sky_tile, t.sky_image)
    scamp = builders.build_exposure_catalog_inputs(
        t.sky_catalog, t.sky_miscfile, t.sky_archive, t.sky_proctag, "Y2A1_FINALCUT")
    return select.catalogs_of_any(scamp, exposures).select("filename_scampcat", "filename_scamphead", "path", "band", "expnum")


@query
def exposure_reconciliation(t):
    exposures = select.selected_exposures(t.sky_tile, t.sky_image)
    return stats.reconcile_exposures(exposures, t.sky_catalog.filter(F.col("filetype") == "cat_finalcut"))


@query
def exposure_pairing(t):
    cats = naming.with_catalog_paths(t.sky_catalog, LOCAL, HTTPS)
    cats = cats.unionByName(cats.withColumn("filepath_local", F.concat("filepath_local", F.lit(".2"))))
    return lists.pair_exposures(t.sky_image, cats)


@query
def exposures_of_bands(t):
    return lists.exposures_of_bands(t.sky_image, ["g", "i"])


@query
def distinct_values(t):
    return stats.distinct_values(t.sky_image, "band", "tag")


# -- input tables --------------------------------------------------------------------------------


def _typed_images(t):
    return t.sky_image.drop("compression", "path", "ra_size", "dec_size").withColumn("filetype", F.lit(builders.IMAGE_TYPE))


@query
def build_images(t):
    df = builders.build_image_inputs(_typed_images(t), t.sky_archive, t.sky_proctag, "Y2T9_FINALCUT", nside=32)
    return df.select("filename", "compression", "path", "pfw_attempt_id", "band", "ccdnum", "expnum", "crossra0", *rounded("ra_size", "dec_size"), "hpix_32")


@query
def build_images_3plane(t):
    return builders.build_plane_inputs(
        t.sky_fileset, t.sky_segmap, t.sky_archive, t.sky_attempt, "Y2T9_FINALCUT", geometry=False)


@query
def build_catalogs(t):
    return builders.build_catalog_inputs(t.sky_catalog, t.sky_archive, t.sky_proctag, "Y2A1_FINALCUT")


@query
def build_scampcats(t):
    return builders.build_exposure_catalog_inputs(
        t.sky_catalog, t.sky_miscfile, t.sky_archive, t.sky_proctag, "Y2N_FIRSTCUT")


@query
def provenance_3key(t):
    image = t.sky_image.select("filename", "band", "ccdnum", *rounded("ra_cent", "dec_cent"))
    return builders.provenance_inputs(image, t.sky_archive, t.sky_wgb, t.sky_runtag, "Y2N_FIRSTCUT")


@query
def provenance_any_task(t):
    image = t.sky_image.select("filename")
    return builders.provenance_inputs(image, t.sky_archive, t.sky_wgb, t.sky_runtag, "Y2T3_FINALCUT", exec_name=None).select("filename")


@query
def provenance_artifacts(t):
    image = t.sky_image.select("filename", "band", "ccdnum")
    return builders.provenance_by_artifact(
        image, t.sky_archive, t.sky_wgb, t.sky_artifact, t.sky_generated, t.sky_exec, t.sky_exectag,
        "Y2N_FIRSTCUT", pattern="%_2_%.fits")


@query
def runs_of_tile(t):
    return lineage.runs_of_tiles(t.sky_location, t.sky_run, "Y1A1_COADD%")


@query
def coadd_lineage(t):
    runs = lineage.runs_of_tiles(t.sky_location, t.sky_run, "Y1A1_COADD")
    return lineage.exposures_of_runs(runs, t.sky_coadd, t.sky_coadd_src, t.sky_source, t.sky_exposure)


@query
def coadd_lineage_of_run(t):
    return lineage.exposures_of_run("run3", t.sky_coadd, t.sky_coadd_src, t.sky_source, t.sky_exposure)


@query
def zeropoint_backfill(t):
    return lineage.backfill_zeropoints(
        t.sky_image, t.sky_oldfile, t.sky_run, t.sky_oldzp, "Y2T3_FINALCUT", tags=("SVA1_FINALCUT", "Y1A1_COADD"))


@query
def zeropoint_selfjoin(t):
    image = t.sky_oldfile.select("id", "run", F.col("filename").alias("imagename"), F.col("filetype").alias("imagetype"))
    return lineage.zeropoints_by_image_name(image, t.sky_oldzp, t.sky_run, ["run4", "run7"], "SVA1_FINALCUT")


# -- tiling --------------------------------------------------------------------------------------

TILE_KEY = ["dec_row", "ra_step"]


def _home_counts(t, plan=tiling.TilingPlan()):
    return tiling.home_tile(t.sky_image, plan).groupBy(*TILE_KEY).agg(F.count(F.lit(1)).alias("n_images"))


@query
def tiling_home_tiles(t):
    home = tiling.home_tile(t.sky_image.select("filename", "ra_cent", "dec_cent"))
    names = tiling.sky_tiling(home.sparkSession).select(*TILE_KEY, "tilename")
    return home.join(names, TILE_KEY, "left").select("filename", "tilename", *TILE_KEY)


@query
def tiling_grid(t):
    counts = _home_counts(t)
    tiles = tiling.sky_tiling(counts.sparkSession)
    return tiles.join(counts, TILE_KEY, "left").fillna(0, ["n_images"]).select(
        "tilename", *TILE_KEY, "crossra0", "n_images",
        *rounded("ra_cent", "dec_cent", "rac1", "rac2", "decc1", "decc3", "racmin", "racmax", "ra_size", "dec_size", "uramin", "uramax", "udecmin", "udecmax"))


@query
def survey_inputs_per_tile(t):
    images = t.sky_image.select("band", "expnum", "ra_cent", "dec_cent", "ra_size", "dec_size")
    tiles = tiling.sky_tiling(images.sparkSession).select("tilename", "ra_cent", "dec_cent", "ra_size", "dec_size")
    pairs = overlap.overlap_join(images, tiles)
    return stats.inputs_per_tile_band(pairs)


@query
def tiling_flat_corners(t):
    counts = _home_counts(t)
    flat = tiling.flat_tiling(counts.sparkSession)
    return flat.join(counts, TILE_KEY, "left").fillna(0, ["n_images"]).select(
        "tilename", "n_images", *rounded("rall", "ralr", "raul", "raur", "decll", "decul", "ural", "urau", "udecl", "udecu"))


@query
def tiling_consistency(t):
    return tiling.inconsistent_tiles(t.sky_bounds).select("tilename", "crossra0", "reason")


@query
def tile_ids(t):
    known = t.sky_bounds.filter("kind > 15").select("tilename", "id")
    return tiling.with_ids(t.sky_bounds.drop("id"), known).select("tilename", "id", "is_new")


@query
def tile_id_range(t):
    return tiling.id_range(t.sky_bounds)


@query
def tile_compare(t):
    df = tiling.compare_tiles(t.sky_bounds, t.sky_bounds_stored)
    return df.select("tilename", "reason")


@query
def tile_compare_older(t):
    df = tiling.compare_tiles(t.sky_bounds, t.sky_bounds_stored, tolerance=1e-3, scale_ra=False)
    return df.select("tilename", "reason", *rounded("d_dec_cent", "d_uramax"))


# -- world coordinates ---------------------------------------------------------------------------


@query
def wcs_corners(t):
    df = wcs.with_image_corners(t.sky_header)
    return df.select("image_id", *rounded("ra", "dec", *sphere.corner_names("rac"), *sphere.corner_names("decc")))


@query
def wcs_corners_tpv(t):
    w = wcs.Wcs(pv1={0: F.lit(0.001), 1: F.lit(1.01), 4: F.lit(0.02)}, pv2={0: F.lit(-0.002), 1: F.lit(0.99), 7: F.lit(0.03)})
    df = wcs.with_image_corners(t.sky_header, w)
    return df.select("image_id", *rounded("ra", "dec", "rac1", "decc1", "rac3", "decc3"))


@query
def wcs_sky2pix(t):
    position = {("x", "y"): (F.col("crval1") + 0.05, F.col("crval2") - 0.03)}
    df = wcs.with_pixels(t.sky_header, position, wcs.Wcs())
    return df.select("image_id", *rounded("x", "y", digits=3))


@query
def custom_tiles(t):
    centres = t.sky_header.select(
        "image_id", F.col("crval1").alias("ra_cent"), F.col("crval2").alias("dec_cent"),
        (F.lit(10.0) + F.col("image_id") % 50).alias("xsize"), (F.lit(20.0) + F.col("image_id") % 30).alias("ysize"))
    df = wcs.custom_tiles(centres).withColumn("tilename", naming.long_tile_name())
    return df.select(
        "image_id", "tilename", "naxis1", "naxis2", "crossra0",
        *rounded("rac1", "decc1", "rac3", "decc3", "racmin", "racmax", "ra_size", "dec_size"))


@query
def hpix_assign(t):
    df = healpix.with_nested_index(t.sky_image.select("filename", "ra_cent", "dec_cent"), "hpix_32", nside=32)
    return healpix.with_nested_index(df, "hpix_256", nside=256).select("filename", "hpix_32", "hpix_256")


@query
def hpix_merge(t):
    pixels = builders.with_healpix(t.sky_image).select("filename", "hpix_32")
    return builders.merge_healpix(t.sky_image, pixels).groupBy("hpix_32", "band").agg(F.count(F.lit(1)).alias("n"))


@query
def sky_map_lookup(t):
    sky_map = t.part.groupBy((F.col("p_partkey") % 12288).cast("int").alias("hpix")).agg(F.max("p_size").cast("double").alias("value"))
    return builders.sky_map_lookup(t.sky_image, sky_map).select("filename", "hpix", "map_value")


# -- depth ---------------------------------------------------------------------------------------


def _corner_pairs(t):
    images = t.sky_image.select("band", "expnum", "ra_cent", "dec_cent", "ra_size", "dec_size", *sphere.corner_names("rac"), *sphere.corner_names("decc"))
    return overlap.overlap_join(images, depth.with_pixel_limits(t.sky_tile))


@query
def depth_map(t):
    return depth.depth_map(depth.depth_runs(depth.merge_rectangles(depth.rectangles(_corner_pairs(t)))))


@query
def depth_fractions(t):
    return depth.tile_statistics(_corner_pairs(t))


@query
def depth_json(t):
    documents = depth.depth_json(depth.tile_statistics(_corner_pairs(t)))
    return documents.select("tilename", *[
        F.get_json_object("json", f"$.{band}.D{n}").cast("double").alias(f"{band}_d{n}") for band in "grizY" for n in range(1, 8)])


# -- lists, bands, names -------------------------------------------------------------------------


def _assoc(t):
    # what an image says by itself is worked out once an image, ahead of the fan-out to tiles
    df = select.candidate_images(t.sky_image, zeropoint=t.sky_zeropoint)
    planes = {
        "sci": (F.col("filename"), F.col("compression"), F.col("path")),
        "bkg": (F.replace("filename", F.lit(".fits"), F.lit("_bkg.fits")), F.col("compression"), F.concat(F.lit("BKG/"), "path")),
        "seg": (F.replace("filename", F.lit(".fits"), F.lit("_segmap.fits")), F.lit(None).cast("string"), F.concat(F.lit("SEG/"), "path"))}
    df = df.withColumns({f"{n}_{k}": c for k, plane in planes.items() for n, c in zip(("filename", "compression", "path"), plane, strict=True)})
    for k in ("bkg", "seg"):
        df = naming.with_image_paths(df, LOCAL, HTTPS, k).withColumnRenamed("filepath_local", f"filepath_{k}")
    df = naming.with_image_paths(df, LOCAL, HTTPS, "sci").withColumn("_base", naming.base_name("filepath_local"))
    df = select.select_inputs(t.sky_tile, df)
    nwg = naming.prepared_image_name(F.col("filepath_local"), F.col("tilename"), F.concat(F.lit(TILEDIR + "/"), "tilename"), base="_base")
    return df.withColumn("filepath_nwg", nwg).drop("_base")


@query
def flux_scale(t):
    return _assoc(t).select("tilename", "filename", "mag_zero", F.round(photometry.flux_scale(), 8).alias("flxscale"))


@query
def band_lists(t):
    return lists.coadd_lists(_assoc(t))


@query
def meds_lists(t):
    return lists.meds_lists(_assoc(t))


@query
def mangle_lists(t):
    return lists.mangle_lists(_assoc(t))


@query
def exposure_lists(t):
    return lists.exposure_files(naming.with_catalog_paths(t.sky_catalog, LOCAL, HTTPS))


@query
def scamp_lists(t):
    return lists.scamp_lists(t.sky_catalog, TILEDIR, "T1")


@query
def drop_failed(t):
    failures = _assoc(t).filter("ccdnum = 2").select("filepath_nwg")
    return lists.drop_failed(_assoc(t), failures).select("tilename", "filename", "filepath_nwg")


def _bands(t):
    # one image of each band is enough, whichever it is; up to some 200 of them, making all pairs takes less than the rounds
    return lists.bands_present(sampling.leading_pairs(t.sky_image, t.sky_tile, 1, 7, "expnum", ["tilename", "band"], whole=1 / 64))


def _joined(c) -> Column:
    return F.array_join(c, ",")


@query
def band_plan(t):
    df = lists.band_plan(_bands(t))
    return df.select("tilename", "n_bands", _joined("do_bands").alias("do_bands"), _joined("d_bands").alias("d_bands"))


@query
def detection_bands(t):
    return _bands(t).select("tilename", _joined(lists.detection_bands()).alias("det_bands"))


@query
def color_triple(t):
    return _bands(t).select("tilename", _joined(lists.color_triple()).alias("triple"))


@query
def tile_list_union(t):
    a = t.sky_tile.filter("dec_cent > -10").select("tilename")
    b = t.sky_tile.filter("ra_cent < 200").select("tilename")
    return a.unionByName(b)


@query
def path_names(t):
    df = naming.with_image_paths(t.sky_image, LOCAL, HTTPS).withColumn("tilename", F.lit("T1"))
    red = naming.prepared_image_name(F.col("filepath_local"), F.col("tilename"), TILEDIR)
    head = naming.head_file_name(F.col("filepath_local"), F.col("tilename"), TILEDIR, naming.file_label("filepath_local"))
    return df.select(
        "filename", red.alias("filepath_nwg"), head.alias("filepath_head"),
        naming.exposure_file_name().alias("exposure_name"), naming.exposure_prefix().alias("prefix"),
        naming.file_label("filepath_local").alias("label"))


@query
def https_paths(t):
    df = naming.with_image_paths(t.sky_image, LOCAL, HTTPS)
    return df.select("filename", "filepath_local", naming.https_from_local("filepath_local", LOCAL, HTTPS).alias("filepath_https"))


@query
def product_files(t):
    groups = _pairs(t).select(F.col("tilename").alias("base"), "band", F.col("expnum").alias("exposure")).distinct()
    groups = groups.withColumn("suffix", F.concat(F.lit("v"), F.col("exposure") % 9))
    kinds = F.array(*[F.lit(k) for k in naming.PRODUCT_FILES])
    return naming.with_product_paths(groups.withColumn("kind", F.explode(kinds)), TILEDIR).select(
        "base", "band", "exposure", "kind", "product_path")


@query
def label_unique(t):
    files = t.sky_catalog.select("filetype", F.col("filename").alias("filepath_local"))
    cats = lists.unique_label(files, keys=["filetype"])
    images = lists.unique_label(t.sky_image.select("band", F.col("filename").alias("filepath_local")), keys=["band"])
    return cats.withColumnRenamed("filetype", "grp").unionByName(images.withColumnRenamed("band", "grp"))


@query
def archive_roots(t):
    archives = t.supplier.select(F.col("s_name").alias("name"), F.concat(F.lit("/root/"), "s_nationkey").alias("root"))
    values = t.supplier.select(
        F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 2 == 0, "root_https").otherwise("root_http").alias("key"),
        F.concat(F.lit("https://"), "s_suppkey").alias("val"))
    return select.archive_root(archives, values, "Supplier#000000004")


@query
def polygon_files(t):
    archive = t.sky_tile.filter("dec_cent > -30").select(
        F.concat(F.lit("Y3A1v1_tiles_10s."), "tile_id", F.lit(".pol")).alias("filename"), F.lit("OPS/pol").alias("path"))
    return select.polygon_files(archive, t.sky_tile)


@query
def tile_names(t):
    return t.sky_image.select("filename", naming.tile_name().alias("short_name"), naming.long_tile_name().alias("long_name"),
                              F.round(sphere.tile_overlap("dec_cent"), 6).alias("overlap"))


# -- sampling --------------------------------------------------------------------------------------

DRAWN = ["tilename", "band", "filename", "expnum"]


@query
def sample_exposures(t):
    pairs = sampling.leading_pairs(t.sky_image, t.sky_tile, sampling.EXPOSURES_PER_BAND, 7, "expnum", DRAWN)
    df = sampling.random_exposures(pairs, seed=7, exposure=F.col("expnum"))
    return sampling.tag_rows(df, "RAN_EXP")


@query
def sample_exposures_by_prefix(t):
    pairs = sampling.leading_pairs(t.sky_image, t.sky_tile, sampling.EXPOSURES_PER_BAND, 7, naming.exposure_prefix(), DRAWN)
    return sampling.tag_rows(sampling.random_exposures(pairs, seed=7), "RAN_EXP")


@query
def sample_images(t):
    quota = {"g": 2, "r": 1, "i": 3, "z": 2, "Y": 1}
    images = t.sky_image.filter(F.col("band").isin(*quota))
    pairs = sampling.leading_pairs(images, t.sky_tile, max(quota.values()), 7, "filename", DRAWN)
    return sampling.tag_rows(sampling.random_images(pairs, quota, seed=7), "RAN_CCD")


# -- comparisons -----------------------------------------------------------------------------------


@query
def catalog_compare(t):
    a = t.embeddings.withColumns({"plain": F.col("label") * 2, "gap": F.when(F.col("label") > 2, F.col("label"))})
    b = t.embeddings.withColumns({
        "label": F.when(F.col("label") == 3, F.col("label") + 1).otherwise(F.col("label")),
        "embedding": F.when(F.col("label") == 1, F.slice("embedding", 1, 5)).otherwise(F.col("embedding")),
        "plain": F.col("label") * 2, "extra": F.lit(1), "gap": F.when(F.col("label") > 2, F.col("label"))})
    return quality.compare_catalogs(a, b, ["vec_id"])


@query
def catalog_compare_rows(t):
    """Tables without a key, paired by their place in an order; the second lacks rows at the end."""
    a = t.supplier.select("s_name", "s_nationkey", F.col("s_acctbal").cast("double").alias("s_acctbal"), F.lit("x").alias("same"))
    b = t.supplier.filter("s_suppkey > 3").select(
        F.col("s_name"), F.when(F.col("s_suppkey") % 10 == 0, -1).otherwise(F.col("s_nationkey")).alias("s_nationkey"),
        F.col("s_acctbal").cast("double").alias("s_acctbal"), F.lit("x").alias("same"), F.lit(1).alias("more"))
    return quality.compare_catalogs_by_row(a, b, ["s_name", "s_nationkey", "s_acctbal"])


def _second_plane(t):
    # without the last pixel of each plane
    return t.sky_pixel.filter("NOT (x = 7 AND y = 7)").withColumn("value", F.col("value") + F.when((F.col("x") + F.col("y")) % 3 == 0, F.col("x") - F.col("y") + 1).otherwise(0))


@query
def plane_diff(t):
    df = quality.plane_statistics(quality.plane_difference(t.sky_pixel, _second_plane(t)))
    return df.select("file", "hdu", "n_pix", "n_unpaired", "n_diff", *rounded("fraction", "diff_mean"), "diff_min", "diff_max", F.col("diff_median").cast("double").alias("diff_median"))


@query
def plane_diff_image(t):
    return quality.plane_difference(t.sky_pixel, _second_plane(t)).filter("diff <> 0")


@query
def config_diff(t):
    new = t.part.select(F.concat(F.lit("K"), "p_partkey").alias("key"), F.col("p_type").alias("value"))
    ref = t.part.filter("p_size <> 5").select(
        F.concat(F.lit("K"), "p_partkey").alias("key"),
        F.when(F.col("p_size") == 7, F.lit("OTHER")).otherwise(F.col("p_type")).alias("value"))
    return quality.config_difference(new, ref)


def _file_pairs(t):
    return t.sky_catalog.select(F.col("filename").alias("file1"), F.concat(F.lit("H"), "expnum", F.lit(".fits")).alias("file2"))


def _inventory(t):
    cats = t.sky_catalog.filter("filetype <> 'cat_firstcut'").select("filename")
    return cats.unionByName(t.sky_catalog.filter("band <> 'g'").select(F.concat(F.lit("H"), "expnum", F.lit(".fits")).alias("filename")))


@query
def pair_missing(t):
    return quality.missing_pairs(_file_pairs(t), _inventory(t))


@query
def pair_existing(t):
    return quality.existing_pairs(_file_pairs(t), _inventory(t))


@query
def corner_compare(t):
    stored = t.sky_tile.withColumns({"rac1": F.col("rac1") + 0.001, "decc3": F.col("decc3") - 0.002})
    df = tiling.compare_corners(t.sky_tile, stored)
    return df.select("tilename", *rounded(*[c for c in df.columns if c != "tilename"]))


@query
def mask_external(t):
    mask = t.sky_pixel.groupBy("y", "x").agg((F.count_if(F.col("value") > 0) > F.count(F.lit(1)) / 2).cast("int").alias("value"))
    return quality.mask_by_plane(t.sky_pixel, mask)


@query
def mask_rectangles(t):
    rects = t.nation.select(
        (F.col("n_nationkey") % 5).alias("x1"), (F.col("n_nationkey") % 5 + 2).alias("x2"),
        (F.floor(F.col("n_nationkey") / 5)).cast("int").alias("y1"), (F.floor(F.col("n_nationkey") / 5) + 2).cast("int").alias("y2")
    ).filter("x1 <> y1")
    return quality.mask_by_rectangles(t.sky_pixel, rects, cell=4)


# -- table maintenance -----------------------------------------------------------------------------


@query
def upsert_tile(t):
    base = t.sky_bounds_stored.select("tilename", "id", "dec_cent")
    new = t.sky_bounds.filter("kind = 5 or kind > 40").select("tilename", (F.col("id") + 1000000).alias("id"), "dec_cent")
    df = tables.upsert(base, new, ["tilename"])
    return df.select("tilename", "id", *rounded("dec_cent"))


@query
def update_corners(t):
    changes = wcs.with_image_corners(t.sky_header.filter("crval2 > 0")).select(F.col("image_id").alias("tile_id"), "rac1", "decc1", "rac2", "decc2")
    df = tables.update_columns(t.sky_tile, changes, ["tile_id"], ["rac1", "decc1", "rac2", "decc2"])
    return df.select("tilename", *rounded("rac1", "decc1", "rac2", "decc2", "rac3"))


@query
def lookup_tiles(t):
    names = t.sky_location.select("tilename")
    df = tables.lookup_tiles(t.sky_tile, names)
    return df.select("tile_id", "tilename", "pixelscale", "naxis1", "naxis2", *rounded("ra_cent", "dec_cent", "racmin", "racmax", "deccmin", "deccmax"), "crossra0")


@query
def constraint_violations(t):
    return quality.constraint_violations(
        t.sky_image.withColumn("band_checked", F.nullif(F.col("band"), F.lit("Y"))),
        not_null=["filename", "compression", "band_checked"], unique=[["filename"], ["expnum", "ccdnum"]],
        checks={"crossra0": F.col("crossra0").isin("Y", "N"), "north": F.col("dec_cent") > 0})


# -- text formats ------------------------------------------------------------------------------------


def _assoc_rows(t):
    df = select.select_inputs(t.sky_tile, t.sky_image, zeropoint=t.sky_zeropoint)
    return df.select("tilename", F.col("band").alias("filter"), F.col("filename").alias("FILEPATH_LOCAL"), F.col("band").alias("BAND"), "mag_zero").withColumnRenamed("mag_zero", "MAG_ZERO")


def _scratch(t, name):
    return f"{staging.shared_folder(t._spark)}/{name}-{uuid.uuid4().hex}"


@query
def list_files(t):
    """One ordered file for each tile and band, line by line as written."""
    path = _scratch(t, "lists")
    writers.write_list_files(_assoc_rows(t), path, ["tilename", "filter"], ["FILEPATH_LOCAL", "MAG_ZERO"])
    lines = t._spark.read.text(path, wholetext=True)
    lines = lines.select("tilename", "filter", F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("place", "line"))
    return lines.select("tilename", "filter", "place", "line")


@query
def list_rows(t):
    """The same lists read back with declared types."""
    path = _scratch(t, "lists")
    writers.write_list(_assoc_rows(t), path, by=["tilename", "filter"])
    return readers.read_list(t._spark, path, T.StructType([*schemas.ASSOC, T.StructField("tilename", T.StringType()), T.StructField("filter", T.StringType())]))


@query
def sorted_list_lines(t):
    """Lists of which a group may fill several files: their lines in the order of the files."""
    path = _scratch(t, "sorted")
    lines = _assoc_rows(t).select("tilename", F.concat_ws(" ", "FILEPATH_LOCAL", "BAND", F.col("MAG_ZERO").cast("string")).alias("line"), F.col("FILEPATH_LOCAL").alias("key"))
    writers.write_sorted_text(lines, path, ["key", "line"], by=["tilename"])
    files = t._spark.read.text(path, wholetext=True).select("tilename", F.col("_metadata.file_name").alias("file"), "value")
    whole = files.groupBy("tilename").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file", "value"))), lambda f: f["value"]), "").alias("value"))
    return whole.select("tilename", F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("place", "line"))


@query
def stored_table(t):
    """A table created, replaced by a part of itself, and added to."""
    name = f"images_{uuid.uuid4().hex}"
    rows = t.sky_image.select("filename", "band", "expnum", "ccdnum")
    before = tables.table_exists(t._spark, name)
    tables.create_table(rows.filter("band <> 'r'"), name)
    kept = tables.create_table(rows, name)
    tables.create_table(t._spark.table(name).filter("ccdnum < 4"), name, clobber=True)
    tables.append_rows(rows.filter("band = 'r'").select("ccdnum", "expnum", "band", "filename"), name)
    tables.append_rows(t._spark.table(name).filter("ccdnum = 1 AND band = 'g'"), name)
    return t._spark.table(name).select("*", F.lit(before).alias("was_there"), F.lit(kept).alias("replaced_unasked"), F.lit(tables.table_exists(t._spark, name)).alias("is_there"))


@query
def stored_columns(t):
    """Columns of the stored tile table with their comments and stored types, and what they hold."""
    tiles = schemas.with_comments(schemas.to_sink_types(t.sky_tile.select("tilename", "ra_cent", "dec_cent", "rac2", "racmin", "pixelscale", "naxis1", "crossra0"), "coaddtile"))
    name = f"tiles_{uuid.uuid4().hex}"
    tables.create_table(tiles, name)
    stored = t._spark.table(name)
    # One row of aggregates, turned afterwards: extremes of text by group would sort a row for every value.
    kept = stored.agg(F.count(F.lit(1)).alias("_rows"), *[F.struct(
        F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.metadata.get("comment")).alias("comment"),
        F.count(f.name).alias("n"), F.min(F.col(f.name).cast("string")).alias("least"), F.max(F.col(f.name).cast("string")).alias("most")).alias(f.name) for f in stored.schema])
    return kept.filter("_rows > 0").select(F.inline(F.array(*[F.col(f.name) for f in stored.schema])))


@query
def tile_json_lines(t):
    return writers.tile_json(t.sky_tile.withColumn("id", F.col("tile_id").cast("int"))).select(
        "tilename", *[F.get_json_object("json", f"$.tileinfo.{k}").cast(kind).alias(k.lower()) for k, kind in (
            ("ID", "int"), ("RA_CENT", "double"), ("DECC3", "double"), ("RACMIN", "double"), ("NAXIS1", "int"), ("CROSSRA0", "string"))],
        F.get_json_object("json", "$.tilename").alias("name_inside"), F.json_object_keys(F.get_json_object("json", "$.tileinfo")).cast("string").alias("keys"))


@query
def tile_json_records(t):
    """Tile documents of today, of older keys, with a wrong value and cut short, read with declared types."""
    tiles = t.sky_tile.withColumn("id", F.col("tile_id").cast("int"))
    now = writers.tile_json(tiles).select(F.col("json").alias("value"), "tilename")
    older = F.format_string('{"tileinfo": {"RA": %s, "DEC": %s, "CROSSRAZERO": "%s", "NAXIS1": 10000.0, "PIXELSCALE": %s}, "tilename": "%s"}', "ra_cent", "dec_cent", "crossra0", F.when(F.col("tile_id") % 7 == 0, F.lit('"fine"')).otherwise(F.lit("0.36")), "tilename")
    given = F.when(F.col("tile_id") % 3 == 0, F.col("value")).when(F.col("tile_id") % 3 == 1, older).otherwise(F.substring("value", 1, 40))
    # Spark reckons with the compressed tiles, not with their documents, and would broadcast these
    documents = tiles.join(now.hint("merge"), "tilename").select(given.alias("value"))
    df = readers.parse_tile_json(documents)
    return df.select("tilename", *rounded("ra_cent", "dec_cent", "rac1"), "crossra0", "naxis1", "id", "pixelscale", F.length("misfit").alias("misfit_length"))


def _flat_tiles(t):
    """The older geometry's columns, one tile per part."""
    tiles = t.sky_bounds.withColumns({"pixelscale": F.lit(0.27), "naxis1": F.lit(10000), "naxis2": F.lit(10000)})
    names = {"rall": "uramin", "decll": "udecmin", "raul": "uramin", "decul": "udecmax", "raur": "uramax", "decur": "udecmax", "ralr": "uramax", "declr": "udecmin",
             "ural": "uramin", "urau": "uramax", "udecl": "udecmin", "udecu": "udecmax"}
    return tiles.select("dec_row", "ra_step", "tilename", "ra_cent", "dec_cent", "pixelscale", "naxis1", "naxis2", *[F.col(old).alias(new) for new, old in names.items()])


@query
def tile_dump_lines(t):
    return writers.tile_dump_lines(_flat_tiles(t))


@query
def tile_dump_records(t):
    """Fixed-width, comma-separated and broken lines of the dump."""
    flat = _flat_tiles(t)
    csv = F.when(F.col("ra_step") % 3 == 0, F.regexp_replace("line", ",", ", ")).when(F.col("ra_step") % 3 == 1, F.regexp_replace("line", r"^([^,]*),", "$1,x")).otherwise(F.col("line"))
    lines = writers.tile_dump_lines(flat).select(F.col("line").alias("value")).unionByName(writers.tile_dump_csv(flat).select(csv.alias("value")))
    return readers.parse_tile_dump(lines).select("tilename", *rounded("ra_cent", "rall", "udecu"), "naxis2", F.col("misfit").isNotNull().alias("is_misfit"))


@query
def assoc_json_document(t):
    df = t.sky_image.select(F.col("filename").alias("FILEPATH_LOCAL"), F.col("band").alias("BAND"), F.when(F.col("ccdnum") != 2, F.col("ccdnum")).alias("MAG_ZERO"))
    return writers.assoc_json_lines(df).groupBy("part", "place", "line").agg(F.count(F.lit(1)).alias("n"))


@query
def config_lines(t):
    lines = t.part.select(F.col("p_partkey").alias("place"), F.when(F.col("p_size") % 7 == 0, F.concat(F.lit("# "), "p_brand", F.lit(" off"))).when(
        F.col("p_size") % 7 == 1, F.col("p_brand")).otherwise(F.concat(F.lit(" "), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("   V"), "p_partkey", F.lit(" # note"))).alias("value"))
    return readers.parse_config(lines, "place")


@query
def name_lines(t):
    name = F.col("tilename")
    lines = t.sky_tile.select(F.when(F.col("tile_id") % 3 == 0, name).when(
        F.col("tile_id") % 3 == 1, F.concat(F.lit("where tilename in ('"), name, F.lit("', 'X"), "tile_id", F.lit("')"))).otherwise(F.lit("two words")).alias("value"))
    return readers.parse_names(lines)


@query
def section_lines(t):
    lines = t.part.select(F.when(F.col("p_size") == 1, F.lit("# file section detector")).otherwise(F.concat(
        F.lit("D"), "p_partkey", F.lit(".fits   ["), F.col("p_size"), F.lit(":"), F.col("p_size") + 2047, F.lit(",1:4096]  "), F.col("p_partkey") % 62 + 1,
        F.lit(" 12.5 -7 "), F.col("p_size"), F.lit(".25 30"))).alias("value"))
    return readers.parse_detector_sections(lines)


@query
def list_lines(t):
    lines = t.sky_image.select(F.explode(F.array(F.lit("# FILENAME BAND EXPNUM "), F.lit("  "), F.concat("filename", F.lit(" "), "band", F.lit("  "), "expnum", F.lit(" ")))).alias("value"))
    return readers.parse_commented_list(lines, "FILENAME string, BAND string, EXPNUM long")
