"""Denormalised input tables built from the processing archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyjoin.functions import healpix, sphere

# File types of the archive.
IMAGE_TYPE, BACKGROUND_TYPE, SEGMENTATION_TYPE = "red_immask", "red_bkg", "red_segmap"
CATALOG_TYPE, EXPOSURE_CATALOG_TYPE, EXPOSURE_HEAD_TYPE = "cat_finalcut", "cat_scamp_full", "head_scamp_full"

GEOMETRY = [
    "crossra0", "racmin", "racmax", "deccmin", "deccmax", "ra_cent", "dec_cent",
    "rac1", "rac2", "rac3", "rac4", "decc1", "decc2", "decc3", "decc4",
]


def _tagged(proctag: DataFrame, tag: str, keys: list[str]) -> DataFrame:
    return proctag.filter(F.col("tag") == tag).select(*keys)


def _of_type(files: DataFrame, filetype: str) -> DataFrame:
    return files.filter(F.col("filetype") == filetype)


def _archived(files: DataFrame, archive: DataFrame, suffix: str = "") -> DataFrame:
    """Files with archive path and compression; columns take ``suffix``."""
    joined = files.join(archive.select("filename", "compression", "path"), "filename")
    for name in ("filename", "compression", "path"):
        joined = joined.withColumnRenamed(name, f"{name}{suffix}")
    return joined


def _sizes(df: DataFrame) -> DataFrame:
    return df.withColumns({"ra_size": sphere.ra_extent(), "dec_size": sphere.dec_extent()})


def build_image_inputs(
    image: DataFrame, archive: DataFrame, proctag: DataFrame, tag: str, filetype: str = IMAGE_TYPE,
    nside: int | None = None,
) -> DataFrame:
    """Images of a tag with their archive location, sizes and, on request, HEALPix pixel."""
    picked = _of_type(image, filetype).join(_tagged(proctag, tag, ["pfw_attempt_id"]), "pfw_attempt_id")
    df = _sizes(_archived(picked, archive)).select(
        "filename", "compression", "path", "pfw_attempt_id", "band", "ccdnum", "expnum", *GEOMETRY, "ra_size", "dec_size")
    return df if nside is None else with_healpix(df, nside)


def with_healpix(df: DataFrame, nside: int = 32) -> DataFrame:
    return healpix.with_nested_index(df, f"hpix_{nside}", nside=nside)


def merge_healpix(images: DataFrame, pixels: DataFrame, nside: int = 32) -> DataFrame:
    """Images joined with a table of (filename, pixel) made elsewhere."""
    return images.join(pixels.select("filename", f"hpix_{nside}"), "filename")


def sky_map_lookup(df: DataFrame, sky_map: DataFrame, nside: int = 32, ra: str = "ra_cent", dec: str = "dec_cent") -> DataFrame:
    """Value of a HEALPix map (hpix, value) at each row's position; NULL off the map.

    The map has 12 * nside^2 pixels at most; Spark broadcasts it where that is small.
    """
    placed = healpix.with_nested_index(df, "hpix", ra, dec, nside)
    return placed.join(sky_map.select("hpix", F.col("value").alias("map_value")), "hpix", "left")


def build_plane_inputs(
    image: DataFrame, miscfile: DataFrame, archive: DataFrame, proctag: DataFrame, tag: str,
    filetype: str = IMAGE_TYPE, geometry: bool = True,
) -> DataFrame:
    """Science image, background and segmentation files of each detector of a tag.

    Each of the three is limited to the tag before it meets the archive.
    """
    tags = _tagged(proctag, tag, ["pfw_attempt_id"])
    key = ["pfw_attempt_id", "ccdnum"]
    carried = ["band", "expnum", *(GEOMETRY if geometry else [])]
    red = _of_type(image, filetype).select("filename", *key, *carried).join(tags, "pfw_attempt_id")
    bkg = _of_type(image, BACKGROUND_TYPE).select("filename", *key).join(tags, "pfw_attempt_id", "left_semi")
    seg = _of_type(miscfile, SEGMENTATION_TYPE).select("filename", *key).join(tags, "pfw_attempt_id", "left_semi")
    df = (
        _archived(red, archive)
        .join(_archived(bkg, archive, "_bkg"), key)
        .join(_archived(seg, archive, "_seg"), key)
    )
    return _sizes(df) if geometry else df


def build_catalog_inputs(catalog: DataFrame, archive: DataFrame, proctag: DataFrame, tag: str, filetype: str = CATALOG_TYPE) -> DataFrame:
    """Catalogues of a tag with their archive path."""
    picked = _of_type(catalog, filetype).select("filename", "pfw_attempt_id", "band", "ccdnum", "expnum")
    return (
        picked.join(_tagged(proctag, tag, ["pfw_attempt_id"]), "pfw_attempt_id")
        .join(archive.select("filename", "path"), "filename")
        .select("filename", "path", "pfw_attempt_id", "band", "ccdnum", "expnum")
    )


def build_exposure_catalog_inputs(
    catalog: DataFrame, miscfile: DataFrame, archive: DataFrame, proctag: DataFrame, tag: str,
) -> DataFrame:
    """Exposure-level catalogues of a tag paired with their header files; distinct."""
    key = ["pfw_attempt_id", "expnum"]
    cats = _of_type(catalog, EXPOSURE_CATALOG_TYPE).select(F.col("filename").alias("filename_scampcat"), *key, "band")
    heads = _of_type(miscfile, EXPOSURE_HEAD_TYPE).select(F.col("filename").alias("filename_scamphead"), *key)
    paths = archive.select(F.col("filename").alias("filename_scampcat"), "path")
    return (
        cats.join(_tagged(proctag, tag, ["pfw_attempt_id"]), "pfw_attempt_id")
        .join(heads, key).join(paths, "filename_scampcat")
        .select("filename_scampcat", "filename_scamphead", "path", "pfw_attempt_id", "expnum", "band")
        .distinct()
    )


RUN_KEY = ["reqnum", "unitname", "attnum"]


def _once(df: DataFrame, *names: str) -> DataFrame:
    """The same with ``names`` worked out once a row, however many tests the joins make of them.

    They come out of a generator: tests on a projection move below it, where each works its column out anew.
    """
    return df.select(*[c for c in df.columns if c not in names], F.inline(F.array(F.struct(*names))))


def provenance_inputs(
    image: DataFrame, archive: DataFrame, wgb: DataFrame, proctag: DataFrame, tag: str,
    filetype: str = "red", exec_name: str | None = "immask",
) -> DataFrame:
    """Images of a tag found through their provenance (request, unit, attempt)."""
    made = _of_type(wgb, filetype)
    if exec_name is not None:
        made = made.filter(F.col("exec_name") == exec_name)
    made = made.select("filename", *RUN_KEY)
    return (
        made.join(_tagged(proctag, tag, RUN_KEY), RUN_KEY)
        .join(archive.select("filename", "compression", "path"), "filename")
        .join(image, "filename")
    )


def provenance_by_artifact(
    image: DataFrame, archive: DataFrame, genfile: DataFrame, artifact: DataFrame,
    generated_by: DataFrame, execution: DataFrame, proctag: DataFrame, tag: str,
    pattern: str = "%immasked%", filetype: str = "red",
) -> DataFrame:
    """The same through artifacts and executed tasks: from the tag's tasks, few, to their files."""
    files = _once(_of_type(genfile, filetype).select("filename"), "filename").filter(F.col("filename").like(pattern))
    tasks = execution.select("task_id", *RUN_KEY).join(_tagged(proctag, tag, RUN_KEY), RUN_KEY)
    made = (
        _once(generated_by.select("opm_artifact_id", "task_id"), "opm_artifact_id").join(tasks, "task_id")
        .join(_once(artifact.select(F.col("name").alias("filename"), F.col("id").alias("opm_artifact_id")), "filename", "opm_artifact_id"), "opm_artifact_id")
        .join(files, "filename")
    )
    return (
        made.drop("opm_artifact_id", "task_id")
        .join(_once(archive.select("filename", "compression", "path"), "filename"), "filename")
        .join(_once(image, "filename"), "filename")
    )
