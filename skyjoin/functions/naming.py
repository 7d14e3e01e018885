"""Tile names, archive paths and product file names as Spark columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyjoin.functions import sphere

# Fixed value: names of the survey's tiles start with it.
TILE_PREFIX = "DES"

# Pushes a value that sits one rounding error below a whole minute over it.
MINUTE_TOLERANCE = 1e-6


def _two(value: Column) -> Column:
    return F.lpad(value.cast("bigint").cast("string"), 2, "0")


def _hours_minutes(value: Column) -> Column:
    """``hhmm`` of a non-negative sexagesimal value, minutes cut not rounded."""
    minutes = F.floor(value * 60 + MINUTE_TOLERANCE)
    return F.concat(_two(F.floor(minutes / 60)), _two(F.pmod(minutes, F.lit(60))))


def _sign(dec: Column) -> Column:
    return F.when(dec < 0, F.lit("-")).otherwise(F.lit("+"))


def tile_name(ra="ra_cent", dec="dec_cent", prefix: str = TILE_PREFIX) -> Column:
    """Short name: prefix, RA as hhmm, signed Dec as ddmm."""
    ra, dec = sphere._c(ra), sphere._c(dec)
    return F.concat(F.lit(prefix), _hours_minutes(ra / 15.0), _sign(dec), _hours_minutes(F.abs(dec)))


def _with_seconds(value: Column) -> Column:
    hundredths = F.round(value * 360000).cast("bigint")
    minutes = F.floor(hundredths / 6000)
    seconds = F.pmod(hundredths, F.lit(6000))
    return F.concat(
        _two(F.floor(minutes / 60)), _two(F.pmod(minutes, F.lit(60))),
        _two(F.floor(seconds / 100)), F.lit("."), _two(F.pmod(seconds, F.lit(100))),
    )


def long_tile_name(ra="ra_cent", dec="dec_cent", prefix: str = TILE_PREFIX) -> Column:
    """Long name with seconds to two decimals: prefix, J, hhmmss.ss, signed ddmmss.ss."""
    ra, dec = sphere._c(ra), sphere._c(dec)
    return F.concat(F.lit(f"{prefix}J"), _with_seconds(ra / 15.0), _sign(dec), _with_seconds(F.abs(dec)))


def exposure_file_name(expnum="expnum", ccdnum="ccdnum") -> Column:
    """Archive name of one detector of one exposure."""
    # Fixed value: file name format.
    return F.format_string("DECam_%08d_%02d.fits", sphere._c(expnum).cast("bigint"), sphere._c(ccdnum).cast("int"))


def exposure_prefix(filename="filename", length: int = 9) -> Column:
    return F.substring(sphere._c(filename), 1, length)


# -- archive paths ---------------------------------------------------------------------


def null_to_blank(names) -> dict[str, Column]:
    """Empty string for NULL in the named columns."""
    return {n: F.coalesce(F.col(n), F.lit("")) for n in names}


def join_path(*parts) -> Column:
    """Parts joined by one slash each; a root may end in a slash already."""
    *roots, last = [sphere._c(p) for p in parts]
    # trimming goes through all characters of a text, so it is left to those that need it
    return F.concat_ws("/", *[F.when(F.endswith(r, F.lit("/")), F.rtrim(r, F.lit("/"))).otherwise(r) for r in roots], last)


def image_suffix(imagetype: str | None) -> str:
    return f"_{imagetype.lower()}" if imagetype else ""


def with_image_paths(
    df: DataFrame, local_archive, root_https, imagetype: str | None = None,
) -> DataFrame:
    """FILEPATH_LOCAL and FILEPATH_HTTPS of the science ('' ), 'bkg' or 'seg' plane.

    FILENAME, COMPRESSION and PATH of the chosen plane take the plain names.
    """
    s = image_suffix(imagetype)
    df = df.withColumns({
        "filename": F.col(f"filename{s}"),
        "compression": F.coalesce(F.col(f"compression{s}"), F.lit("")),
        "path": F.col(f"path{s}"),
    })
    name = F.concat(F.col("filename"), F.col("compression"))
    return df.withColumns({
        "filepath_local": join_path(_root(local_archive), "path", name),
        "filepath_https": join_path(_root(root_https), "path", name),
    })


def with_catalog_paths(
    df: DataFrame, local_archive, root_https, filename_key: str = "filename",
) -> DataFrame:
    """The same for catalogue rows, which carry no compression suffix."""
    return df.withColumns({
        "filename": F.col(filename_key),
        "filepath_local": join_path(_root(local_archive), "path", filename_key),
        "filepath_https": join_path(_root(root_https), "path", filename_key),
    })


def _root(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def https_from_local(filepath, local_archive, root_https) -> Column:
    """Every occurrence of the local root replaced by the URL root."""
    return F.replace(sphere._c(filepath), _root(local_archive), _root(root_https))


def base_name(path) -> Column:
    return F.regexp_extract(sphere._c(path), r"([^/]*)$", 1)


def file_label(path) -> Column:
    """Last underscore-separated token of the file name without its extension."""
    name = F.replace(base_name(path), F.lit(".fits.fz"), F.lit(".fits"))
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    return F.regexp_extract(stem, r"([^_]*)$", 1)


def input_directory(tiledir) -> Column:
    return join_path(_root(tiledir), F.lit("inputs"))


def prepared_image_name(filepath, tilename, tiledir, extension_me="me", base=None) -> Column:
    """Tile's copy of an input image: tile prefix, inputs directory, ``-me.fits``.

    ``base`` is ``base_name(filepath)`` where the caller has it, as many tiles take the same image.
    """
    name = F.concat(_root(tilename), F.lit("_"), base_name(filepath) if base is None else sphere._c(base))
    name = join_path(input_directory(tiledir), name)
    name = F.replace(name, F.lit(".fits.fz"), F.lit(".fits"))
    return F.replace(name, F.lit(".fits"), F.lit(f"-{extension_me}.fits"))


def head_file_name(
    filepath, tilename, tiledir, label_cat, label_red="immasked", extension_me="me",
    extension_head="ohead",
) -> Column:
    """Header file that goes with a catalogue: labels swapped, header extension."""
    name = F.concat(_root(tilename), F.lit("_"), base_name(filepath))
    name = join_path(input_directory(tiledir), name)
    name = F.replace(name, F.lit(".fits.fz"), F.lit(".fits"))
    name = F.replace(name, _root(label_cat), F.lit(f"{label_red}-{extension_me}"))
    return F.replace(name, F.lit("fits"), F.lit(extension_head))


# -- product files ---------------------------------------------------------------------

# Product kind -> (sub-directory of the tile, file name format).
PRODUCT_FILES = {
    "sci_list": ("list/coadd", "{base}_{band}_sci.list"),
    "wgt_list": ("list/coadd", "{base}_{band}_wgt.list"),
    "msk_list": ("list/coadd", "{base}_{band}_msk.list"),
    "flx_list": ("list/coadd", "{base}_{band}_flx.list"),
    "sci_fits": ("coadd", "{base}_{band}_sci.fits"),
    "wgt_fits": ("coadd", "{base}_{band}_wgt.fits"),
    "msk_fits": ("coadd", "{base}_{band}_msk.fits"),
    "gen_fits": ("coadd", "{base}_{band}_{suffix}.fits"),
    "swarp_log": ("log", "{base}_swarp.log"),
    "swarp_cmd": ("aux", "{base}_call_swarp.cmd"),
    "stiff_cmd": ("aux", "{base}_call_stiff.cmd"),
    "stiff_log": ("log", "{base}_stiff.log"),
    "color": ("coadd", "{base}.tiff"),
    "stiff_ptif_cmd": ("aux", "{base}_call_stiff_ptif.cmd"),
    "stiff_ptif_log": ("log", "{base}_stiff_ptif.log"),
    "color_ptif": ("coadd", "{base}.ptif"),
    "extinction_cmd": ("aux", "{base}_call_extinction.cmd"),
    "extinction_log": ("log", "{base}_extinction.log"),
    "hpix_cmd": ("aux", "{base}_call_hpix.cmd"),
    "hpix_log": ("log", "{base}_hpix.log"),
    "psf": ("coadd", "{base}_{band}_psfcat.psf"),
    "psfcat": ("coadd", "{base}_{band}_psfcat.fits"),
    "sexpsf_cmd": ("aux", "{base}_call_SExpsf.cmd"),
    "sexpsf_log": ("log", "{base}_SExpsf.log"),
    "sexpsf_band_log": ("log", "{base}_{band}_SExpsf.log"),
    "psfex_stars": ("coadd", "{base}_{band}_psfex-starlist.fits"),
    "psfex_xml": ("coadd", "{base}_{band}_psfex.xml"),
    "psfex_cmd": ("aux", "{base}_call_psfex.cmd"),
    "psfex_log": ("log", "{base}_psfex.log"),
    "psfex_band_log": ("log", "{base}_{band}_psfex.log"),
    "cat": ("coadd", "{base}_{band}_cat.fits"),
    "seg": ("coadd", "{base}_{band}_seg.fits"),
    "sexdual_cmd": ("aux", "{base}_call_SExdual.cmd"),
    "sexdual_log": ("log", "{base}_SExdual.log"),
    "sexdual_band_log": ("log", "{base}_{band}_SExdual.log"),
    "mef": ("coadd", "{base}_{band}.fits"),
    "mef_cmd": ("aux", "{base}_call_coadd_asseble.cmd"),
    "mef_band_cmd": ("aux", "{base}_{band}_call_coadd_assemble.cmd"),
    "me_prepare_cmd": ("aux", "{base}_call_me_prepare.cmd"),
    "me_prepare_log": ("log", "{base}_me_prepare.log"),
    "depth_plot": ("aux", "{base}_depth.pdf"),
    "depth_fits": ("aux", "{base}_{band}_depth.fits"),
    "depth_fraction": ("aux", "{base}_depth.json"),
    "ccd_plot": ("aux", "{base}_overlap.pdf"),
    "ccd_search_plot": ("aux", "{base}_overlap_{suffix}.pdf"),
    "ccd_image_plot": ("aux", "{base}_overlap_image.pdf"),
    "ccd_image_search_plot": ("aux", "{base}_overlap_image_{suffix}.pdf"),
    "catlist": ("list/coadd", "{base}_{exposure}_scampcat.list"),
    "headlist": ("list/coadd", "{base}_{exposure}_scamp.list"),
    "expcat": ("align", "{base}_{exposure}_scampcat.fits"),
    "exphead": ("align", "{base}_{exposure}_scampcat.head"),
    "expahead": ("align", "{base}_{exposure}_scampcat.ahead"),
    "expcat_list": ("list/coadd", "{base}_scampcat.list"),
    "expcat_head_list": ("list/coadd", "{base}_scampcat.head"),
    "scamp_xml": ("align", "{base}_scamp.xml"),
    "combine_cats_cmd": ("aux", "{base}_call_combine_cats.cmd"),
    "split_head_cmd": ("aux", "{base}_call_split_head.cmd"),
    "scamp_cmd": ("aux", "{base}_call_scamp.cmd"),
    "scamp_log": ("log", "{base}_{suffix}.log"),
    "assoc": ("aux", "{base}.assoc"),
    "assoc_image": ("aux", "{base}_{suffix}.assoc"),
    "cats": ("aux", "{base}_cats.list"),
    "scampcats": ("aux", "{base}_scampcats.list"),
    "scampheads": ("aux", "{base}_scampheads.list"),
    "scamp_plot": ("qa", "{base}_{suffix}"),
    "mangle_list_red": ("list/mangle", "{base}_{band}_mangle-red.list"),
    "mangle_list_me": ("list/mangle", "{base}_{band}_mangle-me.list"),
    "mangle_plot": ("qa/mangle", "{base}_{band}_mangle-{suffix}.png"),
    "mangle_cmd": ("aux", "{base}_call_mangle.cmd"),
    "mangle_log": ("mangle", "{base}_mangle.log"),
    "meds_list_nwg": ("list/meds", "{base}_{band}_nwg.list"),
    "meds_list_bkg": ("list/meds", "{base}_{band}_bkg.list"),
    "meds_list_seg": ("list/meds", "{base}_{band}_seg.list"),
    "meds_tileconf": ("meds", "{base}_{band}_fileconf.yaml"),
    "meds_cmd": ("aux", "{base}_call_meds.cmd"),
    "meds_log": ("log", "{base}_meds.log"),
    "meds_band_log": ("log", "{base}_{band}_meds.log"),
    "meds_fits": ("meds", "{base}_{band}_meds.fits"),
    "mask_cmd": ("aux", "{base}_mask_DECam.cmd"),
    "poltiles": ("mangle_tiles", "{suffix}_tiles_10s.{base}.pol"),
    "poltolys": ("mangle_tiles", "{suffix}_tolys_10s.{base}.pol"),
}

POLYGON_VERSION = "Y3A1v1"  # fixed value: default release of the polygon files


def _fill(pattern: Column, fields: dict) -> Column:
    for key, value in fields.items():
        pattern = F.replace(pattern, F.lit("{%s}" % key), value)
    return pattern


def product_path(
    kind, base="tilename", band=None, exposure=None, suffix=None, tiledir=None,
) -> Column:
    """Path of one product kind; pass ``tiledir=None`` for the bare file name."""
    subdir, pattern = PRODUCT_FILES[kind]
    fields = {"base": base, "band": band, "exposure": exposure, "suffix": suffix}
    used = {k: sphere._c(v).cast("string") for k, v in fields.items() if "{%s}" % k in pattern}
    name = _fill(F.lit(pattern), used)
    return name if tiledir is None else join_path(_root(tiledir), F.lit(subdir), name)


def product_kinds(spark: SparkSession) -> DataFrame:
    """The product table as rows (kind, subdir, pattern)."""
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(subdir).alias("subdir"), F.lit(pattern).alias("pattern")) for kind, (subdir, pattern) in PRODUCT_FILES.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


#: Most fields that a name format takes.
_PLACES = max(len(re.findall(r"{\w+}", pattern)) for _, pattern in PRODUCT_FILES.values())


def _piece(n: int) -> Column:
    """The ``n``-th piece, from 0, of a format cut before and after its fields: texts and fields take turns."""
    return F.get(F.split("pattern", "[{}]"), F.lit(n))


def with_product_paths(df: DataFrame, tiledir, kind: str = "kind") -> DataFrame:
    """PRODUCT_PATH for rows that name their own kind, base, band, exposure, suffix.

    The product table has a fixed number of rows, so it is joined by broadcast. Its formats are cut at their fields
    before, and a row's pieces are put side by side; only rows whose own texts hold a brace are filled in
    field after field.
    """
    names = ("base", "band", "exposure", "suffix")
    kinds = product_kinds(df.sparkSession).withColumnRenamed("kind", kind)
    # a format without a field at some place has an empty piece there
    pieces = {f"_text{n}": F.coalesce(_piece(2 * n), F.lit("")) for n in range(_PLACES + 1)}
    pieces |= {f"_field{n}": F.coalesce(F.array_position(F.array(*[F.lit(k) for k in names]), _piece(2 * n + 1)), F.lit(0)).cast("int") for n in range(_PLACES)}
    kinds = F.broadcast(kinds.withColumns(pieces))
    fields = {k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in names if k in df.columns}

    def value(n):
        # a field that the rows don't have stays as the format has it
        taken = F.lit("")
        for place, k in enumerate(names, 1):
            taken = F.when(F.col(f"_field{n}") == place, fields.get(k, F.lit("{%s}" % k))).otherwise(taken)
        return taken

    parts = [F.col("_text0")]
    for n in range(_PLACES):
        parts += [value(n), F.col(f"_text{n + 1}")]
    name = F.concat(*parts)
    braces = [F.contains(F.col(k).cast("string"), F.lit("{")) for k in fields]
    if braces:
        name = F.when(F.coalesce(sphere.any_of([F.coalesce(b, F.lit(False)) for b in braces]), F.lit(False)), _fill(F.col("pattern"), fields)).otherwise(name)
    path = join_path(_root(tiledir), "subdir", name)
    return df.join(kinds, kind, "left").withColumn("product_path", path).drop("subdir", "pattern", *pieces)
