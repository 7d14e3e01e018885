"""Which inputs cover which tiles: images, zero points, blacklist, catalogues."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyjoin.functions import naming
from skyjoin.operators import overlap

# Default zero-point selection.
ZP_SOURCE, ZP_VERSION, ZP_FLAG = "FGCM", "v2.0", 16


@dataclass
class Extras:
    """A caller's additions: columns, joined tables with their condition, predicate."""

    select: list[Column | str] = field(default_factory=list)
    joins: list[tuple[DataFrame, Column | str | list[str], str]] = field(default_factory=list)
    where: Column | str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        for other, on, how in self.joins:
            df = df.join(other, on, how)
        if self.where is not None:
            df = df.filter(F.expr(self.where) if isinstance(self.where, str) else self.where)
        if self.select:
            df = df.select("*", *self.select)
        return df


def usable_zeropoints(zeropoint: DataFrame, source=ZP_SOURCE, version=ZP_VERSION, flag=ZP_FLAG) -> DataFrame:
    return zeropoint.filter(
        (F.col("source") == source) & (F.col("version") == version) & (F.col("flag") < flag))


def with_zeropoints(images: DataFrame, zeropoint: DataFrame, source=ZP_SOURCE, version=ZP_VERSION, flag=ZP_FLAG, unique: bool = False) -> DataFrame:
    """MAG_ZERO per image; images without a usable zero point drop out, several fan out.

    With ``unique`` the job fails instead where an image of the table has several.
    """
    zp = usable_zeropoints(zeropoint, source, version, flag).select(F.col("imagename").alias("filename"), "mag_zero")
    if not unique:
        return images.join(zp, "filename")
    counted = zp.groupBy("filename").agg(F.first("mag_zero").alias("mag_zero"), F.count(F.lit(1)).alias("_zeropoints"))
    several = F.raise_error(F.format_string("%d usable zero points for image %s", F.col("_zeropoints"), F.col("filename")))
    # In a filter, which stays whatever columns are asked for later; the row's number keeps it above the
    # join, where zero points of other images are gone.
    bad = (F.col("_zeropoints") > 1) & (F.monotonically_increasing_id() >= 0)
    # merged: Spark reckons zero points by compressed files, and would send them through the driver
    return images.join(counted.hint("merge"), "filename").filter(F.when(bad, several.cast("boolean")).otherwise(True)).drop("_zeropoints")


def without_zeropoint(images: DataFrame, zeropoint: DataFrame, source=ZP_SOURCE, version=ZP_VERSION, flag=ZP_FLAG) -> DataFrame:
    """The images that ``with_zeropoints`` drops."""
    zp = usable_zeropoints(zeropoint, source, version, flag).select(F.col("imagename").alias("filename"))
    return images.join(zp, "filename", "left_anti")


def exclude_blacklisted(images: DataFrame, blacklist: DataFrame) -> DataFrame:
    return images.join(blacklist, ["expnum", "ccdnum"], "left_anti")


def exclude_by_name(images: DataFrame, blacklist: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Images whose file name is not among those of the blacklisted detectors."""
    names = catalogue.join(blacklist, ["expnum", "ccdnum"], "left_semi").select("filename")
    return images.join(names, "filename", "left_anti")


def with_tag(images: DataFrame, tags: DataFrame, tag: str, key: str = "filename") -> DataFrame:
    """Images that carry ``tag`` in a table of (key, tag); repeats in the table fan out."""
    return images.join(tags.filter(F.col("tag") == tag).select(key), key)


def candidate_images(
    images: DataFrame, *, zeropoint: DataFrame | None = None, blacklist: DataFrame | None = None,
    ccdnum: int = 0, zp_source=ZP_SOURCE, zp_version=ZP_VERSION, zp_flag=ZP_FLAG,
    zp_unique: bool = False, extras: Extras | None = None, counts: SelectionCounts | None = None,
) -> DataFrame:
    """Everything that is decided per image, ahead of the fan-out to tiles.

    ``zp_unique`` makes the job fail where an image has several usable zero points;
    ``counts`` takes the numbers of images found and dropped along with the job.
    """
    if counts is not None:
        return _counted_candidates(images, zeropoint, blacklist, ccdnum, (zp_source, zp_version, zp_flag), zp_unique, extras, counts)
    df = images
    if ccdnum > 0:
        df = df.filter(F.col("ccdnum") == ccdnum)
    if blacklist is not None:
        df = exclude_blacklisted(df, blacklist)
    if zeropoint is not None:
        df = with_zeropoints(df, zeropoint, zp_source, zp_version, zp_flag, zp_unique)
    return extras.apply(df) if extras else df


class SelectionCounts:
    """Numbers that a job reports about an input selection while it runs.

    They are there once an action on the selection has ended, and count that action alone: ``n_images`` given,
    ``n_other_detector``, ``n_blacklisted`` and ``n_without_zeropoint`` dropped, ``n_candidates`` left, and ``n_pairs`` of
    a tile and an image. An action that doesn't read all rows (``first``, ``limit``) counts what it read, and stages
    that are run again after a lost executor may be counted again.
    """

    IMAGES = ("n_images", "n_other_detector", "n_blacklisted", "n_without_zeropoint")

    def __init__(self):
        self._images, self._candidates, self._pairs = Observation(), Observation(), Observation()

    def images(self, df: DataFrame, *dropped: Column) -> DataFrame:
        return df.observe(self._images, F.count(F.lit(1)).alias(self.IMAGES[0]), *[F.count_if(d).alias(n) for d, n in zip(dropped, self.IMAGES[1:])])

    def candidates(self, df: DataFrame) -> DataFrame:
        return df.observe(self._candidates, F.count(F.lit(1)).alias("n_candidates"))

    def pairs(self, df: DataFrame) -> DataFrame:
        return df.observe(self._pairs, F.count(F.lit(1)).alias("n_pairs"))

    def values(self) -> dict[str, int]:
        """The numbers; waits for the action to end."""
        return {**self._images.get, **self._candidates.get, **self._pairs.get}

    def messages(self) -> list[str]:
        """The same as lines for a log."""
        n = self.values()
        lines = [f"Found {n['n_pairs']} input images of tiles" if n["n_pairs"] else "No input images found"]
        lines += [f"Dropped {n[k]} of {n['n_images']} images: {why}" for k, why in zip(self.IMAGES[1:], ("other detectors", "blacklisted", "no usable zero point")) if n[k]]
        return lines


def _counted_candidates(images, zeropoint, blacklist, ccdnum, zp, zp_unique, extras, counts) -> DataFrame:
    """``candidate_images`` by flags, so that what is dropped is counted in the same pass."""
    columns = images.columns
    other = F.col("ccdnum") != ccdnum if ccdnum > 0 else F.lit(False)
    black, without = F.lit(False), F.lit(False)
    df = images
    if blacklist is not None:
        df = df.join(blacklist.select("expnum", "ccdnum", F.lit(True).alias("_black")).distinct(), ["expnum", "ccdnum"], "left")
        black = F.coalesce("_black", F.lit(False))
    if zeropoint is not None:
        # one row an image until it is counted; several zero points fan out afterwards
        usable = usable_zeropoints(zeropoint, *zp).select(F.col("imagename").alias("filename"), F.lit(True).alias("_zeropoint")).distinct()
        df = df.join(usable, "filename", "left")
        without = F.col("_zeropoint").isNull()
    df = counts.images(df, other, ~other & black, ~other & ~black & without).filter(~other & ~black & ~without)
    df = df.select(*columns)
    if zeropoint is not None:
        df = with_zeropoints(df, zeropoint, *zp, unique=zp_unique)
    return counts.candidates(extras.apply(df) if extras else df)


def select_inputs(
    tiles: DataFrame, images: DataFrame, *, zeropoint: DataFrame | None = None,
    blacklist: DataFrame | None = None, ccdnum: int = 0,
    zp_source=ZP_SOURCE, zp_version=ZP_VERSION, zp_flag=ZP_FLAG,
    zp_unique: bool = False, counts: SelectionCounts | None = None,
    search: str = "distance", wrap: str = "circle", pad: float = 0.5,
    extras: Extras | None = None, **join_options,
) -> DataFrame:
    """Input images of every tile, one row per tile and image.

    RA columns of the images lie on (-180, 180] in the rows of tiles that cross RA=0;
    missing compression suffixes are blank.
    """
    df = candidate_images(
        images, zeropoint=zeropoint, blacklist=blacklist, ccdnum=ccdnum,
        zp_source=zp_source, zp_version=zp_version, zp_flag=zp_flag, zp_unique=zp_unique, extras=extras, counts=counts)
    pairs = overlap.overlap_join(df, tiles, search, wrap=wrap, pad=pad, **join_options)
    if counts is not None:
        pairs = counts.pairs(pairs)
    if "tile_crossra0" in pairs.columns:
        pairs = overlap.fold_crossing(pairs)
    blank = [c for c in ("compression", "compression_bkg", "compression_seg") if c in pairs.columns]
    return pairs.withColumns(naming.null_to_blank(blank)) if blank else pairs


def selected_exposures(tiles: DataFrame, images: DataFrame, *, extras: Extras | None = None, **options) -> DataFrame:
    """Distinct (tilename, expnum); zero points and blacklist play no part here."""
    df = extras.apply(images) if extras else images
    return overlap.overlap_join(df, tiles, **options).select("tilename", "expnum").distinct()


def catalogs_of_exposures(catalogs: DataFrame, exposures: DataFrame) -> DataFrame:
    """Catalogue rows of each tile's exposures.

    Catalogues are merged, whatever size Spark reckons they have: that is the size of compressed files, a small part of what
    the driver would have to hold.
    """
    return exposures.select("tilename", "expnum").distinct().join(catalogs.hint("merge"), "expnum")


def catalogs_of_any(catalogs: DataFrame, exposures: DataFrame) -> DataFrame:
    """Catalogue rows whose exposure was selected for any tile.

    Exposures are made distinct first: Spark then counts the tiles of each out of the plan, so pairs don't travel.
    """
    return catalogs.join(exposures.select("expnum").distinct(), "expnum", "left_semi")


def polygon_files(archive: DataFrame, tiles: DataFrame, version: str = naming.POLYGON_VERSION) -> DataFrame:
    """Archive rows of the two polygon files of each tile id."""
    kinds = F.array(*[
        F.struct(F.lit(k).alias("kind"), naming.product_path(k, F.col("tile_id"), suffix=F.lit(version)).alias("filename"))
        for k in ("poltiles", "poltolys")
    ])
    wanted = tiles.select("tile_id", F.explode(kinds).alias("p")).select("tile_id", "p.*")
    return wanted.join(archive.select("filename", "path"), "filename")


def archive_root(archives: DataFrame, values: DataFrame, name: str, key: str = "root_https") -> DataFrame:
    """Root directory of an archive and its value for ``key``; one row."""
    roots = archives.filter(F.col("name") == name).select("name", "root")
    vals = values.filter((F.col("name") == name) & (F.col("key") == key)).select("name", F.col("val").alias(key))
    return roots.join(vals, "name", "left")
