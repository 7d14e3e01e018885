"""Which images overlap which tiles: a two-dimensional interval join on the sphere.

Both sides are cut along a fixed grid of sky cells, joined on the cell and tested
with the exact predicate. RA cells are numbered round the circle, so boxes across
RA=0 need no special case. A pair that shares several cells is kept in one of them
only, which spares a ``distinct``. Tiles read from files are shuffled on the cell and merged with
the images, whatever size Spark reckons they have: it reckons with compressed files ahead of the
fan-out to cells, which on tables that compress well is a hundredth of what the driver would
have to hold. Spark broadcasts generated tiles where their size allows. Cells that hold very
many images (deep fields) are split, by adaptive execution or by the caller's salt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyjoin.functions import sphere

CELL_DEG = 1.0
# Box edges move out by this much before they are cut into cells, so that rounding
# never separates two boxes that the exact predicate accepts.
EDGE_DEG = 1e-9

#: Images of a bucket of a stored table, about, beyond which it has more buckets: some 100 MB with a score of columns.
BUCKET_IMAGES = 500_000

SEARCHES = ("distance", "corners", "any_corner", "corner_sizes")


@dataclass
class Box:
    """Sky box: RA interval starting at ``ra_lo`` and Dec interval."""

    ra_lo: Column
    ra_width: Column
    dec_lo: Column
    dec_hi: Column


def centre_box(prefix: str = "", ra_size=None, dec_size=None, factor: float = 0.5) -> Box:
    ra, dec = F.col(f"{prefix}ra_cent"), F.col(f"{prefix}dec_cent")
    ra_size = F.col(f"{prefix}ra_size") if ra_size is None else ra_size
    dec_size = F.col(f"{prefix}dec_size") if dec_size is None else dec_size
    return Box(ra - factor * ra_size, 2 * factor * ra_size, dec - factor * dec_size, dec + factor * dec_size)


def extent_box(prefix: str = "") -> Box:
    lo, hi = F.col(f"{prefix}racmin"), F.col(f"{prefix}racmax")
    width = F.when(hi >= lo, hi - lo).otherwise(hi - lo + 360)
    return Box(lo, width, F.col(f"{prefix}deccmin"), F.col(f"{prefix}deccmax"))


def tile_columns(tiles: DataFrame) -> DataFrame:
    """Tile columns renamed with a ``tile_`` prefix so both sides stay apart."""
    return tiles.select(*[
        F.col(c).alias(c if c.lower().startswith("tile") else f"tile_{c}") for c in tiles.columns
    ])


# -- predicates (image columns plain, tile columns with the tile_ prefix) ----------------


def _separation(wrap: str) -> Column:
    if wrap == "circle":
        return sphere.ra_separation("ra_cent", "tile_ra_cent")
    if wrap == "by_tile":
        folded = F.abs(sphere.fold_ra("ra_cent") - sphere.fold_ra("tile_ra_cent"))
        raw = F.abs(F.col("ra_cent") - F.col("tile_ra_cent"))
        return F.when(F.col("tile_crossra0") == "Y", folded).otherwise(raw)
    raise ValueError(f"wrap not supported: {wrap}")


def distance_predicate(wrap: str = "circle", pad: float = 0.5, ra_size=None, dec_size=None) -> Column:
    """Centres nearer than half the sizes in both axes; strict."""
    ra_size = F.col("ra_size") if ra_size is None else ra_size
    dec_size = F.col("dec_size") if dec_size is None else dec_size
    in_ra = _separation(wrap) < 0.5 * F.col("tile_ra_size") + pad * ra_size
    in_dec = F.abs(F.col("dec_cent") - F.col("tile_dec_cent")) < 0.5 * F.col("tile_dec_size") + pad * dec_size
    return in_ra & in_dec


def corners_predicate() -> Column:
    """An RA edge and a Dec edge of the image inside the tile; inclusive."""
    def in_ra(c):
        return sphere.ra_between(c, "tile_racmin", "tile_racmax")

    def in_dec(c):
        return F.col(c).between(F.col("tile_deccmin"), F.col("tile_deccmax"))

    return (in_ra("racmin") | in_ra("racmax")) & (in_dec("deccmin") | in_dec("deccmax"))


def any_corner_predicate() -> Column:
    """At least one of the four image corners inside the tile; inclusive."""
    return sphere.any_of([
        sphere.ra_between(f"rac{k}", "tile_racmin", "tile_racmax")
        & F.col(f"decc{k}").between(F.col("tile_deccmin"), F.col("tile_deccmax"))
        for k in sphere.CORNERS
    ])


def _search(search: str, wrap: str, pad: float) -> tuple[Box, Box, Column]:
    if search == "distance":
        return centre_box(factor=pad), centre_box("tile_"), distance_predicate(wrap, pad)
    if search == "corner_sizes":
        raw, dec_size = sphere.ra_extent_from_corners(), sphere.dec_extent_from_corners()
        box = centre_box("", raw, dec_size, factor=pad)
        if wrap == "by_tile":
            folded = F.abs(sphere.fold_ra("rac2") - sphere.fold_ra("rac3"))
            size = F.when(F.col("tile_crossra0") == "Y", folded).otherwise(raw)
        else:
            size = sphere.ra_separation("rac2", "rac3")
            box = centre_box("", size, dec_size, factor=pad)
        return box, centre_box("tile_"), distance_predicate(wrap, pad, size, dec_size)
    if search == "corners":
        return extent_box(), extent_box("tile_"), corners_predicate()
    if search == "any_corner":
        return extent_box(), extent_box("tile_"), any_corner_predicate()
    raise ValueError(f"search not supported: {search}")


# -- the join ----------------------------------------------------------------------------


def _in_cells(df: DataFrame, box: Box, cell: float, p: str) -> DataFrame:
    """One row per sky cell the box touches; a box without limits touches none.

    Cells have one number, so that the join's table is keyed by it. It is never NULL, which spares a test that
    would work the number out once more.
    """
    if abs(360 / cell - round(360 / cell)) > 1e-9:
        raise ValueError("cell must divide 360 degrees")
    turns = round(360 / cell)
    lo, hi = box.ra_lo - EDGE_DEG, box.ra_lo + box.ra_width + EDGE_DEG
    first_x, first_y = F.floor(lo / cell), F.floor((box.dec_lo - EDGE_DEG) / cell)
    n_x = F.greatest(F.least(F.floor(hi / cell) - first_x + 1, F.lit(turns)), F.lit(1))
    n_y = F.greatest(F.floor((box.dec_hi + EDGE_DEG) / cell) - first_y + 1, F.lit(1))
    df = df.select(
        "*", F.pmod(first_x, F.lit(turns)).cast("int").alias(f"{p}_x0"), n_x.cast("int").alias(f"{p}_nx"),
        first_y.cast("int").alias(f"{p}_y0"),
        F.explode(F.sequence(F.lit(0), (n_x * n_y - 1).cast("int"))).alias(f"{p}_k"),
    )
    ix = F.pmod(F.col(f"{p}_k"), F.col(f"{p}_nx"))
    iy = F.call_function("div", F.col(f"{p}_k"), F.col(f"{p}_nx")).cast("int")
    number = (F.col(f"{p}_y0") + iy) * turns + F.pmod(F.col(f"{p}_x0") + ix, F.lit(turns))
    return df.select("*", ix.alias(f"{p}_ix"), iy.alias(f"{p}_iy"), F.coalesce(number, F.lit(-1)).alias(f"{p}_cell"))


def _owner(cell: float) -> Column:
    """True in exactly one of the cells that an image box and a tile box share."""
    turns = F.lit(round(360 / cell))
    # Where the image's first cell is not the tile's, the tile's first cell is shared;
    # should both be shared (boxes spanning the whole circle), the image's one counts.
    image_start_outside = F.pmod(F.col("_i_x0") - F.col("_t_x0"), turns) >= F.col("_t_nx")
    own_x = (F.col("_i_ix") == 0) | ((F.col("_t_ix") == 0) & image_start_outside)
    own_y = (F.col("_i_iy") == 0) | (F.col("_t_iy") == 0)
    return own_x & own_y


def _salted_images(images: DataFrame, salts: int) -> DataFrame:
    """Images of a cell spread over ``salts`` pieces; the tiles are then repeated in every piece."""
    if salts == 1:
        return images
    own = [c for c in images.columns if not c.startswith("_i_")]
    spread = F.xxhash64(*(["filename"] if "filename" in own else own))
    return images.withColumn("_i_salt", F.pmod(spread, F.lit(salts)).cast("int"))


def overlap_join(
    images: DataFrame, tiles: DataFrame, search: str = "distance", *,
    wrap: str = "circle", pad: float = 0.5, cell: float = CELL_DEG,
    salts: int = 1, also: Column | None = None,
) -> DataFrame:
    """All (image, tile) pairs that overlap; image columns plus ``tile_`` columns.

    ``search``: ``distance`` (centres and sizes), ``corner_sizes`` (the same with sizes
    from the corners), ``corners`` (an edge inside the tile in each axis) or
    ``any_corner``. ``wrap='circle'`` compares RA the short way round for every tile;
    ``wrap='by_tile'`` does so only for tiles flagged CROSSRA0. RAs lie on [0, 360).
    ``pad`` is the share of the image size that counts (0.5 = half).
    ``salts`` is the number of pieces a cell is cut into: one where adaptive execution
    splits skewed partitions, as it does by default; more where that is off. The tile side
    is repeated once per piece. ``also`` is a further condition on both sides' columns; equalities in it are keys of the join.
    """
    image_box, _, _ = _search(search, wrap, pad)
    return _met(_salted_images(_in_cells(images, image_box, cell, "_i"), salts), images.columns, tiles, search, wrap, pad, cell, salts, also)


def _met(cells: DataFrame, columns: list[str], tiles: DataFrame, search: str, wrap: str, pad: float, cell: float, salts: int, also: Column | None = None) -> DataFrame:
    tiles = tile_columns(tiles)
    _, tile_box, predicate = _search(search, wrap, pad)
    keep = [*columns, *tiles.columns]
    t = _in_cells(tiles, tile_box, cell, "_t")
    on = F.col("_i_cell") == F.col("_t_cell")
    if salts > 1:
        t = t.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_t_salt"))
        on = on & (F.col("_i_salt") == F.col("_t_salt"))
    if also is not None:
        on = on & also
    if tiles.inputFiles():
        t = t.hint("merge")
    return cells.join(t, on & _owner(cell) & predicate).select(*keep)


# -- images stored by cell ---------------------------------------------------------------


def store_cells(
    images: DataFrame, name: str, search: str = "distance", *, buckets: int, pad: float = 0.5,
    cell: float = CELL_DEG, salts: int = 1, path: str | None = None,
) -> None:
    """The images of every sky cell as a table ``name``, bucketed and sorted by cell.

    Searches with ``overlap_join_stored`` then read it as it lies: they move and sort
    the tiles only, however often they run. Each image is there once per cell its box touches. A
    bucket is one task's share of a join. There are ``buckets`` of them, and more where each would hold
    more than ``BUCKET_IMAGES`` images; take ``salts`` where single cells hold more images than
    that (deep fields); the tile side is repeated once per salt.
    """
    buckets = max(buckets, -(-images.count() // BUCKET_IMAGES))
    image_box, _, _ = _search(search, "circle", pad)
    keys = ["_i_cell"] + (["_i_salt"] if salts > 1 else [])
    cells = _salted_images(_in_cells(images, image_box, cell, "_i"), salts)
    # rows of a bucket come from one task, so a bucket is one sorted file
    writer = cells.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def overlap_join_stored(
    stored: DataFrame, tiles: DataFrame, search: str = "distance", *,
    wrap: str = "circle", pad: float = 0.5, cell: float = CELL_DEG, salts: int = 1,
) -> DataFrame:
    """``overlap_join`` of a table made by ``store_cells`` with the same search, pad, cell and salts."""
    columns = [c for c in stored.columns if not c.startswith("_i_")]
    return _met(stored, columns, tiles, search, wrap, pad, cell, salts)


def overlap_of_tile(
    images: DataFrame, tile: dict, search: str = "distance", *,
    wrap: str = "circle", pad: float = 0.5, max_ra_size: float = 2.0, max_dec_size: float = 1.0,
) -> DataFrame:
    """Images of one tile given as values; nothing is shuffled.

    For centre searches, images up to the ``max_`` sizes are met by range filters that
    reach the file scan; larger ones pass the ranges and meet the exact test only.
    """
    values = {k.lower(): v for k, v in tile.items()}
    literals = {f"tile_{k}": F.lit(v) for k, v in values.items() if not k.startswith("tile")}
    df = images
    if search == "distance":
        near_ra = 0.5 * values["ra_size"] + pad * max_ra_size + EDGE_DEG
        near_dec = 0.5 * values["dec_size"] + pad * max_dec_size + EDGE_DEG
        ra, dec = values["ra_cent"], values["dec_cent"]
        if near_ra < 180:
            lo, hi = (ra - near_ra) % 360, (ra + near_ra) % 360
            inside = (
                F.col("ra_cent").between(lo, hi) if lo <= hi
                else (F.col("ra_cent") >= lo) | (F.col("ra_cent") <= hi)
            )
            df = df.filter(inside | (F.col("ra_size") > max_ra_size))
        df = df.filter(
            F.col("dec_cent").between(dec - near_dec, dec + near_dec) | (F.col("dec_size") > max_dec_size))
    _, _, predicate = _search(search, wrap, pad)
    keep = df.columns
    return df.withColumns(literals).filter(predicate).select(*keep)


def fold_crossing(df: DataFrame, flag: str = "tile_crossra0", names=("ra_cent", "rac1", "rac2", "rac3", "rac4", "racmin", "racmax")) -> DataFrame:
    """RA columns, each on its own, moved to (-180, 180] on the rows whose tile crosses RA=0."""
    present = [n for n in names if n in df.columns]
    return df.withColumns({
        n: F.when(F.col(flag) == "Y", sphere.fold_ra(n)).otherwise(F.col(n)) for n in present
    })
