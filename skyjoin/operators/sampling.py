"""Repeatable random choices per tile and band.

The order is that of a seeded digest, so a choice repeats. A rank filter below the
partition limit keeps only the best few rows of each map task before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyjoin.functions import naming
from skyjoin.operators import overlap
from skyjoin.sources.staging import staged

# Images drawn per band, and exposures per band.
IMAGES_PER_BAND = {"g": 64, "r": 57, "i": 63, "z": 58, "Y": 51}
EXPOSURES_PER_BAND = 4

#: Part of the images, by digest, that tells how many pairs there are; pairs of the first round for each thing to be drawn; how
#: the part grows by the round; and the part beyond which all images are taken at once.
PROBE, ROOM, GROWTH, WHOLE = 1 / 4096, 3, 8, 1 / 4


def draw_order(value: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), value.cast("string")))


def _digests_between(digest: Column, low: float, high: float) -> Column:
    """Digests from the part ``low`` to the part ``high`` of their range; NULL comes before all."""
    def mark(part):
        return F.lit(f"{int(part * 2**52):013x}")

    above = digest >= mark(low) if low else F.lit(True)
    below = digest < mark(high) if high < 1 else F.lit(True)
    return (above & below) if low else digest.isNull() | below


def leading_pairs(
    images: DataFrame, tiles: DataFrame, n: int, seed: int, value: Column | str, columns: list[str],
    probe: float = PROBE, whole: float = WHOLE, **options,
) -> DataFrame:
    """``columns`` of the pairs of images and tiles that a draw of ``n`` values of each tile and band depends on.

    For every tile name and band these are all pairs up to some digest of ``draw_order``, with ``n`` values or more among
    them; or all its pairs, where it has fewer. What comes first in that order, and whether there is any, is the same as among all pairs.

    Tiles meet images by rising digest: a first part, which should hold enough for nearly all of them by the
    density that a probe finds, then larger parts for the tiles and bands that lack some, in the end all images.
    Nothing is left out: the probe only tells where to begin. So the pairs made grow with the tiles,
    and not with tiles times images. Where pairs are few, all are made at once.
    """
    def met(images, tiles, **more):
        return overlap.overlap_join(images, tiles, **more, **options)

    digest = draw_order(F.col(value) if isinstance(value, str) else value, seed)
    bands = staged(images.select(F.col("band").alias("tile_band")).distinct(), "bands")
    wanted = tiles.count() * bands.count()
    density = met(images.filter(_digests_between(digest, 0, probe)), tiles).count() / probe / max(wanted, 1)
    part = ROOM * n / max(density, 1e-9)
    if part > whole:
        return met(images, tiles).select(*columns)
    value = (F.col(value) if isinstance(value, str) else value).alias("_value")
    keys = ["tilename", "tile_band"]
    left, low, found = tiles.crossJoin(F.broadcast(bands)), 0.0, []
    while True:
        high = part if part <= whole else 1.0
        some = images.filter(_digests_between(digest, low, high)).select("*", value)
        # joined on the band too: a band that a tile lacks costs nothing where the sky has none of it
        pairs = met(some, left, also=F.col("band").eqNullSafe(F.col("tile_band")))
        if high == 1:
            found.append(pairs.select(*columns))
            break
        found.append(staged(pairs.select(*dict.fromkeys([*columns, *keys, "_value"])), "leading"))
        every = reduce(DataFrame.unionByName, found)
        done = every.groupBy(*keys).agg(F.count_distinct("_value").alias("_n")).filter(F.col("_n") >= n)
        same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys])
        left = staged(left.alias("l").join(done.alias("d").hint("merge"), same, "left_anti"), "left")
        if left.isEmpty():
            break
        low, part = high, part * GROWTH
    return reduce(DataFrame.unionByName, [f.select(*columns) for f in found])


def random_exposures(
    pairs: DataFrame, n: int = EXPOSURES_PER_BAND, seed: int = 0,
    keys: list[str] = ["tilename", "band"], exposure: Column | None = None,
) -> DataFrame:
    """All images of ``n`` exposures drawn per group, without replacement."""
    name = naming.exposure_prefix() if exposure is None else exposure
    df = pairs.withColumn("_exposure", name)
    order = Window.partitionBy(*keys).orderBy(draw_order(F.col("_exposure"), seed), "_exposure")
    return df.withColumn("_rank", F.dense_rank().over(order)).filter(F.col("_rank") <= n).drop("_rank", "_exposure")


def random_images(
    pairs: DataFrame, per_band: dict[str, int] = IMAGES_PER_BAND, seed: int = 0,
    keys: list[str] = ["tilename", "band"], image: str = "filename",
) -> DataFrame:
    """Up to ``per_band`` images drawn per group, without replacement; none of a band without a quota."""
    order = Window.partitionBy(*keys).orderBy(draw_order(F.col(image), seed), image)
    quota = F.create_map(*[x for band, n in per_band.items() for x in (F.lit(band), F.lit(n))])
    ranked = pairs.filter(F.col("band").isin(*per_band)).withColumn("_rank", F.row_number().over(order))
    most = max(per_band.values())
    return ranked.filter(F.col("_rank") <= most).filter(F.col("_rank") <= quota[F.col("band")]).drop("_rank")


def tag_rows(drawn: DataFrame, suffix: str) -> DataFrame:
    """Rows of the tag table: FILENAME, BAND, TAG = tile name and suffix."""
    return drawn.select("filename", "band", F.concat_ws("_", "tilename", F.lit(suffix)).alias("tag"))
