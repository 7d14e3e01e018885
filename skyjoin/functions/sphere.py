"""Right ascension / declination arithmetic as Spark columns (degrees throughout)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORNERS = (1, 2, 3, 4)

# Declination limit (degrees) -> tile overlap (arcminutes).
OVERLAP_BY_DEC = ((74.0, 1.0), (82.5, 2.0), (87.6, 5.0))
OVERLAP_AT_POLE = 10.0


def cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def fold_ra(ra) -> Column:
    """RA on (-180, 180]: values above 180 move down by a full turn."""
    ra = _c(ra)
    return F.when(ra > 180, ra - 360).otherwise(ra)


def wrap_ra(ra) -> Column:
    """RA on [0, 360)."""
    ra = _c(ra)
    return F.when(ra < 0, ra + 360).when(ra >= 360, ra - 360).otherwise(ra)


def recentre_ra(ra, at: float = 275.0) -> Column:
    """RA with the seam moved to ``at`` instead of 0."""
    ra = _c(ra)
    return F.when(ra >= at, ra - 360).otherwise(ra)


def ra_separation(a, b) -> Column:
    """Shorter way round between two RAs, both on [0, 360)."""
    d = F.abs(_c(a) - _c(b))
    return F.least(d, F.lit(360.0) - d)


def ra_between(ra, lo, hi) -> Column:
    """Inclusive RA interval test; ``lo > hi`` means the interval crosses RA=0."""
    ra, lo, hi = _c(ra), _c(lo), _c(hi)
    return F.when(lo <= hi, ra.between(lo, hi)).otherwise((ra >= lo) | (ra <= hi))


def ra_extent(racmin="racmin", racmax="racmax", crossra0="crossra0") -> Column:
    """RA size from extremes; RACMIN holds the larger RA when the box crosses RA=0."""
    lo, hi = _c(racmin), _c(racmax)
    return F.when(_c(crossra0) == "Y", F.abs(hi - (lo - 360))).otherwise(F.abs(hi - lo))


def dec_extent(deccmin="deccmin", deccmax="deccmax") -> Column:
    return F.abs(_c(deccmax) - _c(deccmin))


def ra_extent_from_corners(rac2="rac2", rac3="rac3") -> Column:
    return F.abs(_c(rac2) - _c(rac3))


def dec_extent_from_corners(decc1="decc1", decc2="decc2") -> Column:
    return F.abs(_c(decc1) - _c(decc2))


def corner_names(stem: str, prefix: str = "") -> list[str]:
    return [f"{prefix}{stem}{k}" for k in CORNERS]


def extremes(crossra0="crossra0", prefix: str = "") -> dict[str, Column]:
    """RACMIN/RACMAX/DECCMIN/DECCMAX of the four corners, swapped in RA on a crossing."""
    ras = cols(corner_names("rac", prefix))
    decs = cols(corner_names("decc", prefix))
    cross = _c(crossra0) == "Y"
    return {
        f"{prefix}racmin": F.when(cross, F.greatest(*ras)).otherwise(F.least(*ras)),
        f"{prefix}racmax": F.when(cross, F.least(*ras)).otherwise(F.greatest(*ras)),
        f"{prefix}deccmin": F.least(*decs),
        f"{prefix}deccmax": F.greatest(*decs),
    }


def crosses_ra0_by_corners(prefix: str = "") -> Column:
    """'Y' when the corners lie on both sides of RA=0 (spread beyond half a turn)."""
    ras = cols(corner_names("rac", prefix))
    return F.when(F.greatest(*ras) - F.least(*ras) > 180, F.lit("Y")).otherwise(F.lit("N"))


def crosses_ra0_by_bounds(ural, urau, width, dec) -> Column:
    """'Y' when the unique bounds are further apart than two tile widths."""
    limit = 2 * _c(width) / F.cos(F.radians(_c(dec)))
    return F.when(F.abs(_c(urau) - _c(ural)) > limit, F.lit("Y")).otherwise(F.lit("N"))


def tile_overlap(dec) -> Column:
    """Overlap of neighbouring tiles in degrees, growing towards the pole."""
    dec = F.abs(_c(dec))
    (first_limit, first), *rest = OVERLAP_BY_DEC
    out = F.when(dec < first_limit, F.lit(first / 60))
    for limit, arcmin in rest:
        out = out.when(dec < limit, F.lit(arcmin / 60))
    return out.otherwise(F.lit(OVERLAP_AT_POLE / 60))


def tile_overlap_value(dec: float) -> float:
    """The same rule for one number."""
    for limit, arcmin in OVERLAP_BY_DEC:
        if abs(dec) < limit:
            return arcmin / 60
    return OVERLAP_AT_POLE / 60


def in_sky_window(ra, dec, ra1, ra2, dec1, dec2, margin: float = 0.0) -> Column:
    """Open sky box, optionally widened by ``margin`` degrees on each side."""
    ra, dec = _c(ra), _c(dec)
    return (
        (ra > ra1 - margin) & (ra < ra2 + margin)
        & (dec > dec1 - margin) & (dec < dec2 + margin)
    )


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns as the output of a generator.

    Filters on them then stay above: pushed below, they would repeat the whole formula,
    once for every place where it is used.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*[v.alias(n) for n, v in columns.items()]))))
