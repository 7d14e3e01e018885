"""Archive tables derived from the given tables, in SQL that Spark and DuckDB share.

``{name}`` refers to a given table or to another table of this module.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "embeddings")

_FILENAME = (
    "concat('D', cast(l_orderkey as string), '_', cast(l_linenumber as string), '_', "
    "cast(l_partkey as string), '_', cast(l_suppkey as string), '_', "
    "cast(cast(l_quantity as int) as string), '_', "
    "cast(cast(round(l_extendedprice*100) as bigint) as string), '.fits')"
)


def _wrap(x: str) -> str:
    return f"case when {x} < 0 then {x} + 360 when {x} >= 360 then {x} - 360 else {x} end"


_BOX = f"""
    {_wrap('(ra_cent + ra_half)')} as rac1, {_wrap('(ra_cent + ra_half)')} as rac2,
    {_wrap('(ra_cent - ra_half)')} as rac3, {_wrap('(ra_cent - ra_half)')} as rac4,
    dec_cent - dec_half as decc1, dec_cent + dec_half as decc2,
    dec_cent + dec_half as decc3, dec_cent - dec_half as decc4,
    {_wrap('(ra_cent - ra_half)')} as racmin, {_wrap('(ra_cent + ra_half)')} as racmax,
    dec_cent - dec_half as deccmin, dec_cent + dec_half as deccmax,
    case when ra_cent - ra_half < 0 or ra_cent + ra_half >= 360 then 'Y' else 'N' end as crossra0
"""

SQL = {
    # every row of lineitem is one detector image
    "sky_image": f"""
        select *, 2*ra_half as ra_size, 2*dec_half as dec_size, {_BOX}
        from (select {_FILENAME} as filename,
                cast(l_orderkey as bigint) as expnum, cast(l_linenumber as int) as ccdnum,
                substr('grizY', cast(l_partkey % 5 as int)+1, 1) as band,
                case l_returnflag when 'A' then 'Y2A1_FINALCUT' when 'N' then 'Y2T9_FINALCUT' else 'Y2N_FIRSTCUT' end as tag,
                cast(l_orderkey % 50 as bigint) as pfw_attempt_id,
                cast((l_orderkey*7919 + l_partkey*104729 + l_linenumber*1299709) % 360000 as double)/1000 as ra_cent,
                cast((l_partkey*7907 + l_suppkey*611953 + l_orderkey*31) % 60000 as double)/1000 - 60 as dec_cent,
                cast(0.125 as double) as ra_half, cast(0.0625 as double) as dec_half,
                concat('OPS/', cast(l_suppkey as string), '/', cast(l_orderkey as string)) as path,
                case when l_partkey % 3 = 0 then null else '.fz' end as compression
              from {{lineitem}}) box
    """,
    # every part is one tile
    "sky_tile": f"""
        select *, 2*ra_half as ra_size, 2*dec_half as dec_size, {_BOX}
        from (select cast(p_partkey as bigint) as tile_id, concat('T', lpad(cast(p_partkey as string), 8, '0')) as tilename,
                cast((p_partkey*7919) % 21600 % 360 as double) + cast(0.0625 as double) as ra_cent,
                cast(floor(((p_partkey*7919) % 21600)/360) as double) - cast(59.46875 as double) as dec_cent,
                cast(0.5 as double) as ra_half, cast(0.5 as double) as dec_half,
                cast(0.36 as double) as pixelscale, cast(10000 as int) as naxis1, cast(10000 as int) as naxis2
              from {{part}}) box
    """,
    "sky_zeropoint": f"""
        select {_FILENAME} as imagename,
               case l_orderkey % 3 when 0 then 'FGCM' when 1 then 'EXPCALIB' else 'PGCM' end as source,
               case l_linenumber % 2 when 0 then 'v2.0' else 'v1.0' end as version,
               cast(l_suppkey % 32 as int) as flag,
               30 + cast(l_partkey % 1000 as double)/1000 as mag_zero,
               concat('ID', cast(l_partkey as string)) as imageid
        from {{lineitem}}
    """,
    "sky_blacklist": """
        select distinct cast(l_orderkey as bigint) as expnum, cast(l_linenumber as int) as ccdnum, l_linestatus as reason
        from {lineitem} where l_quantity = 50
    """,
    "sky_tag": f"""
        select {_FILENAME} as filename, case when l_tax < 0.04 then 'SN_DEEP' else 'RAN_CCD' end as tag
        from {{lineitem}} where l_quantity > 40
    """,
    # every order is one exposure-level catalogue or a header file
    "sky_catalog": """
        select concat('C', cast(o_orderkey as string), '_cat.fits') as filename,
               case o_orderstatus when 'F' then 'cat_finalcut' when 'O' then 'cat_scamp_full' else 'cat_firstcut' end as filetype,
               substr('grizY', cast(o_custkey % 5 as int)+1, 1) as band,
               cast(o_orderkey % 50 as bigint) as pfw_attempt_id,
               cast(o_custkey % 62 + 1 as int) as ccdnum, cast(o_orderkey as bigint) as expnum,
               concat('CAT/', cast(o_custkey as string)) as path
        from {orders}
    """,
    "sky_miscfile": """
        select concat('H', cast(o_orderkey as string), '_', cast(o_custkey as string), '.ahead') as filename,
               case when o_custkey % 4 = 0 then 'head_scamp' else 'head_scamp_full' end as filetype,
               cast(o_orderkey % 50 as bigint) as pfw_attempt_id, cast(o_orderkey as bigint) as expnum
        from {orders}
    """,
    "sky_proctag": """
        select distinct cast(c_custkey % 50 as bigint) as pfw_attempt_id,
               case c_custkey % 50 % 3 when 0 then 'Y2A1_FINALCUT' when 1 then 'Y2T9_FINALCUT' else 'Y2N_FIRSTCUT' end as tag
        from {customer}
    """,
    # files per detector row: science, background, segmentation (told apart by the ship status)
    "sky_fileset": f"""
        select {_FILENAME} as filename,
               case l_linestatus when 'O' then 'red_immask' else 'red_bkg' end as filetype,
               substr('grizY', cast(l_partkey % 5 as int)+1, 1) as band,
               cast(l_orderkey as bigint) as pfw_attempt_id, cast(l_linenumber as int) as ccdnum,
               cast(l_orderkey as bigint) as expnum,
               case l_returnflag when 'A' then 'Y2A1_FINALCUT' when 'N' then 'Y2T9_FINALCUT' else 'Y2N_FIRSTCUT' end as tag
        from {{lineitem}}
    """,
    "sky_segmap": """
        select concat('S', cast(l_orderkey as string), '_', cast(l_linenumber as string), '_segmap.fits') as filename,
               'red_segmap' as filetype, cast(l_orderkey as bigint) as pfw_attempt_id,
               cast(l_linenumber as int) as ccdnum, cast(l_orderkey as bigint) as expnum
        from {lineitem} group by l_orderkey, l_linenumber
    """,
    "sky_attempt": """
        select cast(o_orderkey as bigint) as pfw_attempt_id,
               case o_orderstatus when 'F' then 'Y2A1_FINALCUT' when 'O' then 'Y2T9_FINALCUT' else 'Y2N_FIRSTCUT' end as tag
        from {orders}
    """,
    "sky_archive": """
        select filename, concat('OPS/', cast(expnum as string)) as path,
               case when expnum % 3 = 0 then null else '.fz' end as compression
        from (select filename, expnum from {sky_fileset}
              union all select filename, expnum from {sky_segmap}
              union all select filename, expnum from {sky_catalog}) files
    """,
    # processing provenance
    "sky_wgb": f"""
        select {_FILENAME} as filename, 'red' as filetype,
               case when l_suppkey % 3 = 0 then 'mkbleed' else 'immask' end as exec_name,
               cast(l_orderkey % 40 as int) as reqnum, concat('D', cast(l_orderkey as string)) as unitname,
               cast(l_linenumber % 2 as int) as attnum, cast(l_suppkey as bigint) as task_id
        from {{lineitem}}
    """,
    "sky_runtag": """
        select cast(o_orderkey % 40 as int) as reqnum, concat('D', cast(o_orderkey as string)) as unitname,
               cast(o_custkey % 2 as int) as attnum,
               case o_orderstatus when 'F' then 'Y2N_FIRSTCUT' when 'O' then 'Y2T_FIRSTCUT' else 'Y2T3_FINALCUT' end as tag
        from {orders}
    """,
    # lineage of the older schema: runs, coadds, their sources and exposures
    "sky_location": """
        select concat('run', cast(c_custkey % 400 as string)) as run,
               concat('T', lpad(cast(c_custkey % 200 as string), 8, '0')) as tilename,
               concat('loc', cast(c_custkey as string), '_red.fits') as filename,
               case when c_nationkey % 2 = 0 then 'red' else 'raw' end as filetype,
               cast(c_custkey as bigint) as id
        from {customer}
    """,
    "sky_run": """
        select distinct concat('run', cast(c_custkey % 400 as string)) as run,
               case c_custkey % 400 % 3 when 0 then 'Y1A1_COADD' when 1 then 'Y1A1_COADD_STRIPE82' else 'SVA1_FINALCUT' end as tag
        from {customer}
    """,
    "sky_coadd": """
        select cast(o_orderkey as bigint) as id, concat('run', cast(o_custkey % 400 as string)) as run,
               concat('T', lpad(cast(o_custkey % 200 as string), 8, '0')) as tilename,
               substr('grizY', cast(o_custkey % 5 as int)+1, 1) as band,
               case when o_custkey % 7 = 0 then concat('c', cast(o_orderkey as string), '_det.fits')
                    else concat('c', cast(o_orderkey as string), '_sci.fits') end as imagename
        from {orders}
    """,
    "sky_coadd_src": """
        select cast(l_orderkey as bigint) as coadd_imageid, cast(l_partkey as bigint) as src_imageid from {lineitem}
    """,
    "sky_source": """
        select cast(p_partkey as bigint) as id, cast(p_partkey % 500 as bigint) as exposureid from {part}
    """,
    "sky_exposure": """
        select cast(s_suppkey as bigint) as id, concat('E', cast(s_suppkey as string)) as exposurename,
               cast(s_suppkey * 10 as bigint) as expnum, concat('n', cast(s_nationkey as string)) as nite,
               substr('grizY', cast(s_suppkey % 5 as int)+1, 1) as band
        from {supplier}
    """,
    # detector files of the older archive and their zero points
    "sky_oldfile": """
        select concat('DECam_', lpad(cast(l_orderkey as string), 8, '0'), '_', lpad(cast(l_linenumber as string), 2, '0'), '.fits') as filename,
               concat('run', cast(l_suppkey % 400 as string)) as run,
               case when l_suppkey % 5 = 0 then 'raw' else 'red' end as filetype,
               concat('ID', cast(l_partkey as string)) as id
        from {lineitem}
    """,
    "sky_oldzp": """
        select concat('ID', cast(p_partkey as string)) as imageid, 30 + cast(p_partkey % 1000 as double)/1000 as mag_zero
        from {part} where p_size <> 11
    """,
    # provenance through artifacts and executed tasks
    "sky_artifact": """select concat('A', filename) as id, filename as name from {sky_wgb}""",
    "sky_generated": """select concat('A', filename) as opm_artifact_id, task_id from {sky_wgb}""",
    "sky_exec": """
        select cast(s_suppkey as bigint) as task_id, cast(s_suppkey % 40 as int) as reqnum,
               concat('D', cast(s_suppkey as string)) as unitname, cast(s_nationkey % 2 as int) as attnum
        from {supplier}
    """,
    "sky_exectag": """
        select reqnum, unitname, attnum, case task_id % 3 when 0 then 'Y2N_FIRSTCUT' else 'Y2A1_FINALCUT' end as tag from {sky_exec}
    """,
    # image headers: one per part, rotated and scaled a little differently each
    "sky_header": """
        select p_partkey as image_id, cast(2048 as int) as naxis1, cast(4096 as int) as naxis2,
               cast((p_partkey*7919) % 360000 as double)/1000 as crval1,
               cast((p_partkey*104729) % 120000 as double)/1000 - 60 as crval2,
               cast(p_partkey % 17 as double)*100 - 800 as crpix1, cast(p_partkey % 13 as double)*100 + 1000 as crpix2,
               cast(p_size as double) / 10000000 as cd1_1, cast(0.0000731 as double) as cd1_2,
               cast(-0.0000729 as double) as cd2_1, cast(p_size as double) / 20000000 as cd2_2
        from {part}
    """,
    # survey table as stored, with small and larger deviations in some rows
    "sky_bounds": """
        select cast(p_partkey as bigint) as id, concat('T', lpad(cast(p_partkey as string), 8, '0')) as tilename,
               cast(floor(((p_partkey*7919) % 21600)/360) as int) as dec_row, cast((p_partkey*7919) % 21600 % 360 as int) as ra_step,
               cast((p_partkey*7919) % 21600 % 360 as double) as ra_cent,
               cast(floor(((p_partkey*7919) % 21600)/360) as double) - 60 as dec_cent,
               cast((p_partkey*7919) % 21600 % 360 as double) - 0.5 as uramin,
               cast((p_partkey*7919) % 21600 % 360 as double) + 0.5 - case when p_size = 7 then 2 else 0 end as uramax,
               cast(floor(((p_partkey*7919) % 21600)/360) as double) - 60.5 as udecmin,
               cast(floor(((p_partkey*7919) % 21600)/360) as double) - 59.5 - case when p_size = 9 then 2 else 0 end as udecmax,
               case when (p_partkey*7919) % 21600 % 360 = 0 then 'Y' else 'N' end as crossra0,
               cast(p_size as int) as kind
        from {part}
    """,
    "sky_bounds_stored": """
        select id, tilename, dec_row, ra_step,
               ra_cent + case when kind = 1 then 0.00003 else 0 end as ra_cent,
               dec_cent + case when kind = 2 then 0.5 else 0 end as dec_cent,
               case when uramin < 0 then uramin + 360 else uramin end as uramin,
               uramax + case when kind = 3 then 360 else 0 end as uramax,
               udecmin, udecmax + case when kind = 4 then 0.002 else 0 end as udecmax, crossra0, kind
        from {sky_bounds} where kind <> 5
    """,
    # image planes: 8 x 8 pixels per vector
    "sky_pixel": """
        select concat('plane', cast(vec_id as string)) as file, cast(label as int) as hdu,
               cast(floor(pos / 8) as int) as y, cast(pos % 8 as int) as x,
               cast(round(cast(v as double) * 64) as int) as value
        from {pixel_values}
    """,
}


def _names(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given or derived table as a DataFrame."""
    if name == "pixel_values":
        return (
            spark.read.parquet(f"{sf_dir}/embeddings.parquet")
            .selectExpr("vec_id", "label", "posexplode(embedding) as (pos, v)")
        )
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SQL[name]
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in _names(text)})


# DuckDB numbers the unnested values from one.
_PIXELS = """(select vec_id, label, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding) as v from embeddings)"""


def duck(name: str) -> str:
    """The same table as a DuckDB sub-select."""
    if name == "pixel_values":
        return _PIXELS
    if name not in SQL:
        return name
    return "(" + SQL[name].format(**{n: f"{duck(n)} as {n}_" if n in SQL or n == "pixel_values" else n for n in _names(SQL[name])}) + ")"


def with_tables(*names: str) -> str:
    """``with a as (...), b as (...)`` for use at the head of a DuckDB query."""
    return "with " + ",\n".join(f"{n} as {duck(n)}" for n in names) + "\n"
