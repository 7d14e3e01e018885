"""The queries once more, as plain SQL over the given tables."""

from __future__ import annotations

from registry.standins import SQL, with_tables
from skyjoin.functions.naming import PRODUCT_FILES

ORACLE: dict[str, str] = {}

PAIR = (
    "least(abs(i.ra_cent - t.ra_cent), 360.0 - abs(i.ra_cent - t.ra_cent)) < 0.5*t.ra_size + {pad}*i.ra_size "
    "and abs(i.dec_cent - t.dec_cent) < 0.5*t.dec_size + {pad}*i.dec_size"
)
NEAR = PAIR.format(pad="0.5")
OUT = "t.tilename, i.filename, i.band, i.expnum, i.ccdnum"


def sql(name: str, tables: str, body: str) -> None:
    ORACLE[name] = with_tables(*tables.split()) + body


def fold(x: str) -> str:
    return f"(case when {x} > 180 then {x} - 360 else {x} end)"


def wrap(x: str) -> str:
    return f"(case when {x} < 0 then {x} + 360 when {x} >= 360 then {x} - 360 else {x} end)"


def r(x: str, name: str, digits: int = 6) -> str:
    return f"round({x}, {digits}) as {name}"


# -- inputs of tiles -------------------------------------------------------------------------

PATH = "concat('{root}/', i.path, '/', i.filename, coalesce(i.compression, ''))"
LOCAL, HTTPS = PATH.format(root="/archive"), PATH.format(root="https://archive.example.org/files")
ZP = "z.imagename = i.filename and z.source = 'FGCM' and z.version = 'v2.0' and z.flag < 16"
NOT_BLACK = "not exists (select 1 from sky_blacklist b where b.expnum = i.expnum and b.ccdnum = i.ccdnum)"

sql("tile_inputs_distance", "sky_image sky_tile sky_zeropoint sky_blacklist", f"""
select {OUT}, z.mag_zero, case when t.crossra0 = 'Y' then {fold('i.ra_cent')} else i.ra_cent end as ra_cent, i.dec_cent,
       coalesce(i.compression, '') as compression, {LOCAL} as filepath_local, {HTTPS} as filepath_https
from sky_image i join sky_zeropoint z on {ZP} join sky_tile t on {NEAR}
where i.tag in ('Y2A1_FINALCUT', 'Y2T9_FINALCUT') and {NOT_BLACK}""")

sql("tile_inputs_wrap", "sky_image sky_tile", f"""
select {OUT}, {r(fold('i.ra_cent'), 'ra_cent')}, {r(fold('i.rac1'), 'rac1')}, {r(fold('i.rac3'), 'rac3')}, {r(fold('i.racmin'), 'racmin')}, {r(fold('i.racmax'), 'racmax')}, {r('i.dec_cent', 'dec_cent')}
from sky_image i join sky_tile t on t.crossra0 = 'Y'
 and abs({fold('i.ra_cent')} - {fold('t.ra_cent')}) < 0.5*t.ra_size + 0.5*i.ra_size
 and abs(i.dec_cent - t.dec_cent) < 0.5*t.dec_size + 0.5*i.dec_size""")


def _in_ra(x: str) -> str:
    return f"(case when t.racmin <= t.racmax then {x} between t.racmin and t.racmax else {x} >= t.racmin or {x} <= t.racmax end)"


def _in_dec(x: str) -> str:
    return f"({x} between t.deccmin and t.deccmax)"


sql("tile_inputs_corners", "sky_image sky_tile", f"""
select {OUT} from sky_image i join sky_tile t
  on ({_in_dec('i.deccmin')} or {_in_dec('i.deccmax')}) and ({_in_ra('i.racmin')} or {_in_ra('i.racmax')})""")

sql("tile_inputs_any_corner", "sky_image sky_tile", f"""
select {OUT} from sky_image i join sky_tile t on """ + " or ".join(
    f"({_in_dec(f'i.decc{k}')} and {_in_ra(f'i.rac{k}')})" for k in (1, 2, 3, 4)))

sql("tile_inputs_padded", "sky_image sky_tile", f"select {OUT} from sky_image i join sky_tile t on {PAIR.format(pad='0.505')}")

sql("tile_inputs_corner_sizes", "sky_image sky_tile", f"""
select {OUT} from sky_image i join sky_tile t
  on least(abs(i.ra_cent - t.ra_cent), 360.0 - abs(i.ra_cent - t.ra_cent))
       < 0.5*t.ra_size + 0.5*least(abs(i.rac2 - i.rac3), 360.0 - abs(i.rac2 - i.rac3))
 and abs(i.dec_cent - t.dec_cent) < 0.5*t.dec_size + 0.5*abs(i.decc1 - i.decc2)""")

sql("tile_inputs_ccdnum", "sky_image sky_tile", f"select {OUT} from sky_image i join sky_tile t on {NEAR} where i.ccdnum = 3")
sql("tile_inputs_subset_tag", "sky_image sky_tile sky_tag", f"""
select {OUT} from sky_image i join sky_tag g on g.filename = i.filename and g.tag = 'SN_DEEP' join sky_tile t on {NEAR}""")
sql("tile_inputs_extras", "sky_image sky_tile sky_proctag", f"""
select {OUT}, upper(i.band) as band_upper, p.tag as proctag
from sky_image i join sky_proctag p on p.pfw_attempt_id = i.pfw_attempt_id and p.tag = 'Y2A1_FINALCUT'
join sky_tile t on {NEAR} where i.dec_cent > -30 and i.ccdnum < 5""")
sql("tile_inputs_zp_force", "sky_image sky_tile sky_blacklist", f"""
select {OUT}, cast(32.2 as double) as mag_zero from sky_image i join sky_tile t on {NEAR} where {NOT_BLACK}""")
sql("images_without_zeropoint", "sky_image sky_zeropoint", f"""
select i.filename, i.expnum, i.ccdnum, i.band from sky_image i where not exists (select 1 from sky_zeropoint z where {ZP})""")
sql("images_not_blacklisted_by_name", "sky_image sky_blacklist", """
select filename, expnum, ccdnum from sky_image where filename not in
 (select i.filename from sky_image i, sky_blacklist b where i.expnum = b.expnum and i.ccdnum = b.ccdnum)""")

PAIRS = f", pairs as (select {OUT}, i.tag from sky_image i join sky_tile t on {NEAR})\n"

sql("inputs_of_one_tile", "sky_image", """
select filename, band, expnum, ccdnum from sky_image
where abs(case when ra_cent > 180 then ra_cent - 360.0625 else ra_cent - 0.0625 end) < 0.5 + 0.5*ra_size and abs(dec_cent + 29.46875) < 0.5 + 0.5*dec_size""")
sql("inputs_of_stored_tile", "sky_image", """
select filename, band, expnum, ccdnum from sky_image where abs(ra_cent - 235.5625) < 0.5 + 0.5*ra_size and abs(dec_cent + 53.46875) < 0.5 + 0.5*dec_size""")
sql("images_centred_in_tiles", "sky_image sky_tile", """
select t.tilename, i.filename from sky_image i join sky_tile t on least(abs(i.ra_cent - t.ra_cent), 360.0 - abs(i.ra_cent - t.ra_cent)) < 0.5*t.ra_size
 and abs(i.dec_cent - t.dec_cent) < 0.5*t.dec_size""")
sql("tile_inputs_stored_cells", "sky_image sky_tile", PAIRS + "select tilename, filename, band, expnum, ccdnum from pairs")
sql("selection_counts", "sky_image sky_tile sky_zeropoint sky_blacklist", f"""
, flagged as (
 select i.*, i.ccdnum <> 2 as other, not {NOT_BLACK} as black, (select count(*) from sky_zeropoint z where {ZP}) as n_zp from sky_image i)
, good as (select * from flagged where not other and not black and n_zp > 0)
select count(*) as n_images, count(*) filter (where other) as n_other_detector, count(*) filter (where not other and black) as n_blacklisted,
  count(*) filter (where not other and not black and n_zp = 0) as n_without_zeropoint, (select coalesce(sum(n_zp), 0)::bigint from good) as n_candidates,
  (select coalesce(sum(i.n_zp), 0)::bigint from good i join sky_tile t on {NEAR}) as n_pairs from flagged""")
sql("tile_inputs_unique_zeropoint", "sky_image sky_tile sky_zeropoint", f"""
, z as (select imagename, source, version, flag, max(mag_zero) as mag_zero from sky_zeropoint group by imagename, source, version, flag
  qualify row_number() over (partition by imagename order by source, version, flag) = 1)
select {OUT}, z.mag_zero from sky_image i join z on {ZP} join sky_tile t on {NEAR}""")
sql("tile_inputs_by_file", "sky_image sky_tile", PAIRS + """
select tilename, band, filename, row_number() over (order by tilename, band, filename) as position from pairs""")
sql("images_by_ra", "sky_image", """
select ra_cent, band, filename, row_number() over (order by ra_cent, band, filename) as position from sky_image""")
sql("tile_inputs_by_detector", "sky_image sky_tile", PAIRS + """
select ccdnum, tilename, filename, row_number() over (order by ccdnum, tilename, filename) as position from pairs""")

sql("inputs_per_tile_band", "sky_image sky_tile", PAIRS + """
select tilename, band, count(*) as nima, count(distinct expnum) as nexp from pairs group by tilename, band""")

FINAL_COADDS = "sky_coadd c where not ends_with(imagename, '_det.fits')"
COADD_INPUTS = f"""
select tilename, band, count(*) as n_inputs
from (select distinct k.tilename, k.band, src_imageid
      from (select id as coadd_imageid, tilename, band from {FINAL_COADDS}
            and exists (select 1 from sky_run where sky_run.run = c.run and tag = '{{tag}}')) k
      join sky_coadd_src using (coadd_imageid)) one_each
group by all"""
sql("coadd_inputs_per_tile_band", "sky_coadd sky_coadd_src sky_run", COADD_INPUTS.format(tag="Y1A1_COADD_STRIPE82"))
sql("inputs_mean_median_by_band", "sky_coadd sky_coadd_src sky_run", f"""
select band, count(*) as n_tiles, round(avg(n_inputs), 6) as mean_inputs, median(n_inputs) as median_inputs,
       cast(list_sort(list(n_inputs))[cast(floor(count(*) / 2) as int) + 1] as double) as upper_median_inputs
from ({COADD_INPUTS.format(tag="Y1A1_COADD")}) n group by band""")

sql("footprint_bounds", "sky_image", """
select band, min(least(rac1, rac2, rac3, rac4)) as x_min, max(greatest(rac1, rac2, rac3, rac4)) as x_max,
       min(least(decc1, decc2, decc3, decc4)) as y_min, max(greatest(decc1, decc2, decc3, decc4)) as y_max, count(*) as n_images
from sky_image group by band""")
RECENTRED = "(case when ra_cent >= 275 then ra_cent - 360 else ra_cent end)"
sql("images_in_sky_window", "sky_image", f"""
select filename, {r(fold('ra_cent'), 'ra_180')}, {r(RECENTRED, 'ra_275')}, {r('dec_cent', 'dec_cent')}
from sky_image where {RECENTRED} > -31 and {RECENTRED} < 31 and dec_cent > -31 and dec_cent < 31""")
sql("image_sizes", "sky_image", f"""
select filename, case when greatest(rac1, rac3) - least(rac1, rac3) > 180 then 'Y' else 'N' end as flag,
  {r("case when crossra0 = 'Y' then abs(racmax - (racmin - 360)) else abs(racmax - racmin) end", 'ra_extent')},
  {r('abs(deccmax - deccmin)', 'dec_extent')}, {r('abs(decc1 - decc2)', 'dec_extent_corners')} from sky_image""")

# -- catalogues and exposures -----------------------------------------------------------------

sql("catalogs_of_exposures", "sky_image sky_tile sky_catalog", PAIRS + """
select p.tilename, c.filename, c.path, c.band, c.ccdnum, c.expnum
from (select distinct tilename, expnum from pairs) p join sky_catalog c on c.expnum = p.expnum""")
SCAMP = """select distinct filename_scampcat, filename_scamphead, path, pfw_attempt_id, expnum, band
from (select filename as filename_scampcat, band, expnum, pfw_attempt_id from sky_catalog c where filetype = 'cat_scamp_full'
      and exists (select 1 from sky_proctag p where p.tag = '{tag}' and p.pfw_attempt_id = c.pfw_attempt_id)) cats
join (select filename as filename_scamphead, expnum, pfw_attempt_id from sky_miscfile where filetype = 'head_scamp_full') heads using (expnum, pfw_attempt_id)
join (select filename as filename_scampcat, path from sky_archive) places using (filename_scampcat)"""
sql("exposure_catalogs", "sky_image sky_tile sky_catalog sky_miscfile sky_archive sky_proctag", PAIRS + f"""
select filename_scampcat, filename_scamphead, path, band, expnum from ({SCAMP.format(tag='Y2A1_FINALCUT')}) s
where expnum in (select expnum from pairs)""")
sql("exposure_reconciliation", "sky_image sky_tile sky_catalog", PAIRS + """
select coalesce(a.expnum, b.expnum) as expnum, case when a.expnum is null then 'image' else 'catalog' end as missing_side
from (select distinct expnum from pairs) a
full outer join (select distinct expnum from sky_catalog where filetype = 'cat_finalcut') b on a.expnum = b.expnum
where a.expnum is null or b.expnum is null""")
sql("exposure_pairing", "sky_image sky_catalog", """
select e.expnum, min(concat('/archive/', c.path, '/', c.filename)) as filepath_local
from (select distinct expnum from sky_image) e join sky_catalog c on c.expnum = e.expnum group by e.expnum""")
sql("exposures_of_bands", "sky_image", "select distinct band, expnum from sky_image where band in ('g', 'i')")
sql("distinct_values", "sky_image", "select distinct band, tag from sky_image")

# -- input tables --------------------------------------------------------------------------------


def interleave(x: str, y: str, bits: int) -> str:
    parts = [f"(((({x}) >> {k}) & 1) << {2 * k}) + (((({y}) >> {k}) & 1) << {2 * k + 1})" for k in range(bits)]
    return " + ".join(parts)


def hpix(rows: str, nside: int, name: str) -> str:
    """Sub-select of ``rows`` (with ra_cent, dec_cent) with the nested pixel added."""
    bits = nside.bit_length() - 1
    return f"""(
 select * exclude (z, tt, jp, jm, fp, fm, q, cp, cm, face, ix, iy), cast(face * {nside * nside} + {interleave('ix', 'iy', bits)} as int) as {name} from (
  select *,
    case when abs(z) <= 2.0/3 then (case when fp = fm then fp % 4 + 4 when fp < fm then fp % 4 else fm % 4 + 8 end)
         when z >= 0 then q else q + 8 end as face,
    case when abs(z) <= 2.0/3 then jm % {nside} when z >= 0 then {nside - 1} - cm else cp end as ix,
    case when abs(z) <= 2.0/3 then {nside - 1} - jp % {nside} when z >= 0 then {nside - 1} - cp else cm end as iy
  from (
   select *, jp // {nside} as fp, jm // {nside} as fm,
      least(cast(floor((tt - q) * {nside} * sqrt(3 * (1 - abs(z)))) as bigint), {nside - 1}) as cp,
      least(cast(floor((1 - (tt - q)) * {nside} * sqrt(3 * (1 - abs(z)))) as bigint), {nside - 1}) as cm
   from (
    select *, cast(floor({nside} * (0.5 + tt) - {nside} * 0.75 * z) as bigint) as jp,
              cast(floor({nside} * (0.5 + tt) + {nside} * 0.75 * z) as bigint) as jm, cast(floor(tt) as bigint) as q
    from (select *, sin(radians(dec_cent)) as z, ra_cent / 90.0 as tt from {rows}) h1) h2) h3) h4)"""


GEOMETRY_JOIN = """select i.filename, places.compression, places.path, i.pfw_attempt_id, i.band, i.ccdnum, i.expnum, i.crossra0,
  round(case when i.crossra0 = 'Y' then 360 - i.racmin + i.racmax else i.racmax - i.racmin end, 6) as ra_size,
  round(i.deccmax - i.deccmin, 6) as dec_size, i.ra_cent, i.dec_cent
from (select * from sky_image semi join (select pfw_attempt_id from sky_proctag where tag = 'Y2T9_FINALCUT') tagged using (pfw_attempt_id)) i
join (select filename, compression, path from sky_archive) places using (filename)"""
sql("build_images", "sky_image sky_archive sky_proctag", f"select * exclude (ra_cent, dec_cent) from {hpix('(' + GEOMETRY_JOIN + ') b', 32, 'hpix_32')} x")

# Every side is a table of its own, so that no planner has more than one join to order.
_own = {n: n for n in ("sky_fileset", "sky_segmap", "sky_catalog", "lineitem", "orders")}
ORACLE["build_images_3plane"] = "with " + ",\n".join(f"{n} as materialized ({text})" for n, text in {
    **{n: SQL[n].format(**_own) for n in ("sky_fileset", "sky_segmap", "sky_catalog", "sky_attempt", "sky_archive")},
    "tagged": "select distinct pfw_attempt_id from sky_attempt where tag = 'Y2T9_FINALCUT'",
    "located": "select filename, compression, path from sky_archive where filename is not null",
    **{f"{side}_tagged": f"select f.* from {table} f where f.filetype = '{kind}' and f.pfw_attempt_id in (select pfw_attempt_id from tagged)" for side, table, kind in (
        ("science", "sky_fileset", "red_immask"), ("background", "sky_fileset", "red_bkg"), ("segments", "sky_segmap", "red_segmap"))},
    "science": "select f.pfw_attempt_id, f.ccdnum, f.filename, l.compression, l.path, f.band, f.expnum from science_tagged f inner join located l on l.filename = f.filename",
    "background": "select f.pfw_attempt_id, f.ccdnum, f.filename as filename_bkg, l.compression as compression_bkg, l.path as path_bkg from background_tagged f inner join located l on l.filename = f.filename",
    "segments": "select f.pfw_attempt_id, f.ccdnum, f.filename as filename_seg, l.compression as compression_seg, l.path as path_seg from segments_tagged f inner join located l on l.filename = f.filename",
    "two": "select s.*, b.filename_bkg, b.compression_bkg, b.path_bkg from science s inner join background b on b.pfw_attempt_id = s.pfw_attempt_id and b.ccdnum = s.ccdnum",
}.items()) + """
select two.*, g.filename_seg, g.compression_seg, g.path_seg from two inner join segments g on g.pfw_attempt_id = two.pfw_attempt_id and g.ccdnum = two.ccdnum"""
sql("build_catalogs", "sky_catalog sky_archive sky_proctag", """
select filename, places.path, pfw_attempt_id, band, ccdnum, expnum
from (select * exclude (path) from sky_catalog c where filetype = 'cat_finalcut'
      and exists (select 1 from sky_proctag p where p.tag = 'Y2A1_FINALCUT' and p.pfw_attempt_id = c.pfw_attempt_id)) cats
join (select filename, path from sky_archive) places using (filename)""")
sql("build_scampcats", "sky_catalog sky_miscfile sky_archive sky_proctag", SCAMP.format(tag="Y2N_FIRSTCUT"))
PLACES = "(select filename, compression, path from sky_archive) places"


def _made(tag: str, condition: str) -> str:
    """Files made in a tagged run, with the run's three keys."""
    return f"""(select filename, reqnum, unitname, attnum from sky_wgb w where {condition}
  and exists (select 1 from sky_runtag g where g.tag = '{tag}' and (g.unitname, g.reqnum, g.attnum) = (w.unitname, w.reqnum, w.attnum))) made"""


sql("provenance_3key", "sky_image sky_archive sky_wgb sky_runtag", f"""
select filename, reqnum, unitname, attnum, compression, path, band, ccdnum, ra_cent, dec_cent
from (select filename, band, ccdnum, {r('ra_cent', 'ra_cent')}, {r('dec_cent', 'dec_cent')} from sky_image) images
join {_made('Y2N_FIRSTCUT', "exec_name = 'immask' and filetype = 'red'")} using (filename) join {PLACES} using (filename)""")
sql("provenance_any_task", "sky_image sky_archive sky_wgb sky_runtag", f"""
select filename from (select filename from sky_image) images
join {_made('Y2T3_FINALCUT', "filetype = 'red'")} using (filename) join {PLACES} using (filename)""")
sql("provenance_artifacts", "sky_image sky_archive sky_wgb sky_artifact sky_generated sky_exec sky_exectag", f"""
, tasks as (
 select task_id, reqnum, unitname, attnum from sky_exec e
 where exists (select 1 from sky_exectag p where p.tag = 'Y2N_FIRSTCUT' and (p.unitname, p.reqnum, p.attnum) = (e.unitname, e.reqnum, e.attnum))),
products as (
 select filename, reqnum, unitname, attnum
 from (select id as opm_artifact_id, name as filename from sky_artifact) artifacts join sky_generated using (opm_artifact_id) join tasks using (task_id))
select filename, compression, path, unitname, reqnum, attnum, band, ccdnum
from products join (select filename from sky_wgb where filetype = 'red' and filename like '%_2_%.fits') wanted using (filename)
join {PLACES} using (filename) join (select filename, band, ccdnum from sky_image) images using (filename)""")
sql("runs_of_tile", "sky_location sky_run", """
select distinct run, tilename, tag from sky_location join (select run, tag from sky_run where starts_with(tag, 'Y1A1_COADD')) tagged using (run)""")
LINEAGE = "sky_location sky_run sky_coadd sky_coadd_src sky_source sky_exposure"
sql("coadd_lineage", LINEAGE, f"""
, located as (select distinct run from sky_location semi join (select run from sky_run where tag = 'Y1A1_COADD') tagged using (run)),
coadds as (select run, id as coadd_imageid from (select * from {FINAL_COADDS}) final semi join located using (run)),
inputs as (select distinct run, src_imageid as id from coadds join sky_coadd_src using (coadd_imageid)),
exposures as (select distinct run, exposureid from inputs join sky_source using (id))
select run, e.id, exposurename, expnum, nite, band from exposures join sky_exposure e on e.id = exposureid""")
sql("coadd_lineage_of_run", LINEAGE, f"""
, inputs as (select distinct src_imageid as id from (select id as coadd_imageid from {FINAL_COADDS} and run = 'run3') coadds join sky_coadd_src using (coadd_imageid)),
exposures as (select distinct exposureid from inputs join sky_source using (id))
select e.id, exposurename, expnum, nite, band from exposures join sky_exposure e on e.id = exposureid""")
EXPOSURE_NAME = "concat('DECam_', lpad(cast(expnum as string), 8, '0'), '_', lpad(cast(ccdnum as string), 2, '0'), '.fits')"
sql("zeropoint_backfill", "sky_image sky_oldfile sky_run sky_oldzp", f"""
, old as (
 select l.filename as imagename, z.imageid, z.mag_zero, row_number() over (partition by l.filename order by z.imageid, z.mag_zero) as rn
 from sky_oldfile l join sky_run g on g.run = l.run and g.tag in ('SVA1_FINALCUT', 'Y1A1_COADD')
 join sky_oldzp z on z.imageid = l.id where l.filetype = 'red')
select i.filename, {EXPOSURE_NAME.replace('expnum', 'i.expnum').replace('ccdnum', 'i.ccdnum')} as imagename, o.mag_zero, o.imageid, 'Y2T3_FINALCUT' as tag
from sky_image i left join old o on o.rn = 1 and o.imagename = {EXPOSURE_NAME.replace('expnum', 'i.expnum').replace('ccdnum', 'i.ccdnum')}""")
sql("zeropoint_selfjoin", "sky_oldfile sky_run sky_oldzp", """
, wanted as (select filename from sky_oldfile where filetype = 'red' and run in ('run4', 'run7')),
tagged as (select distinct filename as imagename, id as imageid from sky_oldfile f where filename in (from wanted)
 and exists (select 1 from sky_run where sky_run.run = f.run and tag = 'SVA1_FINALCUT'))
select distinct imageid, imagename, mag_zero from tagged join sky_oldzp using (imageid)""")

# -- tiling --------------------------------------------------------------------------------------

WIDTH = "(0.263::double*10000/3600.0)"


def overlap(dec: str) -> str:
    return f"(case when abs({dec}) < 74 then 1/60.0::double when abs({dec}) < 82.5 then 2/60.0::double when abs({dec}) < 87.6 then 5/60.0::double else 10/60.0::double end)"


def grid(dec_end: str) -> str:
    return f"""
recursive_rows(dec_row, dec_cent) as (
  select 0, 30.0::double
  union all
  select dec_row + 1, dec_cent - ({WIDTH} - {overlap('dec_cent')}) from recursive_rows
  where dec_cent - ({WIDTH} - {overlap('dec_cent')}) >= {dec_end}),
dec_rows as (
  select dec_row, dec_cent, {overlap('dec_cent')} as ov, ({WIDTH} - {overlap('dec_cent')}) / cos(radians(dec_cent)) as step from recursive_rows),
grid as (
  select *, 275.0 + ra_step * step as ra_run, case when 275.0 + ra_step * step > 360 then 275.0 + ra_step * step - 360 else 275.0 + ra_step * step end as ra_cent
  from (select *, cast(ceil(360.0 / step) as bigint) as n, unnest(generate_series(0, cast(ceil(360.0 / step) as bigint) - 1)) as ra_step from dec_rows) g),
bounds as (
  select dec_row, step, dec_cent - ({WIDTH} - ov)/2 as lo,
         coalesce(lag(dec_cent - ({WIDTH} - ov)/2) over (order by dec_row), dec_cent + ({WIDTH} - ov)/2) as hi from dec_rows),
home as (
  select i.filename, b.dec_row,
         least(cast(floor((case when i.ra_cent - (275.0 - b.step/2) < 0 then i.ra_cent - (275.0 - b.step/2) + 360 else i.ra_cent - (275.0 - b.step/2) end) / b.step) as bigint),
               cast(ceil(360.0 / b.step) as bigint) - 1) as ra_step
  from sky_image i join bounds b on i.dec_cent >= b.lo and i.dec_cent < b.hi),
counts as (select dec_row, ra_step, count(*) as n_images from home group by dec_row, ra_step)
"""


def hhmm(x: str) -> str:
    m = f"cast(floor({x} * 60 + 1e-6) as bigint)"
    return f"concat(lpad(cast({m} // 60 as string), 2, '0'), lpad(cast({m} % 60 as string), 2, '0'))"


def tile_name(ra: str = "ra_cent", dec: str = "dec_cent") -> str:
    return f"concat('DES', {hhmm(f'({ra} / 15.0)')}, case when {dec} < 0 then '-' else '+' end, {hhmm(f'abs({dec})')})"


def tan_ra(u: str, v: str, ra0: str, dec0: str) -> str:
    """RA of intermediate coordinates u, v (degrees)."""
    return wrap(f"({ra0} + degrees(atan2(radians({u}), cos(radians({dec0})) - radians({v})*sin(radians({dec0})))))")


def tan_dec(u: str, v: str, dec0: str) -> str:
    d = f"(cos(radians({dec0})) - radians({v})*sin(radians({dec0})))"
    return f"degrees(atan2(sin(radians({dec0})) + radians({v})*cos(radians({dec0})), sqrt(radians({u})*radians({u}) + {d}*{d})))"


def tiling(name: str, dec_end: str, body: str) -> None:
    ORACLE[name] = with_tables("sky_image").replace("with ", "with recursive ", 1) + ", " + grid(dec_end).strip() + "\n" + body


tiling("tiling_home_tiles", "-85", f"""
select h.filename, {tile_name('g.ra_cent', 'g.dec_cent')} as tilename, h.dec_row, cast(h.ra_step as int) as ra_step
from home h join grid g on g.dec_row = h.dec_row and g.ra_step = h.ra_step""")

HALF = "(0.263::double/3600.0*4999.5)"
_last = "ra_step = n - 1"
_corner = {1: (f"{HALF}", f"-{HALF}"), 2: (f"-{HALF}", f"-{HALF}"), 3: (f"-{HALF}", f"{HALF}"), 4: (f"{HALF}", f"{HALF}")}
CORNERS = ", ".join(
    f"{tan_ra(u, v, 'ra_cent', 'dec_cent')} as rac{k}, {tan_dec(u, v, 'dec_cent')} as decc{k}" for k, (u, v) in _corner.items())
SIZED = f"""
, tiles as (select *, {tile_name()} as tilename,
    case when ra_run - step/2 > 360 then ra_run - step/2 - 360 else ra_run - step/2 end as ural,
    case when {_last} then 275.0 - step/2 when ra_run + step/2 > 360 then ra_run + step/2 - 360 else ra_run + step/2 end as urau,
    {CORNERS} from grid),
flagged as (select *, case when abs(urau - ural) > 2*{WIDTH}/cos(radians(dec_cent)) then 'Y' else 'N' end as crossra0,
    greatest(rac1, rac2, rac3, rac4) as east, least(rac1, rac2, rac3, rac4) as west from tiles),
sized as (select *, case when east - west > 180 then east else west end as racmin, case when east - west > 180 then west else east end as racmax,
    case when east - west > 180 then west + 360 - east else east - west end as ra_size from flagged)
"""
tiling("tiling_grid", "-85", SIZED + f"""
select s.tilename, s.dec_row, cast(s.ra_step as int) as ra_step, s.crossra0, coalesce(c.n_images, 0) as n_images,
  {r('ra_cent', 'ra_cent')}, {r('dec_cent', 'dec_cent')}, {r('rac1', 'rac1')}, {r('rac2', 'rac2')}, {r('decc1', 'decc1')}, {r('decc3', 'decc3')},
  {r('racmin', 'racmin')}, {r('racmax', 'racmax')},
  {r('ra_size', 'ra_size')},
  {r('greatest(decc1, decc2, decc3, decc4) - least(decc1, decc2, decc3, decc4)', 'dec_size')},
  {r('ural', 'uramin')}, {r('urau', 'uramax')}, {r(f'dec_cent - ({WIDTH} - ov)/2', 'udecmin')}, {r(f'dec_cent + ({WIDTH} - ov)/2', 'udecmax')}
from sized s left join counts c on c.dec_row = s.dec_row and c.ra_step = s.ra_step""")

tiling("survey_inputs_per_tile", "-85", SIZED + f"""
, near_rows as (select i.*, g.dec_row from sky_image i join dec_rows g on abs(i.dec_cent - g.dec_cent) < 2)
select s.tilename, i.band, count(*) as nima, count(distinct i.expnum) as nexp
from near_rows i join sized s on s.dec_row = i.dec_row
 and least(abs(i.ra_cent - s.ra_cent), 360.0 - abs(i.ra_cent - s.ra_cent)) < 0.5*s.ra_size + 0.5*i.ra_size
 and abs(i.dec_cent - s.dec_cent) < 0.5*(greatest(s.decc1, s.decc2, s.decc3, s.decc4) - least(s.decc1, s.decc2, s.decc3, s.decc4)) + 0.5*i.dec_size
group by s.tilename, i.band""")

_up, _low = f"({WIDTH}/cos(radians(dec_cent + {WIDTH}/2))/2)", f"({WIDTH}/cos(radians(dec_cent - {WIDTH}/2))/2)"
_past = f"least(ra_run - {_up}, ra_run - {_low}, ra_run - step/2, ra_run + {_up}, ra_run + {_low}, ra_run + step/2) > 360"
_flat = {n: f"case when {_past} then {x} - 360 else {x} end" for n, x in {
    "rall": f"(ra_run - {_low})", "ralr": f"(ra_run + {_low})", "raul": f"(ra_run - {_up})", "raur": f"(ra_run + {_up})",
    "ural": "(ra_run - step/2)", "urau": "(ra_run + step/2)"}.items()}
_flat["urau"] = f"case when {_last} then 275.0 - step/2 else ({_flat['urau']}) end"
tiling("tiling_flat_corners", "-89.99", f"""
select {tile_name('g.ra_cent', 'g.dec_cent')} as tilename, coalesce(c.n_images, 0) as n_images, {', '.join(r(x, n) for n, x in _flat.items())},
  {r(f'dec_cent - {WIDTH}/2', 'decll')}, {r(f'dec_cent + {WIDTH}/2', 'decul')},
  {r(f'dec_cent - ({WIDTH} - ov)/2', 'udecl')}, {r(f'dec_cent + ({WIDTH} - ov)/2', 'udecu')}
from grid g left join (select dec_row, ra_step as s, n_images from counts) c on c.dec_row = g.dec_row and c.s = g.ra_step""")

sql("tiling_consistency", "sky_bounds", """
select tilename, crossra0, concat_ws(',', case when uramin > uramax and crossra0 = 'N' then 'ura' end, case when udecmin > udecmax then 'udec' end) as reason
from sky_bounds where (uramin > uramax and crossra0 = 'N') or udecmin > udecmax""")
sql("tile_ids", "sky_bounds", """
, known as (select tilename, id from sky_bounds where kind > 15)
select b.tilename, k.id is null as is_new,
  coalesce(k.id, (select max(id) from known) + row_number() over (partition by k.id is null order by b.dec_row, b.ra_step)) as id
from sky_bounds b left join known k on k.tilename = b.tilename""")
sql("tile_id_range", "sky_bounds", "select min(id) as id_min, max(id) as id_max from sky_bounds")


def _compare(tol: str, dec_tol: str, f) -> str:
    ura = " or ".join(f"abs(n.{c} - {f('s.' + c)}) > {tol}" for c in ("uramin", "uramax"))
    return f"""concat_ws(',', case when s.tilename is null then 'missing' end,
    case when abs(n.ra_cent - s.ra_cent) > {tol} or abs(n.dec_cent - s.dec_cent) > {dec_tol} then 'centre' end,
    case when {ura} then 'ura' end,
    case when abs(n.udecmin - s.udecmin) > {dec_tol} or abs(n.udecmax - s.udecmax) > {dec_tol} then 'udec' end)"""


sql("tile_compare", "sky_bounds sky_bounds_stored", f"""
select * from (select n.tilename, {_compare("1e-5/cos(radians(s.dec_cent))", "1e-5", lambda c: f"(case when {c} > 360 then {c} - 360 else {c} end)")} as reason
from sky_bounds n left join sky_bounds_stored s on s.tilename = n.tilename) x where reason <> ''""")
sql("tile_compare_older", "sky_bounds sky_bounds_stored", f"""
select * from (select n.tilename, {_compare("1e-3", "1e-3", lambda c: c)} as reason,
  {r('abs(n.dec_cent - s.dec_cent)', 'd_dec_cent')}, {r('abs(n.uramax - s.uramax)', 'd_uramax')}
from sky_bounds n left join sky_bounds_stored s on s.tilename = n.tilename) x where reason <> ''""")

# -- world coordinates ---------------------------------------------------------------------------


def _uv(x: str, y: str) -> tuple[str, str]:
    return (f"(cd1_1*({x} - crpix1) + cd1_2*({y} - crpix2))", f"(cd2_1*({x} - crpix1) + cd2_2*({y} - crpix2))")


_pixels = {1: ("1.0", "1.0"), 2: ("naxis1", "1.0"), 3: ("naxis1", "naxis2"), 4: ("1.0", "naxis2")}
_header = [f"{r(tan_ra(*_uv('naxis1/2.0', 'naxis2/2.0'), 'crval1', 'crval2'), 'ra')}", f"{r(tan_dec(*_uv('naxis1/2.0', 'naxis2/2.0'), 'crval2'), 'dec')}"]
for _k, (_x, _y) in _pixels.items():
    _header += [r(tan_ra(*_uv(_x, _y), "crval1", "crval2"), f"rac{_k}"), r(tan_dec(*_uv(_x, _y), "crval2"), f"decc{_k}")]
sql("wcs_corners", "sky_header", f"select image_id, {', '.join(_header)} from sky_header")


def _tpv(x: str, y: str) -> tuple[str, str]:
    u, v = _uv(x, y)
    return (f"(0.001 + 1.01*{u} + 0.02*{u}*{u})", f"(-0.002 + 0.99*{v} + 0.03*{v}*{v}*{v})")


_distorted = [r(tan_ra(*_tpv("naxis1/2.0", "naxis2/2.0"), "crval1", "crval2"), "ra"), r(tan_dec(*_tpv("naxis1/2.0", "naxis2/2.0"), "crval2"), "dec")]
for _k in (1, 3):
    _distorted += [r(tan_ra(*_tpv(*_pixels[_k]), "crval1", "crval2"), f"rac{_k}"), r(tan_dec(*_tpv(*_pixels[_k]), "crval2"), f"decc{_k}")]
sql("wcs_corners_tpv", "sky_header", f"select image_id, {', '.join(_distorted)} from sky_header")


def inverse(ra: str, dec: str, ra0: str, dec0: str) -> tuple[str, str]:
    """Intermediate coordinates (degrees) of a sky position."""
    a, d, d0 = f"radians({ra} - {ra0})", f"radians({dec})", f"radians({dec0})"
    depth = f"(sin({d0})*sin({d}) + cos({d0})*cos({d})*cos({a}))"
    return (f"degrees(cos({d})*sin({a})/{depth})", f"degrees((cos({d0})*sin({d}) - sin({d0})*cos({d})*cos({a}))/{depth})")


_u, _v = inverse("(crval1 + 0.05)", "(crval2 - 0.03)", "crval1", "crval2")
_det = "(cd1_1*cd2_2 - cd1_2*cd2_1)"
sql("wcs_sky2pix", "sky_header", f"""
select image_id, {r(f'(cd2_2*{_u} - cd1_2*{_v})/{_det} + crpix1', 'x', 3)}, {r(f'(cd1_1*{_v} - cd2_1*{_u})/{_det} + crpix2', 'y', 3)} from sky_header""")


def with_seconds(x: str) -> str:
    h = f"cast(round({x} * 360000) as bigint)"
    return (f"concat(lpad(cast({h} // 360000 as string), 2, '0'), lpad(cast({h} // 6000 % 60 as string), 2, '0'), "
            f"lpad(cast({h} % 6000 // 100 as string), 2, '0'), '.', lpad(cast({h} % 100 as string), 2, '0'))")


def long_name(ra: str, dec: str) -> str:
    return f"concat('DESJ', {with_seconds(f'({ra} / 15.0)')}, case when {dec} < 0 then '-' else '+' end, {with_seconds(f'abs({dec})')})"


_custom = {
    k: (f"({'1' if k in (1, 4) else '-1'}*0.263::double/3600.0*(naxis1 - 1)/2.0)",
        f"({'-1' if k in (1, 2) else '1'}*0.263::double/3600.0*(naxis2 - 1)/2.0)") for k in (1, 2, 3, 4)}
_custom_corners = ", ".join(f"{tan_ra(u, v, 'crval1', 'crval2')} as rac{k}, {tan_dec(u, v, 'crval2')} as decc{k}" for k, (u, v) in _custom.items())
sql("custom_tiles", "sky_header", f"""
, c as (select image_id, crval1, crval2, cast(floor((10.0 + image_id % 50) / (0.263::double/60.0)) as int) as naxis1,
        cast(floor((20.0 + image_id % 30) / (0.263::double/60.0)) as int) as naxis2 from sky_header),
k as (select *, {_custom_corners} from c),
f as (select *, case when greatest(rac1, rac2, rac3, rac4) - least(rac1, rac2, rac3, rac4) > 180 then 'Y' else 'N' end as crossra0,
      greatest(rac1, rac2, rac3, rac4) as hi, least(rac1, rac2, rac3, rac4) as lo from k)
select image_id, {long_name('crval1', 'crval2')} as tilename, naxis1, naxis2, crossra0,
  {r('rac1', 'rac1')}, {r('decc1', 'decc1')}, {r('rac3', 'rac3')}, {r('decc3', 'decc3')},
  round(case when crossra0 = 'Y' then hi else lo end, 6) as racmin, round(case when crossra0 = 'Y' then lo else hi end, 6) as racmax,
  round(case when crossra0 = 'Y' then abs(lo - (hi - 360)) else hi - lo end, 6) as ra_size,
  {r('greatest(decc1, decc2, decc3, decc4) - least(decc1, decc2, decc3, decc4)', 'dec_size')} from f""")

sql("hpix_assign", "sky_image", f"select filename, hpix_32, hpix_256 from {hpix(hpix('sky_image', 32, 'hpix_32') + ' a', 256, 'hpix_256')} b")
sql("hpix_merge", "sky_image", f"select hpix_32, band, count(*) as n from {hpix('sky_image', 32, 'hpix_32')} a group by hpix_32, band")
sql("sky_map_lookup", "sky_image", f"""
select a.filename, a.hpix, p.v as map_value from {hpix('sky_image', 32, 'hpix')} a
left join (select p_partkey % 12288 as k, cast(max(p_size) as double) as v from part group by p_partkey % 12288) p on p.k = a.hpix""")

# -- depth ---------------------------------------------------------------------------------------

N_BINS, BIN_SCALE = 100, "(0.36::double*10000/100/3600.0)"


def _bin_xy(ra: str, dec: str) -> tuple[str, str]:
    u, v = inverse(ra, dec, "t.ra_cent", "t.dec_cent")
    return (f"({u}/(-{BIN_SCALE}) + 50.5)", f"({v}/{BIN_SCALE} + 50.5)")


_cols = []
for _k in (1, 2, 3, 4):
    _x, _y = _bin_xy(f"i.rac{_k}", f"i.decc{_k}")
    _tx, _ty = _bin_xy(f"t.rac{_k}", f"t.decc{_k}")
    _cols += [f"{_x} - 1 as x{_k}", f"{_y} - 1 as y{_k}", f"trunc({_tx}) as tx{_k}", f"trunc({_ty}) as ty{_k}"]


def _edge(a: str, low: bool) -> str:
    own, tile = ", ".join(f"{a}{k}" for k in (1, 2, 3, 4)), ", ".join(f"t{a}{k}" for k in (1, 2, 3, 4))
    x = f"greatest(least({own}), least({tile}))" if low else f"least(greatest({own}), greatest({tile}))"
    return f"greatest(least(cast(trunc({x}) as int), {N_BINS}), 0)"


RECTANGLES = f"""
, projected as (select t.tilename, i.band, i.expnum, {', '.join(_cols)} from sky_image i join sky_tile t on {NEAR}),
rects as (select tilename, band, expnum, {_edge('x', True)} as xa, {_edge('x', False)} as xb, {_edge('y', True)} as ya, {_edge('y', False)} as yb from projected),
pixel as (
 select tilename, band, y, x, count(*) as depth from (
  select tilename, band, y, unnest(generate_series(xa, xb - 1)) as x from (
   select tilename, band, xa, xb, unnest(generate_series(ya, yb - 1)) as y from rects where xa < xb and ya < yb) rows_) cells
 group by tilename, band, y, x)
"""
sql("depth_map", "sky_image sky_tile", RECTANGLES + "select tilename, band, cast(y as int) as y, cast(x as int) as x, depth from pixel")
_share = ", ".join(f"coalesce(count(*) filter (where p.depth >= {n}), 0) / 10000.0::double as d{n}" for n in range(1, 8))
STATISTICS = RECTANGLES + f"""
, covered as (select tilename, band, {_share}, list_sort(list(p.depth)) as depths, count(*) as n from pixel p group by tilename, band),
stats as (
 select r.tilename, r.band, {', '.join(f'coalesce(c.d{n}, 0) as d{n}' for n in range(1, 8))},
   -- the two middle ones of 10000 pixels, of which 10000 - n are zero
   (case when coalesce(c.n, 0) > 5000 then c.depths[5000 - (10000 - c.n)] else 0 end
    + case when coalesce(c.n, 0) >= 5000 then c.depths[5001 - (10000 - c.n)] else 0 end) / 2.0::double as dmedian,
   cast(r.nexp as int) as nexp, cast(r.nima as int) as nima
 from (select tilename, band, count(distinct expnum) as nexp, count(*) as nima from rects group by tilename, band) r
 left join covered c on c.tilename = r.tilename and c.band = r.band)
"""
sql("depth_fractions", "sky_image sky_tile", STATISTICS + "select * from stats")

sql("depth_json", "sky_image sky_tile", STATISTICS + "select tilename, " + ", ".join(
    f"max(d{n}) filter (where band = '{band}') as {band}_d{n}" for band in "grizY" for n in range(1, 8)) + " from stats group by tilename")

# -- lists, bands, names -------------------------------------------------------------------------

ASSOC = f"""
, assoc0 as (select t.tilename, i.filename, i.band, i.ccdnum, z.mag_zero, {LOCAL} as filepath_local,
   concat('/archive/BKG/', i.path, '/', replace(i.filename, '.fits', '_bkg.fits'), coalesce(i.compression, '')) as filepath_bkg,
   concat('/archive/SEG/', i.path, '/', replace(i.filename, '.fits', '_segmap.fits')) as filepath_seg
  from sky_image i join sky_zeropoint z on {ZP} join sky_tile t on {NEAR}),
assoc as (select *, concat('/tiles/', tilename, '/inputs/', tilename, '_',
   replace(replace(regexp_extract(filepath_local, '([^/]*)$', 1), '.fits.fz', '.fits'), '.fits', '-me.fits')) as filepath_nwg from assoc0)
"""
ASSOC_TABLES = "sky_image sky_tile sky_zeropoint"
sql("flux_scale", ASSOC_TABLES, ASSOC + f"select tilename, filename, mag_zero, {r('pow(10.0::double, 0.4*(30.0 - mag_zero))', 'flxscale', 8)} from assoc")


def listing(name: str, sort_key: str, kinds: dict[str, str]) -> None:
    sql(name, ASSOC_TABLES, ASSOC + " union all ".join(
        f"select tilename, band, '{k}' as kind, {sort_key} as sort_key, {line} as line from assoc" for k, line in kinds.items()))


listing("band_lists", "filepath_nwg", {"sci": "concat(filepath_nwg, '[0]')", "wgt": "concat(filepath_nwg, '[2]')", "flx": "printf('%.8f', pow(10.0::double, 0.4*(30.0 - mag_zero)))", "msk": "concat(filepath_nwg, '[1]')"})
listing("meds_lists", "filepath_nwg", {
    "nwg": "concat(filepath_nwg, ' ', cast(mag_zero as string))", "bkg": "filepath_bkg", "seg": "filepath_seg"})
listing("mangle_lists", "filepath_local", {"mangle-red": "concat(filepath_local, ', ', cast(mag_zero as string))", "mangle-me": "filepath_nwg"})
_cat = "concat('/archive/', path, '/', filename)"
sql("exposure_lists", "sky_catalog", f"select expnum, 'catlist' as kind, {_cat} as sort_key, {_cat} as line from sky_catalog")
sql("scamp_lists", "sky_catalog", " union all ".join(
    f"select '{k}' as kind, concat('/tiles/align/T1_', cast(expnum as string), '_scampcat.{e}') as sort_key, concat('/tiles/align/T1_', cast(expnum as string), '_scampcat.{e}') as line from (select distinct expnum from sky_catalog) e"
    for k, e in (("expcat", "fits"), ("exphead", "head"))))
sql("drop_failed", ASSOC_TABLES, ASSOC + "select tilename, filename, filepath_nwg from assoc where ccdnum <> 2")

BANDS = PAIRS + ", bands as (select tilename, list_sort(list(distinct band)) as b from pairs group by tilename)\n"
sql("band_plan", "sky_image sky_tile", BANDS + """
select tilename, cast(len(b) as int) as n_bands, array_to_string(b, ',') as do_bands, concat(array_to_string(b, ','), ',det') as d_bands from bands""")
sql("detection_bands", "sky_image sky_tile", BANDS + """
select tilename, array_to_string(list_filter(b, lambda x: x in ('r', 'i', 'z')), ',') as det_bands from bands""")
sql("color_triple", "sky_image sky_tile", BANDS + """
select tilename, case when list_has_all(b, ['i','r','g']) then 'i,r,g' when list_has_all(b, ['z','r','g']) then 'z,r,g'
  when list_has_all(b, ['z','i','g']) then 'z,i,g' when list_has_all(b, ['z','i','r']) then 'z,i,r' end as triple from bands""")
sql("tile_list_union", "sky_tile", """
select tilename from sky_tile where dec_cent > -10 union all select tilename from sky_tile where ra_cent < 200""")
_name = "replace(concat(filename, coalesce(compression, '')), '.fits.fz', '.fits')"
_label = f"regexp_extract(regexp_replace({_name}, '\\.[^.]*$', ''), '([^_]*)$', 1)"
sql("path_names", "sky_image", f"""
select filename, concat('/tiles/inputs/T1_', replace({_name}, '.fits', '-me.fits')) as filepath_nwg,
  replace(replace(concat('/tiles/inputs/T1_', {_name}), {_label}, 'immasked-me'), 'fits', 'ohead') as filepath_head,
  {EXPOSURE_NAME} as exposure_name, substr(filename, 1, 9) as prefix, {_label} as label from sky_image""")
sql("https_paths", "sky_image", f"select i.filename, {LOCAL} as filepath_local, {HTTPS} as filepath_https from sky_image i")
_kinds = ", ".join(f"('{kind}', '{folder}', '{pattern}')" for kind, (folder, pattern) in PRODUCT_FILES.items())
sql("product_files", "sky_image sky_tile", PAIRS + f"""
, g as (select distinct tilename as base, band, expnum as exposure from pairs), k(kind, subdir, pattern) as (values {_kinds})
select base, band, exposure, kind, concat('/tiles/', subdir, case when subdir = '' then '' else '/' end, replace(replace(replace(replace(pattern, '{{base}}', base), '{{band}}', band),
  '{{exposure}}', cast(exposure as string)), '{{suffix}}', concat('v', exposure % 9))) as product_path from g, k""")
_lab = "regexp_extract(regexp_replace(filename, '\\.[^.]*$', ''), '([^_]*)$', 1)"
sql("label_unique", "sky_catalog sky_image", " union all ".join(
    f"select {g} as grp, case when count(distinct {_lab}) = 1 then min({_lab}) end as label, count(distinct {_lab}) = 1 as is_unique, count(*) as n_files from {t} group by {g}"
    for g, t in (("filetype", "sky_catalog"), ("band", "sky_image"))))
ORACLE["archive_roots"] = """
select s_name as name, concat('/root/', cast(s_nationkey as string)) as root,
  case when s_suppkey % 2 = 0 then concat('https://', cast(s_suppkey as string)) end as root_https
from supplier where s_name = 'Supplier#000000004'"""
sql("polygon_files", "sky_tile", """
select concat('Y3A1v1_tiles_10s.', cast(tile_id as string), '.pol') as filename, tile_id, 'poltiles' as kind, 'OPS/pol' as path
from sky_tile where dec_cent > -30""")
sql("tile_names", "sky_image", f"""
select filename, {tile_name()} as short_name, {long_name('ra_cent', 'dec_cent')} as long_name, {r(overlap('dec_cent'), 'overlap')} from sky_image""")

# -- sampling --------------------------------------------------------------------------------------

sql("sample_exposures", "sky_image sky_tile", PAIRS + """
, ranked as (select *, row_number() over (partition by tilename, band order by md5(concat('7:', cast(expnum as string))), expnum) as rn
  from (select distinct tilename, band, expnum from pairs) e)
select p.filename, p.band, concat(p.tilename, '_RAN_EXP') as tag
from pairs p join ranked k on k.tilename = p.tilename and k.band = p.band and k.expnum = p.expnum and k.rn <= 4""")
sql("sample_exposures_by_prefix", "sky_image sky_tile", PAIRS + """
, drawn as (select tilename, band, prefix from (select distinct tilename, band, filename[1:9] as prefix from pairs) e
  qualify row_number() over (partition by tilename, band order by md5(concat('7:', prefix)), prefix) <= 4)
select filename, band, concat(tilename, '_RAN_EXP') as tag from pairs p semi join drawn d on d.tilename = p.tilename and d.band = p.band and d.prefix = p.filename[1:9]""")
sql("sample_images", "sky_image sky_tile", PAIRS + """
select filename, band, concat(tilename, '_RAN_CCD') as tag
from (select *, row_number() over (partition by tilename, band order by md5(concat('7:', filename)), filename) as rn from pairs) k
where rn <= case band when 'g' then 2 when 'r' then 1 when 'i' then 3 when 'z' then 2 when 'Y' then 1 end""")

# -- comparisons -----------------------------------------------------------------------------------

ORACLE["catalog_compare"] = """
with c as (
 select count(*) filter (where label = 1) as e, count(*) filter (where label = 3) as l from embeddings)
select 'vec_id' as "column", cast(0 as bigint) as n_different, true as is_equal
union all select 'embedding', e, e = 0 from c
union all select 'label', l, l = 0 from c
union all select 'plain', 0, true
union all select 'gap', 0, true
union all select 'extra', null, false
union all select '*', null, false"""
ORACLE["catalog_compare_rows"] = """
with a as (select s_name, s_nationkey, s_acctbal::double as s_acctbal, row_number() over (order by s_name, s_nationkey, s_acctbal) as n from supplier),
b as (select s_name, case when s_suppkey % 10 = 0 then -1 else s_nationkey end as s_nationkey, s_acctbal::double as s_acctbal from supplier where s_suppkey > 3),
c as (select *, row_number() over (order by s_name, s_nationkey, s_acctbal) as n from b),
d as (
 select count(*) filter (where a.n is null or c.n is null) as row, count(*) filter (where a.s_name is distinct from c.s_name) as s_name,
  count(*) filter (where a.s_nationkey is distinct from c.s_nationkey) as s_nationkey, count(*) filter (where a.s_acctbal is distinct from c.s_acctbal) as s_acctbal from a full join c on a.n = c.n)
select 'row' as "column", row as n_different, row = 0 as is_equal from d
union all select 's_name', s_name, s_name = 0 from d
union all select 's_nationkey', s_nationkey, s_nationkey = 0 from d
union all select 's_acctbal', s_acctbal, s_acctbal = 0 from d
union all select 'same', row, row = 0 from d
union all select 'more', null, false
union all select '*', null, false"""
STEP = "(case when (x + y) % 3 = 0 then x - y + 1 else 0 end)"
sql("plane_diff", "sky_pixel", f"""
, d as (select file, hdu, case when x = 7 and y = 7 then null else -{STEP} end as diff from sky_pixel)
select file, hdu, count(*) as n_pix, count(*) filter (where diff is null) as n_unpaired, count(*) filter (where diff <> 0) as n_diff,
  round(count(*) filter (where diff <> 0) / count(*)::double, 6) as fraction, round(avg(diff) filter (where diff <> 0), 6) as diff_mean,
  min(diff) filter (where diff <> 0) as diff_min, max(diff) filter (where diff <> 0) as diff_max, cast(median(diff) filter (where diff <> 0) as double) as diff_median
from d group by file, hdu""")
sql("plane_diff_image", "sky_pixel", f"select file, hdu, y, x, -{STEP} as diff from sky_pixel where {STEP} <> 0 and not (x = 7 and y = 7)")
ORACLE["config_diff"] = """
select concat('K', cast(p_partkey as string)) as "key", p_type as value_new,
  case when p_size = 7 then 'OTHER' end as value_ref
from part where p_size = 5 or p_size = 7"""
sql("pair_missing", "sky_catalog", """
select filename as file1, concat('H', cast(expnum as string), '.fits') as file2, filetype <> 'cat_firstcut' as exists1, band <> 'g' as exists2
from sky_catalog where filetype = 'cat_firstcut' or band = 'g'""")
sql("pair_existing", "sky_catalog", """
select filename as file1, concat('H', cast(expnum as string), '.fits') as file2 from sky_catalog where filetype <> 'cat_firstcut' and band <> 'g'""")
sql("corner_compare", "sky_tile", """
select tilename, round(rac1 - (rac1 + 0.001), 6) as d_rac1, 0.0::double as d_rac2, 0.0::double as d_rac3, 0.0::double as d_rac4,
  0.0::double as d_decc1, 0.0::double as d_decc2, round(decc3 - (decc3 - 0.002), 6) as d_decc3, 0.0::double as d_decc4 from sky_tile""")
sql("mask_external", "sky_pixel", """
, m as (select y, x, case when count(*) filter (where value > 0) > count(*) / 2.0 then 1 else 0 end as v from sky_pixel group by y, x)
select p.file, p.hdu, p.y, p.x, p.value * m.v as value from sky_pixel p join m on m.y = p.y and m.x = p.x""")
sql("mask_rectangles", "sky_pixel", """
, k as (select n_nationkey % 5 as x1, n_nationkey // 5 as y1 from nation where n_nationkey % 5 <> n_nationkey // 5)
select file, hdu, y, x, case when exists (select 1 from k where p.x >= x1 and p.x < x1 + 2 and p.y >= y1 and p.y < y1 + 2) then value else 0 end as value
from sky_pixel p""")

# -- table maintenance -----------------------------------------------------------------------------

sql("upsert_tile", "sky_bounds sky_bounds_stored", f"""
select tilename, id, {r('dec_cent', 'dec_cent')} from sky_bounds_stored where not (kind = 5 or kind > 40)
union all select tilename, id + 1000000, {r('dec_cent', 'dec_cent')} from sky_bounds where kind = 5 or kind > 40""")
_new = {f"rac{k}": tan_ra(*_uv(*_pixels[k]), "crval1", "crval2") for k in (1, 2)} | {f"decc{k}": tan_dec(*_uv(*_pixels[k]), "crval2") for k in (1, 2)}
sql("update_corners", "sky_tile sky_header", f"""
, c as (select image_id, {', '.join(f'{x} as {n}' for n, x in _new.items())} from sky_header where crval2 > 0)
select t.tilename, {', '.join(f'round(coalesce(c.{n}, t.{n}), 6) as {n}' for n in _new)}, round(t.rac3, 6) as rac3
from sky_tile t left join c on c.image_id = t.tile_id""")
sql("lookup_tiles", "sky_tile sky_location", f"""
select tile_id, tilename, pixelscale, naxis1, naxis2, {', '.join(r(c, c) for c in ('ra_cent', 'dec_cent', 'racmin', 'racmax', 'deccmin', 'deccmax'))}, crossra0
from sky_tile where tilename in (select tilename from sky_location)""")
sql("constraint_violations", "sky_image", """
select * from (
 select 'not_null' as kind, 'filename' as name, cast(null as string) as "key", count(*) filter (where filename is null) as n from sky_image
 union all select 'not_null', 'compression', null, count(*) filter (where compression is null) from sky_image
 union all select 'not_null', 'band_checked', null, count(*) filter (where band = 'Y') from sky_image
 union all select 'check', 'crossra0', null, count(*) filter (where crossra0 not in ('Y', 'N')) from sky_image
 union all select 'check', 'north', null, count(*) filter (where not dec_cent > 0) from sky_image) c where n > 0
union all select 'unique', 'filename', filename, count(*) from sky_image group by filename having count(*) > 1
union all select 'unique', 'expnum+ccdnum', concat(cast(expnum as string), '|', cast(ccdnum as string)), count(*) from sky_image group by expnum, ccdnum having count(*) > 1""")

# -- text formats ------------------------------------------------------------------------------------

_LISTS = f"""
, lists as (select t.tilename, i.band as filter, i.filename as f, i.band as b, z.mag_zero as m from sky_image i join sky_zeropoint z on {ZP} join sky_tile t on {NEAR})"""
sql("list_files", "sky_image sky_tile sky_zeropoint", _LISTS + """
select tilename, filter, (row_number() over (partition by tilename, filter order by f, m))::int as place, concat(f, ' ', b, ' ', m) as line from lists
union all select distinct tilename, filter, 0, 'FILEPATH_LOCAL BAND MAG_ZERO' from lists""")
sql("list_rows", "sky_image sky_tile sky_zeropoint", _LISTS + """select f as "FILEPATH_LOCAL", b as "BAND", m as "MAG_ZERO", tilename, filter from lists""")
sql("sorted_list_lines", "sky_image sky_tile sky_zeropoint", _LISTS + """
select tilename, (row_number() over (partition by tilename order by f, concat(f, ' ', b, ' ', m)) - 1)::int as place, concat(f, ' ', b, ' ', m) as line from lists""")
sql("stored_table", "sky_image", """
, kept as (select filename, band, expnum, ccdnum from sky_image where band <> 'r' and ccdnum < 4 union all select filename, band, expnum, ccdnum from sky_image where band = 'r')
select *, false as was_there, false as replaced_unasked, true as is_there from (select * from kept union all select * from kept where band = 'g' and ccdnum = 1)""")
_stored = {
    "tilename": ("string", "Unique tile name", "tilename"), "crossra0": ("string", "Crosses RA=0 (Y/N)", "crossra0"), "naxis1": ("int", "Number of pixels along the first axis", "naxis1"),
    "pixelscale": ("decimal(10,5)", "Pixel scale (arcsec/pixel)", "pixelscale::decimal(10, 5)"),
    **{c: ("decimal(15,10)", text, f"{c}::decimal(15, 10)") for c, text in (
        ("ra_cent", "RA of the centre (deg)"), ("dec_cent", "Dec of the centre (deg)"), ("rac2", "RA of corner 2 (deg)"), ("racmin", "Smallest corner RA (deg)"))}}
sql("stored_columns", "sky_tile", " union all ".join(
    f"""select '{c}' as "column", '{kind}' as type, '{text}' as comment, count(*) as n, min({value}::varchar) as least, max({value}::varchar) as most from sky_tile""" for c, (kind, text, value) in _stored.items()))
_keys = "[CROSSRA0, DECC1, DECC2, DECC3, DECC4, DECCMAX, DECCMIN, DEC_CENT, DEC_SIZE, ID, NAXIS1, NAXIS2, PIXELSCALE, RAC1, RAC2, RAC3, RAC4, RACMAX, RACMIN, RA_CENT, RA_SIZE]"
sql("tile_json_lines", "sky_tile", f"""
select tilename, tile_id::int as id, ra_cent, decc3, racmin, naxis1, crossra0, tilename as name_inside, '{_keys}' as keys from sky_tile""")
sql("tile_json_records", "sky_tile", f"""
select case when tile_id % 3 < 2 then tilename end as tilename, case when tile_id % 3 < 2 then round(ra_cent, 6) end as ra_cent,
  case when tile_id % 3 < 2 then round(dec_cent, 6) end as dec_cent, case when tile_id % 3 = 0 then round(rac1, 6) end as rac1,
  case when tile_id % 3 < 2 then crossra0 end as crossra0, case when tile_id % 3 < 2 then 10000 end as naxis1, case when tile_id % 3 = 0 then tile_id::int end as id,
  case when tile_id % 3 = 0 or tile_id % 3 = 1 and tile_id % 7 <> 0 then 0.36::double end as pixelscale,
  case when tile_id % 3 = 2 then 40 when tile_id % 3 = 1 and tile_id % 7 = 0 then
    length(concat('{{"tileinfo": {{"RA": ', ra_cent, ', "DEC": ', dec_cent, ', "CROSSRAZERO": "', crossra0, '", "NAXIS1": 10000.0, "PIXELSCALE": "fine"}}, "tilename": "', tilename, '"}}')) end::int as misfit_length
from sky_tile""")
_dump = "ra_cent dec_cent pixelscale naxis1 naxis2 uramin udecmin uramin udecmax uramax udecmax uramax udecmin uramin uramax udecmin udecmax".split()
_as = {"pixelscale": "format('{:8.4f}', 0.27)", "naxis1": "format('{:6d}', 10000)", "naxis2": "format('{:6d}', 10000)"}
sql("tile_dump_lines", "sky_bounds", f"""
select dec_row, ra_step, concat_ws(' ', lpad(tilename, 12, ' '), {', '.join(_as.get(n, "format('{:10.6f}', " + n + ")") for n in _dump)}) as line from sky_bounds""")
sql("tile_dump_records", "sky_bounds", """
select tilename, round(ra_cent, 6) as ra_cent, round(uramin, 6) as rall, round(udecmax, 6) as udecu, 10000 as naxis2, false as is_misfit from sky_bounds
union all select tilename, case when ra_step % 3 <> 1 then round(ra_cent, 6) end, round(uramin, 6), round(udecmax, 6), 10000, ra_step % 3 = 1 from sky_bounds""")
sql("assoc_json_document", "sky_image", """
, v as (select 0 as part, concat('"', filename, '"') as v from sky_image union all select 1, concat('"', band, '"') from sky_image
  union all select 2, case when ccdnum <> 2 then cast(ccdnum as string) else 'null' end from sky_image),
first as (select min(filename) as filename from sky_image), top as (
  select filename, band, case when ccdnum <> 2 then cast(ccdnum as string) else 'null' end as m from sky_image where filename = (select filename from first)),
body as (
 select part, 2 as place, concat('    , ', v) as line, count(*) as n from v group by part, v
 union all select 0, 2, concat('    , "', filename, '"'), -1 from top union all select 1, 2, concat('    , "', band, '"'), -1 from top union all select 2, 2, concat('    , ', m), -1 from top)
select part, place, line, sum(n)::bigint as n from body group by part, place, line having sum(n) > 0
union all select 0, 1, concat('      "', filename, '"'), 1 from top union all select 1, 1, concat('      "', band, '"'), 1 from top union all select 2, 1, concat('      ', m), 1 from top
union all select * from (values (-1, 0, '{"assoc": {', 1), (0, 0, '  "FILEPATH_LOCAL": [', 1), (1, 0, '  "BAND": [', 1), (2, 0, '  "MAG_ZERO": [', 1),
  (0, 3, '  ],', 1), (1, 3, '  ],', 1), (2, 3, '  ]', 1), (3, 0, '}}', 1))""")
ORACLE["config_lines"] = """
select replace(p_brand, '#', '') as "key", concat('V', arg_max(p_partkey, p_partkey)) as value
from part where p_size % 7 not in (0, 1) group by all"""
sql("name_lines", "sky_tile", """
select tilename from sky_tile where tile_id % 3 <> 2 union all select concat('X', tile_id) from sky_tile where tile_id % 3 = 1""")
ORACLE["section_lines"] = """
select concat('D', p_partkey, '.fits') as filename, p_size::int as x1, (p_size + 2047)::int as x2, 1 as y1, 4096 as y2, (p_partkey % 62 + 1)::int as ccdnum,
  12.5::double as crpix1, -7.0::double as crpix2, p_size + 0.25::double as crval1, 30.0::double as crval2 from part where p_size <> 1"""
sql("list_lines", "sky_image", """select filename as "FILENAME", band as "BAND", expnum as "EXPNUM" from sky_image""")
