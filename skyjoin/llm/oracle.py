"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import string

from skyjoin.llm import hard_negatives, importance, licences, mixing, quality

WORD = r"[^\x20\x09-\x0D]+"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Links of all pairs that share a shingle, then the smallest doc_id reachable.
NEAR_DUPLICATES = f"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') as w from documents
), grams as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as g from texts
), sizes as (select doc_id, count(*) as n from grams group by 1),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common from grams a join grams b using (g) where a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common >= 80 * (x.n + y.n - common)
), both_ways as (select a, b from links union select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from documents union select r.doc_id, l.b from reach r join both_ways l on l.a = r.other
)
select doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other) as component_id, min(other) = doc_id as kept
from reach left join sizes using (doc_id) group by doc_id
"""

#: Every word window by its words; the words left, in order.
SUBSTRINGS = f"""
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 11)) as i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) as g from texts where len(w) >= 13
), firsts as (select g, min(doc_id) as low from windows group by g),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as i from windows join firsts using (g) where low < doc_id),
words as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from texts),
left_over as (
  select w.doc_id, count(*) as n, string_agg(w.word, ' ' order by w.i) as kept from words w anti join gone g on g.doc_id = w.doc_id and g.i = w.i group by 1
)
select t.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts t left join left_over l using (doc_id)
"""

MIX = f"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size, md5('{mixing.SEED}:' || coalesce(doc_id::varchar, '')) as drawn from documents
), sources as (
  select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from sized group by source
), totals as (select sum(source_size)::bigint as total from sources),
levels as (
  select *, row_number() over (order by source_size / weight, source nulls last) as room,
    (total - coalesce(sum({mixing.MOST} * source_size) over (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
    / sum(weight) over (order by source_size / weight, source nulls last rows between current row and unbounded following)::double as level
  from sources, totals
), cut as (select min(room) as room, arg_min(level, room) as level from levels where level * weight <= {mixing.MOST} * source_size),
targets as (
  select source, source_size, total, greatest(ceil(total / {mixing.BLOCKS}), 1)::bigint as block_size,
    case when l.room >= c.room then c.level * weight else {mixing.MOST}.0 * source_size end as target
  from levels l, cut c
), bids as (
  select source, target, ceil(total / block_size)::bigint as all_blocks, unnest(range(0, ceil(target / block_size)::bigint + 2)) as held from targets where target > 0
), seats as (
  select source, all_blocks, row_number() over (order by target / (2 * held + 1) desc, source nulls last, held) as seat from bids
), quotas as (select source, count(*) as quota from seats where seat <= all_blocks group by source),
gives as (
  select t.source, source_size, block_size, target, least(coalesce(quota, 0) * block_size, {mixing.MOST} * source_size) as gives
  from targets t left join quotas q on t.source is not distinct from q.source
), plans as (
  select *, case when source_size > 0 then gives // source_size else 0 end as passes, case when source_size > 0 then gives % source_size else 0 end as rest from gives
), numbers as (
  select source, source_size, block_size, rest, unnest(range(0, (source_size - 1) // block_size + 1)) as block from plans where source_size > 0
), met as (
  select *, least(block_size, source_size - block * block_size) as words,
    sum(least(block_size, source_size - block * block_size)) over (
      partition by source order by md5('{mixing.SEED}:' || coalesce(source, '') || ':' || block), block rows unbounded preceding) as upto from numbers
), chosen as (select source, block * block_size as low, block * block_size + words as high from met where upto - words / 2 <= rest),
placed as (
  select doc_id, source, size, sum(size) over (partition by source order by drawn, doc_id, size rows unbounded preceding) as stop from sized
), extra as (
  select doc_id, p.source, size, stop, sum(greatest(0, least(stop, high) - greatest(stop - size, low))) as words
  from placed p join chosen c on p.source is not distinct from c.source and low < stop and high > stop - size group by all
)
select p.doc_id, p.size, l.source_size, l.target, (l.passes * p.size + coalesce(e.words, 0))::bigint as taken
from placed p join plans l on p.source is not distinct from l.source
left join extra e on e.doc_id is not distinct from p.doc_id and e.source is not distinct from p.source and e.stop = p.stop and e.size = p.size
"""

#: Repeats of a text are runs along diagonals: starts i < j of equal windows with the same j - i.
QUALITY = f"""
with texts as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 3)) as i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as g from texts where len(w) >= 5
), again as (select doc_id, g, i, lag(i) over (partition by doc_id, g order by i) as before, count(*) over (partition by doc_id, g) as n from windows),
covered as (select doc_id, count(*) as n, sum(len(word)) as chars from (select distinct a.doc_id, unnest(range(i, i + 5)) as i from again a where n > 1) c
  join (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from texts) using (doc_id, i) group by 1),
pairs as (select a.doc_id, a.i, b.i - a.i as gap from windows a join windows b on a.doc_id = b.doc_id and a.g = b.g and a.i < b.i),
runs as (select doc_id, gap, i - row_number() over (partition by doc_id, gap order by i) as run from pairs),
longest as (select doc_id, max(n) + 4 as words from (select doc_id, gap, run, count(*) as n from runs group by all) group by 1),
lines as (
  select doc_id, count(*) - count(distinct line) as n from (select doc_id, unnest(string_split(text, chr(10))) as line from texts) where regexp_matches(line, '{WORD}') group by 1
), counts as (
  select t.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(l.n, 0)::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
    coalesce(c.chars, 0)::bigint as repeat_chars, coalesce(g.words, 0)::bigint as longest_repeat
  from texts t left join lines l using (doc_id) left join covered c using (doc_id) left join longest g using (doc_id)
)
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and repeat_chars / greatest(word_chars, 1) <= {quality.MOST_COVERED} and longest_repeat <= {quality.MOST_WORDS} as kept
from counts
"""

#: CRC-32 bit by bit over the bytes of each distinct word; gains by bucket; weights as plain sums.
IMPORTANCE = f"""
with texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{LETTERS}') as w from documents
), counted as (select doc_id, word, count(*) as n from (select doc_id, unnest(w) as word from texts) group by 1, 2),
target as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{LETTERS}')) as word from benchmark
), spelt as (
  select word, hex(encode(word)) as code from (select word from counted union select word from target)
), sums as (
  select word, xor(4294967295::bigint, list_reduce(
    [4294967295::bigint] || flatten(list_transform(range(0, length(code) // 2), lambda i: [('0x' || substr(code, (2 * i + 1)::integer, 2))::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: case when x >= 0 then xor(c, x) when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end)) % {importance.BUCKETS} as bucket from spelt
), s as (select bucket, sum(n)::double as n from counted join sums using (word) group by 1),
t as (select bucket, count(*)::double as n from target join sums using (word) group by 1),
gains as (
  select bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * (coalesce((select sum(n) from s), 0) + {importance.BUCKETS})
    / ((coalesce(s.n, 0) + 1) * (coalesce((select sum(n) from t), 0) + {importance.BUCKETS}))))::bigint as gain from s full join t using (bucket)
), weights as (select doc_id, sum(n * gain)::bigint as weight from counted join sums using (word) join gains using (bucket) group by 1),
scored as (
  select doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight, coalesce(weight, 0)::bigint
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('{importance.SEED}:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from texts left join weights using (doc_id)
), ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as place from scored where n_features >= 20
)
select doc_id, n_features, weight, score, case when place <= 10 * (select count(*) from ranked) // 100 then place end as rank
from scored left join ranked using (doc_id)
"""

#: Every anchor against every row.
HARD_NEGATIVES = f"""
with valid as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::double)) as v
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score from valid a join valid b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from pairs where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
), ranked as (
  select anchor_id, positive_id, positive_score, n.vec_id as negative_id, n.score as negative_score,
    row_number() over (partition by anchor_id, positive_id order by n.score desc, n.vec_id) as rank
  from positives join pairs n using (anchor_id) where not n.same and 50 * positive_score <= 100 * n.score and 100 * n.score <= 95 * positive_score
)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from ranked where rank <= 3
"""

_common = ", ".join(f"'{t}'" for t in licences.COMMON)
_terms = f"list_filter(regexp_extract_all(lower({{}}), '{licences.TERM}'), lambda t: t not in ({_common}))"
_templates = ", ".join("({}, '{}', '{}')".format(k, i, text.replace("'", "''")) for k, (i, text) in enumerate(licences.TEMPLATES))
_names = ", ".join(f"'{n}'" for n in licences.FILE_NAMES)

#: Every term of every unit of the files, joined with the templates; the licence file in the longest folder above.
LICENCES = f"""
with templates(template, id, text) as (values {_templates}),
wanted as (select template, id, term, count(*) as tf from (select template, id, unnest({_terms.format('text')}) as term from templates) group by all),
named as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text, length(coalesce(text, '')) <= 250 as brief, concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none')) as top from documents
), files as (
  select r, doc_id, text, case when brief and doc_id % 2 = 0 then top || '/LICENSE' when brief then top || '/' || (doc_id // 500) || '/LICENSE'
    else top || '/' || (doc_id // 500) || '/' || doc_id || '.txt' end as path from named
), rows as (select *, parse_filename(path) in ({_names}) as whole, regexp_replace(path, '/?[^/]*$', '') as folder from files),
found as (
  select r, unnest({_terms.format('text')}) as term from rows
), df as (select term, count(distinct r) as df from found where term in (select term from wanted) group by term),
idf as (select distinct term, ln((1 + (select count(*) from rows)) / (1 + coalesce(df, 0))::double) + 1 as idf from wanted left join df using (term)),
weights as (select template, id, term, tf * idf / sqrt(sum((tf * idf) ** 2) over (partition by template)) as w from wanted join idf using (term)),
units as (
  select r, unnest(string_split(text, chr(10)) || list_filter(regexp_split_to_array(text, '{licences.PARAGRAPH}'), lambda b: contains(b, chr(10))) || case when whole then [text] else [] end) as unit from rows
), numbered as (select r, row_number() over () as u, {_terms.format('unit')} as terms from units),
counted as (select r, u, term, count(*) as tf from (select r, u, unnest(terms) as term from numbered) group by all),
valued as (select r, u, term, tf * coalesce(idf, ln(1 + (select count(*) from rows)) + 1) as v from counted left join idf using (term)),
norms as (select u, sqrt(sum(v * v)) as norm from valued group by u),
cosines as (
  select r, id, round(sum(v * w) / any_value(norm), 9) as cosine, count(*) as shared from valued join weights using (term) join norms using (u) group by r, u, template, id
), best as (
  select r, id as own_licence, cosine as score from cosines where cosine >= {licences.LEAST_COSINE} and shared >= {licences.LEAST_TERMS}
  qualify row_number() over (partition by r order by cosine desc, id) = 1
), held as (
  select folder, min(path) as held_path, arg_min(own_licence, path) as held_licence from rows join best using (r) where whole group by folder
), nearest as (
  select r, held_path, held_licence from rows a join held h on h.folder = a.folder or h.folder = '' or starts_with(a.folder, h.folder || '/')
  qualify row_number() over (partition by r order by length(h.folder) desc) = 1
)
select doc_id, path, own_licence, score, coalesce(own_licence, held_licence) as licence, case when own_licence is not null then path else held_path end as licence_path
from rows left join best using (r) left join nearest using (r)
"""

ORACLE: dict[str, str] = {
    "op9_licence_scan": LICENCES,
    "op11_importance_resampling": IMPORTANCE,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op1_near_duplicates": NEAR_DUPLICATES,
    "op4_substring_dedup": SUBSTRINGS,
    "op6_source_mix": MIX,
    "op8_quality_rules": QUALITY,
}
