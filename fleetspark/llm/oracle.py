"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Words by pattern, shares by where resharing ends, and a running sum over all hashes in place of histograms.
ORACLE["op4_mix_sources"] = r"""
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    ('0x' || left(md5(coalesce(doc_id::varchar, 'null') || ':42'), 15))::bigint as h
  from documents
),
sources as (
  select source, sum(size)::bigint as source_size,
    ([3, 1, 2])[1 + (row_number() over (order by source is null, encode(source)) - 1) % 3] as w
  from docs group by source
),
ranked as (
  select *, 2.0 * source_size as most, row_number() over (order by 2.0 * source_size / w, source is null, encode(source)) as place from sources
),
levels as (
  select r.source, (select 1.5 * sum(source_size) from sources) - coalesce(sum(b.most), 0) as words,
    (select sum(w) from sources) - coalesce(sum(b.w), 0) as weight, any_value(r.w) as w, any_value(r.most) as most, any_value(r.place) as place
  from ranked r left join ranked b on b.place < r.place group by r.source
),
factor as (select arg_min(words / weight, place) as f from levels where words / weight * w <= most),
targets as (
  select source, source_size, coalesce(least(most, f * w), most)::double as target from ranked, factor
),
budgets as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as rounds from targets
),
steps as (
  select source, h, sum(size) as s, sum(sum(size)) over (partition by source order by h) - sum(size) as before
  from docs group by source, h
)
select d.doc_id, d.size::bigint as size, b.source_size, b.target,
  (d.size * (b.rounds + case when t.before + t.s <= b.target - b.rounds * b.source_size then 1
    when t.before <= b.target - b.rounds * b.source_size and 2 * (b.target - b.rounds * b.source_size - t.before) >= t.s then 1 else 0 end))::bigint as taken
from docs d join budgets b on d.source is not distinct from b.source
join steps t on t.source is not distinct from d.source and t.h = d.h
"""


def _rounds(rounds: int, ahead: int) -> str:
    """CTEs of k-means rounds over pts(rid, grp, pos, x) from c0(grp, c, pos, x): near_r(rid, grp, c, d) and c_r."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} as materialized (
  select rid, grp, m % {ahead} as c, m // {ahead} as d from (
    select rid, grp, min(d * {ahead} + c) as m from (
      select p.rid, p.grp, e.c, sum((p.x - e.x) * (p.x - e.x))::bigint as d
      from pts p join c{r} e on e.grp = p.grp and e.pos = p.pos group by p.rid, p.grp, e.c
    ) group by rid, grp
  )
)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} as materialized (
  select e.grp, e.c, e.pos, coalesce(m.x, e.x) as x from c{r} e left join (
    select n.grp, n.c, p.pos, floor(sum(p.x)::double / count(*))::bigint as x
    from near{r} n join pts p on p.rid = n.rid and p.grp = n.grp group by n.grp, n.c, p.pos
  ) m on m.grp = e.grp and m.c = e.c and m.pos = e.pos
)""")
    return ",".join(steps)


_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)"

# All pairs of vectors and centroids, no filter; a distance and its centroid's number in one whole number settle ties.
ORACLE["op11_centroid_clusters"] = f"""
with kept as materialized (
  select row_number() over (order by vec_id) as rid, * from embeddings where len(embedding) = 64 and {_FINITE}
),
pts as materialized (
  select rid, 0 as grp, pos, floor(1024 * embedding[pos]::double)::bigint as x from kept, unnest(range(1, 65)) t(pos)
),
first as (select rid, row_number() over (order by sha256('3:' || vec_id)) - 1 as c from kept qualify c < 8),
c0 as materialized (select 0 as grp, c, pos, x from first join pts using (rid)),
{_rounds(10, 64)},
centres as (select c, sha256(string_agg(x::varchar, ',' order by pos)) as centroid_sha256 from c10 group by c)
select k.vec_id, n.c::int as cluster, n.d::bigint as distance, sum(n.d) over (partition by n.c)::bigint as cluster_inertia,
  sum(n.d) over ()::bigint as inertia, centroid_sha256
from near10 n join kept k using (rid) join centres using (c)
"""

ORACLE["op13_vector_codes"] = f"""
with kept as materialized (select row_number() over (order by vec_id) as rid, * from embeddings where {_FINITE}),
pts as materialized (
  select rid, (pos - 1) // (len(embedding) // 16) as grp, (pos - 1) % (len(embedding) // 16) as pos, floor(256 * embedding[pos]::double)::bigint as x
  from (select rid, embedding, unnest(range(1, len(embedding) + 1)) as pos from kept)
),
c0 as materialized (select grp, rid - 1 as c, pos, x from pts where rid <= 64),
{_rounds(2, 64)},
books as (select sha256(string_agg(x::varchar, ',' order by grp, c, pos)) as codebooks_sha256 from c2),
codes as (select rid, string_agg(format('{{:02x}}', c::int), '' order by grp) as code, sum(d)::bigint as error from near2 group by rid)
select k.vec_id, code, error, sum(error) over (partition by k.label)::bigint as label_error, codebooks_sha256
from codes join kept k using (rid), books
"""

# Every window of every document against every window of every item, as lists of words; near items from the places of a window's rarest word.
ORACLE["op12_phrase_decontamination"] = r"""
with d as materialized (
  select row_number() over () as rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
),
b as materialized (
  select distinct item_id::varchar as item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
),
win as materialized (
  select distinct item_id, w[s:s + least(10, len(w)) - 1] as words from b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(s) where len(w) > 0
),
hits as materialized (
  select rid, s, len(words) as size, item_id from (
    select rid, s, w[s:s + size - 1] as words from d, (select distinct len(words) as size from win) z, unnest(range(1, len(w) - size + 2)) t(s)
  ) join win using (words)
),
covered as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(s, s + size)) as p from hits) group by rid),
found as (select rid, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as items from hits group by rid),
places as materialized (select rid, w[p] as word, p from d, unnest(range(1, len(w) + 1)) t(p)),
uses as (select word, count(*) as n from places group by word),
rarest as (
  select item_id, words, arg_min(word, coalesce(n, 0)) as word from (select item_id, words, unnest(words) as word from win) left join uses using (word) group by item_id, words
),
anchors as materialized (
  select distinct rid, p, item_id, words from rarest join places using (word) join d using (rid) where list_has_all(w[greatest(1, p - 19):p + 19], words)
),
near as (
  select rid, count(distinct item_id) as n_near_items from (
    select rid, item_id, words, unnest(range(greatest(1, p - 19), p + 1)) as s from anchors
  ) join d using (rid) where list_has_all(w[s:s + 19], words) group by rid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near_items, 0)::bigint as n_near_items
from d left join covered using (rid) left join found using (rid) left join near using (rid)
"""
