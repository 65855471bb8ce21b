"""Queries of release identity, audits and species."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.operators import cluster, release, species, tree
from cladeforge.plans.registry import Tables, query
from cladeforge.plans.shapes import LINES, NODES, SCORES, WITH_CLOSED
from cladeforge.sources.scratch import kept, written

#: Two releases of domains: orders before and after days that overlap; some texts, ids and classes change.
OLD = f"select o * 10 + n as id, o * 10 + n as sunid, 'd' || lpad(cast(o as string), 4, '0') || 'a' || cast(n as string) as sid, 'e' || cast(o as string) || ' A:' || case when part % 13 = 0 then '' else cast(n * 60 as string) || '-' || cast(n * 60 + cast(qty as bigint) as string) end as description, 'a.' || cast(supp % 7 as string) || '.1' as sccs, 8 as level_id, 1 + supp % 2 as curation_type_id from ({LINES}) x join {{orders}} on o = o_orderkey where o_orderdate < timestamp '1999-06-01'"
NEW = f"select 1000000000 + o * 10 + n as id, o * 10 + n as sunid, 'd' || lpad(cast(o as string), 4, '0') || 'a' || case when part % 17 = 0 then '_' else cast(n as string) end as sid, 'e' || cast(o as string) || ' A:' || case when part % 19 = 0 then '' else cast(n * 60 + case when part % 3 = 0 then part % 90 else 0 end as string) || '-' || cast(n * 60 + cast(qty as bigint) + case when part % 5 = 0 then 40 else 0 end as string) end as description, 'a.' || cast(case when part % 29 = 0 then 9 else supp % 7 end as string) || '.1' as sccs, 8 as level_id, 1 + supp % 2 as curation_type_id from ({LINES}) x join {{orders}} on o = o_orderkey where o_orderdate >= timestamp '1996-01-01'"
LENGTHS = "select 'e' || cast(o_orderkey as string) as code, 'A' as chain, 500 as length from {orders} where o_orderkey % 9 > 0"

MATCHES = f"""o as ({OLD}), w as ({NEW}), l as ({LENGTHS}), ex as (select o.id as old_id, w.id as new_id from o join w using (description)),
 p as (select o.id as old_id, w.id as new_id, length as known, ends_with(o.description, ':') as ow, ends_with(w.description, ':') as ww, try_cast(split_part(split_part(o.description, ':', 2), '-', 1) as integer) as s0, try_cast(split_part(split_part(o.description, ':', 2), '-', 2) as integer) as e0, try_cast(split_part(split_part(w.description, ':', 2), '-', 1) as integer) as s1, try_cast(split_part(split_part(w.description, ':', 2), '-', 2) as integer) as e1
   from o join w on split_part(o.description, ' ', 1) = split_part(w.description, ' ', 1) left join l on code = split_part(o.description, ' ', 1) where o.id not in (select old_id from ex) and w.id not in (select new_id from ex)),
 q as (select *, case when ow or ww then known is not null else (abs(s0 - s1) < 50 and abs(e0 - e1) < 50) or (s0 = s1 and abs(e0 - e1) < 75) or (e0 = e1 and abs(s0 - s1) < 75) end as near, coalesce(case when ow and ww then 1 when ow then case when known is not null then e1 - s1 + 1 end when ww then case when known is not null then e0 - s0 + 1 end else greatest(least(e0, e1) - greatest(s0, s1) + 1, 0) end, 0) as ov from p),
 m as (select old_id, new_id, 'exact' as kind, cast(0 as bigint) as overlap from ex union all select old_id, new_id, case when near then 'perfect' else 'overlap' end, ov from q where near or ov > 0)"""


@query("r1_match_domains", f"with {MATCHES} select * from m")
def r1(t: Tables) -> DataFrame:
    return release.match_domains(t.sql(OLD), t.sql(NEW), t.sql(LENGTHS))


CHANGES = (
    MATCHES
    + """, r as (select * from m where kind <> 'exact'), c as (select *, count(*) over (partition by old_id) as nn, count(*) over (partition by new_id) as no_ from r), d as (select *, max(no_) over (partition by old_id) as mo, max(nn) over (partition by new_id) as mn from c),
 t as (select d.*, case when nn > 1 and mo = 1 then 5 when no_ > 1 and mn = 1 then 4 end as type, ends_with(o.description, ':') as ow, ends_with(w.description, ':') as ww from d join o on o.id = old_id join w on w.id = new_id),
 k as (select *, case when type is null and kind = 'perfect' then row_number() over (partition by old_id, type is null and kind = 'perfect' order by -overlap, old_id, new_id) end as r0, case when type is null and kind = 'perfect' then row_number() over (partition by new_id, type is null and kind = 'perfect' order by -overlap, old_id, new_id) end as r1 from t)"""
)


@query(
    "r2_classify_changes",
    f"with {CHANGES} select old_id, new_id, coalesce(type, case when r0 = 1 and r1 = 1 and not ow and ww then 10 else 7 end) as change_type from k union all select id, null, case when description like 's%' then 1 when description like '0%' then 3 else 2 end from o where id not in (select old_id from m)",
)
def r2(t: Tables) -> DataFrame:
    old, new = t.sql(OLD), t.sql(NEW)
    return release.classify_changes(release.match_domains(old, new, t.sql(LENGTHS)), old, new)[1]


@query("r2_kept_sids", f"with {CHANGES}, z as (select new_id, old_id from m where kind = 'exact' union all select new_id, old_id from k where r0 = 1 and r1 = 1 and ow = ww), g as (select new_id, min(old_id) as old_id from z group by 1) select w.id as new_id, old_id from w left join g on g.new_id = w.id")
def r2k(t: Tables) -> DataFrame:
    old, new = t.sql(OLD), t.sql(NEW)
    return release.classify_changes(release.match_domains(old, new, t.sql(LENGTHS)), old, new)[0]


FRESH = f"select o * 10 + n as id, cast(o % 500 as string) as code, 'A' as chain, part % 11 = 0 as is_whole, part % 7 = 0 as is_multi from ({LINES}) x where o % 4 <= 1"
USED = f"select 'd' || cast(o % 500 as string) || 'a' || substr('{release.SUFFIXES}', cast(1 + part % 35 as int), 1) as sid from ({LINES}) x where o % 4 > 1 union all select 'd' || cast(o % 500 as string) || 'a_' from ({LINES}) x where o % 23 = 0"


@query(
    "r3_allocate_sids",
    f"""with f as (select id, 'd' || lower(code) || case when is_multi then '.' else lower(chain) end as stem, is_whole and not is_multi as whole from ({FRESH})), u as (select distinct sid from ({USED})),
 h as (select min(id) as id, stem || '_' as sid from f where whole group by stem having stem || '_' not in (select sid from u)), x as (select * from f where id not in (select id from h)),
 s as (select stem, i, stem || substr('{release.SUFFIXES}', i, 1) as sid from (select distinct stem from x), (select unnest(range(1, 36)) as i)), e as (select *, row_number() over (partition by stem order by i) as r from s where sid not in (select sid from u)),
 k as (select *, row_number() over (partition by stem order by id) as r from x) select id, sid from h union all select k.id, e.sid from k left join e using (stem, r)""",
)
def r3(t: Tables) -> DataFrame:
    return release.allocate_sids(t.sql(FRESH), t.sql(USED))


CARRIED = f"select 'd' || lpad(cast(o as string), 4, '0') || 'a' || cast(n as string) as old_sid, 'd' || lpad(cast(o as string), 4, '0') || 'a_' as new_sid from ({LINES}) x where part % 17 = 0 and part % 2 = 0"


@query(
    "r4_stable_domain_ids",
    f"""with o as (select sid, min(sunid) as sunid from ({OLD}) group by 1), w as (select id, sid from ({NEW})), a as (select id, sunid from w join o using (sid)), b as (select w.id, min(o.sunid) as sunid from w join ({CARRIED}) c on c.new_sid = w.sid join o on o.sid = c.old_sid where w.id not in (select id from a) group by 1), k as (select * from a union all select * from b),
 f as (select id, sid, case when substr(sid, 2, 4) in (select substr(sid, 2, 4) from o) then 0 else 1 end as unseen from w where id not in (select id from k))
 select * from k union all select id, (select max(sunid) from o) + row_number() over (order by unseen, sid, id) from f""",
)
def r4(t: Tables) -> DataFrame:
    old = t.sql(OLD).groupBy("sid").agg(F.min("sunid").alias("sunid"))
    new = t.sql(NEW).select("id", "sid")
    return release.stable_domain_ids(old, new, t.sql(CARRIED))


CLADES0 = f"select id, sunid, description, level_id, parent_node_id from ({NODES}) x where level_id <= 5 and id % 13 <> 5"
CLADES1 = f"select id, case when id % 19 = 4 then 10 * id else 0 end as sunid, case when id % 7 = 3 then description || ' II' else description end as description, level_id, parent_node_id from ({NODES}) x where level_id <= 5 and id % 17 <> 3"
REMADE = f"select id as new_node_id, cast(4 + id % 4 as int) as change_type from ({NODES}) x where level_id between 2 and 5 and id % 23 = 6"


def _clades() -> str:
    out = f"with o as ({CLADES0}), w as ({CLADES1}), h as (select new_node_id from ({REMADE}) where change_type in (5, 6)), e as (select o.level_id, p.sunid as ps, o.description, arg_max(o.sunid, o.id) as same from o join o p on p.id = o.parent_node_id group by 1, 2, 3), t1 as (select cast(greatest((select max(sunid) from o), (select max(sunid) from w)) as bigint) as top), a1 as (select id, cast(0 as bigint) as sunid from w where level_id = 1)"
    for level in (2, 3, 4, 5):
        b = f"a{level - 1}"
        out += f""", m{level} as (select w.id, w.id in (select new_node_id from h) as remade, case when w.id in (select new_node_id from h) then null when w.id = max(w.id) over (partition by {b}.sunid, w.description) and same is not null then same when w.sunid > 0 then w.sunid end as sunid from w join {b} on {b}.id = w.parent_node_id left join e on e.level_id = w.level_id and e.ps = {b}.sunid and e.description = w.description where w.level_id = {level}),
 a{level} as (select id, sunid from m{level} where sunid is not null union all select id, (select top from t{level - 1}) + row_number() over (order by case when remade then 0 else 1 end, id) from m{level} where sunid is null), t{level} as (select greatest((select top from t{level - 1}), coalesce(max(sunid), 0)) as top from a{level})"""
    return out + " select * from a1 union all select * from a2 union all select * from a3 union all select * from a4 union all select * from a5"


@query("r5_stable_clade_ids", _clades())
def r5(t: Tables) -> DataFrame:
    return release.stable_clade_ids(t.sql(CLADES0), t.sql(CLADES1), t.sql(REMADE), (2, 3, 4, 5))


SCCS0 = f"select 10 * id as id, sunid, case when level_id in (5, 8) and id % 11 = 2 then 'a.0.0.' || cast(id as string) else sccs end as sccs from ({NODES}) x where level_id > 1 and id % 6 <> 5"
SCCS1 = f"select id, case when id % 6 = 1 then id * 10 else sunid end as sunid, level_id, parent_node_id, description from ({NODES}) x where level_id > 1"
EVERY = f"select sccs from ({NODES}) x where level_id > 1"
MOVED = f"select id as new_node_id, 6 as change_type from ({NODES}) x where id % 5 = 1"


def _sccs() -> str:
    out = f"with o as ({SCCS0}), w as ({SCCS1}), k as (select sunid, arg_min(sccs, id) as kept, min(id) as old from o group by 1), g as (select regexp_replace(sccs, '\\.[0-9]+$', '') as ps, max(cast(list_last(string_split(sccs, '.')) as integer)) as big from ({EVERY}) where contains(sccs, '.') group by 1), a2 as (select w.id, coalesce(kept, case when description = 'Artifacts' then 'l' end) as sccs from w left join k using (sunid) where level_id = 2)"
    for level, up in ((3, 2), (4, 3), (5, 4)):
        out += f""", m{level} as (select w.id, p.sccs as ps, old, kept, regexp_replace(kept, '[.][^.]*$', '') as stem, case when kept is not null then kept when description = 'automated matches' then p.sccs || '.0' end as sccs from w join a{up} p on p.id = w.parent_node_id left join k using (sunid) where level_id = {level}),
 a{level} as (select id, sccs from m{level} where sccs is not null union all select id, ps || '.' || (coalesce(big, 0) + row_number() over (partition by ps order by id)) from m{level} left join g using (ps) where sccs is null)"""
    return out + ", m8 as (select w.id, p.sccs as ps, old, kept as stem from w join a5 p on p.id = w.parent_node_id left join k using (sunid) where level_id = 8), a8 as (select id, ps as sccs from m8)"


@query("r6_stable_sccs", _sccs() + " select * from a2 union all select * from a3 union all select * from a4 union all select * from a5 union all select * from a8")
def r6(t: Tables) -> DataFrame:
    return release.stable_sccs(t.sql(SCCS0), t.sql(SCCS1), t.sql(EVERY), t.sql(MOVED), (3, 4, 5, 8))[0]


@query("r6_move_history", _sccs() + ", mm as (select id, ps, old, stem from m3 union all select id, ps, old, stem from m4 union all select id, ps, old, stem from m5 union all select * from m8)" + f" select old as old_node_id, id as new_node_id, 6 as change_type from mm where stem <> ps and id not in (select new_node_id from ({MOVED}))")
def r6h(t: Tables) -> DataFrame:
    return release.stable_sccs(t.sql(SCCS0), t.sql(SCCS1), t.sql(EVERY), t.sql(MOVED), (3, 4, 5, 8))[1]


BOTH = f"select id, sunid, sccs, 1 as release_id from ({OLD}) x union all select id, sunid, sccs, 2 from ({NEW}) y"


@query("r7_next_release_node", f"with b as ({BOTH}) select x.id, y.id as next_id, x.sccs = y.sccs as sccs_stable from b x join b y on x.sunid = y.sunid and y.release_id = x.release_id + 1")
def r7(t: Tables) -> DataFrame:
    return release.next_release_node(t.sql(BOTH))


CHECKED0 = f"select id, sunid, sid, sccs, description, level_id, parent_node_id from ({NODES}) x where id % 19 <> 2"
CHECKED1 = f"select id, case when level_id = 5 and id % 37 = 3 then 3000000000 + id + 10 * (select max(o_orderkey) from {{orders}}) else sunid end as sunid, case when id % 23 = 4 then 'dother' else sid end as sid, case when id % 29 = 5 then 'a.1' when id % 59 = 6 then 'x' else sccs end as sccs, description, level_id, parent_node_id from ({NODES}) x where id % 31 <> 7 or level_id < 5"
TOLD = f"select id as old_node_id, case when id % 3 > 0 then id end as new_node_id, cast(1 + id % 13 as int) as change_type from ({NODES}) x where id % 5 in (1, 3) and id > 5000000000"


@query(
    "r8_check_ids",
    f"""with o as ({CHECKED0}), w as ({CHECKED1}), h as ({TOLD}),
 b as (select w.sunid, w.sid, w.level_id, o.sid as s0, (o.id, w.id) in (select (old_node_id, new_node_id) from h where change_type between 4 and 11) as excused, (o.id, w.id) in (select (old_node_id, new_node_id) from h where change_type in (5, 7, 8)) as retires from w join o using (sunid)),
 u as (select w.*, p.sccs as above from w join w p on p.id = w.parent_node_id where w.level_id > 2),
 n as (select p.sunid as up, w.description, arg_max(w.sunid, w.id) as ns from w join w p on p.id = w.parent_node_id group by 1, 2)
 select 'sid-changed' as issue, cast(sunid as string) as key from b where level_id = 8 and s0 is not null and not coalesce(excused, false) and s0 is distinct from sid
 union all select 'should-be-retired', cast(sunid as string) from b where retires
 union all select 'lost', cast(sunid as string) from o where sunid not in (select sunid from w) and id not in (select old_node_id from h where change_type in (1, 2, 3, 4, 5, 6, 7, 8, 9, 13))
 union all select 'bogus-merge', cast(o.sunid as string) from o join o p on p.id = o.parent_node_id join n on n.up = p.sunid and n.description = o.description where ns <> o.sunid and o.id in (select old_node_id from h where change_type = 4)
 union all select 'skipped', cast(s as string) from (select unnest(generate_series((select max(sunid) + 1 from o), (select max(sunid) from w))) as s) where s not in (select sunid from w)
 union all select 'sid-twice', sid from w where sid is not null group by sid having count(*) > 1 union all select 'sunid-twice', cast(sunid as string) from w group by sunid having count(*) > 1 union all select 'sccs-twice', sccs from w where level_id between 2 and 5 group by sccs having count(*) > 1
 union all select 'sccs-strange', cast(sunid as string) from u where level_id < 6 and not contains(sccs, '.')
 union all select 'sccs-parent', cast(sunid as string) from u where case when level_id > 5 then sccs else regexp_replace(sccs, '[.][^.]*$', '') end <> above
 union all select 'zero-rule', cast(sunid as string) from u where level_id = 5 and description = 'automated matches' and sccs <> above || '.0'
 union all select 'same-text', cast(min(sunid) as string) from w where parent_node_id is not null group by parent_node_id, level_id, description having count(*) > 1""",
)
def r8(t: Tables) -> DataFrame:
    return release.check_ids(t.sql(CHECKED0), t.sql(CHECKED1), t.sql(TOLD))


#: Two releases of whole lines: domains, their orders as parents, and seven grandparents, one of automated matches; in the later one some are under another parent, or
#: their parents under another grandparent, and some sequences are others.
_TENTH = "cast(floor(cast(sunid as double) / 10) as bigint)"


def _tree(domains: str, base: int, parent: str, grand: str, seq: str) -> str:
    parents = f"(select distinct {parent} as o from ({domains}) d)"
    return f"""select id, sunid, sid, description, curation_type_id, 8 as level_id, {base} + 500000000 + {parent} as parent_node_id, {seq} as seq_id from ({domains}) d
 union all select {base} + 500000000 + o, o, null, 'protein', 1, 7, {base} + 900000000 + {grand}, null from {parents} p
 union all select {base} + 900000000 + k, 900000000 + k, null, case when k = 3 then 'automated matches' else 'family' end, 1, 6, null, null from (select distinct {grand} as k from {parents} p) g"""


TREE0 = _tree(OLD, 0, _TENTH, "o % 7", "sunid % 7")
TREE1 = _tree(NEW, 1000000000, f"({_TENTH} + case when sunid % 11 = 0 then 1 else 0 end)", "case when o % 13 = 0 then (o + 3) % 7 else o % 7 end", "sunid % 7 + case when sunid % 5 = 0 then 1 else 0 end")
ENDED = f"select id as old_node_id, cast(1 + sunid % 9 as int) as change_type from ({OLD}) x where sunid % 4 = 1"


@query(
    "r9_change_summary",
    f"""with o as ({TREE0}), w as ({TREE1}), h as ({ENDED}),
 ow as (select d.*, p.sunid as up, g.sunid as grand from o d left join o p on p.id = d.parent_node_id left join o g on g.id = p.parent_node_id where d.level_id = 8),
 nw as (select d.*, p.sunid as up, g.sunid as grand, g.description as gtext from w d left join w p on p.id = d.parent_node_id left join w g on g.id = p.parent_node_id where d.level_id = 8),
 b as (select ow.sid as s0, ow.description as d0, ow.seq_id as q0, ow.up as u0, ow.grand as g0, ow.curation_type_id = 1 as cur, nw.* from ow left join nw on nw.sunid = ow.sunid where ow.id not in (select old_node_id from h where change_type <= 3)),
 c as (select case when cur then 'curated' else 'automatic' end as whose, case when d0 is not distinct from description and s0 is not distinct from sid then 'unchanged' when id is null then 'major'
  when s0 is distinct from sid and ends_with(sid, '_') then case when q0 = seq_id then 'region-to-chain' else 'minor' end when s0 is distinct from sid then 'other-sid' when q0 = seq_id then 'silent' else 'minor' end as category from b
  union all select case when cur then 'curated' else 'automatic' end, case when u0 = up and g0 = grand then 'unmoved' when cur then 'moved' when gtext = 'automated matches' then 'moved-overly-specific' else 'moved-incorrect' end from b where id is not null)
 select category, case when category in ('major', 'minor') or category like 'moved%' then whose else 'all' end as curation, count(*) as n from c group by 1, 2""",
)
def r9(t: Tables) -> DataFrame:
    return release.change_summary(kept(t.sql(TREE0)), kept(t.sql(TREE1)), t.sql(ENDED))


def _reps(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    nodes = t.sql(NODES)
    closed = kept(tree.closure(nodes))
    scored = nodes.filter("level_id = 8").join(t.sql(SCORES), "id").select(F.col("id").alias("node_id"), "sid", "score")
    reps = kept(cluster.level_representatives(closed, scored))
    bad = F.when(F.col("level_node_id") % 11 == 3, F.col("rep_node_id") + 10).when(F.col("level_node_id") % 11 == 4, F.col("level_node_id")).otherwise(F.col("rep_node_id"))
    reps = reps.filter("level_node_id % 11 <> 2").select("level_node_id", bad.alias("rep_node_id"))
    return reps.union(reps.filter("level_node_id % 11 = 5")), closed, nodes


@query(
    "r10_check_representatives",
    WITH_CLOSED + f""", s as ({SCORES}), q as (select c.ancestor_id as k, arg_min(c.node_id, (-score, sid, c.node_id)) as rep from closed c join nodes n on n.id = c.node_id join s on s.id = c.node_id where c.ancestor_level between 2 and 7 and c.depth > 0 group by 1),
 r0 as (select k, case when k % 11 = 3 then rep + 10 when k % 11 = 4 then k else rep end as rep from q where k % 11 <> 2), r as (select * from r0 union all select * from r0 where k % 11 = 5), want as (select distinct ancestor_id as k from closed join nodes on id = node_id where level_id = 8 and ancestor_level between 2 and 7)
 select 'missing' as issue, k as level_node_id from want where k not in (select k from r) union all select 'duplicate', k from r group by k having count(*) > 1 union all select 'not-ancestor', k from r where not exists(select 1 from closed c where c.depth > 0 and c.node_id = rep and c.ancestor_id = k) union all select 'wrong-level', k from r join nodes on id = rep where level_id <> 8""",
)
def r10(t: Tables) -> DataFrame:
    return release.check_representatives(*_reps(t))


PROMOTED = "select l_orderkey * 10 + l_linenumber as id, case when l_partkey % 8 = 0 then -1 else l_orderkey end as parent_node_id from {lineitem} group by 1, 2"
RULES = {"history": "select l_orderkey * 10 + l_linenumber as node_id from {lineitem} where l_partkey % 3 > 0", "chain": "select l_orderkey * 10 + l_linenumber as node_id from {lineitem} where l_partkey % 4 > 0", "map": "select l_orderkey * 10 + l_linenumber as node_id from {lineitem} where l_quantity < 40", "sequence": "select l_orderkey * 10 + l_linenumber as node_id from {lineitem} where l_quantity > 3"}
PARENTS = "select o_orderkey as id from {orders}"


@query("r11_check_promoted", f"with p as ({PROMOTED}) " + " union all ".join(f"select 'no-{k}' as issue, id from p where id not in ({v})" for k, v in RULES.items()) + f" union all select 'no-parent', id from p where parent_node_id not in ({PARENTS})")
def r11(t: Tables) -> DataFrame:
    return release.check_promoted(t.sql(PROMOTED), {k: t.sql(v) for k, v in RULES.items()}, t.sql(PARENTS))


EDITS = "select 'delete' as kind, 5000000000 + o_orderkey as node_id, cast(null as bigint) as target_id, cast(null as string) as text from {orders} where o_orderkey % 40 = 1 union all select 'move', 4000000000 + c_custkey, 3000000000 + c_custkey % 25, null from {customer} where c_custkey % 10 = 2 union all select 'merge', 5000000000 + o_orderkey, 5000000000 + o_orderkey + 1, null from {orders} where o_orderkey % 40 = 11 union all select 'split', 5000000000 + o_orderkey, 6000000000 + 2 * o_orderkey + r_regionkey, r_name from {orders}, {region} where o_orderkey % 40 = 21 and r_regionkey < 2 union all select 'edit', 4000000000 + c_custkey, null, c_mktsegment || ' [TaxId:' || cast(c_custkey as string) || ']' from {customer} where c_custkey % 10 = 3"
#: The release before: another id of each node, some customers already where they are moved to.
BEFORE = f"select 10 * id as id, sunid, case when level_id = 4 and id % 20 = 2 then 10 * (3000000000 + id % 25) else 10 * parent_node_id end as parent_node_id from ({NODES}) x where id % 7 <> 3"
EDITED = f""", e as ({EDITS}), gone as (select distinct c.node_id as id from closed c join e on e.kind = 'delete' and e.node_id = c.ancestor_id), mv as (select e.node_id, e.target_id, n.sunid, p.sunid as up, n.level_id, n.sccs, p.sccs as psccs from e join nodes n on n.id = e.node_id join nodes p on p.id = e.target_id where kind = 'move' and n.level_id = p.level_id + 1 and n.parent_node_id <> e.target_id),
 mg as (select e.node_id, e.target_id from e join nodes n on n.id = e.node_id join nodes p on p.id = e.target_id where kind = 'merge' and n.level_id = p.level_id), sp as (select e.node_id, e.target_id, text from e join nodes n on n.id = e.node_id where kind = 'split')"""


@query(
    "r12_apply_edits",
    WITH_CLOSED + EDITED + """, ad as (select * from mg union all select node_id, min(target_id) from sp group by 1), cut as (select c.node_id from closed c join mv on mv.node_id = c.ancestor_id where not starts_with(mv.sccs, psccs || '.') group by 1)
 select n.id, n.sunid, case when n.id in (select node_id from cut) then '' else n.sccs end as sccs, n.sid, coalesce(replace(replace(ed.text, '[TaxId: ', '[TaxId:'), '[TaxId:', '[TaxId: '), n.description) as description, n.level_id, coalesce(mv.target_id, ad.target_id, n.parent_node_id) as parent_node_id
 from nodes n left join mv on mv.node_id = n.id left join ad on ad.node_id = n.parent_node_id left join (select node_id, text from e where kind = 'edit') ed on ed.node_id = n.id where n.id not in (select id from gone) and n.id not in (select node_id from ad)
 union all select sp.target_id, 0, n.sccs, null, sp.text, n.level_id, n.parent_node_id from sp join nodes n on n.id = sp.node_id""",
)
def r12(t: Tables) -> DataFrame:
    nodes = written(t.sql(NODES))
    return release.apply_edits(nodes, t.sql(EDITS), written(tree.closure(nodes)), t.sql(BEFORE))[0]


@query(
    "r12_edit_history",
    WITH_CLOSED + EDITED + f""", b as (select x.sunid, x.id as old, y.sunid as up from ({BEFORE}) x left join ({BEFORE}) y on y.id = x.parent_node_id where x.sunid > 0)
 select old as old_node_id, cast(null as bigint) as new_node_id, 2 as change_type from gone join nodes n using (id) join b using (sunid) union all select old, mv.node_id, 6 from mv join b using (sunid) where b.up is distinct from mv.up
 union all select old, mg.target_id, 4 from mg join nodes n on n.id = mg.node_id join b using (sunid) union all select old, sp.target_id, 5 from sp join nodes n on n.id = sp.node_id join b using (sunid)""",
)
def r12h(t: Tables) -> DataFrame:
    nodes = written(t.sql(NODES))
    return release.apply_edits(nodes, t.sql(EDITS), written(tree.closure(nodes)), t.sql(BEFORE))[1]


COMMENTS = "select 4000000000 + o_custkey as node_id, o_orderpriority as description, 0 as is_auto from {orders} group by 1, 2"
COMMENT_EDITS = "select 'remove' as kind, 4000000000 + c_custkey as node_id, '1-' as text from {customer} where c_custkey % 3 = 0 union all select 'add', 4000000000 + c_custkey, 'automatic note' from {customer} where c_custkey % 4 = 0 union all select 'add', 4000000000 + c_custkey, '2-HIGH' from {customer} where c_custkey % 5 < 2"


@query(
    "r12_edit_comments",
    f"""with c as ({COMMENTS}), e as ({COMMENT_EDITS}), l as (select * from c where not exists(select 1 from e where kind = 'remove' and e.node_id = c.node_id and starts_with(c.description, e.text)))
 select * from l union all select distinct node_id, text, case when starts_with(text, 'automat') then 1 else 0 end from e where kind = 'add' and not exists(select 1 from l where l.node_id = e.node_id and l.description = e.text)""",
)
def r12c(t: Tables) -> DataFrame:
    return release.edit_comments(t.sql(COMMENTS), t.sql(COMMENT_EDITS))


FLAGS = "select 4000000000 + c_custkey as node_id from {customer} where c_custkey % 12 = 0"


@query("r13_propagate_inconsistent", WITH_CLOSED + f"select distinct node_id from closed join nodes on id = node_id where level_id = 8 and ancestor_id in ({FLAGS})")
def r13(t: Tables) -> DataFrame:
    nodes = t.sql(NODES)
    return release.propagate_inconsistent(t.sql(FLAGS), tree.closure(nodes), nodes)


SPECIES = "select c_custkey as id, 'S' || cast(c_nationkey as string) as scientific_name, case when c_custkey % 3 = 0 then null when c_custkey % 5 = 0 then 'b' else 'a' end as common_name, case when c_custkey % 4 = 0 then 'strain' end as details, case when c_custkey % 2 = 0 then null else c_nationkey + c_custkey % 14 % 2 end as ncbi_taxid from {customer}"
SPECIES_LINKS = "select o_custkey as species_id from {orders}"


@query(
    "r14_merge_duplicate_species",
    f"""with s as (select id, scientific_name as a, coalesce(common_name, '-') as b, coalesce(details, '-') as d, coalesce(cast(ncbi_taxid as string), '-') as x, (select count(*) from ({SPECIES_LINKS}) where species_id = id) as n from ({SPECIES})),
 f as (select a, b, d, x, min(id) as into_, sum(n) as n from s group by 1, 2, 3, 4), rb as (select *, row_number() over (partition by a, d, x order by n desc, into_ desc) as r, count(*) over (partition by a, d, x) as k, coalesce(lead(n) over (partition by a, d, x order by n desc, into_ desc), 0) as n2 from f where b <> '-'),
 lone as (select f.into_ as src, rb.into_ as dst from f join rb using (a, d, x) where f.b = '-' and r = 1 and (k = 1 or (rb.n > n2 + 5 and rb.n > 9))),
 rx as (select *, row_number() over (partition by a, b, d order by n desc, into_ desc) as r, count(*) over (partition by a, b, d) as k, coalesce(lead(n) over (partition by a, b, d order by n desc, into_ desc), 0) as n2 from f where x <> '-'),
 bare as (select f.into_ as src, rx.into_ as dst from f join rx using (a, b, d) where f.x = '-' and r = 1 and (k = 1 or (rx.n > 4 and n2 = 0))), mv as (select src, min(dst) as dst from (select * from lone union all select * from bare) group by 1)
 select id, coalesce(dst, into_) as merged_id from s join f using (a, b, d, x) left join mv on src = into_ where id <> coalesce(dst, into_)""",
)
def r14(t: Tables) -> DataFrame:
    return species.merge_duplicate_species(t.sql(SPECIES), t.sql(SPECIES_LINKS))


CASED = SPECIES.replace("'S' ||", "case when c_custkey % 7 = 0 then 's' else 'S' end ||")


@query(
    "r15_canonical_species_text",
    f"""with t as (select id, case when common_name is not null then common_name || ' (' || scientific_name || ')' else scientific_name end || coalesce(', ' || details, '') || coalesce(' [TaxId: ' || ncbi_taxid || ']', '') as text, (select count(*) from ({SPECIES_LINKS}) where species_id = id) as n from ({CASED})),
 u as (select lower(text) as k, text, sum(n) as n from t group by 1, 2), b as (select k, arg_min(text, (-n, text)) as text from u group by 1) select id, b.text from t join b on lower(t.text) = k""",
)
def r15(t: Tables) -> DataFrame:
    return species.canonical_species_text(t.sql(CASED), t.sql(SPECIES_LINKS))


SIBLINGS = "select o_orderkey as id, o_custkey as parent_node_id, o_orderpriority as species_id from {orders}"


@query("r16_sibling_species_merge", f"with s as (select *, min(id) over (partition by parent_node_id, species_id) as merged_id from ({SIBLINGS})) select id, merged_id from s where id <> merged_id")
def r16(t: Tables) -> DataFrame:
    return species.sibling_species_merge(t.sql(SIBLINGS))


ANNOTATED = "select o_custkey as family_id, l_linenumber as protein_id, case when l_partkey % 50 = 0 then null else l_suppkey end as annotation from {lineitem} join {orders} on l_orderkey = o_orderkey"


@query("r17_shared_annotation_classes", f"with d as (select distinct * from ({ANNOTATED}) where annotation is not null), k as (select family_id, annotation, min(protein_id) as representative, count(*) as n from d group by 1, 2 having count(*) > 1) select family_id, annotation, protein_id, representative, n - 1 as links from d join k using (family_id, annotation)")
def r17c(t: Tables) -> DataFrame:
    return species.shared_annotation_classes(t.sql(ANNOTATED), "family_id", "protein_id")


@query("r17_shared_annotation_conflicts", f"with d as (select distinct * from ({ANNOTATED}) where annotation is not null) select x.family_id, x.annotation, x.protein_id as a, y.protein_id as b from d x join d y on x.family_id = y.family_id and x.annotation = y.annotation and x.protein_id < y.protein_id")
def r17(t: Tables) -> DataFrame:
    return species.shared_annotation_conflicts(t.sql(ANNOTATED), "family_id", "protein_id")


AUTOMATIC = "select o_orderkey as id, o_custkey % 50 as family_id, o_orderkey % 20 as gene, 'S' || cast(o_custkey % 9 as string) as name, o_orderkey % 11 as taxid from {orders}"
GENES = "select c_custkey % 50 as family_id, c_nationkey % 20 as gene, c_custkey % 60 as protein_id from {customer}"
UNDER = "select p_partkey % 60 as protein_id, p_partkey as species_id, 'S' || cast(p_size % 9 as string) as name, p_size % 11 as taxid from {part}"


@query(
    "r18_reassign_automatic",
    f"""with g as (select family_id, gene, min(protein_id) as protein_id from ({GENES}) group by 1, 2 having count(distinct protein_id) = 1), r as (select a.*, protein_id from ({AUTOMATIC}) a join g using (family_id, gene)),
 m as (select r.id, count(distinct case when r.name = s.name and r.taxid = s.taxid then species_id end) as k1, min(case when r.name = s.name and r.taxid = s.taxid then species_id end) as s1, count(distinct case when r.taxid = s.taxid then species_id end) as k2, min(case when r.taxid = s.taxid then species_id end) as s2, count(distinct case when r.name = s.name then species_id end) as k3, min(case when r.name = s.name then species_id end) as s3 from r join ({UNDER}) s using (protein_id) group by 1)
 select r.id, protein_id, coalesce(case when k1 = 1 then s1 end, case when k2 = 1 then s2 end, case when k3 = 1 then s3 end) as species_id from r left join m using (id)""",
)
def r18(t: Tables) -> DataFrame:
    return species.reassign_automatic(t.sql(AUTOMATIC), t.sql(GENES), t.sql(UNDER))
