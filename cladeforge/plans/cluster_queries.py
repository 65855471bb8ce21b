"""Queries of quality, representatives and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.operators import cluster, quality, tree
from cladeforge.plans.asof_queries import SNAPSHOTS, VERSIONS
from cladeforge.plans.registry import Tables, query
from cladeforge.plans.shapes import NODES, SCORES, WITH_CLOSED

MEASURES = """select p_partkey as pdb_release_id, case when p_size = 3 then 'THEORY' when p_size = 5 then 'NMR' when p_size = 7 then 'NMR2' else 'X-RAY' end as method, case when p_size % 11 = 0 then null when p_size % 13 = 0 then 0.0 else cast(p_size as double) / 10 end as resolution,
 case when p_size % 9 = 0 then null else cast(p_partkey % 50 as double) / 100 end as r_factor, 1 + p_partkey % 3 as procheck1, 1 + p_partkey % 2 as procheck2, case when p_partkey % 4 = 0 then null else 2 end as procheck3,
 cast(p_size % 5 as double) as whatcheck1, cast(p_size % 3 as double) as whatcheck2, -cast(p_size % 4 as double) as whatcheck3, case when p_partkey % 6 = 0 then null else cast(p_size % 7 as double) end as whatcheck4 from {part}"""
SPACI = f"""select *, 0.1 + 1.0 / eres - (er - 0.1) - 0.1 * w - 0.1 * p as spaci from (select *, case when method = 'NMR2' then 3.8 when method = 'NMR' then 4.0 when method = 'THEORY' then 20.0 when resolution is null or resolution = 0 then 5.0 else resolution end as eres,
 case when method like 'NMR%' then 0.25 when method = 'THEORY' then 1.0 when resolution is null or resolution = 0 then 0.5 else coalesce(r_factor, 0.25) end as er, coalesce(1.0 - ((whatcheck1 + 8) / 16 + (whatcheck2 + 8) / 12 + (whatcheck3 + 5) / 7 + (whatcheck4 + 10) / 15) / 4, 1.0) as w,
 coalesce(cast(procheck1 + procheck2 + procheck3 - 3 as double) / 6, 1.0) as p from ({MEASURES}))"""


@query("k1_spaci", f"select pdb_release_id, round(cast(eres as double), 9) as effective_resolution, round(cast(er as double), 9) as effective_r_factor, round(cast(spaci as double), 9) + 0.0 as spaci from ({SPACI})")
def k1(t: Tables) -> DataFrame:
    return quality.spaci(t.sql(MEASURES)).select("pdb_release_id", *((F.round(c, 9) + 0.0).alias(c) for c in ("effective_resolution", "effective_r_factor", "spaci")))


COMMENTS = "select p_partkey as pdb_release_id, 'a ' || case when p_size % 5 = 0 then 'Mutant ' else '' end || case when p_partkey % 7 = 0 then 'truncated ' else '' end || p_name as description from {part} union all select p_partkey, 'mutant, circularly permuted' from {part} where p_size % 8 = 0"
AERO = f"with c as ({COMMENTS}), n as (select pdb_release_id, " + " + ".join(f"max(case when contains(lower(description), '{w}') then 1 else 0 end)" for w in quality.BAD_WORDS) + f" as bad from c group by 1), s as ({SPACI})"


@query("k2_aerospaci", AERO + " select pdb_release_id, round(cast(spaci - 2.0 * bad - case when method = 'THEORY' then 5 else 0 end as double), 9) + 0.0 as aerospaci from s join n using (pdb_release_id)")
def k2(t: Tables) -> DataFrame:
    return quality.aerospaci(quality.spaci(t.sql(MEASURES)), t.sql(COMMENTS)).select("pdb_release_id", (F.round("aerospaci", 9) + 0.0).alias("aerospaci"))


_OF_EVENTS = ("from {part}", "from {part} join {events} on p_partkey = 1 + event_id % 150")
EVENT_MEASURES = MEASURES.replace("p_partkey as pdb_release_id", "event_id as pdb_release_id").replace(*_OF_EVENTS)
EVENT_COMMENTS = COMMENTS.replace("p_partkey as pdb_release_id", "event_id as pdb_release_id").replace("select p_partkey,", "select event_id,").replace(*_OF_EVENTS)
LITERATURE = "select distinct user_id as entry_id from {events} where user_id % 10 = 3"


@query(
    "k3_freeze_quality",
    AERO.replace(MEASURES, EVENT_MEASURES).replace(COMMENTS, EVENT_COMMENTS) + f""", v as (select entry_id, arg_max(id, (snapshot_date, id)) as pdb_release_id from ({VERSIONS}) join ({SNAPSHOTS}) on id = release_id where file_date <= date '2024-01-20' and revision_date <= date '2024-01-20' and snapshot_date <= date '2024-01-20' group by 1)
 select entry_id, pdb_release_id, round(cast(spaci as double), 9) + 0.0 as spaci, round(cast(spaci - 2.0 * bad - case when method = 'THEORY' then 5 else 0 end as double), 9) + 0.0 as aerospaci from v join s using (pdb_release_id) join n using (pdb_release_id) where entry_id % 10 <> 3""",
)
def k3(t: Tables) -> DataFrame:
    out = quality.freeze_quality(t.sql(VERSIONS), t.sql(SNAPSHOTS), t.sql(EVENT_MEASURES), t.sql(EVENT_COMMENTS), t.sql(LITERATURE), "2024-01-20")
    return out.select("entry_id", "pdb_release_id", (F.round("spaci", 9) + 0.0).alias("spaci"), (F.round("aerospaci", 9) + 0.0).alias("aerospaci"))


ASKED = "select l_orderkey as question, 'c' || cast(l_linenumber as string) || cast(l_partkey as string) as code, case when l_partkey % 23 = 0 then null else cast(l_quantity % 6 as double) end as score from {lineitem}"


@query(
    "k4_rank_by_quality",
    f"""with a as (select *, count(score) over w = count(*) over w as ok, rank() over (partition by question order by score desc) as k from ({ASKED}) window w as (partition by question)), r as (select *, case when ok then k end as rank from a)
 select question, code, score, rank, coalesce(rank = 1, false) as is_best, coalesce(rank = 1, false) and sum(case when rank = 1 then 1 else 0 end) over (partition by question) = 1 as is_preferred from r""",
)
def k4(t: Tables) -> DataFrame:
    return quality.rank_by_quality(t.sql(ASKED), "score")


ENTRY_ITEMS = "select l_orderkey * 10 + l_linenumber as id, l_partkey as entry_id from {lineitem}"
ENTRY_SCORES = "select p_partkey as entry_id, cast(p_retailprice - 950 as double) / 7 as aerospaci from {part} where p_partkey % 6 > 0"


@query("k5_score_items", f"select entry_id, id, coalesce(floor(aerospaci * 100 + 0.5) / 100, 0.0) as score from ({ENTRY_ITEMS}) left join ({ENTRY_SCORES}) using (entry_id)")
def k5(t: Tables) -> DataFrame:
    return quality.score_items(t.sql(ENTRY_ITEMS), t.sql(ENTRY_SCORES))


@query("c1_level_representatives", WITH_CLOSED + f", s as ({SCORES}) select c.ancestor_id as level_node_id, arg_min(c.node_id, (-score, sid, c.node_id)) as rep_node_id from closed c join nodes n on n.id = c.node_id join s on s.id = c.node_id where c.ancestor_level between 2 and 7 and c.depth > 0 group by 1")
def c1(t: Tables) -> DataFrame:
    nodes = t.sql(NODES)
    scored = nodes.filter("level_id = 8").join(t.sql(SCORES), "id").select(F.col("id").alias("node_id"), "sid", "score")
    return cluster.level_representatives(tree.closure(nodes), scored)


RANKED = "select c_custkey as item, row_number() over (order by floor(c_acctbal / 100) desc, c_custkey) as rank from {customer}"
EDGES = "select least(o_custkey, k) as a, greatest(o_custkey, k) as b, max(floor(o_totalprice) % 101) as pct, max(round(-(floor(o_totalprice) % 53), 8)) as e from (select o_custkey, 1 + o_orderkey * 7 % (select max(c_custkey) from {customer}) as k, o_totalprice from {orders}) x where o_custkey <> k group by 1, 2"


def _greedy(where: str, threshold: float) -> str:
    return f""",
 g{int(abs(threshold))} as (select * from (with recursive nb as (select r.rank, coalesce(list(q.rank), []) as near from r left join (select a as x, b as y from ed where {where} union select b, a from ed where {where}) z on r.item = x left join r q on q.item = y group by r.rank),
 w(rank, reps) as (select cast(0 as bigint), cast([] as bigint[]) union all select nb.rank, case when list_has_any(w.reps, nb.near) then w.reps else list_append(w.reps, nb.rank) end from w join nb on nb.rank = w.rank + 1),
 f as (select reps from w order by rank desc limit 1)
 select cast({threshold} as double) as threshold, r.item, own.item as rep from r join nb using (rank), f join r own on own.rank = case when list_contains(f.reps, nb.rank) then nb.rank else list_min(list_intersect(f.reps, nb.near)) end))"""


@query("c2_nonredundant_by_identity", f"with r as ({RANKED}), ed as ({EDGES})" + _greedy("pct >= 40", 40.0) + _greedy("pct >= 90", 90.0) + " select * from g40 union all select * from g90")
def c2(t: Tables) -> DataFrame:
    return cluster.nonredundant(t.sql(RANKED), t.sql(EDGES), [40.0, 90.0])


@query("c3_nonredundant_by_evalue", f"with r as ({RANKED}), ed as ({EDGES})" + _greedy("e <= -20", -20.0) + " select * from g20")
def c3(t: Tables) -> DataFrame:
    return cluster.nonredundant(t.sql(RANKED), t.sql(EDGES), [-20.0], by="e")


BALANCES = "select c_custkey as item, c_acctbal as score from {customer}"


@query("c4_cluster_log", f"with r as ({RANKED}), ed as ({EDGES})" + _greedy("pct >= 60", 60.0) + f" select threshold, rep, item, score, count(*) over (partition by threshold, rep) as size from g60 join ({BALANCES}) using (item)")
def c4(t: Tables) -> DataFrame:
    return cluster.cluster_log(cluster.nonredundant(t.sql(RANKED), t.sql(EDGES), [60.0]), t.sql(BALANCES))


SEQS = "select c_custkey as seq_id, cast(c_nationkey % 8 as double) / 2 as resolution, 50 + c_custkey % 40 as length from {customer}"
SEQ_HITS = "select o_custkey as seq1_id, 1 + o_orderkey * 7 % (select max(c_custkey) from {customer}) as seq2_id, 20 + o_orderkey % 60 as seq1_length, 20 + o_custkey % 60 as seq2_length from {orders}"
EASY, UNKNOWN = "select distinct o_custkey as seq_id from {orders}", "select c_custkey as seq_id from {customer} where c_custkey % 9 = 0"


@query(
    "c5_prioritise_clusters",
    f"""with recursive g as (select seq_id, length from ({SEQS}) where resolution > 0 and resolution <= 3.2 and seq_id in ({EASY}) and seq_id % 9 <> 0),
 h as (select seq1_id as a, seq2_id as b from ({SEQ_HITS}) x join g p on p.seq_id = seq1_id join g q on q.seq_id = seq2_id where 2 * seq1_length >= p.length and 2 * seq2_length >= q.length),
 u as (select a, b from h union select b, a from h), c(s, m) as (select seq_id, seq_id from g union select u.a, c.m from c join u on u.b = c.s)
 select cluster, count(*) as size from (select s, min(m) as cluster from c group by s) group by 1 order by size desc, cluster limit 20""",
)
def c5(t: Tables) -> DataFrame:
    return cluster.prioritise_clusters(t.sql(SEQS), t.sql(SEQ_HITS), t.sql(EASY), t.sql(UNKNOWN))


SID_CHAINS = "select 's' || cast(o_custkey as string) as sid, o_orderkey as chain_id from {orders}"
#: The first part of each brand and size.
REPS = "select min(p_partkey) as rep_id from {part} group by p_brand, p_size"
DONE = "select l_orderkey as chain_id from {lineitem}"


@query("c6_comparison_worklist", f"with f as (select sid, min(chain_id) as chain_id from ({SID_CHAINS}) group by 1), d as (select chain_id from ({DONE}) group by 1 having count(*) > 5) select cast(chain_id % 2 as int) as segment, chain_id, rep_id from f, ({REPS}) where chain_id not in (select chain_id from d)")
def c6(t: Tables) -> DataFrame:
    return cluster.comparison_worklist(t.sql(SID_CHAINS), t.sql(REPS), t.sql(DONE), 5)


MEMBERS = "select lang || source as family, cast(floor(cast(n_chars as double) / 10) as int) as seqres, cast(n_chars as double) / 10 - doc_id % 30 as atom from {documents} where doc_id % 7 > 0"
NEWCOMERS = "select lang || source as family, doc_id as entry, cast(floor(cast(n_chars as double) / 10) as int) as seqres, cast(n_chars as double) / 10 - doc_id % 40 as atom from {documents} where doc_id % 7 = 0"
BAD_FAMILIES = "select distinct lang || source as family from {documents} where source = 'src3'"


@query(
    "c7_length_consistency",
    f"""with m as (select *, case when 0.8 * seqres > atom and seqres - atom > 15 then 1 else 0 end as differ from ({MEMBERS})), e as (select *, case when 0.8 * seqres > atom and seqres - atom > 15 then 1 else 0 end as own from ({NEWCOMERS})),
 b as (select family, seqres, count(*) as n from m group by 1, 2), f as (select family, min(seqres) as low, max(seqres) as high, count(*) as total, max(differ) as differ, greatest(0, min(seqres) - 30) as base from m group by 1),
 p as (select family, base, seqres, n, total, unnest(range(greatest(0, (seqres - base) * 10 - 400), least((high + 30 - base) * 10, (seqres - base) * 10 + 401))) as i from b join f using (family) where total > 5),
 d as (select family, i, sum(n * exp(-0.5 * (base + cast(i as double) / 10 - seqres) * (base + cast(i as double) / 10 - seqres))) / (any_value(total) * sqrt(2 * pi())) as density from p group by 1, 2),
 s as (select family, i, coalesce(lead(density, 1) over w, 0) - density as d0, coalesce(lead(density, 2) over w, 0) - coalesce(lead(density, 1) over w, 0) as d1, coalesce(lead(density, 3) over w, 0) - coalesce(lead(density, 2) over w, 0) as d2 from d window w as (partition by family order by i)),
 k as (select family, any_value(low) as low, min(base + cast(i + 2 as double) / 10) as first, max(base + cast(i + 2 as double) / 10) as last, count(*) as n from s join f using (family)
  where i >= 1 and i <= (high + 30 - base) * 10 - 4 and ((d0 > 0 and d1 < 0) or (d0 > 0 and d1 < d0 and d2 > d1) or (d0 < 0 and d1 > d0 and d2 < d1)) group by 1),
 v as (select family from k where case when low * 1.5 < first then n + 1 > 1 and low <> 0 and last / low > 1.6 else n > 1 and first <> 0 and last / first > 1.6 end),
 r as (select e.*, f.*, coalesce(density, 0) as density, e.family in (select family from v) as varied, exists (select 1 from b where b.family = e.family and (abs(e.seqres - b.seqres) < 10 or (e.seqres > b.seqres * 0.9 and e.seqres < b.seqres * 1.1))) as alike
  from e join f on f.family = e.family left join d on d.family = e.family and d.i = (e.seqres - base) * 10)
 select family, entry, cast(case when total > 5 then case when density <= 0.0005 then 1 else 0 end when alike then 0 else 1 end + 2 * own + case when seqres > high + 20 or seqres < low - 20 then 4 else 0 end
  + case when total > 5 then case when varied then 8 else 0 end when low <> 0 and high > 1.5 * low then 8 else 0 end + 16 * differ + case when family in ({BAD_FAMILIES}) then 32 else 0 end as int) as code from r""",
)
def c7(t: Tables) -> DataFrame:
    return cluster.length_consistency(t.sql(MEMBERS), t.sql(NEWCOMERS), t.sql(BAD_FAMILIES))


@query("c7_repeat_families", f"with n as ({NODES}), r as (select sccs, level_id from n where level_id between 2 and 5 and contains(description, 'repeat')), f as (select distinct sccs as family from n where level_id = 5) select family from f where (split_part(family, '.', 1), 2) in (select (sccs, level_id) from r) or (array_to_string(string_split(family, '.')[1:2], '.'), 3) in (select (sccs, level_id) from r) or (array_to_string(string_split(family, '.')[1:3], '.'), 4) in (select (sccs, level_id) from r) or (family, 5) in (select (sccs, level_id) from r)".replace("description, 'repeat'", "lower(description), 'il'"))
def c7r(t: Tables) -> DataFrame:
    return cluster.repeat_families(t.sql(NODES).withColumn("description", F.regexp_replace(F.lower("description"), "il", "repeat")))


PENDING = "select o_orderdate as date, case when o_orderkey % 4 = 0 then 'seq' end as seq from {orders} where month(o_orderdate) <> 5"


@query("c8_monthly_counts", f"with m as (select strftime(unnest(generate_series(date '1994-01-01', date '2002-12-01', interval 1 month)), '%Y-%m') as month), o as (select strftime(date, '%Y-%m') as month, count(*) as n from ({PENDING}) where seq is null group by 1) select month, coalesce(n, 0) as n from m left join o using (month)")
def c8(t: Tables) -> DataFrame:
    return cluster.monthly_counts(t.sql(PENDING), "1994-01-01", "2002-12-01")
