"""Queries of joins by date and release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.operators import asof
from cladeforge.plans.registry import Tables, query
from cladeforge.plans.shapes import LINES, NODES

#: Events as releases of the entries that their users stand for.
VERSIONS = "select event_id as id, user_id as entry_id, cast(ts as date) as file_date, cast(ts as date) + cast(event_id % 4 as int) as revision_date from {events}"
SNAPSHOTS = "select event_id as release_id, cast(ts as date) + cast(event_id % 9 as int) as snapshot_date from {events}"


@query("j1_asof_release", f"select entry_id, arg_max(id, (snapshot_date, id)) as id, cast(max(snapshot_date) as string) as snapshot_date from ({VERSIONS}) join ({SNAPSHOTS}) on id = release_id where file_date <= date '2024-01-20' and revision_date <= date '2024-01-20' and snapshot_date <= date '2024-01-20' group by entry_id")
def j1(t: Tables) -> DataFrame:
    return asof.asof_release(t.sql(VERSIONS), t.sql(SNAPSHOTS), "2024-01-20").withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query("j2_asof_date", f"select entry_id, arg_max(id, (revision_date, id)) as id, cast(max(revision_date) as string) as revision_date from ({VERSIONS}) where revision_date <= date '2024-01-15' group by entry_id")
def j2(t: Tables) -> DataFrame:
    return asof.asof_date(t.sql(VERSIONS), "2024-01-15").withColumn("revision_date", F.col("revision_date").cast("string"))


REQUESTS = "select event_id as request_id, user_id as entry_id, cast(ts as date) - 1 as date from {events}"


@query(
    "j3_asof_with_tolerance",
    f"""with q as ({REQUESTS}), v as ({VERSIONS}), n as (select request_id, id, row_number() over (partition by request_id order by case when revision_date <= date then 0 else 1 end, abs(revision_date - date), id desc) as r
 from q join v using (entry_id) where revision_date <= date + 7) select request_id, id as release_id from n where r = 1""",
)
def j3(t: Tables) -> DataFrame:
    return asof.asof_with_tolerance(t.sql(REQUESTS), t.sql(VERSIONS))


#: Parts as chains with maps; valid from the first to the last year of their line items, some not frozen.
RAF = "select l_partkey as pdb_chain_id, l_partkey % 100 as entry_id, case when l_partkey % 17 = 0 then null else min(cast(year(l_shipdate) as int)) end as first_release_id, case when l_partkey % 17 = 0 then null else max(cast(year(l_shipdate) as int)) end as last_release_id from {lineitem} group by l_partkey, l_suppkey % 2"


@query("j4_raf_at", f"with v as (select * from ({RAF}) where first_release_id <= 1997 and last_release_id >= 1997) select v.*, count(*) over (partition by pdb_chain_id) > 1 as duplicated from v")
def j4(t: Tables) -> DataFrame:
    return asof.raf_at(t.sql(RAF), 1997)


@query("j4_raf_current", f"with v as (select * from ({RAF}) where first_release_id is null and last_release_id is null) select v.*, count(*) over (partition by pdb_chain_id) > 1 as duplicated from v")
def j4n(t: Tables) -> DataFrame:
    return asof.raf_at(t.sql(RAF), None)


#: Hits: a part and a supplier (sequences) of one line item; items: customers (domains), two of each sequence.
HITS = "select l_partkey as seq1_id, l_suppkey as seq2_id, -cast(l_quantity as double) as blast_log10_e, 100 - cast(l_linenumber as double) * 10 as pct_identical, cast(l_linenumber as int) - 1 as seq1_length, 5 as seq2_length from {lineitem}"
ITEMS = "select c_custkey as id, cast(floor((c_custkey + 1) / 2) as bigint) as seq_id, 1 + c_nationkey % 2 as source_id, 1 as style_id from {customer}"
PAIRS = f"select a.id as id1, b.id as id2, a.source_id, a.style_id, blast_log10_e, pct_identical from ({HITS}) h join ({ITEMS}) a on a.seq_id = seq1_id join ({ITEMS}) b on b.seq_id = seq2_id where seq1_length > 0 and seq2_length > 0 and a.id <> b.id and a.source_id = b.source_id and a.style_id = b.style_id"


@query("j5_expand_hits", f"select id1, id2, count(*) as n, min(blast_log10_e) as e, max(pct_identical) as pct from ({PAIRS}) group by id1, id2")
def j5(t: Tables) -> DataFrame:
    return asof.expand_hits(t.sql(HITS), t.sql(ITEMS)).groupBy("id1", "id2").agg(F.count("*").alias("n"), F.min("blast_log10_e").alias("e"), F.max("pct_identical").alias("pct"))


@query("j5_pair_edges", f"select least(id1, id2) as a, greatest(id1, id2) as b, max(pct_identical) as pct, max(round(blast_log10_e, 8)) as e from ({PAIRS}) group by all")
def j5e(t: Tables) -> DataFrame:
    return asof.pair_edges(asof.expand_hits(t.sql(HITS), t.sql(ITEMS)))


CLASSED = "select c_custkey as id, 'd' || cast(c_custkey as string) as sid, chr(97 + c_nationkey % 9) || '.' || cast(c_custkey % 3 as string) as sccs, case when c_custkey % 7 = 0 then 1 else 0 end as is_reject from {customer}"
GOOD = f"select id, sid, sccs from ({CLASSED}) where is_reject = 0 and substr(sccs, 1, 1) between 'a' and 'g'"


@query("j6_pair_table", f"with p as ({PAIRS}), g as ({GOOD}), x as (select a.sid as sid1, b.sid as sid2, a.sccs as sccs1, b.sccs as sccs2, blast_log10_e, pct_identical from p join g a on a.id = id1 join g b on b.id = id2) select sid1, sid2, sccs1, sccs2, min(blast_log10_e) as blast_log10_e, arg_min(pct_identical, (blast_log10_e, pct_identical)) as pct_identical from x group by all")
def j6(t: Tables) -> DataFrame:
    return asof.pair_table(asof.expand_hits(t.sql(HITS), t.sql(ITEMS)), t.sql(CLASSED), "bib")


DESCRIBED = "select o_orderkey as id, 'e' || cast(o_custkey as string) || ' A:' || case when o_orderkey % 3 = 0 then ',B:1-' || cast(o_orderkey % 50 as string) else '' end as description from {orders}"
CURRENT = "select 'e' || cast(c_custkey as string) as code, c_custkey as pdb_release_id from {customer}"
CHAINS = "select c_custkey * 2 as id, c_custkey as pdb_release_id, 'A' as chain, 1 as is_polypeptide from {customer} union all select c_custkey * 2 + 1, c_custkey, 'B', case when c_nationkey % 4 = 0 then 0 else 1 end from {customer}"


@query("j7_link_domains_to_chains", "select o_orderkey as node_id, o_custkey * 2 as pdb_chain_id from {orders} join {customer} on o_custkey = c_custkey union select o_orderkey, o_custkey * 2 + 1 from {orders} join {customer} on o_custkey = c_custkey where o_orderkey % 3 = 0 and c_nationkey % 4 <> 0")
def j7(t: Tables) -> DataFrame:
    return asof.link_domains_to_chains(t.sql(DESCRIBED), t.sql(CURRENT), t.sql(CHAINS))


KNOWN = f"select o * 10 + n as chain_id, flag || cast(qty as string) as line, 1 as first_release_id, 2 + cast(o % 3 as int) as last_release_id from ({LINES}) x where o % 5 > 0"
NOW = f"select o * 10 + n as chain_id, case when part % 4 = 0 then 'changed' else flag || cast(qty as string) end as line from ({LINES}) x"


@query(
    "j8_extend_versions",
    f"""with v as ({KNOWN}), c as ({NOW}) select chain_id, line, first_release_id, case when last_release_id = 4 and exists(select 1 from c where c.chain_id = v.chain_id and c.line = v.line) then 5 else last_release_id end as last_release_id from v
 union all select chain_id, line, 5, 5 from c where not exists(select 1 from v where v.chain_id = c.chain_id and v.line = c.line and last_release_id = 4)""",
)
def j8(t: Tables) -> DataFrame:
    return asof.extend_versions(t.sql(KNOWN), t.sql(NOW), 5)


DATED = "select o_orderkey as id, case when o_orderkey % 3 = 0 then cast(o_orderdate as date) end as obsolete_date, case when o_orderkey % 6 = 0 then o_orderkey + 1 when o_orderkey % 9 = 0 then o_orderkey + 2 end as obsoleted_by from {orders}"
CLASSIFIED = "select l_orderkey as entry_id from {lineitem} where l_quantity < 25"


@query("j9_drop_obsolete", f"with e as ({DATED}), c as (select distinct entry_id from ({CLASSIFIED})) select id, cast(obsolete_date as string) as obsolete_date, obsoleted_by from e where not coalesce(obsolete_date <= date '1998-01-01' and (obsoleted_by is null or obsoleted_by in (select entry_id from c)), false)")
def j9(t: Tables) -> DataFrame:
    return asof.drop_obsolete(t.sql(DATED), "1998-01-01", t.sql(CLASSIFIED)).withColumn("obsolete_date", F.col("obsolete_date").cast("string"))


FINE = VERSIONS.replace("user_id as entry_id", "user_id * 50 + event_id % 50 as entry_id")
EVENT_CHAINS = "select event_id * 2 as id, event_id as release_id from {events} union all select event_id * 2 + 1, event_id from {events} where event_id % 3 = 0"


@query(
    "j10_new_chains",
    f"""with v as ({FINE}), l as (select entry_id, arg_max(id, (revision_date, id)) as release_id from v where revision_date <= date '2024-01-25' group by entry_id),
 g as (select * from l where entry_id not in (select entry_id from v where revision_date <= date '2024-01-04') and entry_id not in (select user_id * 50 + event_id % 50 from {{events}} where value < 2) and entry_id % 5 > 0)
 select c.id, entry_id from ({EVENT_CHAINS}) c join g using (release_id)""",
)
def j10(t: Tables) -> DataFrame:
    gone, known = t.sql("select distinct user_id * 50 + event_id % 50 as entry_id from {events} where event_id % 5 = 0"), t.sql("select user_id * 50 + event_id % 50 as entry_id from {events} where value < 2")
    return asof.new_chains(t.sql(FINE), t.sql(EVENT_CHAINS), known, gone, "2024-01-04", "2024-01-25")


@query("j11_new_chains_between_releases", f"with r as ({RAF.replace('% 100', '% 1000')}) select distinct entry_id, pdb_chain_id from r where first_release_id <= 1999 and last_release_id >= 1999 and entry_id not in (select entry_id from r where first_release_id <= 1995 and last_release_id >= 1995)")
def j11(t: Tables) -> DataFrame:
    return asof.new_chains_between_releases(t.sql(RAF.replace("% 100", "% 1000")), 1995, 1999)


NAMED = "select distinct 'd' || cast(l_partkey as string) as sid, cast(year(l_shipdate) as int) as release_id from {lineitem}"


@query("j11_first_seen", f"select sid, min(release_id) as first_release_id from ({NAMED}) group by sid")
def j11b(t: Tables) -> DataFrame:
    return asof.first_seen(t.sql(NAMED))


OLD = "select o_custkey as entry_id, max(o_orderkey) as release_id from {orders} where o_orderdate < timestamp '1998-01-01' group by o_custkey"
NEW = "select o_custkey as entry_id, max(o_orderkey) as release_id from {orders} where o_orderdate >= timestamp '1996-06-01' group by o_custkey"
MAPS = f"select o as release_id, n as chain, flag as line from ({LINES}) x"


@query(
    "j12_release_change_report",
    f"""with b as (select entry_id, a.release_id as r0, z.release_id as r1 from ({OLD}) a full join ({NEW}) z using (entry_id)), c as (select * from b where r0 is null or r1 is null or r0 <> r1), m as ({MAPS}),
 u as (select entry_id, chain, max(l0) as l0, max(l1) as l1 from (select entry_id, chain, line as l0, null as l1 from c join m on r0 = release_id where r1 is not null union all select entry_id, chain, null, line from c join m on r1 = release_id where r0 is not null) group by all),
 g as (select entry_id, count(l1) - count(l0) as more, bool_and(l0 is not distinct from l1) as same from u group by entry_id)
 select entry_id, case when r1 is null then 'obsolete' when r0 is null then 'new' when more > 0 then 'updated, +' || more || ' chains' when more < 0 then 'updated, ' || more || ' chains' when same then 'updated, map same' else 'updated, map different' end as change from c left join g using (entry_id)""",
)
def j12(t: Tables) -> DataFrame:
    return asof.release_change_report(t.sql(OLD), t.sql(NEW), t.sql(MAPS))


HELD0 = "select o_orderkey as entry, cast(o_orderdate as date) as date from {orders} where o_orderkey % 7 > 0"
HELD1 = "select o_orderkey as entry, cast(o_orderdate as date) + cast(case when o_custkey % 5 = 0 then 1 else 0 end as int) as date from {orders} where o_orderkey % 6 > 0"


@query("j13_snapshot_diff", f"select entry, case when a.date is null then 'new' when b.date is null then 'deleted' when a.date = b.date then 'unchanged' else 'changed' end as state from ({HELD0}) a full join ({HELD1}) b using (entry)")
def j13(t: Tables) -> DataFrame:
    return asof.snapshot_diff(t.sql(HELD0), t.sql(HELD1))


VARIANTS = "select event_id as variant_id, user_id as accession, cast(floor(value) as int) % 60 as position from {events}"
ALIGNED = f"select part as accession, o * 10 + n as chain_id, cast(qty as int) as db_start, cast(qty as int) + 8 as db_end, n * 2 as chain_start from ({LINES}) x"
RESIDUES = f"select o * 10 + n as chain_id, i as idx, cast(i as string) || 'A' as res_id, i % 7 > 0 as observed from ({LINES}) x, (select distinct l_linenumber * 2 + l_partkey % 9 as i from {{lineitem}}) y"
VARIANT_CHAINS = f"select o * 10 + n as chain_id, cast(3 + part % 3 as int) as length, o % 3 = 0 as is_classified, case when supp % 3 > 0 then cast(supp % 5 as double) end as score from ({LINES}) x where part % 11 > 0"


@query(
    "j14_variant_to_structure",
    f"""with c as (select variant_id, a.chain_id, chain_start + position - db_start as idx from ({VARIANTS}) v join ({ALIGNED}) a using (accession) where position between db_start and db_end),
 r as ({RESIDUES}),
 s as (select chain_id, idx, res_id, observed, last_value(case when observed then res_id end ignore nulls) over (partition by chain_id order by idx rows between unbounded preceding and current row) as before,
  first_value(case when observed then res_id end ignore nulls) over (partition by chain_id order by idx rows between current row and unbounded following) as after from r where chain_id in (select chain_id from c)),
 p as (select variant_id, c.chain_id, res_id is not null as in_range, res_id, coalesce(observed, false) as observed, case when not observed then before end as nearest_before, case when not observed then after end as nearest_after,
  coalesce(is_classified, false) as classified, coalesce(length, 0) as length, coalesce(score, 0) as score from c left join s using (chain_id, idx) left join ({VARIANT_CHAINS}) q on q.chain_id = c.chain_id),
 n as (select *, row_number() over (partition by variant_id order by in_range desc, classified desc, observed desc, length desc, score desc, chain_id) as k from p)
 select variant_id, chain_id, in_range, res_id, observed, nearest_before, nearest_after from n where k = 1""",
)
def j14(t: Tables) -> DataFrame:
    return asof.variant_to_structure(t.sql(VARIANTS), t.sql(ALIGNED), t.sql(RESIDUES), t.sql(VARIANT_CHAINS))


@query("j15_domain_xrefs", f"with n as ({NODES}) select distinct p_brand as accession, sid from {{lineitem}} join {{part}} on l_partkey = p_partkey join n on id = 8000000000 + l_orderkey * 10 + l_linenumber")
def j15(t: Tables) -> DataFrame:
    links = t.sql("select 8000000000 + l_orderkey * 10 + l_linenumber as node_id, l_partkey as chain_id from {lineitem}")
    return asof.domain_xrefs(links, t.sql("select p_partkey as chain_id, p_brand as accession from {part}"), t.sql(NODES))


KEYED = "select p_partkey as row_id, p_brand as name, case when p_size % 10 = 0 then null else p_size % 10 end as kind from {part}"
DICTIONARY = "select 100 + min(p_partkey) as id, p_brand as name, case when p_size % 10 = 0 then null else p_size % 10 end as kind from {part} where p_size % 10 < 4 group by 2, 3"


@query(
    "j16_dictionary_encode",
    f"""with r as ({KEYED}), d as ({DICTIONARY}), k as (select distinct name, kind from r), f as (select name, kind, (select max(id) from d) + row_number() over (order by name, kind nulls first) as id from k where not exists(select 1 from d where d.name = k.name and d.kind is not distinct from k.kind)),
 u as (select id, name, kind from d union all select id, name, kind from f) select row_id, r.name, r.kind, u.id as key_id from r join u on u.name = r.name and u.kind is not distinct from r.kind""",
)
def j16(t: Tables) -> DataFrame:
    return asof.dictionary_encode(t.sql(KEYED), t.sql(DICTIONARY), ["name", "kind"])[0]
