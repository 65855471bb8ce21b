"""Queries of lookups, filters and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.functions import text
from cladeforge.operators import lookup, tree
from cladeforge.plans.registry import Tables, query
from cladeforge.plans.shapes import NODES, WITH_CLOSED

IDS = """select 'N' || cast(5000000000 + o_orderkey as string) as given from {orders} where o_orderkey % 5 = 0 union all select 'd' || cast(o_orderkey as string) || 'l1' from {orders} where o_orderkey % 5 = 1
 union all select chr(97 + cast(o_custkey % 6 as int)) || '.' || cast(o_orderkey % 30 as string) from {orders} where o_orderkey % 5 = 2 union all select cast(4000000000 + o_orderkey as string) from {orders} where o_orderkey % 5 = 3"""


@query(
    "p1_resolve_ids",
    f"""with n as ({NODES}), i as ({IDS}), k as (select given, case when given like 'N%' then 'id' when regexp_matches(given, '^d[0-9]+l[0-9]$') then 'sid' when regexp_matches(given, '^[a-l](\\.[0-9]+)*$') then 'sccs' else 'sunid' end as kind from i),
 m as (select given, case when kind = 'id' then (select count(*) from n where 'N' || cast(id as string) = given) when kind = 'sid' then (select count(*) from n where sid = given) when kind = 'sccs' then (select count(*) from n where sccs = given and level_id <= 5) else (select count(*) from n where cast(sunid as string) = given) end as c,
  case when kind = 'id' then (select min(id) from n where 'N' || cast(id as string) = given) when kind = 'sid' then (select min(id) from n where sid = given) when kind = 'sccs' then (select min(id) from n where sccs = given and level_id <= 5) else (select min(id) from n where cast(sunid as string) = given) end as id from k)
 select given, cast(case when c = 0 then 0 when c > 1 then -1 else id end as bigint) as node_id from m""",
)
def p1(t: Tables) -> DataFrame:
    return lookup.resolve_ids(t.sql(IDS), t.sql(NODES), r"^d\d+l\d$")


RELEASES = "select distinct cast(year(o_orderdate) as int) as id, cast(year(o_orderdate) % 2 as int) as is_public from {orders}"


@query("p2_latest_release", f"select max(id) as id from ({RELEASES}) where is_public = 1")
def p2(t: Tables) -> DataFrame:
    return lookup.latest_release(t.sql(RELEASES))


@query("p3_class_filter", f"with n as ({NODES}) select id, sccs, 'in' as side from n where substr(sccs, 1, 1) between 'b' and 'd' union all select id, sccs, 'out' from n where not substr(sccs, 1, 1) between 'b' and 'd'")
def p3(t: Tables) -> DataFrame:
    nodes = t.sql(NODES).select("id", "sccs")
    return lookup.class_filter(nodes, "b", "d").withColumn("side", F.lit("in")).union(lookup.class_filter(nodes, "b", "d", invert=True).withColumn("side", F.lit("out")))


ITEMS = "select l_orderkey * 10 + l_linenumber as id, 5000000000 + l_orderkey as node_id, 1 + cast(l_suppkey % 2 as int) as source_id, 1 + cast(l_partkey % 3 as int) as style_id, 'd' || cast(l_orderkey as string) || '_' || cast(l_linenumber as string) as sid, l_partkey as seq_id from {lineitem}"
SEQS = "select p_partkey as id, lower(p_name) as seq, case when p_size < 8 then 1 else 0 end as is_reject from {part}"
VERSIONED = f"select x.*, year(o_orderdate) as release_id from ({NODES}) x join {{orders}} on id = 5000000000 + o_orderkey"


@query("p4_select_sequences", f"with i as ({ITEMS}), s as ({SEQS}), n as ({VERSIONED}) select i.id, i.sid, sccs, seq_id, seq from i join s on seq_id = s.id join n on node_id = n.id where release_id = 1996 and source_id = 2 and style_id in (1, 2) and is_reject = 0 and substr(sccs, 1, 1) between 'a' and 'c'")
def p4(t: Tables) -> DataFrame:
    return lookup.select_sequences(t.sql(ITEMS), t.sql(SEQS), t.sql(VERSIONED), 1996, 2, [1, 2], classes=("a", "c"))


@query("p4_select_distinct_sequences", f"with i as ({ITEMS}), s as ({SEQS}), n as ({VERSIONED}) select seq_id, min(i.sid) as sid, min(seq) as seq from i join s on seq_id = s.id join n on node_id = n.id where release_id = 1997 and source_id = 1 and style_id = 3 and is_reject = 1 group by seq_id")
def p4u(t: Tables) -> DataFrame:
    return lookup.select_sequences(t.sql(ITEMS), t.sql(SEQS), t.sql(VERSIONED), 1997, 1, [3], rejects="only", classes=None, unique=True)




@query("p5_reject_flag", "select id, case when length(seq) < 20 or 5 * (length(seq) - length(replace(seq, 'x', ''))) > length(seq) then 1 else 0 end as is_reject from (select doc_id as id, regexp_replace(replace(lower(text), 'e', 'x'), '[^a-z]', '', 'g') as seq from documents)")
def p5(t: Tables) -> DataFrame:
    seq = F.regexp_replace(F.replace(F.lower("text"), F.lit("e"), F.lit("x")), "[^a-z]", "")
    return lookup.with_reject_flag(t("documents").select(F.col("doc_id").alias("id"), seq.alias("seq"))).select("id", "is_reject")


CHAINS = "select distinct l_orderkey * 10 + l_linenumber as id, l_orderkey as entry_id from {lineitem}"
SOURCES = "select distinct l_orderkey * 10 + l_linenumber as chain_id, case when l_partkey % 29 = 0 then 1 else 0 end as is_synthetic from {lineitem}"
ENTRIES = "select o_orderkey as id, case when o_orderkey % 41 = 0 then 'Designed ' else '' end || o_orderpriority as description from {orders}"


@query("p6_synthetic_flag", f"with c as ({CHAINS}), s as ({SOURCES}), e as ({ENTRIES}), m as (select entry_id from c join s on id = chain_id where is_synthetic = 1 union select id from e where lower(description) like '%design%' or lower(description) like '%synthesized%') select entry_id, id, entry_id in (select entry_id from m) as is_synthetic from c")
def p6(t: Tables) -> DataFrame:
    return lookup.with_synthetic_flag(t.sql(CHAINS), t.sql(SOURCES), t.sql(ENTRIES))


@query("p7_ribosomal_flag", WITH_CLOSED + "select id as node_id, exists(select 1 from closed c join nodes a on a.id = c.ancestor_id where c.node_id = n.id and a.level_id in (4, 5) and a.description like '%URG%') as is_ribosomal from nodes n where level_id = 8")
def p7(t: Tables) -> DataFrame:
    nodes = t.sql(NODES)
    return lookup.with_ribosomal_flag(nodes.filter("level_id = 8").select(F.col("id").alias("node_id")), tree.closure(nodes), nodes, "URG", (4, 5))


LINKS = "select l_orderkey as node_id, l_suppkey as chain_id from {lineitem}"


@query("p8_multi_chain_flag", f"select node_id, count(distinct chain_id) > 1 as is_multi_chain from ({LINKS}) group by node_id")
def p8(t: Tables) -> DataFrame:
    return lookup.with_multi_chain_flag(t.sql(LINKS))


DOMAINS = "select o_orderkey as id, 'd' || cast(o_orderkey as string) || case when o_custkey % 4 = 0 then '_' else 'a' end as sid from {orders}"
PARTS = "select l_orderkey as domain_id, l_returnflag as seq, case when l_linestatus = 'F' then l_returnflag else 'N' end as chain_seq from {lineitem}"


@query("p9_whole_chain_flag", f"with d as ({DOMAINS}), p as (select domain_id, bool_and(seq = chain_seq) as equal from ({PARTS}) group by domain_id) select id, sid, ends_with(sid, '_') or coalesce(equal, false) as is_whole_chain from d left join p on id = domain_id")
def p9(t: Tables) -> DataFrame:
    return lookup.with_whole_chain_flag(t.sql(DOMAINS), t.sql(PARTS))


SUPPLIERS = "select s_suppkey as id, s_nationkey as release_id from {supplier}"


@query("p9_all_chains_flag", f"with l as ({LINKS}), c as ({SUPPLIERS}), u as (select node_id, release_id, count(distinct chain_id) as n from l join c on chain_id = id group by all) select node_id, release_id, n = (select count(*) from c where c.release_id = u.release_id) as uses_all_chains from u")
def p9b(t: Tables) -> DataFrame:
    return lookup.with_all_chains_flag(t.sql(LINKS), t.sql(SUPPLIERS))


GATED = "select p_partkey as id, case when p_size % 9 = 0 then 'NMR' when p_size % 9 = 1 then null else 'X-RAY' end as method, case when p_partkey % 7 = 0 then null when p_partkey % 7 < 3 then 0.0 else cast(p_size as double) / 10 end as resolution, case when p_partkey % 11 = 0 then null when p_partkey % 5 = 0 then 'a model of ' || p_type else p_type end as title from {part}"


@query("p10_resolution_gate", f"select id, case when method is null or resolution >= 3.2 then 'low-res' when coalesce(resolution, 0) > 0 then null when method <> 'NMR' then 'unk-res' when title is null or contains(title, 'model') then 'nmr-model' end as reason from ({GATED})")
def p10(t: Tables) -> DataFrame:
    return lookup.resolution_gate(t.sql(GATED)).select("id", "reason")


HEADERS = "select p_partkey as id, case when p_partkey % 3 = 0 then upper(p_type) || ' DNA AND ATPASE' when p_partkey % 3 = 1 then 'RIBOSOMAL T7 RNA II, MHC T-CELL ' || upper(p_type) else 'Mixed DNA ' || p_type end as header from {part}"


@query("p11_clean_case", "select p_partkey as id, case when p_partkey % 3 = 0 then lower(p_type) || ' DNA and ATPase' when p_partkey % 3 = 1 then 'ribosomal T7 RNA II, MHC T-cell ' || lower(p_type) else 'Mixed DNA ' || p_type end as header from part")
def p11(t: Tables) -> DataFrame:
    return t.sql(HEADERS).select("id", text.clean_case(F.col("header")).alias("header"))


SPECIES = "select c_custkey as id, lower(c_mktsegment) || case when c_custkey % 2 = 0 then ' (Genus' || cast(c_nationkey as string) || ' kind)' else '' end || case when c_custkey % 3 = 0 then ', strain x' else '' end || case when c_custkey % 5 > 0 then ' [TaxId: ' || cast(c_custkey as string) || ']' else '' end as description from {customer}"


@query(
    "p12_parse_species",
    "select c_custkey as id, case when c_custkey % 2 = 0 then lower(c_mktsegment) end as common_name, case when c_custkey % 2 = 0 then 'Genus' || cast(c_nationkey as string) || ' kind' else lower(c_mktsegment) end as scientific_name, case when c_custkey % 3 = 0 then 'strain x' end as details, cast(case when c_custkey % 5 > 0 then c_custkey end as integer) as ncbi_taxid from {customer}",
)
def p12(t: Tables) -> DataFrame:
    return t.sql(SPECIES).select("id", text.parse_species(F.col("description")).alias("s")).select("id", "s.*")


@query(
    "p13_normalise_species",
    """with x as (select c_custkey as id, c_custkey % 4 as k, lower(c_mktsegment) as w, c_mktsegment as m from {customer})
 select id, case k when 0 then null when 1 then upper(substr(w, 1, 1)) || substr(w, 2) || ' alba' when 2 then upper(substr(w, 1, 1)) || substr(w, 2) || ' virus x' else upper(substr(w, 1, 1)) || substr(w, 2) || ' (Old) nova' end as name from x""",
)
def p13(t: Tables) -> DataFrame:
    given = t.sql("select c_custkey as id, case c_custkey % 4 when 0 then c_mktsegment when 1 then c_mktsegment || ' ALBA third' when 2 then c_mktsegment || ' VIRUS x' else lower(c_mktsegment) || ' (OLD) Nova sp.' end as name from {customer}")
    return given.select("id", text.normalise_species(F.col("name")).alias("name"))


COMMENTS = "select doc_id as node_id, text || ' Pfam ' || lpad(cast(doc_id % 100 as string), 5, '0') || ', Pfam 00001 and Pfam 12; PfamB 0' || cast(10000 + doc_id % 9 as string) || ' PubMed ' || cast(doc_id as string) || case when doc_id % 3 = 0 then ' <a href=http://www.uniprot.org/uniprot/P1>P1234' || cast(doc_id % 10 as string) || '</a> SQ P00001' when doc_id % 3 = 1 then ' SQ Q9XYZ' || cast(doc_id % 10 as string) || ', SQ q12345' else '' end as description from {documents}"


@query(
    "p14_extract_xrefs",
    f"""with c as ({COMMENTS}) select distinct node_id, 'pfam' as db, 'PF' || unnest(regexp_extract_all(description, 'Pfam ([0-9]{{5}})', 1)) as accession from c union all select distinct node_id, 'pfamb', 'PB' || unnest(regexp_extract_all(description, 'PfamB ([0-9]{{6}})', 1)) from c
 union all select distinct node_id, 'pubmed', unnest(regexp_extract_all(description, 'PubMed ([0-9]+)', 1)) from c union all select distinct node_id, 'uniprot', 'P1234' || node_id % 10 from c where node_id % 3 = 0 union all select distinct node_id, 'uniprot', 'Q9XYZ' || node_id % 10 from c where node_id % 3 = 1""",
)
def p14(t: Tables) -> DataFrame:
    comments = t.sql(COMMENTS)
    parts = [lookup.extract_xrefs(comments, db).select("node_id", F.lit(db).alias("db"), "accession") for db in ("pfam", "pfamb", "pubmed", "uniprot")]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


CHAIN_LINKS = "select l_orderkey as node_id, l_suppkey as chain_id, o_custkey as release_id from {lineitem} join {orders} on l_orderkey = o_orderkey"
COMPOUNDS = "select s_suppkey as chain_id, case when s_suppkey % 17 = 0 then 'Mutant of ' || s_name else s_name end as description from {supplier}"
TITLES = "select c_custkey as release_id, case when c_custkey % 7 = 0 then 'A Mutation in ' || c_mktsegment else c_mktsegment end as title, case c_nationkey % 4 when 0 then 'DNA Complex' when 1 then 'complex of RNA and DNA' when 2 then 'RNA' end as class, cast(null as string) as keywords from {customer}"
LIGANDS = "select o_custkey as release_id, case when o_orderpriority like '1%' then 'HOH' else substr(o_orderpriority, 3) end as description from {orders} where o_custkey % 3 > 0"


@query(
    "p15_auto_comments",
    f"""with l as ({CHAIN_LINKS}), n as (select node_id, max(release_id) as release_id, bool_or(chain_id % 17 = 0) as mutant from l group by 1),
 b as (select release_id, array_to_string(list_sort(list_distinct(list(lower(description)))), ', ') as codes from ({LIGANDS}) where description <> 'HOH' group by 1),
 j as (select node_id, array_to_string(list_filter([case when c_nationkey % 4 < 2 then 'protein/DNA complex' end, case when c_nationkey % 4 = 1 then 'protein/RNA complex' end, 'complexed with ' || codes, case when mutant or release_id % 7 = 0 then 'mutant' end], lambda x: x is not null), '; ') as description
  from n join customer on c_custkey = release_id left join b using (release_id)) select * from j where description <> ''""",
)
def p15(t: Tables) -> DataFrame:
    return lookup.auto_comments(t.sql(CHAIN_LINKS), t.sql(COMPOUNDS), t.sql(TITLES), t.sql(LIGANDS))
