"""Queries of residue maps, over whole documents taken as chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.functions.text import is_nucleotide
from cladeforge.operators import residues as r
from cladeforge.plans.registry import Tables, query

#: DuckDB: letters of each document, and the residues that their maps hold; every seventh isn't observed.
WITH = """with l as (select doc_id as pdb_chain_id, regexp_replace(lower(text), '[^a-z]', '', 'g') as s from documents),
 res as (select pdb_chain_id, i as idx, cast(i % 9973 + 1 as varchar) as res_id, case when i % 7 = 0 then null when i % 31 = 5 then 'q' else s[i + 1] end as atom, s[i + 1] as seq from (select *, unnest(range(0, length(s))) as i from l)) """


def maps(t: Tables) -> DataFrame:
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    record = lambda x, i: F.concat(F.lpad((i % 9973 + 1).cast("string"), 5, " "), F.when(i % 7 == 0, ".").when(i % 31 == 5, "q").otherwise(x), x)
    body = F.array_join(F.transform(F.filter(F.split(letters, ""), lambda x: x != ""), record), "")
    return t("documents").select(F.col("doc_id").alias("pdb_chain_id"), F.concat(F.rpad(F.lit("head"), 38, " "), body).alias("line"))


@query("q1_explode_residues", WITH + "select pdb_chain_id, cast(idx as integer) as idx, res_id, atom, seq, atom is not null as observed from res")
def q1(t: Tables) -> DataFrame:
    return r.explode_residues(maps(t))


def _seq(expression: str, where: str = "true") -> str:
    return WITH + f"select l.pdb_chain_id, coalesce(string_agg({expression}, '' order by idx) filter (where {where}), '') as seq from l left join res using (pdb_chain_id) group by 1"


@query("q2_chain_sequence_atom", _seq("atom", "atom is not null"))
def q2(t: Tables) -> DataFrame:
    return r.chain_sequence(maps(t), r.ATOM)


@query("q2_chain_sequence_cut", WITH + ", b as (select pdb_chain_id, min(idx) as lo, max(idx) as hi from res where atom is not null group by 1) select l.pdb_chain_id, coalesce(string_agg(seq, '' order by idx) filter (where idx between lo and hi), '') as seq from l left join res using (pdb_chain_id) left join b using (pdb_chain_id) group by 1")
def q2c(t: Tables) -> DataFrame:
    return r.chain_sequence(maps(t), r.SEQRES_CUT)


TAGS = "select doc_id as pdb_chain_id, 'N' as type, 0 as tag_start, cast(doc_id % 20 as int) as tag_end from {documents} where doc_id % 3 = 0 union all select doc_id, 'C', cast(40 + doc_id % 20 as int), 80 from {documents} where doc_id % 4 = 0"


@query("q3_tagless_sequence", _seq("seq", "(l.pdb_chain_id % 3 > 0 or idx > l.pdb_chain_id % 20) and (l.pdb_chain_id % 4 > 0 or idx < 40 + l.pdb_chain_id % 20)"))
def q3(t: Tables) -> DataFrame:
    return r.tagless_sequence(maps(t), t.sql(TAGS))


REGIONS = "select doc_id as pdb_chain_id, cast(doc_id % 50 + 1 as string) as start_id, cast(doc_id % 90 + 10 as string) as end_id from {documents}"


@query(
    "q4_region_sequence",
    WITH + f""", g as ({REGIONS}), b as (select pdb_chain_id, start_id, end_id, min(idx) filter (where res_id = start_id) as lo, max(idx) filter (where res_id = end_id) as hi from g left join res using (pdb_chain_id) group by 1, 2, 3)
 select pdb_chain_id, start_id, end_id, case when lo <= hi then (select coalesce(string_agg(atom, '' order by idx) filter (where atom is not null), '') from res where res.pdb_chain_id = b.pdb_chain_id and idx between lo and hi) end as seq from b""",
)
def q4(t: Tables) -> DataFrame:
    return r.region_sequence(t.sql(REGIONS), maps(t), r.ATOM)


DOMAINS = """select doc_id as domain_id, 1 as position, doc_id as pdb_chain_id, cast(doc_id % 30 + 1 as string) as start_id, cast(doc_id % 30 + 25 as string) as end_id from {documents}
 union all select doc_id, 2, doc_id + 1, '3', '40' from {documents} where doc_id % 4 = 0"""


@query(
    "q5_domain_sequences",
    WITH + f""", d as ({DOMAINS}), b as (select domain_id, position, pdb_chain_id, min(idx) filter (where res_id = start_id) as lo, max(idx) filter (where res_id = end_id) as hi from d left join res using (pdb_chain_id) group by 1, 2, 3),
 p as (select b.*, case when lo <= hi then (select string_agg(seq, '' order by idx) from res where res.pdb_chain_id = b.pdb_chain_id and idx between lo and hi) end as text from b),
 e as (select domain_id, count(distinct pdb_chain_id) as chains, case when bool_and(text is not null) then string_agg(text, 'X' order by position) else '' end as seq from p group by 1),
 u as (select domain_id, case when chains > 1 then 3 else 1 end as style, cast(null as bigint) as chain, seq from e union all select domain_id, 2, pdb_chain_id, coalesce(text, '') from p where domain_id in (select domain_id from e where chains > 1))
 select *, case when length(seq) < 20 or 5 * (length(seq) - length(replace(seq, 'x', ''))) > length(seq) then 1 else 0 end as is_reject from u""",
)
def q5(t: Tables) -> DataFrame:
    return r.domain_sequences(t.sql(DOMAINS), maps(t), r.SEQRES)


HEADED = "select l_orderkey * 10 + l_linenumber as id, 'd' || cast(l_orderkey as string) as sid, 'a.' || cast(l_suppkey as string) as sccs, 'A:1-' || cast(l_partkey as string) as regions, p_type as protein, p_brand as species from {lineitem} join {part} on l_partkey = p_partkey"


@query("q6_domain_header", f"select id, sid || ' ' || sccs || ' (' || regions || ') ' || protein || ' {{' || species || '}}' as header from ({HEADED})".replace("{{", "{").replace("}}", "}"))
def q6(t: Tables) -> DataFrame:
    return r.domain_header(t.sql(HEADED))


POINTS = "select doc_id as pdb_chain_id, cast(doc_id % 200 as int) as seq_idx from {documents}"


@query("q7_index_to_map", WITH + f", o as (select pdb_chain_id, idx, row_number() over (partition by pdb_chain_id order by idx) - 1 as k from res where atom is not null) select p.pdb_chain_id, seq_idx, cast(idx as integer) as idx from ({POINTS}) p left join o on o.pdb_chain_id = p.pdb_chain_id and k = seq_idx")
def q7(t: Tables) -> DataFrame:
    return r.index_to_map(t.sql(POINTS), maps(t), r.ATOM)


@query("q7_map_to_index", WITH + f", o as (select pdb_chain_id, idx, row_number() over (partition by pdb_chain_id order by idx) - 1 as k from res where atom is not null) select p.pdb_chain_id, p.seq_idx as idx, k as seq_idx from ({POINTS}) p left join o on o.pdb_chain_id = p.pdb_chain_id and o.idx = p.seq_idx")
def q7m(t: Tables) -> DataFrame:
    return r.map_to_index(t.sql(POINTS).withColumnRenamed("seq_idx", "idx"), maps(t), r.ATOM)


@query(
    "q8_observed_context",
    WITH + """, w as (select pdb_chain_id, idx, atom is not null as o, min(case when atom is not null then idx end) over a as nx, max(case when atom is not null then idx end) over b as pv, coalesce(max(case when atom is null then idx end) over b + 1, 0) as rs,
   coalesce(min(case when atom is null then idx end) over a - 1, max(idx) over (partition by pdb_chain_id)) as re, sum(case when atom is null then 1 else 0 end) over b - case when atom is null then 1 else 0 end as g from res
   window a as (partition by pdb_chain_id order by idx rows between current row and unbounded following), b as (partition by pdb_chain_id order by idx rows between unbounded preceding and current row))
 select pdb_chain_id, cast(idx as integer) as idx, cast(nx as integer) as next_observed, cast(pv as integer) as previous_observed, cast(case when o then rs end as integer) as run_start, cast(case when o then re end as integer) as run_end, cast(g as bigint) as gaps_before from w""",
)
def q8(t: Tables) -> DataFrame:
    return r.observed_context(maps(t))


MODIFIED = "select l_orderkey * 100000 + l_linenumber * 10000 + l_partkey % 1000 as id, min(replace(substr('acdefgh', l_linenumber), 'd', case when l_partkey % 3 = 0 then '(MSE)' when l_partkey % 3 = 1 then '(ZZZ)' else '.' end)) as text from {lineitem} group by 1"


@query("q9_translate_modified", f"select id, replace(replace(replace(text, '.', ''), '(MSE)', 'm'), '(ZZZ)', 'x') as seq from ({MODIFIED})")
def q9(t: Tables) -> DataFrame:
    codes = t.sql("select case when r_regionkey = 0 then 'MSE' else 'Q' || cast(r_regionkey as string) end as code, 'm' as letter from {region}")
    return r.translate_modified(t.sql(MODIFIED), codes)


BASES = "select doc_id as id, case when doc_id % 3 = 0 then 'acgtxacgtnu' || substr(lower(text), 1, cast(doc_id % 2 as int)) else lower(text) end as seq from {documents}"


@query("q10_is_nucleotide", f"with h as (select id, substr(replace(seq, 'x', ''), 1, 100) as h from ({BASES})) select id, length(h) > 0 and 100 * length(regexp_replace(h, '[^acgtun]', '', 'g')) >= 95 * length(h) as is_nucleotide from h")
def q10(t: Tables) -> DataFrame:
    return t.sql(BASES).select("id", is_nucleotide(F.col("seq")).alias("is_nucleotide"))


@query(
    "q11_map_audit",
    WITH + """, m as (select pdb_chain_id, atom, seq, cast(res_id as integer) < lag(cast(res_id as integer)) over (partition by pdb_chain_id order by idx) as falls from res)
 select pdb_chain_id, 'missing' as issue, count(*) as n from m where atom is null group by 1 union all select pdb_chain_id, 'mismatch', count(*) from m where atom <> seq group by 1 union all select pdb_chain_id, 'not-sequential', count(*) from m where falls group by 1""",
)
def q11(t: Tables) -> DataFrame:
    return r.map_audit(maps(t))


STORED = "select doc_id as id, case when doc_id % 5 = 0 then 'changed' else regexp_replace(lower(text), '[^a-z]', ''{g}) end as seq from {documents}"


@query("q12_recheck_sequences", WITH + f", s as ({STORED.replace('{g}', ', ' + repr('g'))}) select l.pdb_chain_id, 0 as is_reject, case when length(l.s) < 20 or 5 * (length(l.s) - length(replace(l.s, 'x', ''))) > length(l.s) then 1 else 0 end as flag from l join s on id = l.pdb_chain_id where s.seq <> l.s or case when length(l.s) < 20 or 5 * (length(l.s) - length(replace(l.s, 'x', ''))) > length(l.s) then 1 else 0 end <> 0")
def q12(t: Tables) -> DataFrame:
    chains = t.sql("select doc_id as pdb_chain_id, doc_id as seq_id from {documents}")
    return r.recheck_sequences(chains, t.sql(STORED.replace("{g}", "")).withColumn("is_reject", F.lit(0)), maps(t), r.SEQRES)


ENTRY_CHAINS = "select l_orderkey as entry_id, l_suppkey as seq_id from {lineitem}"
NAMES = "select s_suppkey as id, substr(s_name, 1, 5 + cast(s_suppkey % 9 as int)) as seq from {supplier}"


@query("q13_residues_per_entry", f"select entry_id, sum(length(seq)) as residues from (select distinct entry_id, seq_id from ({ENTRY_CHAINS})) join ({NAMES}) on id = seq_id group by 1".replace("sum(length(seq))", "cast(sum(length(seq)) as bigint)"))
def q13(t: Tables) -> DataFrame:
    return r.residues_per_entry(t.sql(ENTRY_CHAINS), t.sql(NAMES), unique=True)
