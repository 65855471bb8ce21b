"""Queries that write the flat files of the tables and read them again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.operators import tree
from cladeforge.operators.residues import SEQRES, chain_sequence
from cladeforge.plans.registry import Tables, query
from cladeforge.plans.residue_queries import maps
from cladeforge.plans.shapes import LINES, NODES, WITH_CLOSED
from cladeforge.sources import flatfiles as f
from cladeforge.sources.scratch import fresh_path, kept, written


def _written(t: Tables, write: Callable[[str], None]) -> str:
    write(path := fresh_path(t.spark, "file"))
    return path


def _text(t: Tables, write: Callable[[str], None]) -> DataFrame:
    """The lines of a file, numbered by nothing but themselves."""
    return t.spark.read.text(_written(t, write)).toDF("line")


@query("s1_read_nodes", f"select sunid, level_id, sccs, sid, description, 7 as release_id from ({NODES})")
def s1(t: Tables) -> DataFrame:
    return f.read_nodes(t.spark, _written(t, lambda p: f.write_des(t.sql(NODES), p)), 7)


@query("s2_read_hierarchy", f"with n as ({NODES}) select n.sunid, p.sunid as parent_sunid from n left join n p on p.id = n.parent_node_id")
def s2(t: Tables) -> DataFrame:
    nodes = kept(t.sql(NODES))
    return f.read_hierarchy(t.spark, _written(t, lambda p: f.write_hie(nodes, p)), nodes.select("sunid"))


COMMENTS = f"select o * 10 as sunid, n as number, case n when 1 then 'complexed with ' || flag when 2 then 'automatically matched to d' || cast(o as string) || 'a_' else 'note ' || flag || '<a>' || state end as description from ({LINES}) x"


@query("s3_read_comments", f"with c as ({COMMENTS}) select sunid, cast(row_number() over (partition by sunid order by number) - 1 as int) as number, replace(description, '<a>', '') as description, case when number < 3 then 1 else 0 end as is_autogenerated from c")
def s3(t: Tables) -> DataFrame:
    return f.read_comments(t.spark, _written(t, lambda p: f.write_com(t.sql(COMMENTS), p)))


HISTORY = f"select 'd' || cast(o as string) as old_id, 'sid' as kind, 1 + cast(supp % 7 as int) as change_type, case when supp % 7 < 3 then null else 'd' || cast(part as string) end as new_id, '2.07-2.08' as releases from ({LINES}) x"


@query("s4_read_history", f"select distinct old_id, kind, change_type, new_id, releases from ({HISTORY})")
def s4(t: Tables) -> DataFrame:
    return f.read_history(t.spark, _written(t, lambda p: f.write_history(t.sql(HISTORY), p)))


RAF = f"select lpad(cast(o % 10000 as string), 4, '0') || 'A 0.03 38 260706 111010' || lpad(cast(n as string), 6, ' ') || lpad(cast(n + 1 as string), 5, ' ') || lpad(cast(n as string), 5, ' ') || 'aa' || lpad(cast(n + 1 as string), 5, ' ') || '.g' as line from ({LINES}) x"


@query("s5_read_raf", f"select substr(line, 1, 4) as code, substr(line, 5, 1) as chain, trim(substr(line, 29, 5)) as first_id, trim(substr(line, 34, 5)) as last_id, line from ({RAF})")
def s5(t: Tables) -> DataFrame:
    return f.read_raf(t.spark, _written(t, lambda p: f.write_raf(t.sql(RAF), p)))


SCORES = "select 'c' || cast(p_partkey as string) as code, cast(p_size as double) / 4 as aerospaci, case when p_size % 7 = 0 then null else cast(p_size as double) / 2 end as spaci, 'X-RAY' as method, case when p_size % 5 = 0 then 0.0 when p_size % 9 = 0 then null else cast(p_size as double) / 4 end as resolution, cast(p_partkey % 4 as double) / 8 as r_factor from {part}"


@query("s6_read_quality", f"select code, aerospaci, spaci, method, cast(nullif(resolution, 0) as double) as resolution, nullif(r_factor, 0) as r_factor, 3 as release_id from ({SCORES})")
def s6(t: Tables) -> DataFrame:
    return f.read_quality(t.spark, _written(t, lambda p: f.write_quality(t.sql(SCORES), p)), 3)


PAIRS = f"select 'd' || cast(o as string) as sid1, 'd' || cast(part as string) as sid2, cast(supp % 5 as int) as depth, case when qty = 7 then -9999.0 else -cast(qty as double) / 2 end as blast_log10_e, cast(n as int) as start1, cast(case when supp % 11 = 0 then 0 else 10 + n end as int) as length1, cast(2 * n as int) as start2, cast(9 + n as int) as length2, cast(qty as double) as pct_identical from ({LINES}) x"


LOG_E = "case when blast_log10_e <= -9999 then -9999 when blast_log10_e > -4 then log10(round(pow(10, blast_log10_e), cast(2 - floor(blast_log10_e) as int))) else floor(blast_log10_e) + log10(round(pow(10, blast_log10_e - floor(blast_log10_e)), 2)) end"
E_TEXT = "case when blast_log10_e <= -9999 then '0' when blast_log10_e > -4 then regexp_replace(printf('%.6f', round(pow(10, blast_log10_e), cast(2 - floor(blast_log10_e) as int))), '[.]?0+$', '') else regexp_replace(printf('%.2f', pow(10, blast_log10_e - floor(blast_log10_e))), '[.]?0+$', '') || 'e' || printf('%03d', cast(floor(blast_log10_e) as int)) end"


@query("s7_read_hit_summary", f"select sid1, sid2, cast(round({LOG_E}, 6) as double) as blast_log10_e, start1, length1, start2, length2 from ({PAIRS}) where length1 > 0")
def s7(t: Tables) -> DataFrame:
    return f.read_hit_summary(t.spark, _written(t, lambda p: f.write_pairs(t.sql(PAIRS), "bg", p)), "bg").withColumn("blast_log10_e", F.round("blast_log10_e", 6))


@query("s8_read_fasta", "with s as (select 'd' || cast(doc_id as string) as name, lang as description, regexp_replace(lower(text), '[^a-z]', '', 'g') as seq from documents) select * from s where length(seq) > 0")
def s8(t: Tables) -> DataFrame:
    seqs = chain_sequence(maps(t), SEQRES).join(t("documents").select(F.col("doc_id").alias("pdb_chain_id"), "lang"), "pdb_chain_id").select(F.concat(F.lit("d"), "pdb_chain_id").alias("sid"), F.col("lang").alias("description"), "seq")
    return f.read_fasta(t.spark, _written(t, lambda p: f.write_fasta(seqs, p, "chain")))



@query("s9_read_structural_clusters", "select 'd' || lpad(cast(min(case when c_custkey % 3 > 0 then c_custkey end) over (partition by c_nationkey) as string), 6, '0') as rep, 'd' || lpad(cast(c_custkey as string), 6, '0') as member from (select * from customer where c_custkey % 3 > 0)")
def s9(t: Tables) -> DataFrame:
    own = t("customer").withColumn("sid", F.concat(F.lit("d"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")))
    texts = own.groupBy("c_nationkey").agg(F.concat(F.lit("a."), F.col("c_nationkey"), F.lit("\n"), F.array_join(F.array_sort(F.collect_list("sid")), " ")).alias("line"))
    return f.read_structural_clusters(t.spark, _written(t, lambda p: texts.select("line").write.text(p)), own.filter("c_custkey % 3 > 0"))


STATS = "select 'Align a' || cast(p_partkey as string) || '.pdb ' || cast(100 + p_size as string) || ' with b.ent ' || cast(90 + p_size as string) || chr(10) || 'Twists 0 ini-len ' || cast(p_size as string) || ' ini-rmsd 1.5 opt-equ ' || cast(p_partkey as string) || ' opt-rmsd 2.25 chain-rmsd 3.5 Score ' || cast(p_partkey % 100 as string) || '.75 align-len 70 gaps 5 (3.23%)' || chr(10) || 'P-value 1.50e-0' || cast(p_partkey % 5 as string) || ' Afp-num 7 Identity 42.50% Similarity 57.25%' as line from {part}"


@query("s10_read_alignment_stats", "select 100 + p_size as chain_len, 90 + p_size as domain_len, p_size as ini_len, cast(1.5 as double) as ini_rmsd, cast(p_partkey as int) as opt_equ, cast(2.25 as double) as opt_rmsd, cast(3.5 as double) as chain_rmsd, cast(p_partkey % 100 as double) + 0.75 as score, 70 as align_len, 5 as gaps, cast('1.5e-0' || cast(p_partkey % 5 as string) as double) as p_value, 7 as afp_num, cast(42.5 as double) as identity, cast(57.25 as double) as similarity from {part}")
def s10(t: Tables) -> DataFrame:
    return f.read_alignment_stats(t.spark, _written(t, lambda p: t.sql(STATS).write.text(p)))


@query("s11_write_cla", WITH_CLOSED + "select sid || chr(9) || split_part(description, ' ', 1) || chr(9) || split_part(description, ' ', 2) || chr(9) || sccs || chr(9) || sunid || chr(9) || 'cl=' || min(case when ancestor_level = 2 then ancestor_id end) || ',cf=' || min(case when ancestor_level = 3 then ancestor_id end) || ',sf=' || min(case when ancestor_level = 4 then ancestor_id end) || ',fa=' || min(case when ancestor_level = 5 then ancestor_id end) || ',px=' || sunid as line from nodes join closed on node_id = id where level_id = 8 group by id, sid, description, sccs, sunid")
def s11(t: Tables) -> DataFrame:
    nodes = written(t.sql(NODES))
    return _text(t, lambda p: f.write_cla(nodes, tree.wide_lineage(tree.closure(nodes), nodes), p))


@query("s12_write_des", f"select sunid || chr(9) || case level_id when 2 then 'cl' when 3 then 'cf' when 4 then 'sf' when 5 then 'fa' else 'px' end || chr(9) || sccs || chr(9) || coalesce(sid, '-') || chr(9) || description as line from ({NODES}) where level_id > 1")
def s12(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_des(t.sql(NODES), p))


@query("s13_write_hie", f"with n as ({NODES}), c as (select parent_node_id as id, string_agg(cast(sunid as string), ',' order by id) as kids from n where parent_node_id is not null group by 1) select n.sunid || chr(9) || coalesce(cast(p.sunid as string), '-') || chr(9) || coalesce(kids, '-') as line from n left join n p on p.id = n.parent_node_id left join c on c.id = n.id")
def s13(t: Tables) -> DataFrame:
    nodes = kept(t.sql(NODES))
    return _text(t, lambda p: f.write_hie(nodes, p))


@query("s14_write_com", f"select sunid || ' ! ' || string_agg(description, ' ! ' order by number) as line from ({COMMENTS}) group by sunid")
def s14(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_com(t.sql(COMMENTS), p))


REPEATS = "select 8000000000 + l_orderkey * 10 + l_linenumber as node_id, 'repeat ' || l_returnflag as description, l_returnflag as kind from {lineitem} where l_quantity < 9"


@query("s14_write_rep", f"with n as ({NODES}) select sid || chr(9) || string_agg(r.description, ' ! ' order by r.description) as line from n join ({REPEATS}) r on node_id = id group by id, sid")
def s14r(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_rep(t.sql(NODES), t.sql(REPEATS), p))


@query("s14_write_inc", f"with n as ({NODES}) select sccs || chr(9) || kind || chr(9) || string_agg(sid, ',' order by sid) as line from n join ({REPEATS}) r on node_id = id group by sccs, kind")
def s14i(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_inc(t.sql(NODES), t.sql(REPEATS).select("node_id", "kind"), p))


@query("s15_write_history", f"select old_id || chr(9) || kind || chr(9) || '(' || change_type || ':' || case when change_type <= 3 then '-' else array_to_string(list_sort(list_distinct(list(new_id))), ',') end || ')' || chr(9) || releases as line from ({HISTORY}) group by old_id, kind, releases, change_type")
def s15(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_history(t.sql(HISTORY), p))


@query("s16_write_raf", RAF)
def s16(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_raf(t.sql(RAF), p))


@query("s16_write_quality", f"select code || chr(9) || printf('%.2f', aerospaci) || chr(9) || coalesce(printf('%.2f', spaci), 'NA') || chr(9) || method || chr(9) || coalesce(printf('%.2f', cast(resolution as double)), 'NA') || chr(9) || printf('%.3f', r_factor) as line from ({SCORES})")
def s16q(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_quality(t.sql(SCORES), p))


@query("s16_write_xrefs", "select distinct p_brand || chr(9) || 'd' || cast(p_partkey as string) as line from {part}")
def s16x(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_xrefs(t.sql("select p_brand as accession, 'd' || cast(p_partkey as string) as sid from {part}"), p))


@query("s17_write_fasta", "with s as (select doc_id, regexp_replace(lower(text), '[^a-z]', '', 'g') as s from documents), w as (select doc_id, unnest(range(0, (length(s) + 59) // 60)) as i, s from s where length(s) > 0) select '>d' || doc_id as line from s where length(s) > 0 union all select substr(s, i * 60 + 1, 60) from w")
def s17(t: Tables) -> DataFrame:
    seqs = chain_sequence(maps(t), SEQRES).select(F.concat(F.lit("d"), "pdb_chain_id").alias("sid"), "seq")
    return _text(t, lambda p: f.write_fasta(seqs, p))


@query("s18_write_pairs", f"select sid1 || ' ' || sid2 || ' ' || printf('%.2f', pct_identical) || ' ' || depth as line from ({PAIRS})")
def s18(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_pairs(t.sql(PAIRS), "bib", p))


@query("s18_write_pairs_bg", f"select sid1 || ' ' || sid2 || ' ' || {E_TEXT} || ' ' || depth || ' ' || (start1 + 1) || ' ' || (start1 + length1) || ' ' || (start2 + 1) || ' ' || (start2 + length2) as line from ({PAIRS}) where length1 > 0")
def s18b(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_pairs(t.sql(PAIRS), "bg", p))


SUBSET = "select 40.0 as threshold, c_custkey % 50 as rep, c_custkey as item, floor(c_acctbal) as score from {customer}"


@query("s19_write_subsets", f"select rep || ': ' || string_agg(item || ' ' || printf('%.2f', cast(score as double)), ', ' order by -score, item) as line from ({SUBSET}) group by rep")
def s19(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_subsets(t.sql(SUBSET).withColumn("score", F.col("score").cast("double")), "log", p))


SUBSET_SEQS = "select c_custkey as item, 'd' || cast(c_custkey as string) as sid, 'd' || cast(c_custkey as string) || ' ' || c_name as header, lower(c_mktsegment) as seq from {customer}"


@query("s19_write_subsets_fasta", f"with q as ({SUBSET_SEQS}), r as (select * from q where item in (select rep from ({SUBSET}))) select '>' || header as line from r union all select seq from r")
def s19f(t: Tables) -> DataFrame:
    return _text(t, lambda p: f.write_subsets(t.sql(SUBSET), "fasta", p, t.sql(SUBSET_SEQS)))


ANNOTATED = f"""select o as chain_id, cast(n as int) as number, cast(n as string) as suffix, case when n % 5 = 0 then 'none' when n % 5 = 1 then 'blast' when n % 5 = 2 then 'pfam' when n % 5 = 3 then 'fam' else 'sf' end as source, case when n % 5 = 1 then '1.5' || chr(32) || 'd' || cast(supp as string) else '2.0' end as info,
 'a.1.' || cast(part as string) as family, n * 10 as start, n * 10 + 5 as "end", 0 as region, case when part % 7 = 0 then -9999.0 else cast(-qty * qty / 4 as double) end as log10e from ({LINES}) x"""
ANNOTATED += ANNOTATED.replace("select o as", " union all select o as", 1).replace("n * 10 as start, n * 10 + 5", "n * 10 + 7, n * 10 + 9").replace("0 as region", "1") + " where part % 2 = 0"
PREDICTED_CHAINS = "select o_orderkey as chain_id, 'e' || cast(o_orderkey as string) as sid from {orders}"
_VERBOSE = "case source when 'none' then '[UNMATCHED]' when 'blast' then '[ASTRAL-1.5-BLAST-' || substr(info, 5) || ']a.1' when 'pfam' then '[PFAM-' || info || ']' || family when 'fam' then '[ASTRALfam-' || info || ']' || family else '[ASTRALsf-' || info || ']' || family end"


@query(
    "s20_write_predictions",
    f"""with a as (select *, {_VERBOSE} as name from ({ANNOTATED})), g as (select chain_id, number, name, min(start) + 1 as s, max("end") as e, string_agg((start + 1) || '-' || "end", ',' order by region) as regions, min(log10e) as v from a group by 1, 2, 3)
 select name || ' ' || s || ' ' || e || ' ' || regions || ' 0.0 ' || case when v = -9999 then '-9999' when v > -10 then printf('%.14f', v) when v > -100 then printf('%.13f', v) else printf('%.12f', v) end as line from g union all select '>' || sid from ({PREDICTED_CHAINS})""",
)
def s20(t: Tables) -> DataFrame:
    rows = t.sql(ANNOTATED.replace('"end"', "`end`"))
    named = rows.withColumn("name", f.prediction_name(F.col("source"), F.col("info"), F.col("family"), verbose=True))
    return _text(t, lambda p: f.write_predictions(named, t.sql(PREDICTED_CHAINS), p))
