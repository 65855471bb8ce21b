"""Queries on hits and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.operators import regions as b
from cladeforge.plans.registry import Tables, query
from cladeforge.plans.residue_queries import WITH, maps
from cladeforge.plans.shapes import LINES

RAW = "select l_orderkey * 10 + l_linenumber as hit_id, cast(l_quantity as int) as identities, 100 + l_linenumber as len1, cast(50 + l_quantity as int) as len2, case when l_quantity = 7 then 0.0 else cast(l_quantity as double) / 1000 end as evalue from {lineitem}"


@query("b1_hit_metrics", f"select hit_id, round(200.0 * identities / (len1 + len2), 9) as pct_identical, round(cast(case when evalue = 0 then -9999.0 else log10(evalue) end as double), 9) as blast_log10_e from ({RAW})".replace("round(200.0 * identities / (len1 + len2), 9)", "round(cast(200 * identities as double) / (len1 + len2), 9)"))
def b1(t: Tables) -> DataFrame:
    return b.hit_metrics(t.sql(RAW)).select("hit_id", F.round("pct_identical", 9).alias("pct_identical"), F.round("blast_log10_e", 9).alias("blast_log10_e"))


ALIGNED = "select doc_id as hit_id, text as query, regexp_replace(text, '[aeiou, ]', '-'{g}) as hit, doc_id % 7 as start from {documents}"


@query(
    "b2_alignment_gaps",
    f"""with a as ({ALIGNED.replace('{g}', ", 'g'")}), c as (select hit_id, start, query, hit, unnest(range(1, length(hit) + 1)) as i from a),
 d as (select hit_id, start, i, i - row_number() over (partition by hit_id order by i) as run from c where hit[i] = '-'),
 g as (select hit_id, start, min(i) as lo, max(i) as hi from d group by hit_id, start, run having count(*) >= 3)
 select hit_id, start + (lo - 1) - (length(substr(query, 1, lo - 1)) - length(replace(substr(query, 1, lo - 1), '-', ''))) as gap_start, hi - lo + 1 - (length(substr(query, lo, hi - lo + 1)) - length(replace(substr(query, lo, hi - lo + 1), '-', ''))) as gap_length
 from g join a using (hit_id, start) where hi < length(hit)""",
)
def b2(t: Tables) -> DataFrame:
    return b.alignment_gaps(t.sql(ALIGNED.replace("{g}", "")), 3)


SPANS = "select o_orderkey as hit_id, 0 as start, 100 as length from {orders}"
GAPS = f"select o as hit_id, n * 10 as gap_start, cast(qty as bigint) % 9 + 1 as gap_length from ({LINES}) x"


@query(
    "b3_hit_regions",
    f"""with g as ({GAPS}), x as (select hit_id, 0 as start, coalesce(lead(gap_start, 0) over (partition by hit_id order by gap_start), 100) as e, row_number() over (partition by hit_id order by gap_start) as r from g where false),
 p as (select hit_id, coalesce(lag(gap_start + gap_length) over (partition by hit_id order by gap_start), 0) as start, gap_start as e from g union all select hit_id, max(gap_start + gap_length), 100 from g group by hit_id union all select hit_id, 0, 100 from ({SPANS}) where hit_id not in (select hit_id from g))
 select hit_id, start, e - start as length from p where e > start""",
)
def b3(t: Tables) -> DataFrame:
    return b.hit_regions(t.sql(SPANS), t.sql(GAPS))


HITS = "select l_orderkey * 10 + l_linenumber as hit_id, l_orderkey as chain_id, l_suppkey as seq1_id, l_partkey as seq2_id, 1 + l_linenumber % 2 as style2_id, -cast(l_quantity as double) / 4 as blast_log10_e, cast(l_quantity as bigint) as length from {lineitem}"
TARGETS = "select p_partkey as id, p_partkey as seq_id, 1 + p_size % 2 as style_id, chr(97 + p_size % 12) || '.1' as sccs from {part}"


@query("b4_significant_hits", f"select hit_id, target_id, blast_log10_e from ({HITS}) h join (select id as target_id, seq_id, style_id from ({TARGETS}) where substr(sccs, 1, 1) between 'a' and 'h') d on seq_id = seq2_id and style_id = style2_id where blast_log10_e <= -4")
def b4(t: Tables) -> DataFrame:
    return b.significant_hits(t.sql(HITS), t.sql(TARGETS)).select("hit_id", "target_id", "blast_log10_e")


MODEL_HITS = "select l_orderkey * 10 + l_linenumber as hit_id, l_partkey as model_id, l_quantity as score, cast(l_quantity as int) as hmm_length from {lineitem}"
MODELS = "select p_partkey as id, p_size as length, cast(p_size as double) as trusted_cutoff, p_partkey % 4 as type_id from {part}"


@query("b4_significant_model_hits", f"select hit_id, model_id from ({MODEL_HITS}) h join ({MODELS}) m on m.id = model_id where score >= trusted_cutoff and hmm_length >= 0.75 * m.length and type_id < 3")
def b4m(t: Tables) -> DataFrame:
    return b.significant_model_hits(t.sql(MODEL_HITS), t.sql(MODELS)).select("hit_id", "model_id")


TARGETED = f"select h.*, seq2_id % 20 as target_seq_id, 1 + hit_id % 3 as target_chains, 100 as target_length, case when hit_id % 5 = 0 then null else 85 + hit_id % 30 end as target_length_now from ({HITS}) h"


@query("b5_best_hit_per_target", f"with x as (select *, row_number() over (partition by chain_id, target_seq_id order by length desc, hit_id) as r from ({TARGETED}) where length >= 20 and target_chains = 1 and abs(target_length - target_length_now) <= 10) select chain_id, target_seq_id, hit_id, length from x where r = 1")
def b5(t: Tables) -> DataFrame:
    return b.best_hit_per_target(t.sql(TARGETED))


@query("b6_min_max_hit", f"select chain_id, arg_min(hit_id, (blast_log10_e, hit_id)) as min_hit, arg_max(hit_id, (blast_log10_e, -hit_id)) as max_hit from ({HITS}) group by 1")
def b6(t: Tables) -> DataFrame:
    return b.min_max_hit(t.sql(HITS))


LINE_REGIONS = f"select o as chain_id, o * 10 + n as id, n * 10 as start, cast(qty as bigint) as length from ({LINES}) x"
OTHER_REGIONS = f"select o as chain_id, o * 10 + n as id, n * 10 + part % 12 - 5 as start, cast(qty as bigint) % 20 + 5 as length from ({LINES}) x where supp % 3 > 0"


@query(
    "b7_region_overlap",
    f"""with p as (select a.chain_id as pair_id, a.start as s1, a.length as l1, b.start as s2, b.length as l2 from ({LINE_REGIONS}) a join (select *, row_number() over (partition by chain_id order by id) as r from ({OTHER_REGIONS})) b on a.id = b.id where a.chain_id not in (select o from ({LINES}) x where supp % 3 = 0)),
 q as (select pair_id, greatest(least(s1 + l1, s2 + l2) - greatest(s1, s2), 0) as v, l1 + l2 as w, greatest(abs(s1 - s2), abs(s1 + l1 - s2 - l2)) as e from p)
 select pair_id, cast(sum(v) as bigint) as overlap, cast(sum(w) - 2 * sum(v) as bigint) as unmatched, max(e) as max_end_error from q group by 1""",
)
def b7(t: Tables) -> DataFrame:
    def sets(text: str, name: str) -> DataFrame:
        parts = F.transform(F.array_sort(F.collect_list(F.struct("id", "start", "length"))), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
        return t.sql(text).groupBy(F.col("chain_id").alias("pair_id")).agg(parts.alias(name))

    return b.region_overlap(sets(LINE_REGIONS, "a").join(sets(OTHER_REGIONS, "b"), "pair_id"))


MATCHED = f"select x.chain_id, x.id as a_id, y.id as b_id, greatest(abs(x.start - y.start), abs(x.start + x.length - y.start - y.length)) as end_error from ({LINE_REGIONS}) x join ({OTHER_REGIONS}) y on x.chain_id = y.chain_id and x.start < y.start + y.length and y.start < x.start + x.length"


@query("b8_all_region_matches", MATCHED)
def b8(t: Tables) -> DataFrame:
    return b.all_region_matches(t.sql(LINE_REGIONS), t.sql(OTHER_REGIONS))


@query("b8_best_region_match", f"select a_id, arg_min(b_id, (end_error, b_id)) as b_id, min(end_error) as end_error from ({MATCHED}) group by 1")
def b8b(t: Tables) -> DataFrame:
    return b.best_region_match(t.sql(LINE_REGIONS), t.sql(OTHER_REGIONS))


IDS = "select doc_id as pdb_chain_id, cast(doc_id % 50 + 1 as string) as start_id, cast(doc_id % 90 + 10 as string) as end_id from {documents}"


@query("b9_parse_regions", WITH + f", g as (select pdb_chain_id, start_id, end_id, min(idx) filter (where res_id = start_id) as lo, max(idx) filter (where res_id = end_id) as hi from ({IDS}) left join res using (pdb_chain_id) group by 1, 2, 3) select pdb_chain_id, start_id, end_id, case when lo <= hi then lo end as start, case when lo <= hi then hi - lo + 1 end as length from g")
def b9(t: Tables) -> DataFrame:
    return b.parse_regions(t.sql(IDS), maps(t))


PLACES = "select doc_id as pdb_chain_id, case when doc_id % 4 = 0 then 0 else doc_id % 21 end as start, case when doc_id % 4 = 0 then 1000000 else doc_id % 60 end as length from {documents}"


@query(
    "b9_format_regions",
    WITH + f""", g as (select pdb_chain_id, start, length, min(idx) filter (where atom is not null and idx >= start and idx < start + length) as lo, max(idx) filter (where atom is not null and idx >= start and idx < start + length) as hi, min(idx) filter (where atom is not null) as a, max(idx) filter (where atom is not null) as z from ({PLACES}) left join res using (pdb_chain_id) group by 1, 2, 3)
 select pdb_chain_id, start, length, case when lo is null then null when lo = a and hi = z then 'A:' else 'A:' || (lo % 9973 + 1) || '-' || (hi % 9973 + 1) end as regions from g""",
)
def b9f(t: Tables) -> DataFrame:
    return b.format_regions(t.sql(PLACES), maps(t))


#: DuckDB: covered places one by one.
CELLS = f"a as (select distinct chain_id, unnest(range(start, start + length)) as i from ({LINE_REGIONS})), b as (select distinct chain_id, unnest(range(start, start + length)) as i from ({OTHER_REGIONS}))"
ISLANDS = "select chain_id, min(i) as start, max(i) + 1 as \"end\" from (select *, i - row_number() over (partition by chain_id order by i) as run from {x}) group by chain_id, run"


@query("b10_subtract_regions", f"with {CELLS}, d as (select * from a except select * from b), z as ({ISLANDS.format(x='d')}) select chain_id, start, \"end\" - start as length from z")
def b10(t: Tables) -> DataFrame:
    return b.subtract_regions(t.sql(LINE_REGIONS), t.sql(OTHER_REGIONS))


@query("b10_max_gap", f"with {CELLS}, z as ({ISLANDS.format(x='b')}), g as (select chain_id, start - lag(\"end\") over (partition by chain_id order by start) as gap from z) select chain_id, coalesce(max(gap), 0) as max_gap from g group by 1")
def b10g(t: Tables) -> DataFrame:
    return b.max_gap(t.sql(OTHER_REGIONS))


LENGTHS = "select o_orderkey as chain_id, 60 + o_orderkey % 40 as chain_length from {orders}"


@query(
    "b11_coverage_stats",
    f"""with {CELLS}, l as ({LENGTHS}), c as (select a.* from a join l using (chain_id) where i >= 0 and i < chain_length), u as (select chain_id, unnest(range(0, chain_length)) as i from l except select * from c),
 z as (select *, "end" - start as n from ({ISLANDS.format(x='c')})), y as (select *, "end" - start as n from ({ISLANDS.format(x='u')})),
 p as (select chain_id, sum(n) as covered, sum(n) filter (where n >= 6) as covered_in_runs, max(n) as longest_run, arg_max(start, (n, -start)) as longest_start from z group by 1), q as (select chain_id, sum(n) as uncovered_in_runs from y where n >= 6 group by 1)
 select chain_id, cast(coalesce(covered, 0) as bigint) as covered, cast(coalesce(covered_in_runs, 0) as bigint) as covered_in_runs, cast(coalesce(uncovered_in_runs, 0) as bigint) as uncovered_in_runs, cast(coalesce(longest_run, 0) as bigint) as longest_run, longest_start, round(cast(100 * coalesce(covered, 0) as double) / chain_length, 6) as pct_covered
 from l left join p using (chain_id) left join q using (chain_id)""",
)
def b11(t: Tables) -> DataFrame:
    return b.coverage_stats(t.sql(LINE_REGIONS), t.sql(LENGTHS), 6)


@query("b11_close_short_holes", f"with {CELLS}, z as ({ISLANDS.format(x='b')}), n as (select *, case when start - lag(\"end\") over (partition by chain_id order by start) < 5 then 0 else 1 end as f from z), g as (select *, sum(f) over (partition by chain_id order by start) as run from n) select chain_id, min(start) as start, max(\"end\") as \"end\" from g group by chain_id, run")
def b11h(t: Tables) -> DataFrame:
    return b.close_short_holes(t.sql(OTHER_REGIONS), 5)


DOMAINS = """select doc_id as pdb_chain_id, doc_id * 10 + 1 as domain_id, cast(doc_id % 20 + 1 as string) as start_id, cast(doc_id % 20 + 40 as string) as end_id from {documents}
 union all select doc_id, doc_id * 10 + 2, cast(doc_id % 20 + 30 + doc_id % 15 as string), '90' from {documents} where doc_id % 3 = 0 union all select doc_id + 1000000, 1, '1', '2' from {documents} where doc_id % 9 = 0"""
BEFORE = "select doc_id as pdb_chain_id, n_chars as length from {documents}"


@query(
    "b12_domain_coverage_check",
    WITH + f""", d as ({DOMAINS}), p as (select d.pdb_chain_id, domain_id, start_id, end_id, min(idx) filter (where res_id = start_id) as lo, max(idx) filter (where res_id = end_id) as hi from d join l using (pdb_chain_id) left join res using (pdb_chain_id) group by 1, 2, 3, 4),
 g as (select * from p where lo <= hi), c as (select pdb_chain_id, i as idx, count(distinct domain_id) as n from (select pdb_chain_id, domain_id, unnest(range(lo, hi + 1)) as i from g) group by 1, 2), has as (select distinct pdb_chain_id from l where length(s) > 0)
 select pdb_chain_id, 'unknown-chain' as issue, count(*) as n from d where pdb_chain_id not in (select pdb_chain_id from l) group by 1
 union all select pdb_chain_id, 'unknown-residue', count(*) from p where lo is null or hi is null or lo > hi group by 1
 union all select pdb_chain_id, 'unobserved-end', count(*) from (select pdb_chain_id, lo as idx from g union all select pdb_chain_id, hi from g) join res using (pdb_chain_id, idx) where atom is null group by 1
 union all select pdb_chain_id, 'overlap', count(*) from c where n > 1 group by 1
 union all select pdb_chain_id, 'uncovered', count(*) from res where atom is not null and pdb_chain_id in (select pdb_chain_id from d) and not exists(select 1 from c where c.pdb_chain_id = res.pdb_chain_id and c.idx = res.idx) group by 1
 union all select l.pdb_chain_id, 'length-change', abs(length(s) - b.length) from l join ({BEFORE}) b using (pdb_chain_id) where abs(length(s) - b.length) > 10""",
)
def b12(t: Tables) -> DataFrame:
    return b.domain_coverage_check(t.sql(DOMAINS), maps(t), t.sql(BEFORE))


DIFFS = f"select o as pdb_chain_id, part % 2 as dbref_id, supp % 2 as category_id, n * 3 as diff_start, n * 3 + case when part % 3 > 0 then 2 else 1 end as diff_end, flag as diff_seq from ({LINES}) x"


@query(
    "b13_merge_adjacent_differences",
    f"""with d as (select *, case when diff_start = lag(diff_end) over w + 1 then 0 else 1 end as f from ({DIFFS}) window w as (partition by pdb_chain_id, dbref_id, category_id order by diff_start, diff_end)), r as (select *, sum(f) over (partition by pdb_chain_id, dbref_id, category_id order by diff_start, diff_end) as run from d)
 select pdb_chain_id, dbref_id, category_id, min(diff_start) as diff_start, max(diff_end) as diff_end, string_agg(diff_seq, '' order by diff_start, diff_end, diff_seq) as diff_seq from r group by pdb_chain_id, dbref_id, category_id, run""",
)
def b13(t: Tables) -> DataFrame:
    return b.merge_adjacent_differences(t.sql(DIFFS))
