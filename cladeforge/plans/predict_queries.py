"""Queries of predicted domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.operators import predict, residues, tree
from cladeforge.operators.predict import SUFFIXES
from cladeforge.plans.registry import Tables, query
from cladeforge.plans.residue_queries import WITH, maps
from cladeforge.plans.shapes import LINES, NODES, WITH_CLOSED
from cladeforge.sources.scratch import kept

HITS = f"select o as chain_id, o * 10 + n as hit_id, 'h' || cast(supp as string) as name, case when part % 4 = 0 then 1 else 0 end as is_model, part % 2 = 0 as is_sequence_hit, -cast(qty as double) as log10e, n * 12 as start, cast(qty as bigint) + 3 as length from ({LINES}) x union all select o, o * 10 + n, 'h' || cast(supp as string), case when part % 4 = 0 then 1 else 0 end, part % 2 = 0, -cast(qty as double), n * 12 + 70, cast(qty as bigint) % 7 + 1 from ({LINES}) x where part % 3 = 0"


#: Acceptance residue by residue: of each chain, hit after hit in their order, the residues taken so far, and those that the hit got.
ACCEPTED = f"""with recursive hits as ({HITS}),
 hit as (select chain_id, hit_id, min(name) as name, min(is_model) as is_model, bool_or(is_sequence_hit) as is_seq, min(log10e) as log10e, cast(sum(length) as bigint) as total,
  flatten(list(range(start, start + length) order by start)) as pos, list([start, start + length] order by start) as runs from (select distinct * from hits) group by chain_id, hit_id),
 ranked as (select *, row_number() over (partition by chain_id order by is_model, log10e, -total, is_seq desc, name, runs, hit_id) as k from hit),
 walk(chain_id, k, name, got, taken) as (
  select o_orderkey, cast(0 as bigint), '', cast([] as bigint[]), cast([] as bigint[]) from orders
  union all
  select chain_id, k, name, got, list_concat(taken, got) from (
   select w.chain_id, r.k, r.name, w.taken, case when len(list_intersect(w.taken, r.pos)) <= least(10, r.total // 2) then list_filter(r.pos, lambda p: not list_contains(w.taken, p)) else [] end as got
   from walk w join ranked r on r.chain_id = w.chain_id and r.k = w.k + 1)),
 pos as (select chain_id, k, name, unnest(got) as p from walk),
 isle as (select chain_id, k, name, min(p) as s, max(p) + 1 as e from (select *, p - row_number() over (partition by chain_id, k order by p) as g from pos) group by chain_id, k, name, g),
 hole as (select *, lead(s) over (partition by chain_id, k order by s) as next from isle),
 spoilt as (select distinct h.chain_id, h.k from hole h join isle i on i.chain_id = h.chain_id and i.k <> h.k and i.s >= h.e and i.s < h.next where h.next - h.e < 50),
 run as (select h.*, sum(case when before is null or s - before >= 50 or spoilt.k is not null then 1 else 0 end) over (partition by h.chain_id, h.k order by s) as run
  from (select *, lag(e) over (partition by chain_id, k order by s) as before from isle) h left join spoilt using (chain_id, k)),
 own as (select chain_id, k, name, min(s) as s, max(e) as e from run group by chain_id, k, name, run),
 ends as (select chain_id, s, e from own union all select o_orderkey, 150, 150 from orders),
 bare as (select chain_id, coalesce(max(e) over (partition by chain_id order by s, e rows between unbounded preceding and 1 preceding), 0) as s, s as e from ends),
 every as (select chain_id, k, name, s, e from own union all select chain_id, -s - 1, 'unmatched', s, e from bare where e - s >= 20),
 first as (select *, min(s) over (partition by chain_id, k) as begins, count(*) over (partition by chain_id) as n from every),
 told as (select chain_id, dense_rank() over (partition by chain_id order by begins) as number, name, s, e, n, row_number() over (partition by chain_id, k order by s) - 1 as region from first),
 accepted as (select chain_id, cast(number as int) as number, case when n = 1 and s = 0 and e = 150 then '_' else substr('{SUFFIXES}', number, 1) end as suffix, name, s as start, e as "end", cast(region as int) as region from told)"""


@query("n1_accept_annotations", f"{ACCEPTED} select * from accepted")
def n1(t: Tables) -> DataFrame:
    return predict.accept_annotations(t.sql(HITS), t.sql("select o_orderkey as chain_id, 150 as chain_length from {orders}"))


PIECES = f"select o as chain_id, supp % 3 as id, n * 40 as start, n * 40 + cast(qty as bigint) % 30 + 5 as end from ({LINES}) x"
PIECES_SQL = PIECES.replace(" as end from", ' as "end" from')


@query(
    "n2_fill_gaps",
    f"""with r as ({PIECES_SQL}), g as (select *, lead(start) over (partition by chain_id, id order by start) as nxt, lag("end") over (partition by chain_id, id order by start) as prv from r),
 bad as (select distinct g.chain_id, g.id from g join r on r.chain_id = g.chain_id and r.id <> g.id and r.start < g.nxt and r."end" > g."end" where g.nxt - g."end" < 50),
 k as (select g.*, sum(case when prv is null or start - prv >= 50 or bad.id is not null then 1 else 0 end) over (partition by g.chain_id, g.id order by start) as run from g left join bad on bad.chain_id = g.chain_id and bad.id = g.id)
 select chain_id, id, min(start) as start, max("end") as "end" from k group by chain_id, id, run""",
)
def n2(t: Tables) -> DataFrame:
    return predict.fill_gaps(t.sql(PIECES))


CHAIN_SIZES = "select o_orderkey as chain_id, 330 as chain_length from {orders}"


@query(
    "n3_unmatched_regions",
    f"""with r as ({PIECES_SQL}), e as (select chain_id, start, "end" from r union all select o_orderkey, 330, 330 from {{orders}}), f as (select *, coalesce(max("end") over (partition by chain_id order by start, "end" rows between unbounded preceding and 1 preceding), 0) as free from e)
 select chain_id, free as start, start as "end" from f where start - free >= 20""",
)
def n3(t: Tables) -> DataFrame:
    return predict.unmatched_regions(t.sql(PIECES), t.sql(CHAIN_SIZES))


NUMBERED = f"select o as chain_id, 'e' || cast(o as string) || 'a' as sid, o * 10 + n as id, supp as start, part % 2 = 0 as is_whole from ({LINES}) x"


@query(
    "n4_number_domains",
    f"""with d as ({NUMBERED}), k as (select *, count(*) over (partition by chain_id) as c, row_number() over (partition by chain_id order by start, id) as r from d)
 select chain_id, id, 'u' || sid || case when c = 1 and is_whole then '_' else substr('{predict.SUFFIXES}', r, 1) end as sid from k""",
)
def n4(t: Tables) -> DataFrame:
    return predict.number_domains(t.sql(NUMBERED))


REGIONS = "select doc_id as chain_id, doc_id * 2 as id, doc_id % 40 as start, doc_id % 40 + 50 as end from {documents} union all select doc_id, doc_id * 2 + 1, doc_id % 40 + 60, doc_id % 40 + 90 from {documents}"


@query(
    "n5_extend_to_ends",
    WITH + f""", o as (select pdb_chain_id as chain_id, idx, coalesce(max(case when atom is null then idx end) over b + 1, 0) as rs, coalesce(min(case when atom is null then idx end) over a - 1, max(idx) over (partition by pdb_chain_id)) as re, atom is not null as seen from res window a as (partition by pdb_chain_id order by idx rows between current row and unbounded following), b as (partition by pdb_chain_id order by idx rows between unbounded preceding and current row)),
 g as (select *, coalesce(lag("end") over w, 0) as before, lead(start) over w as after from ({REGIONS.replace(' as end ', ' as "end" ')}) window w as (partition by chain_id order by start)),
 j as (select g.*, greatest(coalesce(case when x.seen then x.rs end, start), before) as down, least(coalesce(case when y.seen then y.re + 1 end, "end"), coalesce(after, 1099511627776)) as up from g left join o x on x.chain_id = g.chain_id and x.idx = start left join o y on y.chain_id = g.chain_id and y.idx + 1 = "end")
 select chain_id, id, case when start - down <= 4 then down else start end as start, case when up - "end" <= 4 then up else "end" end as "end" from j""",
)
def n5(t: Tables) -> DataFrame:
    regions = t.sql(REGIONS.replace(" as end ", " as `end` "))
    ends = regions.select(F.col("chain_id").alias("pdb_chain_id"), F.explode(F.array("start", F.col("end") - 1)).alias("idx"))
    return predict.extend_to_ends(regions, residues.runs_at(ends, maps(t)).withColumnRenamed("pdb_chain_id", "chain_id"), 4)


LINKED = f"select o as chain_id, o * 10 + n as id, n * 20 as start, n * 20 + cast(qty as bigint) % 19 + 1 as \"end\", part % 5 as missed_after, supp % 4 as missed_before from ({LINES}) x"


@query(
    "n6_split_linkers",
    f"""with g as (select *, lead(start) over w - "end" as hole, lead(missed_before) over w as nb from ({LINKED}) window w as (partition by chain_id order by start)),
 h as (select *, case when hole > 0 and hole <= 12 then case when missed_after + nb > 0 then cast(floor(cast(hole * missed_after as double) / (missed_after + nb)) as bigint) else cast(floor(cast(hole as double) / 2) as bigint) end else 0 end as gained from g),
 k as (select *, case when lag(hole) over w > 0 and lag(hole) over w <= 12 then lag(hole) over w - lag(gained) over w else 0 end as given from h window w as (partition by chain_id order by start))
 select chain_id, id, start - given as start, "end" + gained as "end" from k""",
)
def n6(t: Tables) -> DataFrame:
    return predict.split_linkers(t.sql(LINKED.replace('"end"', "`end`")), 12)


ACCEPTED_CHAINS = "select o_orderkey as chain_id, 'c' || cast(o_custkey as string) as code, 'A' as chain, rpad('mk', 150, o_orderpriority) as seq from {orders}"


@query(
    "n7_predict_domains",
    f"""{ACCEPTED}, c as ({ACCEPTED_CHAINS}),
 d as (select a.chain_id, number, suffix, name, any_value(code) as code, any_value(chain) as chain, string_agg(chain || ':' || (start + 1) || '-' || "end", ',' order by region) as regions, string_agg(substr(seq, start + 1, "end" - start), 'X' order by region) as seq
  from accepted a join c using (chain_id) group by all),
 s as (select *, 'e' || lower(code) || lower(chain) || suffix as sid from d)
 select chain_id, sid, regions, seq, sid || ' (' || regions || ') ' || name as header from s""",
)
def n7(t: Tables) -> DataFrame:
    return predict.predict_domains(t.sql(HITS), t.sql(ACCEPTED_CHAINS))


CHECKED = """select l_orderkey * 10 + l_linenumber + l_partkey * 1000000 as id, l_orderkey as chain_id, case when l_partkey % 31 = 0 then null else 'd' end as description, l_partkey % 7 % 2 as unmatched_parts, l_linenumber as domains_in_chain, l_suppkey % 29 = 0 as is_genetic, l_partkey % 12 as hit_start, 100 as hit_end,
 100 + l_partkey % 14 as target_length, 1 + l_suppkey % 2 as regions, 1 as target_regions, case when l_quantity = 5 then 'low-res' when l_quantity = 6 then 'nmr-model' when l_quantity = 7 then 'unk-res' end as gate, l_quantity = 8 as is_ribosomal, l_quantity = 9 as is_synthetic, 80 + l_partkey % 50 as length, case when l_quantity = 10 then 1 else 0 end as is_reject,
 70 + l_suppkey % 30 as observed, l_suppkey % 3 as target_domains, l_suppkey % 2 as target_chain_id, l_partkey % 5 % 2 as gap_residues, 0 as unmatched_residues from {lineitem}"""


def _reasons(bits: int) -> str:
    tests = {
        "no-desc": "description is null", "not-entire-chain": "unmatched_parts > 0", "not-one-domain": "domains_in_chain <> 1", "genetic-domain": "is_genetic", "short-hit": "hit_start >= 10 or target_length - hit_end > 10", "hit-wrong-regions": "regions <> target_regions",
        "low-res": "gate = 'low-res'", "nmr-model": "gate = 'nmr-model'", "unk-res": "gate = 'unk-res'", "ribo": "is_ribosomal", "synthetic": "is_synthetic", "fragment": "abs(target_length - length) > least(30, cast(target_length as double) / 3) or is_reject = 1", "fragment2": "observed < 0.8 * length",
        "entire-chain-not-classified": "target_domains <> 1", "not-all-same-chain": "other", "unmatched-residues": "gap_residues > 0 or unmatched_residues > 0",
    }
    cases = " ".join(f"when {tests[n]} then '{n}'" for b, n in predict.FILTERS if b == 0 or bits & b)
    return f"with p as (select *, min(target_chain_id) over (partition by chain_id) <> max(target_chain_id) over (partition by chain_id) as other from ({CHECKED})), r as (select id, case {cases} end as reason from p) select id, reason, reason is null as passed from r"


@query("n8_filter_predictions", _reasons(2 | 32 | 64))
def n8(t: Tables) -> DataFrame:
    return predict.filter_predictions(t.sql(CHECKED), 2 | 32 | 64)


@query("n8_filter_predictions_strict", _reasons(511))
def n8s(t: Tables) -> DataFrame:
    return predict.filter_predictions(t.sql(CHECKED), 511)


PREDICTED = f"select o as chain_id, o * 10 + n as id, n * 15 as start, 20 + cast(qty as bigint) as length, 8000000000 + o * 10 + n as target_node from ({LINES}) x"
TRUTH = f"select o as chain_id, o * 10 + n as id, n * 15 + part % 9 as start, 24 + cast(qty as bigint) - supp % 5 as length, 8000000000 + (o + part % 2) * 10 + 1 as node from ({LINES}) x where part % 6 > 0"


@query(
    "n9_evaluate_predictions",
    WITH_CLOSED + f""", p as ({PREDICTED}), t as ({TRUTH}), m as (select p.id, arg_min(t.id, (greatest(abs(p.start - t.start), abs(p.start + p.length - t.start - t.length)), t.id)) as match_id, min(greatest(abs(p.start - t.start), abs(p.start + p.length - t.start - t.length))) as end_error from p join t on p.chain_id = t.chain_id and p.start < t.start + t.length and t.start < p.start + p.length group by 1),
 j as (select p.*, match_id, end_error, node from p left join m using (id) left join t on t.id = match_id),
 s as (select j.id, max(x.ancestor_level) as lv from j join closed x on x.node_id = target_node and x.depth > 0 join closed y on y.node_id = node and y.depth > 0 and x.ancestor_id = y.ancestor_id group by 1)
 select j.id, match_id, end_error, coalesce(lv, 0) as shared_level, coalesce(end_error <= 10 and end_error <= floor(cast(length as double) / 5) and coalesce(lv, 0) >= 4, false) as correct from j left join s using (id)""",
)
def n9(t: Tables) -> DataFrame:
    predictions, truth = t.sql(PREDICTED), t.sql(TRUTH)
    pairs = predictions.select("chain_id", F.col("target_node").alias("a")).join(truth.select("chain_id", F.col("node").alias("b")), "chain_id").select("a", "b").distinct()
    return predict.evaluate_predictions(predictions, truth, tree.relationship(pairs, tree.closure(t.sql(NODES))))


EVALUATED = "select l_extendedprice as log10e, l_partkey % 3 > 0 as is_correct from {lineitem}"


@query("n10_precision_recall", f"with b as (select log10e, count(*) as k, sum(case when is_correct then 1 else 0 end) as c from ({EVALUATED}) group by 1), r as (select log10e, sum(k) over w as n, sum(c) over w as correct, (select sum(c) from b) as every from b window w as (order by log10e)) select log10e, cast(n as bigint) as n, cast(correct as bigint) as correct, round(cast(correct as double) / n, 9) as precision, round(cast(correct as double) / every, 9) as recall from r")
def n10(t: Tables) -> DataFrame:
    return predict.precision_recall(t.sql(EVALUATED), "log10e")


GATED = f"select o * 10 + n as id, o as entry_id, case when n % 3 = 0 then 'a' when n % 3 = 1 then 'A' else cast(n as string) end as chain, flag as line, case when part % 9 = 0 then 'other' else flag end as frozen_line from ({LINES}) x"
FROZEN, GONE, CURATED = "select o_orderkey as entry_id from {orders} where o_custkey % 8 > 0", "select o_orderkey as entry_id from {orders} where o_orderkey % 14 = 0", f"select o * 10 + n as chain_id from ({LINES}) x where supp % 10 = 0"


@query("n11_promotion_gate", f"with g as (select *, count(*) over (partition by entry_id, lower(chain)) > 1 as clash from ({GATED})) select id, case when entry_id not in ({FROZEN}) then 'not-in-frozen-set' when entry_id in ({GONE}) then 'entry-obsolete' when line <> frozen_line then 'map-changed' when id in ({CURATED}) then 'curated-domains' when clash then 'case-clash' end as reason from g")
def n11(t: Tables) -> DataFrame:
    return predict.promotion_gate(t.sql(GATED), t.sql(FROZEN), t.sql(GONE), t.sql(CURATED))


PLACED = "select o_orderkey as id, floor(o_totalprice) % 101 as pct, o_custkey % 40 as gene, case when o_orderkey % 9 = 0 then 'One' else 'homo SAPIENS' end as species, o_orderkey % 6 as taxid, o_custkey % 3 as superfamily_id, o_custkey % 6 as family_id, o_orderkey % 12 as protein_id from {orders}"
GENES = "select c_custkey % 40 as gene, c_custkey % 3 as superfamily_id, c_custkey % 6 as family_id, c_custkey % 12 as protein_id from {customer}"
SPECIES = "select p_partkey % 12 as protein_id, p_partkey as species_id, case when p_size % 5 = 0 then 'Homo sapiens' else 'Mus musculus' end as scientific_name, p_size % 13 as taxid from {part}"


@query(
    "n12_assign_parents",
    f"""with p as ({PLACED}), g as ({GENES}), f as (select superfamily_id, gene, min(family_id) as f0, max(family_id) as f1 from g group by 1, 2),
 a as (select p.*, case when species = 'One' then null else 'Homo sapiens' end as name, coalesce(pct >= 55, false) or coalesce(f0 = family_id and f1 = family_id, false) as fam, exists(select 1 from g where g.gene = p.gene and g.protein_id = p.protein_id) as hg from p left join f using (superfamily_id, gene)),
 b as (select id, name, taxid, case when fam then family_id end as family_id, case when fam and (coalesce(pct >= 99, false) or hg) then protein_id end as protein_id from a)
 select id, family_id, protein_id, (select min(species_id) from ({SPECIES}) s where s.protein_id = b.protein_id and (s.scientific_name = b.name or s.taxid = b.taxid)) as species_id, name is not null as has_species from b""",
)
def n12(t: Tables) -> DataFrame:
    return predict.assign_parents(t.sql(PLACED), t.sql(GENES), t.sql(SPECIES))


TAG_CHAINS = "select o_orderkey as chain_id, o_orderkey % 200 as seq_id, case when o_orderkey % 200 % 5 = 0 then 'mghhhhhh' when o_orderkey % 200 % 5 = 1 then 'mghhh' else '' end || rpad('q', cast(20 + o_orderkey % 200 % 9 as int), 'acdefgw') || case when o_orderkey % 200 % 3 = 0 then 'lehhhhhh' else '' end as seq from {orders}"
TAG_NOTES = "select o_orderkey as chain_id, 'N' as type, 0 as start, cast(3 + o_custkey % 4 as int) as end from {orders} where o_orderkey % 37 = 0"
KNOWN_TAGS = "select case r_regionkey when 0 then 'mghhhhhh' when 1 then 'mghhh' when 2 then 'lehhhhhh' when 3 then 'hhhhhh' else 'hhxhh' end as tag from {region}"
REFERENCES = "select o_orderkey as chain_id, cast(4 + o_custkey % 9 as int) as ref_start, 26 as ref_end from {orders} where o_custkey % 2 = 0"


@query(
    "n13_find_tags",
    f"""with c as ({TAG_CHAINS}), a as ({TAG_NOTES.replace(' as end ', ' as "end" ')}), k as ({KNOWN_TAGS}),
 tw as (select seq_id, type, min((start, "end")) as t from a join c using (chain_id) group by 1, 2),
 kt as (select chain_id, 'N' as type, 0 as start, max(length(tag)) - 1 as "end" from c join k on starts_with(seq, tag) where length(tag) >= 5 and not contains(tag, 'x') and length(seq) > length(tag) group by 1 union all select chain_id, 'C', length(any_value(seq)) - max(length(tag)), length(any_value(seq)) - 1 from c join k on ends_with(seq, tag) where length(tag) >= 5 and not contains(tag, 'x') and length(seq) > length(tag) group by 1),
 u as (select chain_id, type, start, "end", 1 as p from a union all select chain_id, type, t[1], t[2], 2 from tw join c using (seq_id) union all select *, 3 from kt), b as (select *, row_number() over (partition by chain_id, type order by p, start, "end") as r from u),
 z as (select chain_id, type, case when type = 'N' then 0 else greatest(start, coalesce(ref_end + 1, 0)) end as start, case when type = 'N' then least("end", coalesce(ref_start - 1, length(seq))) else length(seq) - 1 end as "end", case p when 1 then 'annotated' when 2 then 'same-sequence' else 'known-tag' end as source from b join c using (chain_id) left join ({REFERENCES}) q using (chain_id) where r = 1)
 select chain_id, type, cast(start as integer) as start, cast("end" as integer) as "end", source from z where start <= "end\"""",
)
def n13(t: Tables) -> DataFrame:
    return predict.find_tags(t.sql(TAG_CHAINS), t.sql(TAG_NOTES.replace(" as end ", " as `end` ")), t.sql(KNOWN_TAGS), t.sql(REFERENCES))


TAG_DOMAINS = f"select o as chain_id, o * 10 + n as id, n * 20 - part % 9 as start, n * 20 + 15 as \"end\" from ({LINES}) x"
CALLS = "select o_orderkey as chain_id, 'N' as type, 0 as first_start, 10 + o_custkey % 20 as first_end, 0 as second_start, 8 + o_orderkey % 30 as second_end from {orders} where o_orderkey % 2 = 0"


SPLIT = f"""t as (select chain_id, type, 0 as t0, case when second_end >= first_end then second_end else first_end end as t1 from ({CALLS})), r as (select d.*, type, t0, t1, coalesce(start <= t1 and "end" >= t0, false) as over_, coalesce(start >= t0 and "end" <= t1, false) as sw, start - t1 - 1 as away from ({TAG_DOMAINS}) d left join t using (chain_id)),
 s as (select *, sum(case when over_ then 1 else 0 end) over w as n, min(case when away >= 0 then away end) over w as near from r window w as (partition by chain_id, type)),
 a as (select *, case when t0 is null then 'kept' when over_ and (n > 1 or sw) then 'manual' when over_ then 'cut' when n = 0 and away = near and away > 0 and away <= 10 then 'grown' else 'kept' end as action from s)"""


@query("n14_split_tag_domains", f"with {SPLIT} select chain_id, id, type, case when action in ('cut', 'grown') then t1 + 1 else start end as start, \"end\", action from a")
def n14(t: Tables) -> DataFrame:
    return predict.split_tag_domains(t.sql(TAG_DOMAINS.replace('"end"', "`end`")), t.sql(CALLS))


MADE = f"{SPLIT}, made as (select 9000000000 + row_number() over (order by chain_id, type, id) as id, chain_id, type, t0 as start, t1 as \"end\", 'l.1.1.1' as sccs, 8 as level_id, 101 as parent_node_id, id as made_from from a where action in ('cut', 'grown'))"
KNOWN_BEFORE = f"select o * 10 + n as id, o * 100 + n as old_node_id from ({LINES}) x where part % 4 > 0"


@query("n14_tag_nodes", f"with {MADE} select * from made")
def n14t(t: Tables) -> DataFrame:
    calls = t.sql(CALLS)
    return predict.tag_nodes(predict.split_tag_domains(t.sql(TAG_DOMAINS.replace('"end"', "`end`")), calls), calls, {"N": 101, "C": 102}, 9_000_000_001)


@query(
    "n14_tag_history",
    f"with {MADE}, k as (select a.*, old_node_id from a join ({KNOWN_BEFORE}) b using (id) where action in ('cut', 'grown')) select old_node_id, id as new_node_id, 11 as change_type from k union all select old_node_id, id, 5 from k where action = 'cut' union all select old_node_id, made.id, 5 from k join made on made_from = k.id and made.type = k.type where action = 'cut'",
)
def n14h(t: Tables) -> DataFrame:
    calls = t.sql(CALLS)
    split = kept(predict.split_tag_domains(t.sql(TAG_DOMAINS.replace('"end"', "`end`")), calls))
    return predict.tag_history(split, predict.tag_nodes(split, calls, {"N": 101, "C": 102}, 9_000_000_001), t.sql(KNOWN_BEFORE))


SEQ_CHAINS = "select o_orderkey as chain_id, o_custkey as seq_id from {orders}"
DONE = f"select o as chain_id, o_custkey as seq_id, o * 10 + n as node_id, n * 10 as start, cast(qty as bigint) as length from ({LINES}) x join {{orders}} on o = o_orderkey where o % 3 = 0"


@query("n15_exact_sequence_match", f"with d as ({DONE}), f as (select seq_id, min(chain_id) as donor_chain_id from d group by 1) select c.chain_id, donor_chain_id, node_id, start, length, cast(-9999 as double) as log10e, cast(100 as double) as pct from ({SEQ_CHAINS}) c join f using (seq_id) join d on d.chain_id = donor_chain_id where c.chain_id not in (select chain_id from d)")
def n15(t: Tables) -> DataFrame:
    return predict.exact_sequence_match(t.sql(SEQ_CHAINS), t.sql(DONE))


SOURCED = "select l_orderkey * 10 + l_linenumber + l_partkey * 1000000 as id, l_orderkey as chain_id, case when l_partkey % 9 = 0 then 'exact' when l_partkey % 5 = 0 then 'multi' else 'original' end as source from {lineitem}"


@query("n16_choose_source", f"with p as (select *, case source when 'exact' then 0 when 'multi' then 1 else 2 end as k from ({SOURCED})), m as (select *, min(k) over (partition by chain_id) as best from p) select id, chain_id, case k when 0 then 4 when 1 then 5 else 3 end as method, case when k < 2 then 32 else 7 end as bits from m where k = best")
def n16(t: Tables) -> DataFrame:
    return predict.choose_source(t.sql(SOURCED), 7)
