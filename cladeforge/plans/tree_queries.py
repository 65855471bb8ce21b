"""Queries on the tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.operators import tree
from cladeforge.plans.registry import Tables, query
from cladeforge.plans.shapes import NODES, SCORES, WITH_CLOSED

PAIRS = "select 8000000000 + o_orderkey * 10 + 1 as a, 8000000000 + (o_orderkey * 7 % 1000 + 1) * 10 + 1 as b from {orders}"


@query("h0_closure", WITH_CLOSED + "select node_id, ancestor_id, ancestor_level, depth from closed")
def h0(t: Tables) -> DataFrame:
    return tree.closure(t.sql(NODES))


@query("h1_ancestor_at", WITH_CLOSED + "select id as node_id, coalesce(ancestor_id, 0) as ancestor_id from nodes left join closed on id = node_id and ancestor_level = 3")
def h1(t: Tables) -> DataFrame:
    nodes = t.sql(NODES)
    return tree.ancestor_at(nodes.select(F.col("id").alias("node_id")), tree.closure(nodes), 3)


@query(
    "h2_wide_lineage",
    WITH_CLOSED + "select id as node_id, " + ", ".join(f"min(case when ancestor_level = {k} then ancestor_id end) as {v}" for k, v in tree.LEVELS.items() if 2 <= k < 8) + " from nodes left join closed on node_id = id where level_id = 8 group by id",
)
def h2(t: Tables) -> DataFrame:
    nodes = t.sql(NODES)
    return tree.wide_lineage(tree.closure(nodes), nodes)


@query("h3_descendants", WITH_CLOSED + "select ancestor_id, node_id from closed join nodes on id = node_id where depth > 0 and ancestor_level = 3 and level_id = 8")
def h3(t: Tables) -> DataFrame:
    nodes = t.sql(NODES)
    return tree.descendants(nodes.filter("level_id = 3").select(F.col("id").alias("node_id")), tree.closure(nodes), nodes, 8)


@query("h4_is_ancestor", WITH_CLOSED + "select ancestor_id, n.node_id, exists(select 1 from closed c where c.depth > 0 and c.ancestor_id = n.ancestor_id and c.node_id = n.node_id) as above from (select 5000000000 + o_orderkey as node_id, 3000000000 + o_custkey % 25 as ancestor_id from {orders}) n")
def h4(t: Tables) -> DataFrame:
    pairs = t.sql("select 5000000000 + o_orderkey as node_id, 3000000000 + o_custkey % 25 as ancestor_id from {orders}")
    return tree.is_ancestor(pairs, tree.closure(t.sql(NODES))).select("ancestor_id", "node_id", "above")


@query(
    "h5_relationship",
    WITH_CLOSED + f""", p as (select distinct a, b from ({PAIRS}) x),
 s as (select a, b, coalesce(max(x.ancestor_level), 0) as shared_level from p left join (closed x join closed y on x.ancestor_id = y.ancestor_id and x.depth > 0 and y.depth > 0) on x.node_id = a and y.node_id = b group by a, b)
 select a, b, shared_level, case when shared_level >= 5 then 'shared_family' when shared_level = 4 then 'shared_superfamily' when shared_level = 3 then 'shared_fold_only' when shared_level = 2 then 'shared_class_only' else 'none' end as relationship from s""",
)
def h5(t: Tables) -> DataFrame:
    return tree.relationship(t.sql(PAIRS).distinct(), tree.closure(t.sql(NODES)))


#: A stable identifier (customer) in yearly releases, with the nation and the segment of its orders that year.
HISTORY = """select o_custkey as identifier, year(o_orderdate) as release_id, 5 as ancestor_level, min(o_orderpriority) as ancestor_sunid from {orders} group by o_custkey, year(o_orderdate)
 union all select o_custkey, year(o_orderdate), 4, min(o_orderstatus) from {orders} where o_orderkey % 3 > 0 group by o_custkey, year(o_orderdate)
 union all select o_custkey, year(o_orderdate), 3, cast(c_nationkey as string) from {orders} join {customer} on o_custkey = c_custkey group by o_custkey, year(o_orderdate), c_nationkey"""


@query(
    "h6_lineage_history",
    f"""with h as ({HISTORY}), r as (select identifier, count(distinct release_id) as n from h group by identifier),
 g as (select identifier, ancestor_level, count(distinct ancestor_sunid) as kinds, count(distinct release_id) as present from h group by identifier, ancestor_level)
 select identifier, ancestor_level, kinds + case when present < n then 1 else 0 end as "values" from g join r using (identifier) where kinds + case when present < n then 1 else 0 end > 1""",
)
def h6(t: Tables) -> DataFrame:
    return tree.lineage_history(t.sql(HISTORY))


@query(
    "h7_sccs_depth",
    f"""with n as ({NODES}), p as (select a, b, string_split(x.sccs, '.') as u, string_split(y.sccs, '.') as v from ({PAIRS}) z join n x on x.id = a join n y on y.id = b)
 select a, b, case when u[1] <> v[1] then 0 when coalesce(u[2] <> v[2], true) then 1 when coalesce(u[3] <> v[3], true) then 2 when coalesce(u[4] <> v[4], true) then 3 else 4 end as depth from p""",
)
def h7(t: Tables) -> DataFrame:
    from cladeforge.functions.text import sccs_depth

    nodes = t.sql(NODES).select("id", "sccs")
    pairs = t.sql(PAIRS).join(nodes.toDF("a", "x"), "a").join(nodes.toDF("b", "y"), "b")
    return pairs.select("a", "b", sccs_depth(F.col("x"), F.col("y")).alias("depth"))


@query(
    "h8_tree_order",
    f"""with recursive nodes as ({NODES}), s as ({SCORES}),
 k as (select n.id, parent_node_id, row_number() over (partition by parent_node_id order by case when description = 'automated matches' then 1 else 0 end,
   case when level_id between 3 and 5 then cast(list_last(string_split(sccs, '.')) as integer) else 0 end, case when level_id = 8 then -coalesce(score, 0) else 0 end,
   case when level_id = 2 then sccs when level_id = 8 then coalesce(sid, '') when level_id > 5 then upper(description) else '' end, n.id) as r from nodes n left join s on s.id = n.id),
 p(id, path) as (select id, [r] from k where parent_node_id is null union all select k.id, list_append(p.path, k.r) from p join k on k.parent_node_id = p.id)
 select id, row_number() over (order by path) as new_id from p""",
)
def h8(t: Tables) -> DataFrame:
    return tree.tree_order(t.sql(NODES), t.sql(SCORES))


@query("h9_leafless_nodes", f"with n as ({NODES}) select id, level_id, description from n where level_id < 8 and id not in (select parent_node_id from n where parent_node_id is not null)")
def h9(t: Tables) -> DataFrame:
    return tree.leafless_nodes(t.sql(NODES)).select("id", "level_id", "description")


@query("h9_duplicate_siblings", f"with n as ({NODES}) select parent_node_id, level_id, description, count(*) as n from n group by all having count(*) > 1")
def h9b(t: Tables) -> DataFrame:
    return tree.duplicate_siblings(t.sql(NODES))


#: Orders that say they were matched to others, some in chains and in rings.
MATCHES = "select 'd' || cast(o_orderkey as string) as sid, 'd' || cast(o_orderkey - o_custkey % 7 as string) as target from {orders} where o_custkey % 3 = 0 union all select 'd' || cast(o_orderkey as string), 'd' || cast(o_orderkey + 1 as string) from {orders} where o_orderkey % 50 = 0"
SEEDS = "select 'd' || cast(o_orderkey as string) as sid from {orders} where o_orderkey % 97 = 0"


@query("h10_automatch_closure", f"with recursive m as ({MATCHES}), s as ({SEEDS}), f(sid) as (select sid from s union select m.sid from m join f on m.target = f.sid) select distinct sid from f where sid not in (select sid from s)")
def h10(t: Tables) -> DataFrame:
    return tree.automatch_closure(t.sql(MATCHES), t.sql(SEEDS))
