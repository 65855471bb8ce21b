"""The library's tables made of the driver's ones, in SQL that Spark and DuckDB both read; {name} stands for a table."""

from __future__ import annotations

#: One line item for each (order, line): the key repeats.
LINES = """select l_orderkey as o, l_linenumber as n, min(l_partkey) as part, min(l_suppkey) as supp, min(l_quantity) as qty, min(l_shipdate) as shipped,
 min(l_returnflag) as flag, min(l_linestatus) as state from {lineitem} group by l_orderkey, l_linenumber"""

#: Regions, nations, customers, orders and line items as classes, folds, superfamilies, families and domains.
NODES = f"""select cast(0 as bigint) as id, cast(0 as bigint) as sunid, 'root' as sccs, cast(null as string) as sid, 'root' as description, 1 as level_id, cast(null as bigint) as parent_node_id
 union all select 2000000000 + cast(r_regionkey as bigint), 2000000000 + cast(r_regionkey as bigint), chr(97 + r_regionkey), null, r_name, 2, cast(0 as bigint) from {{region}}
 union all select 3000000000 + cast(n_nationkey as bigint), 3000000000 + cast(n_nationkey as bigint), chr(97 + n_regionkey) || '.' || cast(n_nationkey as string), null, n_name, 3, 2000000000 + cast(n_regionkey as bigint) from {{nation}}
 union all select 4000000000 + c_custkey, 4000000000 + c_custkey, chr(97 + n_regionkey) || '.' || cast(n_nationkey as string) || '.' || cast(c_custkey as string), null, c_mktsegment, 4, 3000000000 + cast(n_nationkey as bigint)
 from {{customer}} join {{nation}} on c_nationkey = n_nationkey
 union all select 5000000000 + o_orderkey, 5000000000 + o_orderkey, chr(97 + n_regionkey) || '.' || cast(n_nationkey as string) || '.' || cast(c_custkey as string) || '.' || cast(o_orderkey as string), null,
 case when o_orderkey % 11 = 0 then 'automated matches' else o_orderpriority end, 5, 4000000000 + c_custkey from {{orders}} join {{customer}} on o_custkey = c_custkey join {{nation}} on c_nationkey = n_nationkey
 union all select 8000000000 + o * 10 + n, 8000000000 + o * 10 + n, chr(97 + n_regionkey) || '.' || cast(n_nationkey as string) || '.' || cast(c_custkey as string) || '.' || cast(o_orderkey as string),
 'd' || cast(o as string) || 'l' || cast(n as string), 'e' || cast(o as string) || ' A:' || cast(n * 10 as string) || '-' || cast(n * 10 + cast(qty as bigint) as string), 8, 5000000000 + o
 from ({LINES}) x join {{orders}} on o = o_orderkey join {{customer}} on o_custkey = c_custkey join {{nation}} on c_nationkey = n_nationkey"""

#: Scores of domains: the part's price below the highest, by hundreds.
SCORES = f"""select 8000000000 + o * 10 + n as id, cast(floor(cast(p_size as double) * 7 / 10 * 100 + 0.5) / 100 as double) as score from ({LINES}) x join {{part}} on part = p_partkey"""

#: For the oracle: nodes and the closure, to be followed by a select.
WITH_CLOSED = f"""with recursive nodes as ({NODES}),
 c(node_id, ancestor_id, depth) as (select id, id, 0 from nodes union all select c.node_id, n.parent_node_id, c.depth + 1 from c join nodes n on n.id = c.ancestor_id where n.parent_node_id is not null),
 closed as (select c.node_id, c.ancestor_id, c.depth, level_id as ancestor_level from c join nodes on id = c.ancestor_id) """
