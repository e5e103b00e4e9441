"""Trees built from the given tables: one heap-shaped tree of all customers, one
tree per order, and the region/nation species tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.specs import parse_age, parse_calibrations
from ..operators import checks as V
from ..operators import trees as T
from ..runtime import by_rows, materialize_even
from ..sources import newick as N
from .registry import Tables, query

# -- inputs ------------------------------------------------------------------------


def with_tips(nodes: DataFrame) -> DataFrame:
    """Add ``is_tip``: nodes that are nobody's parent."""
    parents = nodes.where("parent_id is not null").select(
        "tree_id", F.col("parent_id").alias("node_id"), F.lit(True).alias("inner_node")
    ).distinct()
    return nodes.join(parents, ["tree_id", "node_id"], "left").withColumn(
        "is_tip", F.col("inner_node").isNull()
    ).drop("inner_node")


def heap_edges(t: Tables, *extra: str) -> DataFrame:
    """Node ``n`` is customer ``n - 1``, its parent node ``n div 2``."""
    node = F.col("c_custkey") + 1
    return with_tips(t.customer.select(
        F.lit("heap").alias("tree_id"),
        node.alias("node_id"),
        F.when(node > 1, F.floor(node / 2)).alias("parent_id"),
        F.col("c_name").alias("label"),
        (F.col("c_custkey") % 7 + 1).cast("double").alias("branch_length"),
        (node % 2).cast("int").alias("child_ord"),
        *extra,
    ))


HEAP = """
nodes as (select c_custkey + 1 as node_id,
    case when c_custkey > 0 then (c_custkey + 1) // 2 end as parent_id,
    c_name as label, (c_custkey % 7 + 1)::double as branch_length,
    ((c_custkey + 1) % 2)::int as child_ord,
    (c_custkey + 1) not in (select (c_custkey + 1) // 2 from customer) as is_tip,
    c_mktsegment, c_acctbal
  from customer),
deep as materialized (
  with recursive d(node_id, depth, level) as (
    select node_id, branch_length, 0::bigint from nodes where parent_id is null
    union all select n.node_id, d.depth + n.branch_length, d.level + 1
    from nodes n join d on n.parent_id = d.node_id) select * from d)"""

CLOSURE = """
closure as materialized (
  with recursive a(node_id, anc, dist, hops) as (
    select node_id, node_id, 0::double, 0::bigint from nodes
    union all select a.node_id, n.parent_id, a.dist + n.branch_length, a.hops + 1
    from a join nodes n on n.node_id = a.anc where n.parent_id is not null) select * from a)"""


def order_trees(t: Tables) -> DataFrame:
    """One tree per order: the order, its return flags, its lines as tips."""
    # all three levels are grouped by tree: one shuffle serves them and what follows
    tree_id = F.col("l_orderkey").cast("string").alias("tree_id")
    line = by_rows(
        t.lineitem.select(tree_id, "l_returnflag", "l_linenumber", "l_quantity"), ["tree_id"], t.lineitem.count()
    )
    flag_id = F.ascii("l_returnflag").cast("bigint")
    tips = line.groupBy("tree_id", "l_returnflag", "l_linenumber").agg(
        F.min("l_quantity").alias("branch_length")
    ).select(
        "tree_id",
        (flag_id * 1000 + F.col("l_linenumber")).alias("node_id"),
        flag_id.alias("parent_id"),
        F.concat(F.col("l_returnflag"), F.col("l_linenumber")).alias("label"),
        "branch_length",
        F.lit(True).alias("is_tip"),
        F.col("l_linenumber").cast("int").alias("child_ord"),
    )
    flags = line.groupBy("tree_id", "l_returnflag").agg(
        F.count("*").cast("double").alias("branch_length")
    ).select(
        "tree_id", flag_id.alias("node_id"), F.lit(0).cast("bigint").alias("parent_id"),
        F.col("l_returnflag").alias("label"), "branch_length",
        F.lit(False).alias("is_tip"), flag_id.cast("int").alias("child_ord"),
    )
    roots = line.groupBy("tree_id").agg(F.lit(0).alias("child_ord")).select(
        "tree_id", F.lit(0).cast("bigint").alias("node_id"),
        F.lit(None).cast("bigint").alias("parent_id"), F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("double").alias("branch_length"), F.lit(False).alias("is_tip"), "child_ord",
    )
    return tips.unionByName(flags).unionByName(roots)


ORDER_TIPS = """
tips as (select l_orderkey, l_returnflag as flag, l_linenumber as line, min(l_quantity) as qty
  from lineitem group by all),
flags as (select l_orderkey, l_returnflag as flag, count(*) as n from lineitem group by all)"""


def species_edges(t: Tables) -> DataFrame:
    """Root, regions, nations; every nation lies 100 below the root."""
    region = F.col("r_regionkey").cast("bigint") + 1
    up = (F.col("r_regionkey") % 3 * 10 + 20).cast("double")
    regions = t.region.select(
        region.alias("node_id"), F.lit(0).cast("bigint").alias("parent_id"),
        F.col("r_name").alias("label"), up.alias("branch_length"),
        F.col("r_regionkey").cast("int").alias("child_ord"),
    )
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey").cast("bigint") + 100).alias("node_id"), region.alias("parent_id"),
        F.col("n_name").alias("label"), (F.lit(100.0) - up).alias("branch_length"),
        F.col("n_nationkey").cast("int").alias("child_ord"),
    )
    root = t.region.agg(F.count("*").alias("n")).select(
        F.lit(0).cast("bigint").alias("node_id"), F.lit(None).cast("bigint").alias("parent_id"),
        F.lit("root").alias("label"), F.lit(None).cast("double").alias("branch_length"),
        F.lit(0).alias("child_ord"),
    )
    nodes = regions.unionByName(nations).unionByName(root)
    return with_tips(nodes.withColumn("tree_id", F.lit("species")))


# -- depths and shape ----------------------------------------------------------------


@query("tip_depths", f"""with {HEAP}
select 'heap' as tree_id, node_id, label, depth from nodes join deep using (node_id) where is_tip""")
def tip_depths(t: Tables) -> DataFrame:
    return T.tip_depths(heap_edges(t))


@query("node_levels", f"""with {HEAP} select 'heap' as tree_id, node_id, depth, level from deep""")
def node_levels(t: Tables) -> DataFrame:
    return T.node_depths(heap_edges(t))


@query("is_ultrametric", f"""with {HEAP}, {ORDER_TIPS},
d as (select 'heap' as tree_id, depth from nodes join deep using (node_id) where is_tip
  union all select tips.l_orderkey::varchar, qty + n from tips join flags using (l_orderkey, flag))
select tree_id, max(depth) - min(depth) as deviation, max(depth) as height,
       max(depth) - min(depth) <= 1e-3 * max(depth) as is_ultrametric from d group by tree_id""")
def is_ultrametric(t: Tables) -> DataFrame:
    edges = heap_edges(t)
    return T.is_ultrametric(edges.unionByName(order_trees(t).select(*edges.columns)))


@query("validate_tree", f"""with {HEAP}, {ORDER_TIPS},
fan as (select 'heap' as tree_id, parent_id::varchar as node, parent_id = 1 as root, count(*) as n
    from nodes where parent_id is not null group by all
  union all select l_orderkey::varchar, flag, false, count(*) from tips group by all
  union all select l_orderkey::varchar, 'r', true, count(*) from flags group by all),
shape as (select tree_id, max(n) filter (where root) as rc, count(*) filter (where n > 2) as p,
  count(*) filter (where n = 1) as u from fan group by tree_id)
select 'ERROR' as severity, 'not_rooted' as code, tree_id as subject, 'root children: ' || rc as detail
  from shape where rc <> 2
union all select 'ERROR', 'polytomy', tree_id, 'polytomies: ' || p from shape where p > 0
union all select 'INFO', 'unary_nodes', tree_id, 'single-child nodes: ' || u from shape where u > 0""")
def validate_tree(t: Tables) -> DataFrame:
    edges = heap_edges(t)
    return V.validate_tree(edges.unionByName(order_trees(t).select(*edges.columns)))


@query("strip_support", f"""with {HEAP}
select 'heap' as tree_id, node_id, case when is_tip then label end as label, branch_length from nodes""")
def strip_support(t: Tables) -> DataFrame:
    return T.strip_support(heap_edges(t)).select("tree_id", "node_id", "label", "branch_length")


@query("root_spanning_taxa", f"""with {HEAP}, {CLOSURE}
select 'heap' as tree_id, s.child_ord, min(n.label) as low_tip
from nodes s join closure c on c.anc = s.node_id join nodes n on n.node_id = c.node_id and n.is_tip
where s.parent_id = 1 group by s.child_ord""")
def root_spanning_taxa(t: Tables) -> DataFrame:
    return T.root_spanning_taxa(heap_edges(t))


# -- ancestors -----------------------------------------------------------------------


@query("ancestors", f"""with {HEAP}, {CLOSURE} select 'heap' as tree_id, * from closure""")
def ancestors(t: Tables) -> DataFrame:
    return T.ancestors(heap_edges(t))


@query("interval_labels", f"""with {HEAP}, {CLOSURE},
sizes as (select anc as node_id, count(*) as size from closure group by anc),
steps as (select node_id, case when parent_id is null then 0 else 1 + coalesce(sum(size) over
    (partition by parent_id order by child_ord, node_id rows between unbounded preceding and 1 preceding), 0) end as step
  from nodes join sizes using (node_id))
select 'heap' as tree_id, c.node_id, sum(step)::bigint as entry, any_value(size) as size,
  (count(*) - 1)::bigint as level
from closure c join steps s on s.node_id = c.anc join sizes z on z.node_id = c.node_id group by c.node_id""")
def interval_labels(t: Tables) -> DataFrame:
    return T.interval_labels(heap_edges(t)).select("tree_id", "node_id", "entry", "size", "level")


@query("ancestor_pairs", f"""with {HEAP}, {CLOSURE},
pairs as (select distinct o_orderkey as pair_id, o_custkey + 1 as u, (o_custkey + 1) // 3 + 1 as v from orders)
select 'heap' as tree_id, pair_id, u, v, a.anc is not null as u_above, b.anc is not null as v_above
from pairs left join closure a on a.node_id = v and a.anc = u left join closure b on b.node_id = u and b.anc = v""")
def ancestor_pairs(t: Tables) -> DataFrame:
    return T.ancestor_pairs(heap_edges(t), order_pairs(t).distinct())


MRCA_SQL = f"""{HEAP}, {CLOSURE},
height as (select max(depth) as height from nodes join deep using (node_id) where is_tip)"""


def order_pairs(t: Tables) -> DataFrame:
    node = F.col("o_custkey") + 1
    return t.orders.select(
        F.lit("heap").alias("tree_id"), F.col("o_orderkey").alias("pair_id"),
        node.alias("u"), (F.floor(node / 3) + 1).alias("v"),
    )


@query("mrca", f"""with {MRCA_SQL},
pairs as (select distinct o_orderkey as pair_id, o_custkey + 1 as u, (o_custkey + 1) // 3 + 1 as v
  from orders),
met as (select pair_id, u, v, arg_max(a.anc, d.level) as mrca
  from pairs join closure a on a.node_id = u join closure b on b.node_id = v and b.anc = a.anc
  join deep d on d.node_id = a.anc group by all)
select 'heap' as tree_id, pair_id, u, v, mrca, depth as mrca_depth, height - depth as age
from met join deep on node_id = mrca cross join height""")
def mrca(t: Tables) -> DataFrame:
    return T.mrca(heap_edges(t), order_pairs(t).distinct())


def spec_text(t: Tables) -> DataFrame:
    """Calibration arguments from orders: two customers and an age."""
    other = F.floor(F.col("o_custkey") / 3)
    money = F.floor("o_totalprice").cast("bigint") % 60
    kind = F.col("o_orderkey") % 6
    age = (
        F.when(kind == 0, money.cast("string"))
        .when(kind == 1, F.concat(money, F.lit("-"), money + 30))
        .when(kind == 2, F.concat(money, F.lit("-")))
        .when(kind == 3, F.concat(F.lit("-"), money))
        .when(kind == 4, F.concat(money, F.lit(".5")))
        .otherwise(F.lit("old"))
    )
    name = F.concat(F.lit("cal "), F.col("o_orderkey"))

    def customer(key):
        return F.concat(F.lit("Customer#"), F.lpad(key.cast("string"), 9, "0"))

    taxa = F.concat(customer(F.col("o_custkey")), F.lit(", "), customer(other))
    taxa = F.when(F.col("o_orderkey") % 10 == 9, customer(F.col("o_custkey"))).otherwise(taxa)
    return t.orders.select("o_orderkey", F.concat(name, F.lit(":"), taxa, F.lit(":"), age).alias("spec"))


def parsed_specs(t: Tables) -> DataFrame:
    """Distinct arguments, parsed by the tasks that have them after a shuffle."""
    parsed = parse_calibrations(spec_text(t).select("spec").distinct())
    # -0 and 0 are the same age
    ages = {c: F.col(c) + F.lit(0.0) for c in ("age", "min_age", "max_age")}
    return parsed.withColumns(ages)


CUSTOMER = "'Customer#' || lpad(({})::varchar, 9, '0')"
AGE_TEXT = """case o_orderkey % 6 when 0 then m::varchar when 1 then m || '-' || (m + 30) when 2 then m || '-'
  when 3 then '-' || m when 4 then m || '.5' else 'old' end"""
SPEC_SQL = f"""
raw as (select *, floor(o_totalprice)::bigint % 60 as m from orders),
spec as (select o_orderkey, o_custkey, m, {AGE_TEXT} as age_text,
  o_orderkey % 10 = 9 as one_taxon from raw),
cal as (select distinct 'cal ' || o_orderkey || ':' || {CUSTOMER.format('o_custkey')} ||
    case when one_taxon then '' else ', ' || {CUSTOMER.format('o_custkey // 3')} end || ':' || age_text as spec,
  case when not one_taxon then 'cal_' || o_orderkey end as name,
  case when not one_taxon then {CUSTOMER.format('o_custkey')} end as sp1,
  case when not one_taxon then {CUSTOMER.format('o_custkey // 3')} end as sp2,
  case when one_taxon then null when o_orderkey % 6 = 0 then m::double
       when o_orderkey % 6 = 3 then (-m)::double when o_orderkey % 6 = 4 then m + 0.5::double end as age,
  case when not one_taxon and o_orderkey % 6 in (1, 2) then m::double end as min_age,
  case when not one_taxon and o_orderkey % 6 = 1 then m + 30::double end as max_age,
  case when one_taxon then 'not two taxa' when o_orderkey % 6 = 5 then 'unreadable age'
       when o_orderkey % 6 = 3 and m > 0 then 'negative age' end as error
  from spec)"""


@query("calibration_specs", f"""with {SPEC_SQL}
select spec, name, sp1, sp2, age + 0.0 as age, min_age, max_age, error from cal""")
def calibration_specs(t: Tables) -> DataFrame:
    return parsed_specs(t)


@query("age_spec", f"""with {SPEC_SQL}
select age_text as token,
  (case o_orderkey % 6 when 0 then m::double when 3 then 0.0 - m when 4 then m + 0.5 end)::double as age,
  case when o_orderkey % 6 in (1, 2) then m::double end as min_age,
  case when o_orderkey % 6 = 1 then m + 30::double end as max_age,
  case when o_orderkey % 6 = 5 then 'unreadable age'
       when o_orderkey % 6 = 3 and m > 0 then 'negative age' end as error, count(*) as n
from spec group by all""")
def age_spec(t: Tables) -> DataFrame:
    token = F.element_at(F.split("spec", ":"), -1)
    tokens = spec_text(t).groupBy(token.alias("token")).agg(F.count("*").alias("n"))
    parsed = tokens.select("token", parse_age("token").alias("a"), "n")
    return parsed.select(
        "token", (F.col("a.age") + F.lit(0.0)).alias("age"), "a.min_age", "a.max_age", "a.error", "n"
    )


@query("validate_calibrations", f"""with {SPEC_SQL}, {HEAP}
select 'ERROR' as severity, 'malformed' as code, coalesce(name, spec) as subject, error as detail
  from cal where error is not null
union all
select 'ERROR', 'unknown_taxon', coalesce(name, spec), 'heap: ' || x.taxon from
  (select name, spec, sp1 as taxon from cal union all select name, spec, sp2 from cal) x
where x.taxon is not null and x.taxon not in (select label from nodes where is_tip)""")
def validate_calibrations(t: Tables) -> DataFrame:
    return V.validate_calibrations(parsed_specs(t), heap_edges(t))


@query("check_calibrations", f"""with {SPEC_SQL}, {MRCA_SQL},
c as (select cal.*, x.node_id as u, y.node_id as v from cal
  left join nodes x on x.label = sp1 and x.is_tip left join nodes y on y.label = sp2 and y.is_tip
  where error is null),
met as (select name, arg_max(a.anc, d.level) as mrca from c join closure a on a.node_id = u
  join closure b on b.node_id = v and b.anc = a.anc join deep d on d.node_id = a.anc group by name),
aged as (select name, height - depth as tree_age from met join deep on node_id = mrca cross join height)
select 'heap' as tree_id, c.name, sp1, sp2, age, min_age, max_age, tree_age,
  case when tree_age is null then 'unknown taxon'
       when coalesce(age = tree_age, true) and coalesce(min_age <= tree_age, true)
        and coalesce(max_age >= tree_age, true) then 'ok' else 'violated' end as status
from c left join aged using (name)""")
def check_calibrations(t: Tables) -> DataFrame:
    good = parsed_specs(t).where("error is null")
    cals = good.select(
        F.lit("heap").alias("tree_id"), "name", "sp1", "sp2", "age", "min_age", "max_age"
    )
    return T.check_calibrations(heap_edges(t), cals)


# -- pruning and topology --------------------------------------------------------------


@query("prune", f"""with {HEAP}, {CLOSURE},
kept_tips as (select node_id from nodes where is_tip and c_mktsegment in ('AUTOMOBILE', 'BUILDING')),
live as materialized (select distinct anc as node_id from closure join kept_tips using (node_id)),
fan as (select parent_id as node_id, count(*) as n from nodes join live using (node_id)
  where parent_id is not null group by parent_id),
keep as materialized (select node_id from nodes join live using (node_id) left join fan using (node_id)
  where is_tip or n >= 2),
above as (select c.node_id, min(hops) as hops from closure c join keep k on k.node_id = c.node_id
  join keep p on p.node_id = c.anc where hops > 0 group by c.node_id),
up as (select c.node_id, c.anc, c.dist from closure c join above a
  on a.node_id = c.node_id and a.hops = c.hops)
select 'heap' as tree_id, k.node_id, up.anc as parent_id, n.label,
  case when up.anc is not null then up.dist when n.parent_id is null then n.branch_length end as branch_length,
  n.is_tip
from keep k join nodes n using (node_id) left join up using (node_id)""")
def prune(t: Tables) -> DataFrame:
    edges = heap_edges(t, "c_mktsegment")
    wanted = edges.where("is_tip and c_mktsegment in ('AUTOMOBILE', 'BUILDING')")
    return T.prune(edges, wanted.select("tree_id", "label")).select(
        "tree_id", "node_id", "parent_id", "label", "branch_length", "is_tip"
    )


RELABEL_SQL = """b as (select node_id, case when c_acctbal < 0 then 'x' || label else label end as label
  from nodes)"""


def relabelled(t: Tables) -> DataFrame:
    """The heap tree with the names of indebted customers changed."""
    other = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("x"), F.col("label"))).otherwise(F.col("label"))
    return heap_edges(t, "c_acctbal").withColumn("label", other).drop("c_acctbal")


@query("clade_differences", f"""with {HEAP}, {CLOSURE}, {RELABEL_SQL},
sets as materialized (select c.anc as node_id, count(*) as n_tips,
   string_agg(n.label, ',' order by n.label) as sa, string_agg(b.label, ',' order by b.label) as sb
  from closure c join nodes n on n.node_id = c.node_id and n.is_tip join b on b.node_id = c.node_id
  group by c.anc)
select 'heap' as tree_id, node_id, 'only_a' as side, n_tips from sets where sa not in (select sb from sets)
union all
select 'heap', node_id, 'only_b', n_tips from sets where sb not in (select sa from sets)""")
def clade_differences(t: Tables) -> DataFrame:
    return T.clade_differences(heap_edges(t), relabelled(t))


@query("same_topology", f"""with {ORDER_TIPS},
a as (select l_orderkey, flag, string_agg(line::varchar, ',' order by line) as s from tips group by all),
odd as (select distinct l_orderkey from tips where line = 5)
select l_orderkey::varchar as tree_id, l_orderkey not in (select l_orderkey from odd) as same_topology
from (select distinct l_orderkey from a)""")
def same_topology(t: Tables) -> DataFrame:
    """Order trees against themselves with other lengths and line 5 renamed."""
    edges = materialize_even(order_trees(t))
    renamed = F.when(F.col("label").endswith("5"), F.concat(F.col("label"), F.lit("x")))
    other = edges.withColumn("branch_length", F.col("branch_length") * 2).withColumn(
        "label", F.coalesce(renamed, F.col("label"))
    )
    return T.same_topology(edges, other)


# -- Newick ----------------------------------------------------------------------------

ORDER_NEWICK = f"""{ORDER_TIPS},
sub as (select l_orderkey, flag, string_agg(flag || line || ':' || qty::bigint, ',' order by line) as s
  from tips group by all),
nwk as (select l_orderkey, '(' || string_agg('(' || s || ')' || flag || ':' || n, ',' order by flag) || ');'
    as newick from sub join flags using (l_orderkey, flag) group by l_orderkey)"""


@query("newick_text", f"with {ORDER_NEWICK} select l_orderkey::varchar as tree_id, newick from nwk")
def newick_text(t: Tables) -> DataFrame:
    return N.edges_to_newick(order_trees(t), internal_labels=True)


@query("newick_edges", f"""with {ORDER_TIPS},
n as (select l_orderkey, '' as flag, 0 as line, null::varchar as label, null::double as len, false as tip,
    0 as ord from (select distinct l_orderkey from flags)
  union all select l_orderkey, flag, 0, flag, n::double, false,
    (row_number() over (partition by l_orderkey order by flag) - 1)::int from flags
  union all select l_orderkey, flag, line, flag || line, qty::double, true,
    (row_number() over (partition by l_orderkey, flag order by line) - 1)::int from tips),
numbered as (select *, row_number() over (partition by l_orderkey order by flag, line) - 1 as node_id from n)
select l_orderkey::varchar as tree_id, node_id,
  case when flag = '' then null when line = 0 then 0
    else min(node_id) over (partition by l_orderkey, flag) end as parent_id,
  label, len as branch_length, tip as is_tip, ord as child_ord, null::varchar as error
from numbered""")
def newick_edges(t: Tables) -> DataFrame:
    """Order trees written as text and read back."""
    return N.newick_to_edges(newick_text(t))
