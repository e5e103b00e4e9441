"""Traits, ancestral states and turnover on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rates import er_matrix, er_probability, expm_q
from ..functions.specs import merge_labels
from ..operators import ancestral as B
from ..operators import checks as V
from ..operators import counts as C
from ..operators import phenotype as H
from ..operators import summary as S
from ..plans.results import summary_tables
from ..runtime import materialize, materialize_even
from ..sources import newick as N
from .genes import MEMBERS, nation_counts, nation_species, part_cells
from .registry import Tables, query
from .trees import CLOSURE, HEAP, ORDER_TIPS, heap_edges, order_trees, species_edges

# -- labels ----------------------------------------------------------------------------

SUBSTITUTIONS = [("BUILDING", "HOUSEHOLD"), ("HOUSEHOLD", "HOME")]
MERGE_ONLY = [("FURNITURE", "BUILDING")]


def raw_labels(t: Tables) -> DataFrame:
    """Customer segments, some doubled, some missing."""
    label = (
        F.when(F.col("c_custkey") % 9 == 0, F.lit(None))
        .when(F.col("c_custkey") % 9 == 1, F.concat(F.col("c_mktsegment"), F.lit("/BUILDING")))
        .otherwise(F.col("c_mktsegment"))
    )
    return t.customer.select(F.col("c_name").alias("species"), label.alias("phenotype"))


LABELS = """
raw as (select c_name as species, case c_custkey % 9 when 0 then null
  when 1 then c_mktsegment || '/BUILDING' else c_mktsegment end as phenotype from customer),
hybrid as (select species, case when contains(phenotype, 'FURNITURE') and contains(phenotype, 'BUILDING')
  then 'BUILDING' else phenotype end as phenotype from raw),
sub as (select species, case when phenotype = 'BUILDING' then 'HOUSEHOLD' else phenotype end as phenotype from hybrid),
merged as (select species, case when phenotype = 'HOUSEHOLD' then 'HOME' else phenotype end as phenotype from sub)"""


@query("merge_labels", f"with {LABELS} select * from merged")
def merged_labels(t: Tables) -> DataFrame:
    return raw_labels(t).select(
        "species", merge_labels("phenotype", SUBSTITUTIONS, MERGE_ONLY).alias("phenotype")
    )


def event_labels(t: Tables) -> DataFrame:
    """Labels of users from their events; errors are missing labels."""
    label = F.when(F.col("event_type") != "error", F.col("event_type"))
    return t.events.select(F.col("user_id").alias("species"), label.alias("phenotype"))


@query("phenotype_conflicts", """
select user_id as species, count(distinct event_type) as n_labels from events
where event_type <> 'error' group by user_id having count(distinct event_type) > 1""")
def phenotype_conflicts(t: Tables) -> DataFrame:
    return H.phenotype_conflicts(event_labels(t))


@query("resolved_phenotypes", f"""with {LABELS}, twice as (select * from raw union all
  select species, null from raw union all select species, phenotype from raw)
select species, max(phenotype) as phenotype from twice group by species""")
def resolved_phenotypes(t: Tables) -> DataFrame:
    rows = raw_labels(t)
    empty = rows.select("species", F.lit(None).cast("string").alias("phenotype"))
    return H.resolve_phenotypes(rows.unionByName(empty).unionByName(rows))


@query("phenotype_coverage", f"""with {HEAP}, {LABELS}, tips as (select label as species from nodes where is_tip)
select count(*) filter (where species in (select species from tips) and phenotype is not null) as n_covered,
  (select count(*) from tips) - count(*) filter (where species in (select species from tips)
     and phenotype is not null) as n_missing,
  count(*) filter (where species not in (select species from tips)) as n_extra from merged""")
def phenotype_coverage(t: Tables) -> DataFrame:
    tips = heap_edges(t).where("is_tip").select(F.col("label").alias("species"))
    return H.phenotype_coverage(tips, merged_labels(t))


def tip_labels(t: Tables) -> DataFrame:
    """Merged labels of the tips of the heap tree, ``background`` where missing."""
    _, tips, _ = H.apply_unclassified(heap_edges(t), merged_labels(t), "background")
    return tips


TIPS = f"""{HEAP}, {LABELS},
tips as (select node_id, label as species, coalesce(phenotype, 'background') as phenotype
  from nodes join merged on label = species where is_tip),
legend as (select dense_rank() over (order by category)::int as integer, category, n_tips
  from (select phenotype as category, count(*) as n_tips from tips group by all))"""


@query("unclassified_background", f"with {TIPS} select 'heap' as tree_id, node_id, species, phenotype from tips")
def unclassified_background(t: Tables) -> DataFrame:
    return tip_labels(t)


@query("unclassified_drop", f"""with {HEAP}, {LABELS}, {CLOSURE},
kept_tips as (select node_id from nodes join merged on label = species where is_tip and phenotype is not null),
live as materialized (select distinct anc as node_id from closure join kept_tips using (node_id)),
fan as (select parent_id as node_id, count(*) as n from nodes join live using (node_id)
  where parent_id is not null group by parent_id)
select 'heap' as tree_id, node_id, label, is_tip from nodes join live using (node_id)
left join fan using (node_id) where is_tip or n >= 2""")
def unclassified_drop(t: Tables) -> DataFrame:
    kept, _, _ = H.apply_unclassified(heap_edges(t), merged_labels(t), "drop")
    return kept.select("tree_id", "node_id", "label", "is_tip")


@query("class_legend", f"with {TIPS} select * from legend")
def class_legend(t: Tables) -> DataFrame:
    return H.class_legend(tip_labels(t))


FORCED = f"""{TIPS},
classes as (select node_id, parent_id, is_tip, coalesce(integer,
    (select integer from legend where category = 'HOME')) as class
  from nodes left join tips using (node_id) left join legend on category = tips.phenotype)"""


def forced(t: Tables) -> tuple[DataFrame, DataFrame]:
    return B.class_tree(heap_edges(t), tip_labels(t), anc_category="HOME")


@query("forced_classes", f"with {FORCED} select 'heap' as tree_id, node_id, class from classes")
def forced_classes(t: Tables) -> DataFrame:
    return forced(t)[0].select("tree_id", "node_id", "class")


@query("class_coverage", f"""with {FORCED},
every as (select category, integer from legend union all select r_name, r_regionkey + 100 from region)
select 'WARNING' as severity, 'unused_class' as code, category as subject,
  'class ' || integer || ' is on no branch' as detail
from every where integer not in (select class from classes where parent_id is not null)""")
def class_coverage(t: Tables) -> DataFrame:
    """The branches against a legend that has the regions as further classes."""
    edges, legend = forced(t)
    regions = t.region.select(
        F.col("r_name").alias("category"), (F.col("r_regionkey") + 100).alias("integer")
    )
    return H.class_coverage(edges, legend.select("category", "integer").unionByName(regions))


@query("class_tree_report", f"""with {FORCED}, {CLOSURE}
select 'ERROR' as severity, 'tip_mismatch' as code, label as subject, 'heap: only_in_list' as detail
  from nodes where is_tip and c_acctbal < 0
union all select 'ERROR', 'tip_mismatch', 'x' || label, 'heap: only_in_tree' from nodes where is_tip and c_acctbal < 0
union all select 'ERROR', 'non_integer_class', case when is_tip and c_acctbal < 0 then 'x' else '' end || label,
    (class + 0.5)::varchar
  from nodes join (select node_id, class from classes) using (node_id)
  where is_tip and node_id % 100 = 1 and node_id > 1""")
def class_tree_report(t: Tables) -> DataFrame:
    """A class tree with renamed tips and some fractional classes."""
    edges = heap_edges(t, "c_acctbal")
    classes = forced(t)[0].select("tree_id", "node_id", "class")
    tip = F.col("is_tip")
    wrong = edges.join(classes, ["tree_id", "node_id"]).select(
        "tree_id", "node_id", "parent_id", "is_tip",
        F.when(tip & (F.col("c_acctbal") < 0), F.concat(F.lit("x"), F.col("label")))
        .otherwise(F.col("label")).alias("label"),
        F.when(tip & (F.col("node_id") % 100 == 1), F.col("class") + F.lit(0.5))
        .otherwise(F.col("class").cast("double")).alias("class"),
    )
    return V.validate_class_tree(wrong, edges)


@query("tip_species_diff", f"""with {HEAP}, s as (select 'Customer#' || lpad(o_custkey::varchar, 9, '0') as name
  from orders union select 'extra ' || r_name from region)
select 'heap' as tree_id, label as name, 'only_in_tree' as side from nodes
  where is_tip and label not in (select name from s)
union all select 'heap', name, 'only_in_list' from s where name not in (select label from nodes where is_tip)""")
def tip_species_diff(t: Tables) -> DataFrame:
    buyers = t.orders.select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("species")
    )
    extra = t.region.select(F.concat(F.lit("extra "), F.col("r_name")).alias("species"))
    return V.tip_species_diff(heap_edges(t), buyers.union(extra).distinct())


@query("tips_of_many_trees", f"""with {ORDER_TIPS},
own as (select l_orderkey as tree, flag || line as name from tips),
other as (select xor(l_orderkey, 1) as tree, flag || line as name from tips)
select tree::varchar as tree_id, name, 'only_in_tree' as side from (from own except from other)
union all select tree::varchar, name, 'only_in_list' from (from other except from own)""")
def tips_of_many_trees(t: Tables) -> DataFrame:
    """The trees of orders, each against the tips of its neighbour."""
    edges = order_trees(t)
    neighbour = F.col("tree_id").cast("bigint").bitwiseXOR(F.lit(1)).cast("string")
    species = edges.where("is_tip").select(neighbour.alias("tree_id"), F.col("label").alias("species"))
    return V.tip_species_diff(edges, species)


@query("tips_missing_per_tree", f"""with {ORDER_TIPS},
names as (select distinct flag || line as name from tips)
select l_orderkey::varchar as tree_id, name, 'only_in_list' as side
from (select distinct l_orderkey from flags) cross join names
where (l_orderkey, name) not in (select (l_orderkey, flag || line) from tips)""")
def tips_missing_per_tree(t: Tables) -> DataFrame:
    """The trees of orders against the tips that any of them has."""
    edges = order_trees(t)
    return V.tip_species_diff(edges, edges.where("is_tip").select(F.col("label").alias("species")))


# -- ancestral states --------------------------------------------------------------------

RATE = 0.05
K = 5
#: The segment names of the test data, in name order (fixed values).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def segment_tips(t: Tables) -> tuple[DataFrame, DataFrame]:
    edges = materialize_even(heap_edges(t, "c_mktsegment"))
    tips = edges.where("is_tip").select(
        "tree_id", "node_id", F.col("label").alias("species"), F.col("c_mktsegment").alias("phenotype")
    )
    return edges.drop("c_mktsegment"), tips


def _cols(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(s=s) for s in range(1, K + 1))


# One level per recursion step.  A step sees the likelihoods of one level and
# joins the tips of the next.
_HOT = ", ".join(f"(c_mktsegment = '{seg}')::int::double as l{i + 1}" for i, seg in enumerate(SEGMENTS))
_MSG = _cols(f"ln(((1 - exp(-{K} * {RATE} * len)) / {K} + exp(-{K} * {RATE} * len) * l{{s}})) as m{{s}}")
FORWARD_SQL = f"""{HEAP},
t as (select d.level, node_id, parent_id, branch_length as len, is_tip, {_HOT}
  from nodes join deep d using (node_id)),
forward as materialized (
  with recursive f as (
    select level, node_id, parent_id, len, 0::double as scale, {_cols('l{s}')} from t
      where is_tip and level = (select max(level) from t)
    union all
    select * from (
      select any_value(t.level) as level, t.node_id, any_value(t.parent_id) as parent_id, any_value(t.len) as len,
        sum(c.scale) + ln({_cols('exp(sum(c.m{s}))', ' + ')}) as scale,
        {', '.join(f"exp(sum(c.m{s})) / ({_cols('exp(sum(c.m{s}))', ' + ')}) as l{s}" for s in range(1, K + 1))}
      from (select *, {_MSG} from f) c join t on t.node_id = c.parent_id group by t.node_id
      union all
      select level, node_id, parent_id, len, 0::double, {_cols('l{s}')} from t
      where is_tip and level = (select max(level) - 1 from f)))
  select f.*, t.is_tip from f join t using (node_id)),"""
_P = "(1 - exp(-{k} * {r} * f.len)) / {k}".format(k=K, r=RATE)
_D = "exp(-{k} * {r} * f.len)".format(k=K, r=RATE)
_R = "(p.l{s} / (" + _P + " + " + _D + " * f.l{s}))"
_RSUM = " + ".join(_R.format(s=s) for s in range(1, K + 1))
BACKWARD_SQL = f"""
backward as materialized (
  with recursive b as (
    select node_id, {_cols('l{s}')} from forward where parent_id is null
    union all
    select f.node_id, {', '.join(f"f.l{s} * ({_P} * ({_RSUM}) + {_D} * {_R.format(s=s)}) as l{s}" for s in range(1, K + 1))}
    from forward f join b p on f.parent_id = p.node_id where not f.is_tip)
  select * from b),
best as (select node_id, greatest({_cols('l{s}')}) - 1e-9 as top, {_cols('l{s}')} from backward),
states as (select node_id, (case {' '.join(f'when l{s} >= top then {s}' for s in range(1, K + 1))} end)::int as class from best)"""


@query("forward_loglik", f"""with {FORWARD_SQL.rstrip(',')}
select 'segment' as trait_id, 'heap' as tree_id,
  round(scale + ln(({_cols('l{s}', ' + ')}) / {K}), 5) as log_likelihood
from forward where parent_id is null""")
def forward_loglik(t: Tables) -> DataFrame:
    return B.log_likelihoods(_forward(t), "flat").select(
        "trait_id", "tree_id", F.round("log_likelihood", 5).alias("log_likelihood")
    )


def _forward(t: Tables) -> B.Forward:
    edges, tips = segment_tips(t)
    coded = H.code_tips(tips, H.class_legend(tips))
    states = coded.select(
        F.lit("segment").alias("trait_id"), "tree_id", "node_id",
        F.col("class").alias("state"), F.lit(RATE).alias("rate"),
    )
    return B.forward_liks(edges, states, K)


@query("marginal_states", f"""with {FORWARD_SQL} {BACKWARD_SQL}
select 'segment' as trait_id, 'heap' as tree_id, node_id, {_cols('round(l{s}, 6) as l_{s}')} from backward""")
def marginal_states(t: Tables) -> DataFrame:
    posteriors = B.marginal_states(_forward(t))
    return posteriors.select(
        "trait_id", "tree_id", "node_id", *[F.round(f"l_{s}", 6).alias(f"l_{s}") for s in range(1, K + 1)]
    )


CLASS_SQL = f"""{FORWARD_SQL} {BACKWARD_SQL},
tip_class as (select node_id, (1 + {' + '.join(f"(c_mktsegment > '{s}')::int" for s in SEGMENTS)})::int as class
  from nodes where is_tip),
class_edges as (select node_id, parent_id, is_tip, label, class from nodes
  join (select * from states union all select * from tip_class) using (node_id))"""


def er_class_tree(t: Tables) -> DataFrame:
    edges, tips = segment_tips(t)
    return B.class_tree(edges, tips, rate=RATE)[0]


@query("class_tree_er", f"""with {CLASS_SQL}
select 'heap' as tree_id, node_id, parent_id, class from class_edges""")
def class_tree_er(t: Tables) -> DataFrame:
    return er_class_tree(t).select("tree_id", "node_id", "parent_id", "class")


@query("branch_transitions", f"""with {CLASS_SQL}
select 'heap' as tree_id, c.node_id, c.class <> p.class as transition
from class_edges c join class_edges p on c.parent_id = p.node_id""")
def branch_transitions(t: Tables) -> DataFrame:
    return S.branch_transitions(er_class_tree(t))


@query("transition_matrix", f"""with {HEAP}, len as (select distinct branch_length as t from nodes),
s as (select unnest(range(1, {K + 1}))::int as s)
select t as branch_length, a.s as from_state, b.s as to_state,
  round(case when a.s = b.s then 1.0 / {K} + (1 - 1.0 / {K}) * exp(-{K} * {RATE} * t)
        else (1 - exp(-{K} * {RATE} * t)) / {K} end, 9) as probability,
  round(case when a.s = b.s then 1.0 / {K} + (1 - 1.0 / {K}) * exp(-{K} * {RATE} * t)
        else (1 - exp(-{K} * {RATE} * t)) / {K} end, 9) as from_exponential
from len, s a, s b""")
def transition_matrix(t: Tables) -> DataFrame:
    """Closed form and matrix exponential, for every distinct branch length."""
    lengths = heap_edges(t).select("branch_length").distinct().withColumn("rate", F.lit(RATE))
    cells = lengths.select(
        "branch_length", "rate",
        F.posexplode(expm_q(er_matrix(K, RATE), F.col("branch_length"))).alias("cell", "p"),
    )
    i, j = F.floor(F.col("cell") / K).cast("int"), F.col("cell") % K
    return cells.select(
        "branch_length", (i + 1).alias("from_state"), (j + 1).alias("to_state"),
        F.round(er_probability(K, i == j), 9).alias("probability"),
        F.round("p", 9).alias("from_exponential"),
    )


@query("class_newick", f"""with {ORDER_TIPS},
sub as (select l_orderkey, flag, string_agg(flag || line || ':' || (1 + line % 2), ',' order by line) as s
  from tips group by all)
select l_orderkey::varchar as tree_id, '(' || string_agg('(' || s || '):1', ',' order by flag) || ');' as newick
from sub group by l_orderkey""")
def class_newick(t: Tables) -> DataFrame:
    """Order trees as text with class codes in the length slot, inner branches in
    class 1."""
    edges = order_trees(t)
    line = F.regexp_extract("label", r"(\d+)$", 1).cast("int")
    tips = edges.where("is_tip").select("tree_id", "node_id", (line % 2 + 1).alias("class"))
    return N.edges_to_newick(H.forced_classes(edges, tips, 1), "class")


#: Rates whose likelihoods are compared.
GRID = [0.002, 0.01, 0.05, 0.25, 1.25]
_GRID_MSG = _cols(f"ln(((1 - exp(-{K} * rate * len)) / {K} + exp(-{K} * rate * len) * l{{s}})) as m{{s}}")
GRID_SQL = f"""{HEAP},
t as (select d.level, node_id, parent_id, branch_length as len, is_tip, rate, {_HOT}
  from nodes join deep d using (node_id) cross join (values {', '.join(f'({r}::double)' for r in GRID)}) as g(rate)),
grid as materialized (
  with recursive f as (
    select level, node_id, parent_id, len, rate, 0::double as scale, {_cols('l{s}')} from t
      where is_tip and level = (select max(level) from t)
    union all
    select * from (
      select any_value(t.level) as level, t.node_id, any_value(t.parent_id) as parent_id, any_value(t.len) as len, t.rate,
        sum(c.scale) + ln({_cols('exp(sum(c.m{s}))', ' + ')}) as scale,
        {', '.join(f"exp(sum(c.m{s})) / ({_cols('exp(sum(c.m{s}))', ' + ')}) as l{s}" for s in range(1, K + 1))}
      from (select *, {_GRID_MSG} from f) c join t on t.node_id = c.parent_id and t.rate = c.rate group by t.node_id, t.rate
      union all
      select level, node_id, parent_id, len, rate, 0::double, {_cols('l{s}')} from t
      where is_tip and level = (select max(level) - 1 from f)))
  select rate, scale + ln(({_cols('l{s}', ' + ')}) / {K}) as log_likelihood from f where parent_id is null)"""


@query("rate_grid", f"""with {GRID_SQL}
select model, 'segment' as trait_id, 'heap' as tree_id, rate, round(log_likelihood, 4) as log_likelihood,
  log_likelihood = max(log_likelihood) over () as is_best
from grid cross join (values ('ER'), ('ARD')) as m(model)""")
def rate_grid(t: Tables) -> DataFrame:
    """Likelihoods of a grid of rates, in closed form and as rate matrices of free rates
    that are all equal, and the best one."""
    edges, tips = segment_tips(t)
    coded = H.code_tips(tips, H.class_legend(tips))
    states = coded.select(F.lit("segment").alias("trait_id"), "tree_id", "node_id", F.col("class").alias("state"))
    grid = F.posexplode(F.array(*[F.lit(r) for r in GRID])).alias("cand", "rate")
    problems = t.region.select(F.lit("segment").alias("trait_id"), F.lit("heap").alias("tree_id")).distinct()
    cands = materialize(problems.select("trait_id", "tree_id", grid))
    matrices = cands.withColumn("q", B.flat_q(K, "ARD", F.array_repeat("rate", K * (K - 1))))
    nodes = B.tree_nodes(edges)
    found = [
        B.score_rates(edges, states, K, rows, column, nodes=nodes).drop(column).join(cands, ["trait_id", "tree_id", "cand"])
        .withColumn("model", F.lit(model))
        for model, rows, column in (("ER", cands, "rate"), ("ARD", matrices, "q"))
    ]
    both = materialize(found[0].unionByName(found[1]))
    top = both.groupBy("model", "trait_id", "tree_id").agg(F.max("log_likelihood").alias("top"))
    return both.join(top, ["model", "trait_id", "tree_id"]).select(
        "model", "trait_id", "tree_id", "rate", F.round("log_likelihood", 4).alias("log_likelihood"),
        (F.col("log_likelihood") == F.col("top")).alias("is_best"),
    )


@query("fit_mk")
def fit_mk(t: Tables) -> DataFrame:
    """Rate of change of the market segment on the heap tree, by maximum likelihood."""
    edges, tips = segment_tips(t)
    coded = H.code_tips(tips, H.class_legend(tips))
    states = coded.select(
        F.lit("segment").alias("trait_id"), "tree_id", "node_id", F.col("class").alias("state")
    )
    return B.fit_mk(edges, states, K, "ER")


# -- turnover ----------------------------------------------------------------------------


@query("turnover_inputs", r"""
with cells as (select coalesce(n_name, 'none ' || p_size % 30) as species, p_partkey as family_id,
    case p_partkey % 11 when 0 then 'NA' when 1 then '-' || p_size when 2 then null
      when 3 then ' ' || p_size || ' ' when 4 then p_size || '.5' else p_size::varchar end as cell
  from part left join nation on n_nationkey = p_size % 30)
select 'ERROR' as severity, case when cell is null or not regexp_matches(cell, '^\s*[+-]?\d+\s*$')
    then 'not_an_integer' else 'negative_count' end as code,
  family_id || '/' || species as subject, coalesce(cell, '(missing)') as detail
from cells where cell is null or not regexp_matches(cell, '^\s*[+-]?\d+\s*$') or trim(cell)::bigint < 0
union all select 'ERROR', 'tip_mismatch', n_name, 'species: only_in_tree' from nation
  where n_name not in (select species from cells)
union all select distinct 'ERROR', 'tip_mismatch', species, 'species: only_in_list' from cells
  where species not in (select n_name from nation)
union all select 'ERROR', 'not_rooted', 'species', 'root children: 5'
union all select 'ERROR', 'polytomy', 'species', 'polytomies: ' || (1 + (select count(*) from
  (select n_regionkey from nation group by n_regionkey having count(*) > 2)))""")
def turnover_inputs(t: Tables) -> DataFrame:
    """Part sizes as cells of nations against the region/nation tree."""
    cells = part_cells(t).drop("species").join(
        t.part.select(F.col("p_partkey").alias("family_id"), "p_size"), "family_id"
    )
    place = F.col("p_size") % 30
    name = F.coalesce("n_name", F.concat(F.lit("none "), place))
    named = cells.join(t.nation, F.col("n_nationkey") == place, "left").select(
        "family_id", name.alias("species"), "cell"
    )
    return V.validate_turnover_inputs(named, species_edges(t))


NODE_SIZES = f"""{MEMBERS},
fam as (select distinct l_partkey as family_id from members),
n_cnt as (select family_id, n.n_name, n.n_regionkey, count(l_partkey) as copies from fam cross join nation n
  left join members m on l_partkey = family_id and m.n_name = n.n_name group by all),
r_cnt as (select family_id, r_name, r_regionkey, floor(sum(copies) / 5)::bigint as copies
  from n_cnt join region on r_regionkey = n_regionkey group by all),
root_cnt as (select family_id, floor(sum(copies) / 25)::bigint as copies from n_cnt group by all),
sizes as (select family_id, n_name as node, copies from n_cnt
  union all select family_id, r_name, copies from r_cnt union all select family_id, 'root', copies from root_cnt),
changes as (select n.family_id, n.n_name as branch, n.copies - r.copies as change
    from n_cnt n join r_cnt r on r.family_id = n.family_id and r.r_regionkey = n.n_regionkey
  union all select r.family_id, r.r_name, r.copies - o.copies from r_cnt r join root_cnt o using (family_id))"""


def node_sizes(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Sizes of nations, regions and the root (means of the nations, rounded down),
    and the change on every branch."""
    species = nation_species(t)
    dense = C.long_counts(C.wide_counts(nation_counts(t), species), species)
    where = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("species"), "r_name"
    )
    tips = dense.join(where, "species")
    region = tips.groupBy("family_id", "r_name").agg(
        F.floor(F.sum("copies") / 5).cast("bigint").alias("region_copies")
    )
    root = tips.groupBy("family_id").agg(
        F.floor(F.sum("copies") / 25).cast("bigint").alias("root_copies")
    )
    sizes = (
        tips.select("family_id", F.col("species").alias("node"), "copies")
        .union(region.select("family_id", "r_name", "region_copies"))
        .union(root.withColumn("node", F.lit("root")).select("family_id", "node", "root_copies"))
    )
    below = tips.join(region, ["family_id", "r_name"]).select(
        "family_id", F.col("species").alias("branch"),
        (F.col("copies") - F.col("region_copies")).alias("change"),
    )
    above = region.join(root, "family_id").select(
        "family_id", F.col("r_name").alias("branch"),
        (F.col("region_copies") - F.col("root_copies")).alias("change"),
    )
    return sizes, below.unionByName(above)


BRANCH_SQL = """select branch, count(*) filter (where change > 0) as n_expanded,
  count(*) filter (where change < 0) as n_contracted,
  coalesce(sum(change) filter (where change > 0), 0)::bigint as genes_gained,
  coalesce(-sum(change) filter (where change < 0), 0)::bigint as genes_lost from changes group by branch"""


@query("turnover_by_branch", f"with {NODE_SIZES} {BRANCH_SQL}")
def turnover_by_branch(t: Tables) -> DataFrame:
    return S.turnover_by_branch(node_sizes(t)[1])


@query("turnover_on_tree", f"""with {NODE_SIZES}, b as ({BRANCH_SQL})
select 'species' as tree_id, coalesce(branch, 'root') as label, coalesce(n_expanded, 0) as n_expanded,
  coalesce(n_contracted, 0) as n_contracted, coalesce(genes_gained, 0) as genes_gained,
  coalesce(genes_lost, 0) as genes_lost
from (select n_name as l from nation union all select r_name from region union all select 'root')
left join b on l = branch""")
def turnover_on_tree(t: Tables) -> DataFrame:
    table = S.tree_turnover_table(species_edges(t), turnover_by_branch(t))
    return table.select(
        "tree_id", "label", "n_expanded", "n_contracted", "genes_gained", "genes_lost"
    )


@query("family_dynamics", f"""with {NODE_SIZES},
s as (select family_id, min(copies) as min_copies, max(copies) as max_copies,
  round(avg(copies), 6) as mean_copies from sizes group by family_id),
m as (select family_id, sum(greatest(change, 0))::bigint as total_gain,
  sum(greatest(-change, 0))::bigint as total_loss from changes group by family_id)
select * from s join m using (family_id)""")
def family_dynamics(t: Tables) -> DataFrame:
    sizes, changes = node_sizes(t)
    return S.family_dynamics(sizes, changes).withColumn("mean_copies", F.round("mean_copies", 6))


# Trait of a nation: its region, with one region unlabelled.
def nation_labels(t: Tables) -> DataFrame:
    label = F.when(F.col("r_name") != "ASIA", F.col("r_name"))
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("species"), label.alias("phenotype")
    )


def part_pvalues(t: Tables) -> DataFrame:
    # the smallest parts have no value
    value = F.when(F.col("p_size") > 2, (F.col("p_size") / 100.0).cast("double"))
    return t.part.select(F.col("p_partkey").alias("family_id"), value.alias("pvalue"))


LABELLED = f"""{NODE_SIZES},
pv as (select p_partkey as family_id, case when p_size > 2 then p_size / 100.0::double end as pvalue from part),
labelled as (select family_id, n.n_name as species, copies, nullif(r_name, 'ASIA') as phenotype
  from n_cnt n join region on r_regionkey = n_regionkey)"""


def labelled_counts(t: Tables) -> DataFrame:
    species = nation_species(t)
    dense = C.long_counts(C.wide_counts(nation_counts(t), species), species)
    return S.add_phenotype(dense, nation_labels(t))


@query("significant_families", f"with {LABELLED} select * from pv where pvalue < 0.05")
def significant_families(t: Tables) -> DataFrame:
    return S.significant_families(part_pvalues(t))


@query("merge_family_results", f"""with {LABELLED}
select family_id, n_name as species, copies, pvalue from n_cnt left join pv using (family_id)""")
def merge_family_results(t: Tables) -> DataFrame:
    return S.merge_family_results(labelled_counts(t).drop("phenotype"), part_pvalues(t))


@query("add_phenotype", f"with {LABELLED} select * from labelled")
def add_phenotype(t: Tables) -> DataFrame:
    return labelled_counts(t)


@query("mean_copies_by_phenotype", f"""with {LABELLED}
select family_id, phenotype, round(avg(copies), 6) as mean_copies, count(*) as n_species
from labelled group by all""")
def mean_copies_by_phenotype(t: Tables) -> DataFrame:
    return S.mean_copies_by_phenotype(labelled_counts(t)).withColumn(
        "mean_copies", F.round("mean_copies", 6)
    )


@query("associate", f"""with {LABELLED},
x as (select l.family_id, p.r_name as phenotype, l.copies, (l.phenotype = p.r_name)::int as hit
  from labelled l cross join region p where l.phenotype is not null and p.r_name <> 'ASIA')
select family_id, phenotype,
  round(avg(copies) filter (where hit = 1) - avg(copies) filter (where hit = 0), 6) + 0.0 as mean_difference,
  case when max(copies) > min(copies) then round(corr(copies, hit), 6) end + 0.0 as correlation
from x group by family_id, phenotype having count(*) filter (where hit = 1) > 0""")
def associate(t: Tables) -> DataFrame:
    # adding 0.0 turns a rounded -0.0 into 0.0
    return S.associate(labelled_counts(t)).select(
        "family_id", "phenotype",
        (F.round("mean_difference", 6) + F.lit(0.0)).alias("mean_difference"),
        (F.round("correlation", 6) + F.lit(0.0)).alias("correlation"),
    )


@query("transition_overlap", f"""with {CLASS_SQL},
gain as (select c_name as branch, sum(l_quantity)::bigint as g from customer
  join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey group by c_name),
x as (select c.class <> p.class as t, coalesce(g, 0) >= 900 as h
  from class_edges c join class_edges p on c.parent_id = p.node_id left join gain on branch = c.label)
select count(*) filter (where t and h) as transition_high, count(*) filter (where t and not h) as transition_low,
  count(*) filter (where not t and h) as stable_high, count(*) filter (where not t and not h) as stable_low from x""")
def transition_overlap(t: Tables) -> DataFrame:
    """Customers' bought quantities as gains on the branches of the heap tree."""
    changes = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.customer, F.col("o_custkey") == F.col("c_custkey")
    ).select(
        F.col("l_partkey").alias("family_id"), F.col("c_name").alias("branch"),
        F.col("l_quantity").cast("bigint").alias("change"),
    )
    edges = materialize(er_class_tree(t))
    names = edges.select("tree_id", "node_id", F.col("label").alias("branch"))
    transitions = S.branch_transitions(edges).join(names, ["tree_id", "node_id"])
    return S.transition_overlap(S.turnover_by_branch(changes), transitions, 900)


NATION_COLUMNS = ", ".join(f"sum(case when n_name = 'NATION_{i}' then copies end)::bigint as NATION_{i}" for i in range(25))


@query("heatmap_table", f"with {NODE_SIZES} select family_id, {NATION_COLUMNS} from n_cnt group by family_id")
def heatmap_table(t: Tables) -> DataFrame:
    return S.heatmap_table(nation_counts(t), nation_species(t))


@query("size_histogram", f"""with {MEMBERS}, s as (select l_partkey, count(*) as size from members group by all)
select (case when size < 0 then 0 when size >= 60 then 13 else floor(size / 5) + 1 end)::bigint as bin,
  count(*) as n_families from s group by 1""")
def size_histogram(t: Tables) -> DataFrame:
    return S.size_histogram(nation_counts(t), 0, 60, 12)


@query("phenotype_quantiles", f"""with {LABELLED}
select phenotype, min(copies)::double as low, quantile_cont(copies, 0.25) as q1,
  quantile_cont(copies, 0.5) as median, quantile_cont(copies, 0.75) as q3, max(copies)::double as high
from labelled where phenotype is not null group by phenotype""")
def phenotype_quantiles(t: Tables) -> DataFrame:
    return S.phenotype_quantiles(labelled_counts(t))


def _results(t: Tables) -> dict[str, DataFrame]:
    _, changes = node_sizes(t)
    counts = labelled_counts(t).drop("phenotype")
    return summary_tables(counts, part_pvalues(t), nation_labels(t), changes)


@query("gene_family_summary", f"""with {LABELLED},
s as (select family_id, min(copies) as min_copies, max(copies) as max_copies,
  round(avg(copies), 6) as mean_copies from n_cnt group by family_id),
m as (select family_id, sum(greatest(change, 0))::bigint as total_gain,
  sum(greatest(-change, 0))::bigint as total_loss from changes group by family_id)
select * from s join m using (family_id) left join pv using (family_id)""")
def gene_family_summary(t: Tables) -> DataFrame:
    return _results(t)["gene_family_summary"].withColumn("mean_copies", F.round("mean_copies", 6))


@query("significant_family_table", f"""with {LABELLED},
m as (select family_id, phenotype, round(avg(copies), 6) as mean_copies, count(*) as n_species
  from labelled where phenotype is not null group by all)
select pv.family_id, pvalue, phenotype, mean_copies, n_species from pv left join m using (family_id)
where pvalue < 0.05""")
def significant_family_table(t: Tables) -> DataFrame:
    return _results(t)["significant_families"].withColumn("mean_copies", F.round("mean_copies", 6))


@query("turnover_by_phenotype", f"""with {LABELLED}
select phenotype, sum(copies)::bigint as total_copies, round(avg(copies), 6) as mean_copies,
  count(*) filter (where copies > 0) as n_present
from labelled semi join (select family_id from pv where pvalue < 0.05) using (family_id)
where phenotype is not null group by phenotype""")
def turnover_by_phenotype(t: Tables) -> DataFrame:
    return _results(t)["turnover_by_phenotype"].withColumn("mean_copies", F.round("mean_copies", 6))
