"""Search plans, costs and manifests on the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as V
from ..operators import search as P
from ..runtime import checkpoint_root
from ..sources import reports as R
from ..streaming import gate as G
from .registry import Tables, query

# Species are nations.  A proteome's size is the number of its customers, a
# search result is an order line between the customer's and the supplier's nation.


def nation_ids(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("id"))


def nation_sizes(t: Tables) -> DataFrame:
    spent = F.sum(F.floor("o_totalprice").cast("bigint")).alias("size_bytes")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("id")
    ).agg(spent)


def line_pairs(t: Tables) -> DataFrame:
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("c_nationkey").alias("qid")
    )
    sellers = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("did"))
    return (
        t.lineitem.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("qid", "did", "l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    )


LINES = """
lines as (select c_nationkey as qid, s_nationkey as did, l_orderkey, l_quantity, l_extendedprice, l_returnflag
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey),
sizes as (select c_nationkey as id, sum(floor(o_totalprice)::bigint)::bigint as size_bytes
  from orders join customer on o_custkey = c_custkey group by c_nationkey)"""


def results(t: Tables) -> DataFrame:
    """One result per pair, as long as the returned goods with a high value."""
    big = F.when(
        (F.col("l_returnflag") == "R") & (F.col("l_extendedprice") > 90000), F.col("l_quantity")
    ).otherwise(F.lit(0))
    return line_pairs(t).groupBy("qid", "did").agg(F.sum(big).cast("bigint").alias("length"))


RESULTS = f"""{LINES},
results as (select qid, did, sum(case when l_returnflag = 'R' and l_extendedprice > 90000
    then l_quantity else 0 end)::bigint as length from lines group by all),
missing as (select a.n_nationkey as qid, b.n_nationkey as did from nation a cross join nation b
  where not exists (select 1 from results r where r.qid = a.n_nationkey and r.did = b.n_nationkey
                    and r.length > 0))"""


@query("missing_pairs", f"with {RESULTS} select * from missing")
def missing_pairs(t: Tables) -> DataFrame:
    return P.missing_pairs(nation_ids(t), results(t))


@query("missing_after_replay", f"with {RESULTS} select * from missing")
def missing_after_replay(t: Tables) -> DataFrame:
    """Results that arrive in files, taken in by a stream in two runs: what is missing then."""
    folder = f"{checkpoint_root(t.spark).rstrip('/')}/gate-{uuid.uuid4().hex}"
    every = results(t).select(F.col("qid").cast("bigint"), F.col("did").cast("bigint"), "length")
    ranked = G.positions(nation_ids(t))
    for part in (F.col("qid") % 3 == 0, F.col("did") % 2 == 0, F.lit(True)):
        # results come again, and a later file can have what an earlier one had not
        every.where(part).repartition(3).write.mode("append").parquet(f"{folder}/arrivals")
        G.run_gate(t.spark, f"{folder}/arrivals", ranked, folder, files_per_batch=2)
    return G.still_missing(t.spark, folder, ranked)


@query("completeness", f"""with {RESULTS}
select (select count(*) * count(*) from nation) as n_expected,
  (select count(*) * count(*) from nation) - count(*) as n_present, count(*) as n_missing from missing""")
def completeness(t: Tables) -> DataFrame:
    return P.completeness(nation_ids(t), missing_pairs(t))


def manifest(t: Tables) -> DataFrame:
    """A pair belongs to the tasks of the orders it occurs in."""
    return line_pairs(t).select((F.col("l_orderkey") % 500).alias("task_id"), "qid", "did").distinct()


@query("pairs_to_tasks", f"""with {RESULTS}
select distinct l_orderkey % 500 as task_id from lines semi join missing using (qid, did)""")
def pairs_to_tasks(t: Tables) -> DataFrame:
    return P.pairs_to_tasks(missing_pairs(t), manifest(t))


@query("pair_costs", f"""with {LINES}, pairs as (select distinct qid, did from lines)
select qid, did, q.size_bytes as query_bytes, d.size_bytes as db_bytes,
  (q.size_bytes::hugeint * d.size_bytes)::varchar as cost
from pairs left join sizes q on q.id = qid left join sizes d on d.id = did""")
def pair_costs(t: Tables) -> DataFrame:
    pairs = line_pairs(t).select("qid", "did").distinct()
    costed = P.pair_costs(pairs, nation_sizes(t))
    return costed.withColumn("cost", F.col("cost").cast("string"))


@query("bucket_summary", f"""with {LINES},
m as (select distinct l_orderkey % 500 as task_id, qid, did from lines)
select task_id, sum(q.size_bytes::hugeint * d.size_bytes)::varchar as task_cost,
  count(*) as n_commands, max(d.size_bytes) as largest_db_bytes
from m join sizes q on q.id = qid join sizes d on d.id = did group by task_id""")
def bucket_summary(t: Tables) -> DataFrame:
    pairs = line_pairs(t).select("qid", "did").distinct()
    summary = P.bucket_summary(P.pair_costs(pairs, nation_sizes(t)), manifest(t))
    return summary.withColumn("task_cost", F.col("task_cost").cast("string"))


@query("busiest_task", f"""with {LINES},
m as (select distinct l_orderkey % 500 as task_id, qid, did from lines),
s as (select task_id, sum(q.size_bytes::hugeint * d.size_bytes) as cost, max(d.size_bytes) as largest
  from m join sizes q on q.id = qid join sizes d on d.id = did group by task_id)
select max(cost)::varchar as max_task_cost,
  (select task_id from s order by cost desc, task_id limit 1) as busiest_task,
  max(largest) as largest_db_bytes from s""")
def busiest_task(t: Tables) -> DataFrame:
    pairs = line_pairs(t).select("qid", "did").distinct()
    summary = P.bucket_summary(P.pair_costs(pairs, nation_sizes(t)), manifest(t))
    return P.busiest_task(summary).withColumn("max_task_cost", F.col("max_task_cost").cast("string"))


@query("throughput", """
with r as (select floor(l_extendedprice * 100)::bigint as cost, (l_quantity - 1)::double as seconds from lineitem)
select count(*) as n_runs, sum(cost)::bigint as total_cost, sum(seconds) as total_seconds,
  round(sum(cost)::double / sum(seconds), 4) as aggregate_rate,
  round(min(cost / seconds) filter (where seconds > 0), 6) as min_rate,
  round(quantile_cont(case when seconds > 0 then cost / seconds end, 0.5), 6) as median_rate,
  round(max(cost / seconds) filter (where seconds > 0), 6) as max_rate from r""")
def throughput(t: Tables) -> DataFrame:
    runs = t.lineitem.select(
        F.floor(F.col("l_extendedprice") * 100).cast("bigint").alias("cost"),
        (F.col("l_quantity") - 1).alias("seconds"),
    )
    report = P.throughput(runs)
    return report.select(
        "n_runs", F.col("total_cost").cast("bigint").alias("total_cost"), "total_seconds", F.round("aggregate_rate", 4).alias("aggregate_rate"),
        *[F.round(c, 6).alias(c) for c in ("min_rate", "median_rate", "max_rate")],
    )


@query("proteome_volume", """
select sum(n_chars)::bigint as total_bytes, max(n_chars) as largest_bytes, count(*) as n_files from documents""")
def proteome_volume(t: Tables) -> DataFrame:
    return P.proteome_volume(t.documents.select(F.col("n_chars").alias("length")))


# -- command lists -----------------------------------------------------------------------


def command_lines(t: Tables) -> DataFrame:
    """Command lines from order lines; some have other text or wrong tokens."""
    q, d = F.col("l_partkey"), F.col("l_suppkey")
    query_id = F.when(F.col("l_linenumber") == 6, q + 1).otherwise(q)
    database_id = F.when(F.col("l_linenumber") == 5, d + 1).otherwise(d)
    head = F.when(F.col("l_linenumber") == 7, F.lit("diamond commands that must be run: ")).otherwise(
        F.lit("diamond blastp -d w/diamondDBSpecies")
    )
    out = F.when(
        F.col("l_linenumber") == 4, F.lit("out.gz")
    ).otherwise(F.concat(F.lit("w/Blast"), q, F.lit("_"), d, F.lit(".txt.gz")))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.concat(head, database_id, F.lit(" -q w/Species"), query_id, F.lit(".fa -o "), out,
                 F.lit(" -p 1")).alias("value"),
    )


@query("search_commands", """
select l_orderkey, l_linenumber, l_partkey::int as qid, l_suppkey::int as did,
  case when l_linenumber = 6 then 'query token disagrees'
       when l_linenumber = 5 then 'database token disagrees' end as error
from lineitem where l_linenumber <> 7""")
def search_commands(t: Tables) -> DataFrame:
    return R.parse_search_pairs(command_lines(t)).select(
        "l_orderkey", "l_linenumber", "qid", "did", "error"
    )


@query("species_ids", """
select o_orderkey::int as id, o_orderpriority || '.fa' as filename from orders where o_orderstatus <> 'F'""")
def species_ids(t: Tables) -> DataFrame:
    line = F.concat(
        F.when(F.col("o_orderstatus") == "F", F.lit("#")).otherwise(F.lit("")),
        F.col("o_orderkey"), F.lit(": "), F.col("o_orderpriority"), F.lit(".fa"),
    )
    return R.parse_species_ids(t.orders.select(line.alias("value")))


@query("dated_trees", r"""
select user_id::varchar as file, '(a:' || event_id || ',b:1);' as newick from (
  select *, row_number() over (partition by user_id order by event_id desc) as rn
  from events where event_type in ('click', 'view')) where rn = 1""")
def dated_trees(t: Tables) -> DataFrame:
    """Solver logs from events: one per user, clicks and views are tree lines."""
    tree = F.concat(
        F.when(F.col("event_type") == "click", F.lit("tree t = [&R] (a:")).otherwise(F.lit(" tree x = (a:")),
        F.col("event_id"), F.lit(",b:1);"),
    )
    value = F.when(F.col("event_type").isin("click", "view"), tree).otherwise(F.col("event_type"))
    lines = t.events.select(
        F.col("user_id").cast("string").alias("file"), F.col("event_id").alias("ord"),
        value.alias("value"),
    )
    return R.last_dated_trees(lines)


@query("search_plan_check", f"""with {LINES}, pairs as (select distinct qid, did from lines),
dbs as (select distinct s_nationkey as id from supplier where s_acctbal > 8000)
select 'ERROR' as severity, 'incomplete_plan' as code, 'search plan' as subject,
  count(*) || ' of ' || (select count(*) * count(*) from nation) || ' searches' as detail
  from pairs having count(*) <> (select count(*) * count(*) from nation)
union all
select 'ERROR', 'missing_database', n_nationkey::varchar, 'diamondDBSpecies' || n_nationkey || '.dmnd'
from nation where n_nationkey not in (select id from dbs)""")
def search_plan_check(t: Tables) -> DataFrame:
    pairs = line_pairs(t).select("qid", "did").distinct()
    # databases of the other suppliers are unfinished
    end = F.when(F.col("s_acctbal") > 8000, F.lit(".dmnd")).otherwise(F.lit(".part"))
    built = t.supplier.select(
        F.concat(F.lit("diamondDBSpecies"), F.col("s_nationkey"), end).alias("name")
    ).distinct()
    return P.search_plan_check(pairs, nation_ids(t), built)


@query("verify_manifest", """
with was as (select doc_id::varchar as path, md5(text) as md5 from documents where doc_id % 10 <> 0),
now as (select doc_id::varchar as path, md5(case when doc_id % 7 = 0 then text || ' ' else text end) as md5
  from documents where doc_id % 9 <> 0)
select coalesce(was.path, now.path) as path,
  case when now.path is null then 'missing' when was.path is null then 'new' else 'changed' end as status
from was full join now on was.path = now.path where was.md5 is distinct from now.md5""")
def verify_manifest(t: Tables) -> DataFrame:
    """Two states of the documents as file manifests."""
    path = F.col("doc_id").cast("string").alias("path")
    was = t.documents.where("doc_id % 10 <> 0").select(path, F.md5("text").alias("md5"))
    text = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    now = t.documents.where("doc_id % 9 <> 0").select(path, F.md5(text).alias("md5"))
    return V.verify_manifest(was, now)
