"""Sources and sinks on the given tables: what is written to the shared folder and read
back must be the rows it was made from."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import checks as V
from ..operators import counts as C
from ..operators import phenotype as H
from ..plans.cleaning import clean_directory
from ..runtime import checkpoint_root, small_rows
from ..sources import fasta as S
from ..sources import files as I
from ..sources import reports as R
from ..sources import tables as T
from .genes import CELLS_SQL, MEMBERS, REGION_CELLS, REGIONS, RECORDS, part_cells, records, region_members, region_species
from .registry import Tables, query
from .search import command_lines
from .traits import TIPS, raw_labels, tip_labels


def new_folder(t: Tables, name: str) -> str:
    return f"{checkpoint_root(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# -- FASTA ---------------------------------------------------------------------------


def proteins(t: Tables) -> DataFrame:
    """Documents as records whose species can name a file and whose sequence has neither
    white space nor a record mark."""
    rows = records(t)
    species = F.regexp_replace("species", r"[^A-Za-z0-9._-]", "_")
    sequence = F.regexp_replace("sequence", r"[ \t\n\x0B\f\r>]", "")
    return rows.withColumn("species", species).withColumn("sequence", sequence).withColumn(
        "length", F.length("sequence")
    ).withColumn("sort_rank", F.lit(0)).withColumn("gene_id", F.lit(None).cast("string"))


PROTEINS = RECORDS.replace("select source as species", "select regexp_replace(source, '[^A-Za-z0-9._-]', '_', 'g') as species").replace(
    "text as sequence, length(text) as length",
    r"regexp_replace(text, '[ \t\n\x0B\f\r>]', '', 'g') as sequence, length(regexp_replace(text, '[ \t\n\x0B\f\r>]', '', 'g')) as length",
)


@query("fasta_round_trip", f"""with {PROTEINS} select species, header, accession, sequence, length::int as length from rec""")
def fasta_round_trip(t: Tables) -> DataFrame:
    """Records written as part files by species and read in small ranges."""
    folder = new_folder(t, "fasta")
    S.write_fasta(proteins(t), folder)
    return S.read_fasta_sink(t.spark, folder, split_bytes=1 << 16).select(
        "species", "header", "accession", "sequence", "length"
    )


@query("fasta_compressed", f"""with {PROTEINS}, kinds(kind) as (values ('bzip2'), ('gzip'))
select kind, species, header, md5(sequence) as md5 from rec cross join kinds""")
def fasta_compressed(t: Tables) -> DataFrame:
    """Bzip2 files cut between their blocks, and gzip files whose names don't tell."""
    packed, hidden = new_folder(t, "bzip2"), new_folder(t, "gzip")
    S.write_fasta(proteins(t), packed, one_file=True, compression="bzip2")
    lines = proteins(t).select(F.col("species").alias("file"), "ord", S.fasta_text().alias("value"))
    lines = lines.repartition("file").sortWithinPartitions("file", "ord")
    S.write_lines(lines, hidden, exact=True, compression="gzip", suffix=".fasta")
    found = [
        S.read_fasta_directory(t.spark, folder, split_bytes=1 << 16).withColumn("kind", F.lit(kind))
        for kind, folder in (("bzip2", packed), ("gzip", hidden))
    ]
    return found[0].unionByName(found[1]).select("kind", "species", "header", F.md5("sequence").alias("md5"))


@query("fasta_directory", f"""with {PROTEINS}
select species, species || '.fa' as file, count(*) as n_records, sum(length)::bigint as n_residues from rec group by species""")
def fasta_directory(t: Tables) -> DataFrame:
    folder = new_folder(t, "proteomes")
    S.write_fasta(proteins(t), folder, one_file=True)
    return S.read_fasta_directory(t.spark, folder).groupBy("species", "file").agg(
        F.count("*").alias("n_records"), F.sum("length").alias("n_residues")
    )


@query("fasta_file_list", f"""with {PROTEINS},
files as (select species, row_number() over (order by species desc) - 1 as file_idx from (select distinct species from rec))
select 'all' as species, species || '.fa' as file, file_idx::int as file_idx, header, length::int as length
from rec join files using (species)""")
def fasta_file_list(t: Tables) -> DataFrame:
    """The files of one species, in a given order."""
    folder = new_folder(t, "chromosomes")
    rows = proteins(t)
    S.write_fasta(rows, folder, one_file=True)
    names = sorted((r["species"] for r in small_rows(rows.select("species").distinct(), "files")), reverse=True)
    got = S.read_fasta(t.spark, [f"{folder}/{n}.fa" for n in names], species="all")
    return got.select("species", "file", F.col("ord.file_idx").alias("file_idx"), "header", "length")


@query("clean_folder", f"""with {PROTEINS}
select species, header, length::int as length from (
  select *, row_number() over (partition by species, gene_id order by length desc, ord) as rn from genes)
where rn = 1 or gene_id is null""")
def clean_folder(t: Tables) -> DataFrame:
    """A folder of proteomes cleaned in one job; the kept records as they were written."""
    given, out = new_folder(t, "raw"), new_folder(t, "clean")
    S.write_fasta(proteins(t), given, one_file=True)
    clean_directory(t.spark, given, out, on_duplicate="skip")
    return S.read_fasta_sink(t.spark, f"{out}/fasta").select("species", "header", "length")


@query("clean_folder_stats", f"""with {PROTEINS},
totals as (select species, count(*) as total_records from rec group by species),
g as (select species, count(distinct gene_id) as unique_genes, count(*) filter (where gene_id is null) as unidentified
  from genes group by species)
select species, total_records, unique_genes, unidentified, unique_genes + unidentified as output_records,
  'ensembl' as detected_format from totals join g using (species)""")
def clean_folder_stats(t: Tables) -> DataFrame:
    """The statistics of the same job, from their JSON files."""
    given, out = new_folder(t, "raw"), new_folder(t, "clean")
    S.write_fasta(proteins(t), given, one_file=True)
    cleaned = clean_directory(t.spark, given, out, on_duplicate="skip")
    return t.spark.read.schema(cleaned.stats.schema).json(f"{out}/stats")


# -- inventories, sizes, manifests -----------------------------------------------------


def part_files(t: Tables) -> DataFrame:
    """Lines of one file a part size: records of parts."""
    record = F.concat(F.lit(">P"), F.col("p_partkey"), F.lit("\n"), F.col("p_name"))
    lines = t.part.select(F.concat(F.lit("Species"), F.col("p_size")).alias("file"), "p_partkey", record.alias("value"))
    return lines.repartition("file").sortWithinPartitions("file", "p_partkey")


@query("proteome_size_files", """
select p_size as id, sum(strlen('>P' || p_partkey) + strlen(p_name) + 2)::bigint as size_bytes from part group by p_size""")
def proteome_size_files(t: Tables) -> DataFrame:
    folder = new_folder(t, "numbered")
    S.write_lines(part_files(t), folder, exact=True, suffix=".fa")
    return I.proteome_sizes(t.spark, folder)


@query("manifest_files", """
with f as (select 'Species' || p_size || '.fa' as name,
  string_agg('>P' || p_partkey || chr(10) || p_name || chr(10), '' order by p_partkey) as content from part group by p_size)
select name, md5(content) as md5, strlen(content)::bigint as size_bytes,
  ((strlen(content) + 999) // 1000)::bigint as n_chunks,
  md5(array_to_string(list_transform(range(0, strlen(content), 1000), lambda i: md5(content[i + 1 : i + 1000])), '')) as tree_md5
from f""")
def manifest_files(t: Tables) -> DataFrame:
    """MD5 sums of files, whole and as a tree over chunks of 1,000 bytes."""
    folder = new_folder(t, "manifest")
    S.write_lines(part_files(t), folder, exact=True, suffix=".fa")
    whole = I.file_manifest(t.spark, folder).select("path", "md5", "size_bytes")
    tree = I.tree_manifest(t.spark, folder, chunk_bytes=1000).select("path", "tree_md5", "n_chunks")
    name = F.regexp_extract("path", r"([^/]*)$", 1).alias("name")
    return whole.join(tree, "path").select(name, "md5", "size_bytes", "n_chunks", "tree_md5")


@query("newest_results", """
select 'Results_' || max(p_brand) as folder, count(*) filter (where p_brand = (select max(p_brand) from part)) as n_lines from part""")
def newest_results(t: Tables) -> DataFrame:
    """Runs written one after another: the newest one and its lines."""
    root = new_folder(t, "runs")
    brands = sorted(r["p_brand"] for r in small_rows(t.part.select("p_brand").distinct(), "runs"))
    for brand in brands[:1] + brands[-1:]:
        lines = t.part.where(F.col("p_brand") == brand).select(F.lit("Species_Tree").alias("file"), F.col("p_name").alias("value"))
        S.write_lines(lines, f"{root}/Results_{brand}")
    newest = I.latest_results(t.spark, root)
    found = t.spark.read.text(f"{newest}/Species_Tree")
    return found.agg(F.lit(newest.rpartition("/")[2]).alias("folder"), F.count("*").alias("n_lines"))


@query("proteome_folder_report", """
with f as (select r_regionkey, r_name || ' ' || r_regionkey as stem, count(n_name) as n from region
  left join nation on n_regionkey = r_regionkey group by all)
select 'INFO' as severity, 'n_files' as code, 'folder' as subject, count(*)::varchar as detail from f
union all select 'WARNING', 'unusual_name', stem || '.fa', 'use letters, digits, dots, hyphens and underscores' from f
union all select 'ERROR', 'not_fasta', stem || '.fa', 'does not start with a header' from f where r_regionkey % 2 = 1""")
def proteome_folder_report(t: Tables) -> DataFrame:
    """Files of nations by region, every other one without a header."""
    folder = new_folder(t, "checked")
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    mark = F.when(F.col("r_regionkey") % 2 == 0, F.lit(">")).otherwise(F.lit(""))
    lines = joined.select(
        F.concat_ws(" ", "r_name", "r_regionkey").alias("file"), "n_nationkey", F.concat(mark, F.col("n_name")).alias("value")
    )
    S.write_lines(lines.repartition("file").sortWithinPartitions("file", "n_nationkey"), folder, exact=True, suffix=".fa")
    report = V.validate_proteomes(t.spark, folder)
    return report.withColumn("subject", F.when(F.col("subject") == folder, F.lit("folder")).otherwise(F.col("subject")))


# -- tables ----------------------------------------------------------------------------


@query("tsv_file", """
select s_suppkey::varchar as s_suppkey, s_name, s_acctbal::varchar as s_acctbal, null::varchar as note from supplier""")
def tsv_file(t: Tables) -> DataFrame:
    """A table written by columns, one of which it lacks, and read back as text."""
    folder = new_folder(t, "tsv")
    T.write_tsv(t.supplier, folder, ["s_name", "note", "s_suppkey", "s_acctbal"])
    return T.read_tsv(t.spark, folder)


@query("gene_count_file", f"""with {MEMBERS}, k as (select distinct l_partkey from members)
select k.l_partkey::varchar as family_id, region.r_name as species, count(m.l_partkey) as copies
from k cross join region left join members m
  on m.l_partkey = k.l_partkey and m.r_name = region.r_name group by all""")
def gene_count_file(t: Tables) -> DataFrame:
    """A count table with totals, read as long counts."""
    folder, species = new_folder(t, "counts"), region_species(t)
    T.write_tsv(C.gene_counts(region_members(t), species), folder, ["family_id", *species, "Total"])
    return T.read_gene_counts(t.spark, folder)[0]


TEXT_CELLS = ", ".join(f"""(count(*) filter (where r_name = '{r}'))::varchar as "{r}" """ for r in REGIONS)


@query("count_cell_lines", f"""with {CELLS_SQL},
lines as (select family_id, cell, row_number() over (order by family_id)
    + (select count(*) from part p where p.p_partkey < cells.family_id and p.p_partkey % 50 = 0) + 1 as line from cells)
select line::bigint as line, family_id::varchar as family_id, 'odd' as species, cell from lines
union all select line, family_id::varchar, 'plain', family_id::varchar from lines""")
def count_cell_lines(t: Tables) -> DataFrame:
    """Cells of a count table with their lines; some are no numbers, some lines are blank."""
    folder = new_folder(t, "cells")
    cells = part_cells(t)
    head = t.region.agg(F.min("r_regionkey").alias("family_id")).select(
        F.lit("counts").alias("file"), F.lit(0).alias("rank"), F.lit(-1).cast("bigint").alias("family_id"),
        F.lit("Family\todd\tplain\tTotal").alias("value"),
    )
    rows = cells.select(
        F.lit("counts").alias("file"), F.lit(1).alias("rank"), F.col("family_id").cast("bigint"),
        F.concat(F.concat_ws("\t", F.col("family_id"), F.coalesce("cell", F.lit("")), F.col("family_id"), F.lit("x")),
                 F.when(F.col("family_id") % 50 == 0, F.lit("\n\t\t")).otherwise(F.lit(""))).alias("value"),
    )
    S.write_lines(head.unionByName(rows).repartition("file").sortWithinPartitions("file", "rank", "family_id"), folder, exact=True)
    return T.read_count_cells(t.spark, folder)[0].select("line", "family_id", "species", "cell")


@query("search_command_file", """
select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 as line_index, l_partkey::int as qid, l_suppkey::int as did,
  case when l_linenumber = 6 then 'query token disagrees' when l_linenumber = 5 then 'database token disagrees' end as error
from lineitem qualify l_linenumber <> 7""")
def search_command_file(t: Tables) -> DataFrame:
    """One list of commands, written and read in parts: each command with the position of
    its line in all of them."""
    folder = new_folder(t, "commands")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = command_lines(t).select(F.lit("commands").alias("file"), *order, "value")
    S.write_lines(lines.repartitionByRange(*order).sortWithinPartitions("file", *order), folder)
    return R.read_search_pairs(t.spark, f"{folder}/commands", in_parts=True).select("line_index", "qid", "did", "error")


@query("count_matrix_file", f"""with {MEMBERS}
select 'fam' as "Desc", l_partkey::varchar as "Family ID", {TEXT_CELLS} from members group by l_partkey""")
def count_matrix_file(t: Tables) -> DataFrame:
    folder = new_folder(t, "matrix")
    T.write_count_matrix(C.family_counts(region_members(t)), folder, region_species(t), "fam")
    return T.read_tsv(t.spark, folder)


@query("phenotype_file", """
select c_name as species, case c_custkey % 9 when 0 then null when 1 then c_mktsegment || '/BUILDING' else c_mktsegment end as phenotype
from customer""")
def phenotype_file(t: Tables) -> DataFrame:
    folder = new_folder(t, "phenotypes")
    labels = raw_labels(t).withColumn("phenotype", F.coalesce("phenotype", F.lit(" NA ")))
    T.write_tsv(labels, folder, ["species", "phenotype"])
    return T.read_phenotypes(t.spark, folder)


@query("orthogroup_file", f"""with {MEMBERS},
genes as (select l_orderkey, l_linenumber, r_name from lineitem join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select distinct l_orderkey::varchar as family_id, r_name as species, 'g' || l_linenumber as gene from genes""")
def orthogroup_file(t: Tables) -> DataFrame:
    """Families as cells of comma-joined genes, written and read back."""
    where = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    genes = t.lineitem.join(where, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("Orthogroup"), "r_name", F.concat(F.lit("g"), F.col("l_linenumber")).alias("gene")
    )
    species, folder = region_species(t), new_folder(t, "families")
    cells = genes.groupBy("Orthogroup").pivot("r_name", species).agg(F.array_join(F.collect_set("gene"), ", "))
    T.write_tsv(cells, folder, ["Orthogroup", *species])
    return T.read_orthogroups(t.spark, folder)


@query("single_copy_file", f"""with {MEMBERS},
c as (select l_orderkey, r_name, count(*) as n from members group by all)
select l_orderkey::varchar as family_id from c group by l_orderkey having min(n) = 1 and max(n) = 1 and count(*) = 5""")
def single_copy_file(t: Tables) -> DataFrame:
    folder = new_folder(t, "single")
    found = C.single_copy(C.family_counts(region_members(t, "l_orderkey")), len(region_species(t)))
    found.select(F.col("family_id").cast("string").alias("value")).write.text(folder)
    return T.read_single_copy(t.spark, folder)


@query("legend_file", f"with {TIPS} select integer::varchar as integer, category, n_tips::varchar as n_tips from legend")
def legend_file(t: Tables) -> DataFrame:
    folder = new_folder(t, "legend")
    T.write_tsv(H.class_legend(tip_labels(t)), folder, ["integer", "category", "n_tips"])
    return T.read_tsv(t.spark, folder)


def run_lines(wide: DataFrame, file: Column, key: str, columns: list[str], cell) -> DataFrame:
    """Lines of a table for each run: its header, then a row a family."""
    head = F.lit("\t".join(["Family", *columns]))
    rows = wide.select(
        file.alias("file"), F.lit(1).alias("rank"), F.col(key).alias("family"),
        F.concat_ws("\t", F.col(key), *[cell(F.col(f"`{c}`")).cast("string") for c in columns]).alias("value"),
    )
    heads = rows.select("file").distinct().select("file", F.lit(0).alias("rank"), F.lit(None).cast("bigint").alias("family"), head.alias("value"))
    return heads.unionByName(rows)


@query("turnover_files", f"""with {MEMBERS},
w as (select 'run' || l_partkey % 2 as run, l_partkey::varchar as family_id, {REGION_CELLS} from members group by l_partkey),
cells as (unpivot w on {', '.join(f'"{r}"' for r in REGIONS)} into name key value n)
select 'counts' as found, run, family_id, key, n::double as value from cells
union all select 'changes', run, family_id, key, (n - 2)::double from cells
union all select 'branch_probabilities', run, family_id, key, case when n > 0 then n / 64.0 end from cells
union all select 'pvalues', run, family_id, null, "{REGIONS[0]}" / 128.0 from w""")
def turnover_files(t: Tables) -> DataFrame:
    """Result tables of two runs, in the solver's layout."""
    folder, species = new_folder(t, "turnover"), region_species(t)
    wide = C.wide_counts(C.family_counts(region_members(t)), species)
    run = F.concat(F.lit("run"), F.col("family_id") % 2)

    def change(n: Column) -> Column:
        return F.concat(F.when(n >= 2, F.lit("+")).otherwise(F.lit("")), n - 2)

    def chance(n: Column) -> Column:
        return F.when(n > 0, (n / 64.0).cast("string")).otherwise(F.lit("N/A"))

    tables = [
        run_lines(wide, F.concat(run, F.lit("_count.tab")), "family_id", species, lambda n: n),
        run_lines(wide, F.concat(run, F.lit("_change.tab")), "family_id", species, change),
        run_lines(wide, F.concat(run, F.lit("_branch_probabilities.tab")), "family_id", species, chance),
        run_lines(wide, F.concat(run, F.lit("_family_results.txt")), "family_id", species[:1], lambda n: n / 128.0),
    ]
    lines = tables[0]
    for more in tables[1:]:
        lines = lines.unionByName(more)
    S.write_lines(lines.repartition("file").sortWithinPartitions("file", "rank", "family"), folder, exact=True)
    got = R.read_turnover(t.spark, folder)
    long = []
    for name, key, value in (
        ("counts", "node", "copies"), ("changes", "branch", "change"),
        ("branch_probabilities", "branch", "probability"), ("pvalues", None, "pvalue"),
    ):
        label = F.col(key) if key else F.lit(None).cast("string")
        long.append(got[name].select(
            F.lit(name).alias("found"), "run", "family_id", label.alias("key"), F.col(value).cast("double").alias("value")
        ))
    out = long[0]
    for more in long[1:]:
        out = out.unionByName(more)
    return out
