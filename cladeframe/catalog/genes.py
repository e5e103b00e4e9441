"""Records, headers, counts and families on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import headers as H
from ..operators import checks as V
from ..operators import counts as C
from ..operators import families as E
from ..operators import isoforms as A
from ..runtime import by_rows
from ..sources import tables as S
from .registry import Tables, query

# -- documents as protein records --------------------------------------------------


def records(t: Tables) -> DataFrame:
    """One record per document; the source is the species, the text the sequence.

    Three successive documents share an accession number, every seventeenth has
    no gene tag.
    """
    number = F.col("doc_id") - F.col("doc_id") % 3
    tag = F.when(
        F.col("doc_id") % 17 != 0,
        F.concat(F.lit(" gene:"), F.col("lang"), F.col("doc_id") % 50),
    ).otherwise(F.lit(" unplaced"))
    header = F.concat(F.lit("D"), number, tag)
    return t.documents.select(
        F.col("source").alias("species"),
        F.col("doc_id").alias("ord"),
        header.alias("header"),
        H.accession(header).alias("accession"),
        F.col("text").alias("sequence"),
        F.length("text").alias("length"),
    )


RECORDS = r"""
rec as (
  select source as species, doc_id as ord,
         'D' || (doc_id - doc_id % 3) ||
           case when doc_id % 17 <> 0 then ' gene:' || lang || (doc_id % 50)
                else ' unplaced' end as header,
         'D' || (doc_id - doc_id % 3) as accession,
         text as sequence, length(text) as length
  from documents),
firsts as (
  select * exclude rn from (
    select *, row_number() over (partition by species, accession order by ord) as rn from rec)
  where rn = 1),
genes as (
  select *, nullif(regexp_extract(header, 'gene[:=](\S+)', 1), '') as gene_id from firsts)
"""


@query("longest_isoform", f"""with {RECORDS}
select species, ord, header, accession, sequence, length::int as length, gene_id,
       (case when gene_id is null then 1 else 0 end)::int as sort_rank
from (select *, row_number() over (partition by species, gene_id order by length desc, ord) as rn
      from genes)
where rn = 1 or gene_id is null""")
def longest_isoform(t: Tables) -> DataFrame:
    return A.longest_isoform(records(t), "auto", "skip")


@query("filter_stats", f"""with {RECORDS},
totals as (select species, count(*) as total_records from rec group by species),
fmt as (select species, 'ensembl' as detected_format from rec group by species),
g as (select species, count(distinct gene_id) as unique_genes,
             count(*) filter (where gene_id is null) as unidentified
      from genes group by species)
select species, total_records, unique_genes, unidentified,
       unique_genes + unidentified as output_records, detected_format
from totals join g using (species) join fmt using (species)""")
def filter_stats(t: Tables) -> DataFrame:
    return A.filter_stats(records(t), "auto", "skip")


@query("dedup_first", """
select user_id, event_id, event_type from (
  select *, row_number() over (partition by user_id order by event_id) as rn from events)
where rn = 1""")
def dedup_first(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", "event_type")
    return A.dedup_accessions(rows, "skip", keys=("user_id",), ord_col="event_id")


@query("proteome_set_report", f"""with {RECORDS},
expected as (select distinct source as species from documents
             union select 'user' || user_id from events)
select 'ERROR' as severity, 'missing_species' as code, species as subject, 'no proteome' as detail
from expected where species not in (select species from rec)
union all
select 'ERROR', 'duplicate_accession', species, count(*)::varchar
from (select species, accession from rec group by all having count(*) > 1) group by species
union all
select 'ERROR', 'empty_sequence', species, count(*)::varchar from rec where length = 0 group by species
union all
select 'WARNING', 'header_format', species, count(*)::varchar from rec
where contains(header, 'gene:') or not contains(header, 'gene:') group by species""")
def proteome_set_report(t: Tables) -> DataFrame:
    rows = records(t)
    users = t.events.select(F.concat(F.lit("user"), F.col("user_id")).alias("species"))
    expected = rows.select("species").union(users).distinct()
    return V.validate_proteome_set(rows, expected, "ncbi")


@query("alignment_width", """
select lang as alignment, count(*) as n_rows,
       (case when min(length(text)) = max(length(text)) and min(length(text)) > 0
             then max(length(text)) end)::int as n_sites,
       min(length(text)) = max(length(text)) as is_rectangular
from documents group by lang
union all
select 'p' || p_size, count(*),
       (case when min(length(p_brand)) = max(length(p_brand)) then max(length(p_brand)) end)::int,
       min(length(p_brand)) = max(length(p_brand))
from part group by p_size""")
def alignment_width(t: Tables) -> DataFrame:
    texts = t.documents.select(F.col("lang").alias("alignment"), F.length("text").alias("length"))
    brands = t.part.select(
        F.concat(F.lit("p"), F.col("p_size")).alias("alignment"), F.length("p_brand").alias("length")
    )
    return V.alignment_width(texts.union(brands), "alignment")


# -- parts as headers ----------------------------------------------------------------

NCBI_SQL = """'XP_' || p_partkey || ' ' || p_name ||
  case when p_partkey % 3 <> 0 then ' isoform X' || p_size else '' end || ' [' || p_brand || ']'"""


def ncbi_headers(t: Tables) -> DataFrame:
    isoform = F.when(
        F.col("p_partkey") % 3 != 0, F.concat(F.lit(" isoform X"), F.col("p_size"))
    ).otherwise(F.lit(""))
    header = F.concat(
        F.lit("XP_"), F.col("p_partkey"), F.lit(" "), F.col("p_name"), isoform,
        F.lit(" ["), F.col("p_brand"), F.lit("]"),
    )
    return t.part.select("p_partkey", header.alias("header"))


def mixed_headers(t: Tables) -> DataFrame:
    """The headers above, with the closing bracket or a gene tag on some."""
    key = F.col("p_partkey")
    header = (
        F.when(key % 5 == 0, F.concat(F.col("header"), F.lit(" gene="), key))
        .when(key % 5 == 1, F.regexp_replace("header", r"\]$", ""))
        .when(key % 5 == 2, F.concat(F.lit("ENS"), F.col("header")))
        .otherwise(F.col("header"))
    )
    return ncbi_headers(t).select("p_partkey", header.alias("header"))


MIXED_SQL = f"""ncbi as (select p_partkey, {NCBI_SQL} as h from part),
mixed as (select p_partkey, case p_partkey % 5 when 0 then h || ' gene=' || p_partkey
  when 1 then regexp_replace(h, '\\]$', '') when 2 then 'ENS' || h else h end as header from ncbi),
fmt as (select p_partkey, header, regexp_extract(header, '^\\s*(\\S*)', 1) as accession,
  case when contains(header, 'gene:') or contains(header, 'gene=') then 'ensembl'
       when regexp_matches(header, '^(XP_|NP_|YP_|WP_)') and regexp_matches(header, '\\]\\s*$')
       then 'ncbi' else 'ensembl' end as header_format from mixed)"""

NCBI_KEY_SQL = r"""case when regexp_matches({h}, '\s+isoform\s+X?\d+[A-Za-z]*')
  then regexp_extract(regexp_replace({h}, '\s+isoform\s+X?\d+[A-Za-z]*', '', 'g'),
                      '^\s*\S+\s+(\S.*)$', 1) else {h} end"""


@query("header_format", f"with {MIXED_SQL} select * from fmt")
def header_format(t: Tables) -> DataFrame:
    return mixed_headers(t).select(
        "p_partkey", "header", H.accession("header").alias("accession"),
        H.header_format("header").alias("header_format"),
    )


@query("gene_key_ncbi", f"""with ncbi as (select {NCBI_SQL} as h from part)
select {NCBI_KEY_SQL.format(h='h')} as gene_id, count(*) as n_records from ncbi group by 1""")
def gene_key_ncbi(t: Tables) -> DataFrame:
    return ncbi_headers(t).groupBy(H.gene_id_ncbi("header").alias("gene_id")).agg(
        F.count("*").alias("n_records")
    )


@query("gene_key_auto", f"""with {MIXED_SQL}
select p_partkey, case when header_format = 'ncbi' then {NCBI_KEY_SQL.format(h='header')}
  else nullif(regexp_extract(header, 'gene[:=](\\S+)', 1), '') end as gene_id from fmt""")
def gene_key_auto(t: Tables) -> DataFrame:
    return mixed_headers(t).select("p_partkey", H.gene_id("header", "auto").alias("gene_id"))


@query("species_names", r"""
with f as (select doc_id, 'in/' || source || '.' || lang || case doc_id % 3 when 0 then '.fa'
  when 1 then '.fasta.gz' else '.faa.bz2' end as path, source || ' (' || lang || ')' as raw from documents)
select path, raw, regexp_replace(regexp_replace(regexp_extract(path, '([^/]*)$', 1),
    '\.(gz|bz2)$', ''), '\.[^.]*$', '') as species,
  regexp_replace(trim(raw), '[^A-Za-z0-9_]', '_', 'g') as node_name,
  regexp_matches(raw, '^[A-Za-z0-9._-]+$') as is_safe, count(*) as n
from f group by all""")
def species_names(t: Tables) -> DataFrame:
    ending = (
        F.when(F.col("doc_id") % 3 == 0, F.lit(".fa"))
        .when(F.col("doc_id") % 3 == 1, F.lit(".fasta.gz"))
        .otherwise(F.lit(".faa.bz2"))
    )
    path = F.concat(F.lit("in/"), F.col("source"), F.lit("."), F.col("lang"), ending)
    raw = F.concat(F.col("source"), F.lit(" ("), F.col("lang"), F.lit(")"))
    names = t.documents.groupBy(path.alias("path"), raw.alias("raw")).agg(F.count("*").alias("n"))
    return names.select(
        "path", "raw", H.species_from_path("path").alias("species"),
        H.sanitize_name("raw").alias("node_name"), H.is_safe_species("raw").alias("is_safe"), "n",
    )


# -- order lines as gene copies --------------------------------------------------------


def region_members(t: Tables, family: str = "l_partkey") -> DataFrame:
    """One member per order line: the supplier's region is the species."""
    where = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return t.lineitem.join(where, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col(family).alias("family_id"), F.col("r_name").alias("species"),
        F.col("n_name").alias("nation"),
    )


def nation_counts(t: Tables) -> DataFrame:
    return C.family_counts(
        region_members(t).select("family_id", F.col("nation").alias("species"))
    )


def region_species(t: Tables) -> list[str]:
    return C.species_list(t.region.select(F.col("r_name").alias("species")))


def nation_species(t: Tables) -> list[str]:
    return C.species_list(t.nation.select(F.col("n_name").alias("species")))


MEMBERS = """
members as (select l_partkey, l_orderkey, r_name, n_name from lineitem
  join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey)"""

#: The region names of the test data, in name order (fixed values).
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
REGION_CELLS = ", ".join(
    f"""count(*) filter (where r_name = '{r}') as "{r}" """ for r in REGIONS
)
GREATEST = "greatest(" + ", ".join(f'"{r}"' for r in REGIONS) + ")"


@query("family_counts_long", f"""with {MEMBERS}
select l_partkey as family_id, r_name as species, count(*) as copies from members group by all""")
def family_counts_long(t: Tables) -> DataFrame:
    return C.family_counts(region_members(t))


@query("gene_counts_total", f"""with {MEMBERS}
select l_partkey as family_id, {REGION_CELLS}, count(*) as "Total" from members group by l_partkey""")
def gene_counts_total(t: Tables) -> DataFrame:
    return C.gene_counts(region_members(t), region_species(t))


@query("count_matrix", f"""with {MEMBERS}
select '(null)' as "Desc", l_partkey as "Family ID", {REGION_CELLS} from members group by l_partkey""")
def count_matrix(t: Tables) -> DataFrame:
    return C.count_matrix(C.family_counts(region_members(t)), region_species(t))


@query("large_family_split", f"""with {MEMBERS}
select *, {GREATEST} >= 12 as is_large from (
  select '(null)' as "Desc", l_partkey as "Family ID", {REGION_CELLS} from members group by l_partkey)""")
def large_family_split(t: Tables) -> DataFrame:
    species = region_species(t)
    matrix = C.count_matrix(C.family_counts(region_members(t)), species)
    kept, excluded = C.split_large(matrix, species, 12)
    return kept.withColumn("is_large", F.lit(False)).unionByName(
        excluded.withColumn("is_large", F.lit(True))
    )


@query("long_from_matrix", f"""with {MEMBERS}, k as (select distinct l_partkey from members)
select k.l_partkey as family_id, region.r_name as species, count(m.l_partkey) as copies
from k cross join region left join members m
  on m.l_partkey = k.l_partkey and m.r_name = region.r_name group by all""")
def long_from_matrix(t: Tables) -> DataFrame:
    species = region_species(t)
    return C.long_counts(C.wide_counts(C.family_counts(region_members(t)), species), species)


@query("single_copy", f"""with {MEMBERS},
c as (select l_orderkey, r_name, count(*) as n from members group by all)
select l_orderkey as family_id from c group by l_orderkey
having min(n) = 1 and max(n) = 1 and count(*) = 5""")
def single_copy(t: Tables) -> DataFrame:
    counts = C.family_counts(region_members(t, "l_orderkey"))
    return C.single_copy(counts, len(region_species(t)))


CELLS_SQL = """cells as (
  select p_brand as species, p_partkey as family_id,
         case p_partkey % 11 when 0 then 'NA' when 1 then '-' || p_size when 2 then null
              when 3 then ' ' || p_size || ' ' when 4 then p_size || '.5' else p_size::varchar end as cell
  from part)"""


def part_cells(t: Tables) -> DataFrame:
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 11
    cell = (
        F.when(kind == 0, F.lit("NA"))
        .when(kind == 1, F.concat(F.lit("-"), size))
        .when(kind == 2, F.lit(None))
        .when(kind == 3, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(kind == 4, F.concat(size, F.lit(".5")))
        .otherwise(size)
    )
    return t.part.select(
        F.col("p_partkey").alias("family_id"), F.col("p_brand").alias("species"), cell.alias("cell")
    )


@query("validate_counts", rf"""with {CELLS_SQL}
select 'ERROR' as severity,
  case when cell is null or not regexp_matches(cell, '^\s*[+-]?\d+\s*$') then 'not_an_integer'
       else 'negative_count' end as code,
  family_id || '/' || species as subject, coalesce(cell, '(missing)') as detail
from cells where cell is null or not regexp_matches(cell, '^\s*[+-]?\d+\s*$') or trim(cell)::bigint < 0""")
def validate_counts(t: Tables) -> DataFrame:
    return V.validate_counts(part_cells(t))


@query("orthogroup_members", """
select l_orderkey as family_id, n_name as species, 'g' || l_orderkey || '_' || l_linenumber as gene,
       count(*) as n
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
group by all""")
def orthogroup_members(t: Tables) -> DataFrame:
    """Membership cells (the genes of one family and species) taken apart.

    An order is a family, so a cell holds at most the lines of one order.
    """
    nation = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    gene = F.concat(F.lit("g"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber"))
    placed = t.lineitem.join(nation, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("family_id"), F.col("n_name").alias("species"), gene.alias("gene")
    )
    # cells are made and taken apart in the same tasks
    cells = by_rows(placed, ["family_id", "species"], t.lineitem.count()).groupBy("family_id", "species").agg(
        F.array_join(F.collect_list("gene"), ", ").alias("genes")
    )
    return S.explode_members(cells).groupBy("family_id", "species", "gene").agg(
        F.count("*").alias("n")
    )


# -- similarity and families -------------------------------------------------------------


def text_sketches(t: Tables) -> DataFrame:
    """Sketches of all documents over runs of five words; the source is the species."""
    from ..runtime import materialize

    seqs = t.documents.select(F.col("doc_id").alias("seq_id"), F.col("source").alias("species"), "text")
    return materialize(E.sketch(seqs, E.word_shingles(F.col("text"), 5), N_PERM))


N_PERM, BAND_ROWS, MIN_SCORE = E.POSITIONS, E.BAND_ROWS, E.MIN_SCORE
_MINS = ", ".join(
    f"min(((x >> 30) * {a} + (x & {E.HALF - 1}) * {b}) % {E.PRIME} * {E.HALF} + (x & {E.HALF - 1})) as h_{i}"
    for i, (a, b) in enumerate(E.permutations(N_PERM))
)
_POSITIONS = ", ".join(f"h_{i}" for i in range(N_PERM))
_SAME = " + ".join(f"(a.h_{i} = b.h_{i})::int" for i in range(N_PERM))
_BANDS = "\n  union all ".join(
    f"select '{b // BAND_ROWS}:' || " + " || ':' || ".join(f"h_{i}" for i in range(b, b + BAND_ROWS))
    + " as band, seq_id from reps"
    for b in range(0, N_PERM, BAND_ROWS)
)
SKETCH_SQL = rf"""
words as (select doc_id, source,
  string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') as w from documents),
toks as (select doc_id, source, unnest(
  case when len(w) < 5 then [array_to_string(w, ' ')]
       else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as t from words),
hashed as (select doc_id, source, ('0x' || substr(md5(t), 1, 15))::bigint as x from toks),
sk as materialized (select doc_id as seq_id, source as species, {_MINS}
  from hashed group by all),
reps as materialized (select min(seq_id) as seq_id, species, {_POSITIONS} from sk group by all),
member as materialized ({_BANDS})"""

HITS_SQL = f"""{SKETCH_SQL},
cand as (select distinct x.seq_id as query, y.seq_id as target from member x join member y using (band)
  where x.seq_id <> y.seq_id),
hits as materialized (select query, a.species as query_species, target, b.species as target_species,
    ({_SAME})::int as score
  from cand join reps a on a.seq_id = query join reps b on b.seq_id = target
  where ({_SAME}) >= {MIN_SCORE})"""


@query("kmer_hits", f"with {HITS_SQL} select * from hits")
def kmer_hits(t: Tables) -> DataFrame:
    return E.kmer_hits(text_sketches(t), N_PERM, BAND_ROWS, MIN_SCORE)


RECIPROCAL_SQL = f"""{HITS_SQL},
best as (select * from (select *, row_number() over (partition by query, target_species
    order by score desc, target) as rn from hits where query_species <> target_species) where rn = 1),
mutual as (select x.query as a, x.target as b, greatest(x.score, y.score) as score
  from best x join best y on x.query = y.target and x.target = y.query where x.query < x.target)"""


@query("reciprocal_best", f"with {RECIPROCAL_SQL} select * from mutual")
def reciprocal_best(t: Tables) -> DataFrame:
    from ..runtime import materialize

    return E.reciprocal_best(materialize(kmer_hits(t)))


@query("families", f"""with recursive {RECIPROCAL_SQL},
links as materialized (select a, b from mutual
  union select query, target from hits where query_species = target_species
  union select seq_id, min(seq_id) over (partition by species, {_POSITIONS}) from sk),
sym as materialized (select a, b from links union all select b, a from links),
reach(node, seen) as (select seq_id, seq_id from sk union select r.node, sym.b
  from reach r join sym on r.seen = sym.a),
comp as (select node as seq_id, min(seen) as component from reach group by node),
ranked as (select component, row_number() over (order by n desc, component) - 1 as rank
  from (select component, count(*) as n from comp group by component))
select seq_id, 'OG' || lpad(rank::varchar, 7, '0') as family_id from comp join ranked using (component)""")
def families(t: Tables) -> DataFrame:
    from ..runtime import materialize

    sketches = text_sketches(t)
    hits = materialize(E.kmer_hits(sketches, N_PERM, BAND_ROWS, MIN_SCORE))
    links = E.family_links(hits, sketches, N_PERM)
    return E.families(links, t.documents.select(F.col("doc_id").alias("seq_id")))
