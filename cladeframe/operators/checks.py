"""Validation reports: rows ``severity, code, subject, detail``.

A run is gated by ``report.where("severity = 'ERROR'").isEmpty()``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import header_format, species_from_path
from ..runtime import MAX_SMALL_ROWS, by_rows, global_rank, materialize_even
from ..sources.files import FASTA_FILE, file_heads, file_inventory
from ..sources.tables import parse_count
from .isoforms import duplicate_accessions
from .trees import is_ultrametric

# Limits of a proteome set.
MIN_SPECIES = 4
MAX_NAME_LENGTH = 200
NAME_PATTERN = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"

#: Positions of a species list that are compared as one array.
BLOCK = 1024


def report_rows(df: DataFrame, severity: str, code: str, subject: Column, detail) -> DataFrame:
    text = F.lit(detail) if isinstance(detail, str) else detail
    return df.select(
        F.lit(severity).alias("severity"),
        F.lit(code).alias("code"),
        subject.cast("string").alias("subject"),
        text.alias("detail"),
    )


def union_reports(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def has_errors(report: DataFrame) -> bool:
    return not report.where("severity = 'ERROR'").isEmpty()


# -- proteomes -------------------------------------------------------------------


def validate_proteomes(spark: SparkSession, directory: str) -> DataFrame:
    """Checks on a folder of uncompressed proteomes: number of species, file names,
    empty files, first byte, one file per species.  An INFO row has the number
    of files."""
    files = file_inventory(spark, directory).where(F.col("name").rlike(FASTA_FILE))
    stem = species_from_path("path")
    heads = file_heads(spark, directory).select("name", "head")
    opened = files.where("length > 0").join(heads, "name", "left")
    counted = files.agg(F.count("*").alias("n"))
    few = counted.where((F.col("n") > 0) & (F.col("n") < MIN_SPECIES))
    clash = files.groupBy(stem.alias("stem")).count().where("count > 1")
    name = F.col("name")
    return union_reports(
        report_rows(counted, "INFO", "n_files", F.lit(directory), F.col("n").cast("string")),
        report_rows(counted.where("n = 0"), "ERROR", "no_files", F.lit(directory),
                    "no FASTA files found"),
        report_rows(few, "ERROR", "too_few_species", F.lit(directory),
                    F.concat(F.col("n"), F.lit(f" files, at least {MIN_SPECIES} needed"))),
        report_rows(files.where(F.length(name) > MAX_NAME_LENGTH), "WARNING", "long_name", name,
                    f"longer than {MAX_NAME_LENGTH} characters"),
        report_rows(files.where(~stem.rlike(NAME_PATTERN)), "WARNING", "unusual_name", name,
                    "use letters, digits, dots, hyphens and underscores"),
        report_rows(files.where("length = 0"), "ERROR", "empty_file", name, "0 bytes"),
        report_rows(opened.where("head not like '3e%'"), "ERROR", "not_fasta", name,
                    "does not start with a header"),
        report_rows(clash, "ERROR", "duplicate_species", F.col("stem"),
                    "each species needs exactly one file"),
    )


def validate_proteome_set(records: DataFrame, species: DataFrame, fmt: str | None = None) -> DataFrame:
    """Checks on scanned records: every expected species is there, sequences are
    not empty, accessions are unique and headers follow ``fmt``."""
    absent = species.join(records.select("species").distinct(), "species", "left_anti")
    narrow = records.select("species", "accession", "header", "length")
    empty = narrow.where("length = 0").groupBy("species").agg(F.count("*").alias("n"))
    repeated = duplicate_accessions(narrow).groupBy("species").agg(F.count("*").alias("n"))
    n = F.col("n").cast("string")
    reports = [
        report_rows(absent, "ERROR", "missing_species", F.col("species"), "no proteome"),
        report_rows(empty, "ERROR", "empty_sequence", F.col("species"), n),
        report_rows(repeated, "ERROR", "duplicate_accession", F.col("species"), n),
    ]
    if fmt is not None:
        other = narrow.where(header_format("header") != fmt).groupBy("species").agg(
            F.count("*").alias("n")
        )
        reports.append(report_rows(other, "WARNING", "header_format", F.col("species"), n))
    return union_reports(*reports)


def alignment_width(records: DataFrame, group: str = "species") -> DataFrame:
    """Width of each alignment and whether its rows agree, ``n_sites`` null if not."""
    agreed = F.min("length") == F.max("length")
    return records.groupBy(group).agg(
        F.count("*").alias("n_rows"),
        F.when(agreed & (F.min("length") > 0), F.max("length")).alias("n_sites"),
        agreed.alias("is_rectangular"),
    )


# -- counts ----------------------------------------------------------------------


def validate_counts(cells: DataFrame) -> DataFrame:
    """Cells ``family_id, species, cell`` that are not whole numbers of 0 or more, with
    their ``line`` where the cells have one."""
    count = parse_count()
    subject = F.concat_ws("/", "family_id", "species")
    shown = F.coalesce(F.col("cell"), F.lit("(missing)"))
    if "line" in cells.columns:
        shown = F.concat(F.lit("line "), F.col("line"), F.lit(": "), shown)
    return union_reports(
        report_rows(cells.where(count.isNull()), "ERROR", "not_an_integer", subject, shown),
        report_rows(cells.where(count < 0), "ERROR", "negative_count", subject, shown),
    )


# -- trees -----------------------------------------------------------------------


def tip_species_diff(edges: DataFrame, species: DataFrame) -> DataFrame:
    """``tree_id, name, side``: per tree, tips that are no species (``only_in_tree``)
    and the reverse (``only_in_list``).

    Species with a ``tree_id`` are those of that tree; without one they are the list
    of every tree in ``edges``.
    """
    tips = edges.where("is_tip").select("tree_id", F.col("label").alias("name"))
    if "tree_id" in species.columns:
        return _sides(tips, species.select("tree_id", F.col("species").alias("name")))
    tips = materialize_even(tips.distinct())
    listed = materialize_even(species.select(F.col("species").alias("name")).distinct())
    only_tree = tips.join(_sent_whole(listed, listed.count()), ["name"], "left_anti")
    only_list = _absent(materialize_even(edges.select("tree_id").distinct()), tips, listed)
    return only_tree.select("tree_id", "name", F.lit("only_in_tree").alias("side")).unionByName(
        only_list.select("tree_id", "name", F.lit("only_in_list").alias("side"))
    )


def _sent_whole(names: DataFrame, n: int) -> DataFrame:
    """A short list of names goes to every task: a name that many trees have would be
    one task's otherwise."""
    return F.broadcast(names) if n <= MAX_SMALL_ROWS else names


def _sides(tips: DataFrame, listed: DataFrame) -> DataFrame:
    """Distinct ``tree_id, name`` that one of two tables lacks, met in one shuffle; a null
    equals nothing."""
    both = tips.withColumn("place", F.lit(1)).unionByName(listed.withColumn("place", F.lit(2)))
    places = both.groupBy("tree_id", "name").agg(F.bit_or("place").alias("places"))
    unknown = F.col("tree_id").isNull() | F.col("name").isNull()
    sides = F.array(
        F.when((F.col("places") == 1) | (unknown & (F.col("places") == 3)), F.lit("only_in_tree")),
        F.when((F.col("places") == 2) | (unknown & (F.col("places") == 3)), F.lit("only_in_list")),
    )
    found = places.select("tree_id", "name", F.explode(F.array_compact(sides)).alias("side"))
    return materialize_even(found)


def _absent(trees: DataFrame, tips: DataFrame, listed: DataFrame) -> DataFrame:
    """``tree_id, name`` for every listed name that a tree lacks.

    Names get positions, and a tree is compared with ``BLOCK`` positions at a time, so
    the work is that of the tips, the blocks and the names missing.
    """
    ranked = global_rank(listed, [F.col("name")], "pos")
    n = ranked.count()
    ranked = _sent_whole(ranked, n)
    first = F.col("slot") * BLOCK
    slots = trees.select(
        "tree_id", F.expr(f"explode(sequence(0L, {(n - 1) // BLOCK}L)) as slot")
    ) if n else trees.select("tree_id", F.lit(0).cast("bigint").alias("slot")).where("false")
    placed = tips.join(ranked, "name").select("tree_id", "pos", F.floor(F.col("pos") / BLOCK).alias("slot"))
    placed = by_rows(placed, ["tree_id", "slot"], tips.count())
    found = placed.groupBy("tree_id", "slot").agg(F.collect_set("pos").alias("found"))
    every = F.sequence(first, F.least(first + BLOCK, F.lit(n).cast("bigint")) - 1)
    none = F.array().cast("array<bigint>")
    holes = slots.join(found, ["tree_id", "slot"], "left").select(
        "tree_id", F.explode(F.array_except(every, F.coalesce("found", none))).alias("pos")
    )
    return holes.join(ranked, "pos").select("tree_id", "name")


def tree_shape(edges: DataFrame) -> DataFrame:
    """Per tree: children of the root, nodes with more than two, and with one."""
    is_root = F.col("parent_id").isNull()
    node = F.coalesce("parent_id", "node_id").alias("node_id")
    told = edges.select("tree_id", node, (~is_root).cast("bigint").alias("n"), is_root.cast("bigint").alias("roots"))
    nodes = told.groupBy("tree_id", "node_id").agg(F.sum("n").alias("n"), F.sum("roots").alias("roots"))
    # a null id is no tree whose root could be found; a root given twice counts twice
    known, n = F.col("tree_id").isNotNull(), F.col("n")
    times = F.when(known, F.greatest("roots", F.lit(1).cast("bigint"))).otherwise(F.lit(1).cast("bigint"))
    children = F.when(F.col("roots") > 0, F.when(known, n).otherwise(F.lit(0).cast("bigint")))
    zero = F.lit(0).cast("bigint")
    return nodes.groupBy("tree_id").agg(
        F.coalesce(F.max(children), zero).alias("root_children"),
        F.coalesce(F.sum(F.when(n > 2, times)), zero).alias("polytomies"),
        F.coalesce(F.sum(F.when(n == 1, times)), zero).alias("unary_nodes"),
    )


def validate_tree(edges: DataFrame) -> DataFrame:
    """Rooted and binary; a root with three children gives both errors.  Rows of
    unreadable trees (``error`` set by the Newick scan) are reported as well;
    single-child nodes are information only."""
    tree = F.col("tree_id")
    readable, reports = edges, []
    if "error" in edges.columns:
        reports.append(report_rows(edges.where("error is not null"), "ERROR", "unreadable_tree",
                                   tree, F.col("error")))
        readable = edges.where("error is null")
    shape = materialize_even(tree_shape(readable))
    reports += [
        report_rows(shape.where("root_children <> 2"), "ERROR", "not_rooted", tree,
                    F.concat(F.lit("root children: "), F.col("root_children"))),
        report_rows(shape.where("polytomies > 0"), "ERROR", "polytomy", tree,
                    F.concat(F.lit("polytomies: "), F.col("polytomies"))),
        report_rows(shape.where("unary_nodes > 0"), "INFO", "unary_nodes", tree,
                    F.concat(F.lit("single-child nodes: "), F.col("unary_nodes"))),
    ]
    return union_reports(*reports)


def validate_class_tree(class_edges: DataFrame, edges: DataFrame, class_col: str = "class") -> DataFrame:
    """Every class tree has the tips of the dated tree with its ``tree_id``, and
    whole-number classes."""
    tips = edges.where("is_tip").select("tree_id", F.col("label").alias("species"))
    diff = tip_species_diff(class_edges, tips)
    value = F.col(class_col).cast("double")
    odd = class_edges.where(
        F.col("parent_id").isNotNull() & (value.isNull() | (value != F.floor(value)))
    )
    return union_reports(
        report_rows(diff, "ERROR", "tip_mismatch", F.col("name"), F.concat_ws(": ", "tree_id", "side")),
        report_rows(odd, "ERROR", "non_integer_class",
                    F.coalesce(F.col("label"), F.col("node_id").cast("string")),
                    F.coalesce(value.cast("string"), F.lit("(missing)"))),
    )


def validate_turnover_inputs(cells: DataFrame, edges: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Count cells, and a rooted, binary, ultrametric tree with the same species."""
    species = cells.select("species").distinct()
    diff = tip_species_diff(edges, species)
    bent = is_ultrametric(edges, tolerance).where("not is_ultrametric")
    return union_reports(
        validate_counts(cells),
        report_rows(diff, "ERROR", "tip_mismatch", F.col("name"), F.concat_ws(": ", "tree_id", "side")),
        validate_tree(edges),
        report_rows(bent, "ERROR", "not_ultrametric", F.col("tree_id"),
                    F.concat(F.lit("deviation "), F.round("deviation", 6))),
    )


# -- calibrations ----------------------------------------------------------------


def validate_calibrations(calibrations: DataFrame, edges: DataFrame) -> DataFrame:
    """Parsed calibrations (``functions.parse_calibrations``) against the tips of every
    tree, or of the tree in their ``tree_id``.

    Without any calibration the tree is anchored at its root, which is reported
    as information.
    """
    scope = ["tree_id"] if "tree_id" in calibrations.columns else []
    name = F.coalesce("name", F.col("spec")) if "spec" in calibrations.columns else F.col("name")
    # read by several checks
    calibrations = materialize_even(calibrations)
    taxa = calibrations.select(
        *scope, name.alias("name"), F.explode(F.array("sp1", "sp2")).alias("taxon")
    ).where("taxon is not null")
    absent = tip_species_diff(edges, taxa.select(*scope, F.col("taxon").alias("species")))
    unknown = taxa.join(
        absent.where("side = 'only_in_list'").select("tree_id", F.col("name").alias("taxon")),
        [*scope, "taxon"],
    )
    malformed = calibrations.where("error is not null")
    undated = calibrations.where(
        "error is null and age is null and min_age is null and max_age is null"
    )
    counted = calibrations.agg(F.count("*").alias("n")).where("n = 0")
    return union_reports(
        report_rows(malformed, "ERROR", "malformed", name, F.col("error")),
        report_rows(undated, "ERROR", "no_age", name, "needs an age or a window"),
        report_rows(unknown, "ERROR", "unknown_taxon", F.col("name"),
                    F.concat_ws(": ", "tree_id", "taxon")),
        report_rows(counted, "INFO", "root_anchor", F.lit("tree"),
                    "no calibration: relative time, anchored at the root"),
    )


# -- manifests -------------------------------------------------------------------


def verify_manifest(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Files whose content differs from the recorded manifest, or that are gone or
    new; both sides are ``path, md5, …``."""
    both = recorded.select("path", F.col("md5").alias("was")).join(
        current.select("path", F.col("md5").alias("now")), "path", "full_outer"
    )
    status = (
        F.when(F.col("now").isNull(), F.lit("missing"))
        .when(F.col("was").isNull(), F.lit("new"))
        .when(F.col("was") != F.col("now"), F.lit("changed"))
    )
    return both.select("path", status.alias("status")).where("status is not null")
