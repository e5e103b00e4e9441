"""Species tree and trait table to a class tree ready for the turnover model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.specs import merge_labels
from ..operators.ancestral import class_tree
from ..operators.checks import has_errors, union_reports, validate_class_tree, validate_tree
from ..operators.phenotype import apply_unclassified, class_coverage, resolve_phenotypes
from ..runtime import DataError
from ..sources.newick import edges_to_newick


@dataclass
class ClassTree:
    edges: DataFrame
    legend: DataFrame
    newick: DataFrame
    report: DataFrame
    matrix: DataFrame | None


def build_class_tree(
    edges: DataFrame,
    phenotypes: DataFrame,
    substitutions=(),
    merge_only=(),
    unclassified: str = "background",
    background_label: str = "background",
    model: str = "ER",
    rate: float | None = None,
    anc_category: str | None = None,
    matrix: DataFrame | None = None,
    root_prior: str = "auto",
    q=None,
) -> ClassTree:
    """Merge labels, complete the tips, reconstruct branch classes, check, serialise."""
    shape = validate_tree(edges)
    if has_errors(shape):
        problems = shape.where("severity = 'ERROR'").take(5)
        raise DataError("; ".join(f"{r['subject']}: {r['code']}" for r in problems))
    labels = resolve_phenotypes(phenotypes).withColumn(
        "phenotype", merge_labels("phenotype", substitutions, merge_only)
    )
    tree, tips, matrix = apply_unclassified(
        edges, labels, unclassified, background_label, matrix
    )
    classes, legend = class_tree(tree, tips, model, rate, anc_category, root_prior, q)
    report = union_reports(
        validate_class_tree(classes, tree), class_coverage(classes, legend)
    )
    return ClassTree(classes, legend, edges_to_newick(classes, "class"), report, matrix)


def rate_classes(class_edges: DataFrame | None):
    """Class column for the turnover fit: none means one rate for all branches."""
    if class_edges is None:
        return None
    bad = class_edges.where(F.col("parent_id").isNotNull() & F.col("class").isNull())
    if not bad.isEmpty():
        raise DataError("the class tree has branches without a class")
    return "class"
