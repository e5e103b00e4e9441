"""The result tables of a study."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.summary import (
    add_phenotype,
    family_dynamics,
    mean_copies_by_phenotype,
    merge_family_results,
    significant_families,
    turnover_by_phenotype,
)


def summary_tables(
    counts: DataFrame,
    pvalues: DataFrame,
    phenotypes: DataFrame,
    changes: DataFrame | None = None,
    threshold: float = 0.05,
) -> dict[str, DataFrame]:
    """``gene_family_summary``, ``significant_families`` and
    ``turnover_by_phenotype`` from counts ``family_id, species, copies``."""
    labelled = add_phenotype(counts, phenotypes)
    summary = merge_family_results(family_dynamics(counts, changes), pvalues)
    chosen = significant_families(pvalues, threshold)
    means = mean_copies_by_phenotype(labelled.where("phenotype is not null"))
    return {
        "gene_family_summary": summary,
        "significant_families": chosen.join(means, "family_id", "left"),
        "turnover_by_phenotype": turnover_by_phenotype(
            labelled.join(chosen.select("family_id"), "family_id", "left_semi")
        ),
    }
