"""Column expressions; all run inside the JVM unless noted."""

from .headers import (  # noqa: F401
    accession,
    gene_id,
    gene_id_ensembl,
    gene_id_ncbi,
    header_format,
    is_safe_species,
    sanitize_name,
    species_from_path,
)
from .specs import (  # noqa: F401
    calibrations_from_config,
    calibrations_from_lists,
    merge_labels,
    pair_cost,
    parse_age,
    parse_calibrations,
)
