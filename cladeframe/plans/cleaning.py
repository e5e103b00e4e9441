"""Proteomes to one protein per gene, for a whole folder in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.isoforms import filter_stats, longest_isoform
from ..runtime import materialize
from ..sources.fasta import read_fasta_directory, write_fasta
from ..sources.tables import write_stats


@dataclass
class Cleaned:
    records: DataFrame
    stats: DataFrame


def clean_directory(
    spark: SparkSession,
    input_dir: str,
    output_dir: str | None = None,
    header_format: str = "auto",
    on_duplicate: str = "error",
) -> Cleaned:
    """Longest isoform per gene for every FASTA file in ``input_dir``.

    The scan is stored once, columnar, so that the narrow passes of the filter
    read only the columns they need.  With ``output_dir`` the kept records go to
    ``fasta/species=…`` and the statistics to ``stats``.
    """
    records = materialize(read_fasta_directory(spark, input_dir))
    kept = longest_isoform(records, header_format, on_duplicate)
    stats = filter_stats(records, header_format, on_duplicate)
    if output_dir is not None:
        write_fasta(kept, f"{output_dir}/fasta")
        write_stats(stats, f"{output_dir}/stats")
    return Cleaned(kept, stats)
