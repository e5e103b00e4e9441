"""FASTA header, species and node-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header conventions of the two annotation sources.
NCBI_PREFIXES = ("XP_", "NP_", "YP_", "WP_")
GENE_TAG = r"gene[:=](\S+)"
ISOFORM_TAG = r"\s+isoform\s+X?\d+[A-Za-z]*"
COMPRESSION_SUFFIX = r"\.(gz|bz2)$"
SAFE_SPECIES = r"^[A-Za-z0-9._-]+$"

FORMATS = ("ensembl", "ncbi", "auto")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def accession(header) -> Column:
    """First whitespace-delimited token; empty for a blank header."""
    return F.regexp_extract(_col(header), r"^\s*(\S*)", 1)


def header_format(header) -> Column:
    """``'ensembl'`` or ``'ncbi'``, judged from one header."""
    h = _col(header)
    prefixed = accession(h).rlike("^(" + "|".join(NCBI_PREFIXES) + ")")
    tagged = h.contains("gene:") | h.contains("gene=")
    return F.when(~tagged & prefixed & h.rlike(r"\]\s*$"), F.lit("ncbi")).otherwise(
        F.lit("ensembl")
    )


def gene_id_ensembl(header) -> Column:
    """Value of the ``gene:`` / ``gene=`` tag, null without one."""
    return F.nullif(F.regexp_extract(_col(header), GENE_TAG, 1), F.lit(""))


def gene_id_ncbi(header) -> Column:
    """Description without isoform tags; the accession goes only if one was there."""
    h = _col(header)
    cleaned = F.regexp_replace(h, ISOFORM_TAG, "")
    description = F.regexp_extract(cleaned, r"^\s*\S+\s+(\S[\s\S]*)$", 1)
    return F.when(
        h.rlike(ISOFORM_TAG), F.coalesce(F.nullif(description, F.lit("")), cleaned)
    ).otherwise(cleaned)


def gene_id(header, fmt="auto") -> Column:
    """Gene key of a header; ``fmt`` is a format name or a column of names.

    ``'auto'`` judges every header on its own; a file-wide decision is passed
    as a column (see ``operators.isoforms``).
    """
    h = _col(header)
    if isinstance(fmt, str):
        if fmt not in FORMATS:
            raise ValueError(f"Unknown header format: {fmt!r}")
        if fmt == "ensembl":
            return gene_id_ensembl(h)
        if fmt == "ncbi":
            return gene_id_ncbi(h)
        fmt = header_format(h)
    return F.when(fmt == "ncbi", gene_id_ncbi(h)).otherwise(gene_id_ensembl(h))


def species_from_path(path) -> Column:
    """File name without directory, compression suffix and extension."""
    name = F.regexp_extract(_col(path), r"([^/]*)$", 1)
    name = F.regexp_replace(name, COMPRESSION_SUFFIX, "")
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def sanitize_name(name) -> Column:
    """Letters, digits and underscores only; ``'node'`` when nothing is left."""
    trimmed = F.regexp_replace(_col(name), r"^\s+|\s+$", "")
    cleaned = F.regexp_replace(trimmed, "[^A-Za-z0-9_]", "_")
    return F.when(cleaned == "", F.lit("node")).otherwise(cleaned)


def is_safe_species(name) -> Column:
    return _col(name).rlike(SAFE_SPECIES)
