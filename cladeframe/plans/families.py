"""Proteins to gene families and their counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.counts import family_counts
from ..operators.families import BAND_ROWS, MIN_SCORE, POSITIONS, families, family_links, kmer_hits, kmers, sketch
from ..runtime import materialize


@dataclass
class GeneFamilies:
    hits: DataFrame
    members: DataFrame
    counts: DataFrame


def infer_families(
    seqs: DataFrame,
    tokens: Column | None = None,
    k: int = 5,
    n_perm: int = POSITIONS,
    rows: int = BAND_ROWS,
    min_score: int = MIN_SCORE,
) -> GeneFamilies:
    """Families of ``seq_id, species, sequence`` rows, by ``family_links``."""
    tokens = kmers(F.col("sequence"), k) if tokens is None else tokens
    sketches = materialize(sketch(seqs, tokens, n_perm))
    hits = materialize(kmer_hits(sketches, n_perm, rows, min_score))
    found = families(family_links(hits, sketches, n_perm), seqs.select("seq_id"))
    members = materialize(found.join(seqs.select("seq_id", "species"), "seq_id"))
    return GeneFamilies(hits, members, family_counts(members))
