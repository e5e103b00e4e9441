"""Gene families from sequence similarity: sketches, hits, best hits, components.

Similarity is estimated on min-hash sketches of the k-mer sets.  Equal sketches of
one species are one; different ones that agree on a band meet in a bucket and are
compared there.  Large buckets are split without losing a hit.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import global_rank, join_skewed, materialize, spread

#: Prime modulus of the hash permutations (fixed value, 2**31 - 1).
PRIME = 2147483647
#: Values of half a token hash.
HALF = 2**30

#: Members of a bucket that are compared in one cell.
BLOCK = 256

#: Positions of a sketch, successive positions of a band, and positions that a hit agrees
#: on.  Of pairs with a Jaccard similarity s of their tokens, 1 - (1 - s**2)**16 share a
#: band, and a binomial tail agrees on 8 of 32 positions: together 0.90 at s = 0.4, 0.99
#: at s = 0.5.
POSITIONS = 32
BAND_ROWS = 2
MIN_SCORE = 8

# Multipliers of the permutations: terms of a fixed linear
# congruential sequence, so sketches agree between runs and machines.
_LCG = (1103515245, 12345, 2**31)


def permutations(n: int) -> list[tuple[int, int]]:
    """``n`` pairs of multipliers below the modulus."""
    a, c, m = _LCG
    x, out = 1, []
    for _ in range(n):
        x = (a * x + c) % m
        y = (a * x + c) % m
        out.append((x % (PRIME - 1) + 1, y % PRIME))
        x = y
    return out


def token_hash(token: Column) -> Column:
    """60-bit hash any SQL engine can repeat: the first fifteen hexadecimal digits of
    the MD5 sum."""
    return F.conv(F.substring(F.md5(token), 1, 15), 16, 10).cast("bigint")


def kmers(sequence: Column, k: int) -> Column:
    """Array of the letter k-mers of a sequence; a shorter sequence is one k-mer."""
    found = F.regexp_extract_all(sequence, F.lit("(?=(.{%d}))" % k), F.lit(1))
    return F.when(F.size(found) > 0, found).otherwise(F.array(sequence))


def word_shingles(text: Column, k: int) -> Column:
    """Array of the runs of ``k`` words; a shorter text is one run."""
    spaced = F.trim(F.regexp_replace(text, r"\s+", " "))

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - F.lit(k))
        run = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)]))
        return F.when(F.size(words) >= k, run).otherwise(F.array(F.array_join(words, " ")))

    # the words are a variable of the function, so that they are split once a text
    return F.get(F.transform(F.array(F.split(spaced, " ", -1)), runs), F.lit(0))


def sketch(seqs: DataFrame, tokens: Column, n_perm: int = POSITIONS, keep=("species",)) -> DataFrame:
    """``seq_id, …keep, h_0..h_{n-1}``: smallest value of each permutation over the
    tokens of a sequence.

    A permutation mixes both halves of the hash into 31 bits and appends the lower
    half, so equal values mean equal tokens.  The minima are combined map-side:
    exploded tokens never leave their task.
    """
    hashed = spread(seqs, "seq_id").select(
        "seq_id", *keep, F.explode(tokens).alias("token")
    ).select("seq_id", *keep, token_hash(F.col("token")).alias("x")).select(
        "seq_id", *keep, F.shiftright("x", 30).alias("hi"), F.col("x").bitwiseAND(F.lit(HALF - 1)).alias("lo")
    )
    mins = [
        F.expr(f"min((hi * {a} + lo * {b}) % {PRIME} * {HALF} + lo) as h_{i}")
        for i, (a, b) in enumerate(permutations(n_perm))
    ]
    return hashed.groupBy("seq_id", *keep).agg(*mins)


def _positions(n_perm: int) -> list[str]:
    return [f"h_{i}" for i in range(n_perm)]


def copies(sketches: DataFrame, n_perm: int = POSITIONS) -> DataFrame:
    """``seq_id, representative``: sequences of one species with equal sketches, and the
    smallest id among them, which stands for all in ``kmer_hits``.  ``sketches`` is a
    stored table."""
    # text, so that sequences without a species meet as well
    kind = F.to_json(F.struct("species")).alias("kind")
    keyed = sketches.select("seq_id", kind, *_positions(n_perm))
    keys = ["kind", *_positions(n_perm)]
    first = keyed.groupBy(*keys).agg(F.min("seq_id").alias("representative"))
    return (
        join_skewed(keyed, first, keys, sketches.count())
        .select("seq_id", "representative")
        .where("seq_id <> representative")
    )


def _sized(members: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key others share, with the number ``n`` of rows of the key."""
    members = materialize(members)
    shared = members.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return join_skewed(members, shared, keys, members.count())


def kmer_hits(
    sketches: DataFrame, n_perm: int = POSITIONS, rows: int = BAND_ROWS, min_score: int = MIN_SCORE, block: int = BLOCK
) -> DataFrame:
    """``query, query_species, target, target_species, score``: all pairs, in both
    directions, of sequences that agree on a band of ``rows`` successive positions and
    on ``min_score`` positions (the ``score``) in all.

    Sequences of one species with equal sketches are one here, the smallest id
    (``copies`` has the others).  Members of a band's bucket are compared with each
    other.  A bucket of more than ``block`` members is first split by every further
    position where that leaves fewer pairs (near copies would meet at nearly every
    position): as ``min_score`` is above ``rows``, a hit agrees on one of them at
    least, so none is lost.  What is still larger is compared in cells of two blocks
    each, so no task holds a whole group.  A pair counts where it meets first.
    """
    if min_score <= rows:
        raise ValueError(f"min_score must be above the {rows} positions of a band")
    distinct = sketches.groupBy("species", *_positions(n_perm)).agg(F.min("seq_id").alias("seq_id"))
    starts = [F.lit(b) for b in range(0, n_perm - rows + 1, rows)]
    member = distinct.select(
        "seq_id", "species", F.array(*_positions(n_perm)).alias("sketch"), F.explode(F.array(*starts)).alias("start")
    ).withColumn("band", F.slice("sketch", F.col("start") + 1, F.lit(rows)))

    bucket = ["start", "band"]
    outside = [F.lit(i) for i in range(n_perm)]
    further = F.filter(F.array(*outside), lambda i: (i < F.col("start")) | (i >= F.col("start") + rows))
    shared = materialize(_sized(member, bucket))
    value = F.when(F.col("further") >= 0, F.get("sketch", F.col("further"))).otherwise(F.lit(0))
    divided = shared.where(F.col("n") > block).withColumn("further", F.explode(further)).withColumn("value", value)
    pairs = F.col("n") * (F.col("n") - 1)
    worth = materialize(
        divided.groupBy(*bucket, "n", "further", "value").agg(F.count("*").alias("m"))
        .groupBy(*bucket, "n").agg(F.sum(F.col("m") * (F.col("m") - 1)).alias("left"))
        .where(F.col("left") < pairs).select(*bucket)
    )
    whole = shared.join(worth, bucket, "left_anti").withColumn("further", F.lit(-1)).withColumn("value", value)
    split = join_skewed(shared, worth, bucket, shared.count()).withColumn("further", F.explode(further))
    split = whole.unionByName(split.withColumn("value", value))
    cell = [*bucket, "further", "value"]
    placed = _sized(split.drop("n"), cell).withColumn(
        "blocks", F.ceil(F.col("n") / block)
    ).withColumn("own", F.pmod(F.xxhash64("seq_id"), F.col("blocks")))
    zero = F.lit(0).cast("bigint")
    left = placed.select(
        *cell, F.col("own").alias("p"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("q"),
        F.col("seq_id").alias("query"), F.col("species").alias("query_species"), F.col("sketch").alias("a"),
    )
    right = placed.select(
        *cell, F.explode(F.sequence(zero, "own")).alias("p"), F.col("own").alias("q"),
        F.col("seq_id").alias("target"), F.col("species").alias("target_species"), F.col("sketch").alias("b"),
    )
    def band_agrees(first: Column) -> Column:
        return F.coalesce(reduce(and_, [F.get("a", first + i) == F.get("b", first + i) for i in range(rows)]), F.lit(False))

    # most pairs of near copies agree on the first band or on the one before: cheap to see
    met = left.join(right, [*cell, "p", "q"]).where(
        (F.col("p") < F.col("q")) | (F.col("query") < F.col("target"))
    ).where(~band_agrees(F.col("start") - rows)).where((F.col("start") == 0) | ~band_agrees(F.lit(0)))
    in_band = [(F.col("start") <= i) & (F.col("start") + rows > i) for i in range(n_perm)]

    def first_score(same: Column) -> Column:
        """The score of a hit where it meets first, else null."""
        agrees = [F.get(same, F.lit(i)) for i in range(n_perm)]
        first_band = F.coalesce(*[
            F.when(reduce(and_, agrees[b : b + rows]), F.lit(b)) for b in range(0, n_perm - rows + 1, rows)
        ])
        first_further = F.coalesce(*[F.when(agrees[i] & ~in_band[i], F.lit(i)) for i in range(n_perm)])
        score = F.size(F.filter(same, lambda x: x))
        here = (F.col("further") < 0) | (first_further == F.col("further"))
        return F.when((first_band == F.col("start")) & (score >= min_score) & here, score)

    # a variable of the function again: compared once a pair
    score = F.get(F.transform(F.array(F.zip_with("a", "b", lambda x, y: x == y)), first_score), F.lit(0))
    once = met.where(score.isNotNull()).select("query", "query_species", "target", "target_species", score.alias("score"))
    back = F.struct(
        F.col("target").alias("query"), F.col("target_species").alias("query_species"),
        F.col("query").alias("target"), F.col("query_species").alias("target_species"), "score",
    )
    there = F.struct("query", "query_species", "target", "target_species", "score")
    return once.select(F.inline(F.array(there, back)))


def best_hits(hits: DataFrame) -> DataFrame:
    """Best target of every query in each other species; the smallest id on ties."""
    best = F.min(F.struct((-F.col("score")).alias("neg"), F.col("target"))).alias("b")
    return (
        hits.where("query_species <> target_species")
        .groupBy("query", "query_species", "target_species")
        .agg(best)
        .select(
            "query", "query_species", F.col("b.target").alias("target"), "target_species",
            (-F.col("b.neg")).alias("score"),
        )
    )


def reciprocal_best(hits: DataFrame) -> DataFrame:
    """Pairs ``a < b`` that are each other's best hit between their species."""
    best = best_hits(hits)
    back = best.select(
        F.col("target").alias("query"), F.col("query").alias("target"),
        F.col("score").alias("back_score"),
    )
    both = best.join(back, ["query", "target"]).where("query < target")
    return both.select(
        F.col("query").alias("a"), F.col("target").alias("b"),
        F.greatest("score", "back_score").alias("score"),
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for undirected links ``a, b``; the component is its
    smallest node.

    Every round hangs each node's larger neighbours, then its smaller ones, on
    the smallest neighbour, until nothing changes; the number of rounds grows
    with the logarithm of the longest path.  Minima are combined map-side and
    joined back (unique on one side), so a hub with very many links is no group
    that one task must hold.
    """
    edges = materialize(_oriented(links.select("a", "b")))
    signature = _signature(edges)
    while True:
        edges = materialize(_small_star(*_large_star(edges, signature[0])))
        before, signature = signature, _signature(edges)
        if signature == before:
            break
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    return nodes.join(members, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _signature(edges: DataFrame) -> tuple:
    """Number of links and a hash of them all."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _oriented(links: DataFrame) -> DataFrame:
    """Distinct links from the larger node ``a`` to the smaller ``b``."""
    return links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _large_star(edges: DataFrame, n_links: int) -> tuple[DataFrame, int]:
    """Hang every node's larger neighbours on its smallest one or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    joined = join_skewed(both, lowest, "a", 2 * n_links)
    hung = joined.where("b > a").select(F.col("b").alias("a"), F.least("low", "a").alias("b"))
    return _oriented(hung), n_links


def _small_star(edges: DataFrame, n_links: int) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = join_skewed(edges, lowest, "a", n_links)
    hung = joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
    return _oriented(hung.unionByName(lowest.select("a", F.col("low").alias("b"))))


def families(links: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """``seq_id, family_id``: connected components of accepted links ``a, b``,
    numbered from the largest (then by smallest member).

    With ``members`` (``seq_id``) sequences without any link become families of
    one.
    """
    parts = connected_components(links)
    if members is not None:
        alone = members.select(F.col("seq_id").alias("node")).join(parts, "node", "left_anti")
        parts = parts.unionByName(alone.withColumn("component", F.col("node")))
    parts = materialize(parts)
    sizes = parts.groupBy("component").agg(F.count("*").alias("n"))
    total = parts.count()
    numbered = global_rank(sizes, [F.col("n").desc(), F.col("component")], "rank")
    digits = F.greatest(F.length(F.col("rank").cast("string")), F.lit(7))
    number = F.lpad(F.col("rank").cast("string"), digits, F.lit("0"))
    named = numbered.select("component", F.concat(F.lit("OG"), number).alias("family_id"))
    return join_skewed(parts, named, "component", total).select(F.col("node").alias("seq_id"), "family_id")


def family_links(hits: DataFrame, sketches: DataFrame, n_perm: int = POSITIONS) -> DataFrame:
    """Links ``a, b`` of families: copies with their representative, hits within a
    species, and reciprocal best hits between species."""
    within = hits.where("query_species = target_species and query < target")
    return (
        copies(sketches, n_perm).select(F.col("seq_id").alias("a"), F.col("representative").alias("b"))
        .unionByName(within.select(F.col("query").alias("a"), F.col("target").alias("b")))
        .unionByName(reciprocal_best(hits).select("a", "b"))
    )
