"""Gene-family gain and loss on a dated species tree.

A linear birth-death process with equal birth and death rate per branch class.
The species tree is small (its size is checked) and goes to every task; the
families are the data.  Families with equal counts have equal likelihoods, so
the fit runs on distinct count profiles with their weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import DataError, materialize, small_rows
from .counts import wide_counts

#: Sizes above the largest observed copy number that hidden nodes may take.
HEADROOM = 20

#: Largest copy number the model takes; larger families belong in the side table
#: of ``counts.split_large`` (a family of that size says nothing about rates).
MAX_COPIES = 2000

#: Numbers held at once while tracing sizes back.
CELLS = 4_000_000


@dataclass(frozen=True)
class SpeciesTree:
    """One tree in child-before-parent order; ``tips`` are the count columns."""

    node_ids: list[int]
    parents: list[int]
    lengths: list[float]
    labels: list[str | None]
    classes: list[int]
    tips: list[str]

    @property
    def n_classes(self) -> int:
        return max(self.classes) + 1


def species_tree(edges: DataFrame, class_col: str | None = None) -> SpeciesTree:
    """Bring one species tree to the driver; ``class_col`` has codes 1..k."""
    wanted = ["node_id", "parent_id", "label", "branch_length", "is_tip"]
    rows = small_rows(edges.select(*wanted, *([class_col] if class_col else [])), "species tree")
    by_id = {r["node_id"]: r for r in rows}
    if len(by_id) != len(rows):
        raise DataError("the species table must hold one tree")
    depth = {}
    for r in rows:
        path, node = [], r["node_id"]
        while node is not None and node not in depth:
            path.append(node)
            node = by_id[node]["parent_id"]
        base = depth[node] if node is not None else -1
        for i, n in enumerate(reversed(path)):
            depth[n] = base + 1 + i
    order = sorted(by_id, key=lambda n: (-depth[n], n))
    place = {n: i for i, n in enumerate(order)}
    nodes = [by_id[n] for n in order]
    return SpeciesTree(
        node_ids=order,
        parents=[-1 if r["parent_id"] is None else place[r["parent_id"]] for r in nodes],
        lengths=[float(r["branch_length"] or 0.0) for r in nodes],
        labels=[r["label"] if r["is_tip"] else None for r in nodes],
        classes=[(r[class_col] or 1) - 1 if class_col else 0 for r in nodes],
        tips=sorted(r["label"] for r in nodes if r["is_tip"]),
    )


def size_transitions(rate: float, length: float, largest: int) -> np.ndarray:
    """``P[s, c]``: from ``s`` copies to ``c`` along a branch, 0..largest.

    One copy leaves none with probability ``a = rt / (1 + rt)`` and ``n >= 1``
    with ``(1 - a)^2 a^(n - 1)``; ``s`` copies are ``s`` independent ones.
    """
    a = rate * length / (1.0 + rate * length)
    one = np.empty(largest + 1)
    one[0] = a
    one[1:] = (1.0 - a) ** 2 * a ** np.arange(largest)
    p = np.zeros((largest + 1, largest + 1))
    p[0, 0] = 1.0
    for s in range(1, largest + 1):
        p[s] = np.convolve(p[s - 1], one)[: largest + 1]
    return p


def _branch_matrices(tree: SpeciesTree, rates, largest: int) -> list[np.ndarray]:
    return [
        size_transitions(rates[c], t, largest) for c, t in zip(tree.classes, tree.lengths)
    ]


def profile_log_likelihoods(tree: SpeciesTree, rates, counts: np.ndarray, largest: int) -> np.ndarray:
    """Log-likelihood of every row of ``counts`` (columns ``tree.tips``), with equal
    prior weight on root sizes 1..largest."""
    p = _branch_matrices(tree, rates, largest)
    column = {s: i for i, s in enumerate(tree.tips)}
    liks = [None] * len(p)
    log_scale = np.zeros(len(counts))
    for i, parent in enumerate(tree.parents):
        if tree.labels[i] is not None:
            sent = p[i][:, counts[:, column[tree.labels[i]]]].T
        elif parent >= 0:
            sent = liks[i] @ p[i].T
        if parent < 0:
            root = liks[i]
            break
        liks[i] = None
        liks[parent] = sent.copy() if liks[parent] is None else liks[parent] * sent
        top = liks[parent].max(axis=1)
        top[top == 0.0] = 1.0
        liks[parent] /= top[:, None]
        log_scale += np.log(top)
    with np.errstate(divide="ignore"):
        return log_scale + np.log(root[:, 1:].sum(axis=1) / largest)


def reconstruct_sizes(tree: SpeciesTree, rates, counts: np.ndarray, largest: int) -> np.ndarray:
    """Jointly most likely size of every node (columns in ``tree.node_ids`` order);
    ties go to the smaller size."""
    p = _branch_matrices(tree, rates, largest)
    column = {s: i for i, s in enumerate(tree.tips)}
    n = len(counts)
    with np.errstate(divide="ignore"):
        logp = [np.log(m) for m in p]
    score = [None] * len(p)
    choice = [None] * len(p)
    for i, parent in enumerate(tree.parents):
        if parent < 0:
            break
        if tree.labels[i] is not None:
            sent = logp[i][:, counts[:, column[tree.labels[i]]]].T
        else:
            through = score[i][:, None, :] + logp[i][None, :, :]
            choice[i] = through.argmax(axis=2)
            sent = through.max(axis=2)
        score[parent] = sent.copy() if score[parent] is None else score[parent] + sent
    root = len(p) - 1
    sizes = np.zeros((n, len(p)), dtype=np.int64)
    sizes[:, root] = score[root][:, 1:].argmax(axis=1) + 1
    for i in range(root - 1, -1, -1):
        if tree.labels[i] is not None:
            sizes[:, i] = counts[:, column[tree.labels[i]]]
        else:
            sizes[:, i] = choice[i][np.arange(n), sizes[:, tree.parents[i]]]
    return sizes


def count_profiles(counts: DataFrame, species: list[str]) -> DataFrame:
    """``profile array<int>, n_families``: distinct rows of the count matrix."""
    wide = wide_counts(counts, species)
    profile = F.array(*[F.col(f"`{s}`").cast("int") for s in species]).alias("profile")
    return wide.select(profile).groupBy("profile").agg(F.count("*").alias("n_families"))


def _largest(found: DataFrame) -> int:
    most = int(found.first()[0] or 0)
    if most > MAX_COPIES:
        raise DataError(f"a family has {most} copies in one species; split large families first")
    return most + HEADROOM


def score_rates(profiles: DataFrame, tree: SpeciesTree, candidates: list, largest: int) -> list[float]:
    """Total log-likelihood of each candidate (a rate per class)."""

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = np.stack(batch["profile"].to_numpy()).astype(np.int64)
            weight = batch["n_families"].to_numpy()
            totals = [
                float(weight @ profile_log_likelihoods(tree, rates, counts, largest))
                for rates in candidates
            ]
            yield pd.DataFrame({"cand": range(len(totals)), "log_likelihood": totals})

    partial = profiles.mapInPandas(scores, "cand int, log_likelihood double")
    rows = partial.groupBy("cand").agg(F.sum("log_likelihood").alias("ll")).collect()
    found = {r["cand"]: r["ll"] for r in rows}
    return [found.get(i, 0.0) for i in range(len(candidates))]


def fit_turnover(
    counts: DataFrame, edges: DataFrame, class_col: str | None = None, rounds: int = 4
) -> DataFrame:
    """Most likely turnover rates: ``class, rate, log_likelihood``.

    One rate without ``class_col`` (a class per branch, 1..k), else one per
    class.  A geometric grid around one event per tree height is refined; with
    several classes the rates are then improved one at a time.
    """
    spark = counts.sparkSession
    tree = species_tree(edges, class_col)
    profiles = materialize(count_profiles(counts, tree.tips))
    largest = _largest(profiles.agg(F.max(F.array_max("profile"))))
    k = tree.n_classes
    base, factor, half = 1.0 / max(sum(tree.lengths) / len(tree.lengths), 1e-12), 3.0, 5
    best, top = base, None
    for _ in range(rounds):
        grid = [best * factor**i for i in range(-half, half + 1)]
        found = score_rates(profiles, tree, [[g] * k for g in grid], largest)
        top = max(found)
        best = grid[found.index(top)]
        factor, half = factor ** (1.0 / 3.0), 3
    rates = [best] * k
    if k > 1:
        for step in range(3 * rounds):
            f = 2.0 ** (0.5 ** (step // 3))
            moves = [rates] + [
                [r * m if i == c else r for i, r in enumerate(rates)]
                for c in range(k) for m in (f, 1.0 / f)
            ]
            found = score_rates(profiles, tree, moves, largest)
            top = max(found)
            rates = moves[found.index(top)]
    return spark.createDataFrame(
        [(c + 1, float(r), float(top)) for c, r in enumerate(rates)],
        "class int, rate double, log_likelihood double",
    )


def branch_changes(
    counts: DataFrame, edges: DataFrame, rates: list[float], class_col: str | None = None
) -> DataFrame:
    """``family_id, node_id, copies, change``: reconstructed size of every node and
    the change from its parent (null at the root)."""
    tree = species_tree(edges, class_col)
    wide = wide_counts(counts, tree.tips)
    profile = F.array(*[F.col(f"`{s}`").cast("int") for s in tree.tips]).alias("profile")
    rows = wide.select("family_id", profile)
    largest = _largest(counts.agg(F.max("copies")))

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes, up = np.array(tree.node_ids), np.array(tree.parents)
        for batch in batches:
            profiles = np.stack(batch["profile"].to_numpy()).astype(np.int64)
            distinct, inverse = np.unique(profiles, axis=0, return_inverse=True)
            step = max(1, CELLS // (largest + 1) ** 2)
            parts = [
                reconstruct_sizes(tree, rates, distinct[i : i + step], largest)
                for i in range(0, len(distinct), step)
            ]
            found = np.concatenate(parts)[inverse.reshape(-1)]
            change = found - found[:, up]
            out = pd.DataFrame({
                "family_id": np.repeat(batch["family_id"].to_numpy(), len(nodes)),
                "node_id": np.tile(nodes, len(batch)),
                "copies": found.reshape(-1),
                "change": change.reshape(-1),
            })
            out["change"] = out["change"].astype("Int64").mask(np.tile(up < 0, len(batch)))
            yield out

    key = rows.schema["family_id"].dataType.simpleString()
    return rows.mapInPandas(
        sizes, f"family_id {key}, node_id bigint, copies bigint, change bigint"
    )
