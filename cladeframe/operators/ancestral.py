"""Discrete traits on trees: likelihoods, marginal states, rates, branch classes.

Many traits on many trees run in one job.  Upwards, nodes send a message to their
parent; messages meet in an aggregate (sums of logarithms, combined map-side, so a
parent with very many children is no hot spot).  Trees of at most ``SHALLOW`` levels are
worked level by level.  Deeper ones are contracted: all nodes that are done send at once,
and a node that waits for one child only is a matrix that maps the child's message to its
own likelihoods; chains of such nodes are multiplied by pointer doubling, so that a
ladder-shaped tree takes about as many rounds as the logarithm of its depth.  Downwards, a
node's posterior is its parent's times a matrix, and the matrices of a path are multiplied
the same way.  Every round is stored, which keeps plans short and survives lost executors.

``tip_states`` has ``tree_id, node_id, state`` (1..k), the columns in ``keys``
that tell independent problems apart, and the rates: ``rate`` (double) for ER
or ``q`` (the k*k rate matrix, flattened by rows) otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rates import ER_DECAY, free_rates, matrix_messages, matrix_probabilities, rate_search
from ..runtime import DataError, by_rows, join_skewed, materialize, materialize_even
from .phenotype import class_legend, code_tips, forced_classes, require_classes
from .trees import NODE, SHALLOW, lifted

#: Posteriors closer than this count as tied; ties go to the lowest code.
TIE = 1e-9

NAN = "double('NaN')"

#: Rows whose rate matrices one task exponentiates.
MATRIX_ROWS = 50_000

#: Tasks that the nodes of one tree are dealt to when they meet its problems.
SALT = 32

#: Steps of the search for SYM and ARD, one rate at a time, where no rounds are given.
STEPS = 20


@dataclass
class Forward:
    """Partial likelihoods of the internal nodes (``all``), stored, of which there are
    ``n``."""

    all: DataFrame
    k: int
    keys: list[str]
    rate_col: str
    n: int
    #: ``f_1..f_k`` for each problem and tree: the shares of the states among its tips.
    shares: DataFrame

    @property
    def root(self) -> DataFrame:
        return self.all.where("parent_id is null")


def _lik(k: int, prefix: str = "l") -> list[str]:
    return [f"{prefix}_{s}" for s in range(1, k + 1)]


def _each(template: str, *names: list[str]) -> list[str]:
    """The SQL ``template`` filled with the names of each state in turn."""
    return [template.format(*row) for row in zip(*names)]


def _messages(df: DataFrame, k: int, rate_col: str) -> DataFrame:
    """Add ``m_1..m_k``: ``P(t) . likelihoods`` over the branch of each row."""
    own, sent = _lik(k), _lik(k, "m")
    if rate_col == "rate":
        decayed = df.selectExpr(
            "*", f"{ER_DECAY.format(k=k)} as decay", f"{' + '.join(own)} as spread"
        )
        even = f"(1d - decay) / {k}d * spread + decay * {{}} as {{}}"
        return decayed.selectExpr("*", *_each(even, own, sent)).drop("decay", "spread")
    message = matrix_messages(k)(F.col("q"), F.col("branch_length"), F.array(*own))
    packed = df.withColumn("sent", message)
    return packed.selectExpr(
        "*", *[f"get(sent, {i}) as {name}" for i, name in enumerate(sent)]
    ).drop("sent")


LOG = "case when {0} > 0 then ln({0}) when isnan({0}) then {0} else double('-Infinity') end"


def _log(x: Column) -> Column:
    return F.when(x > 0, F.log(x)).otherwise(F.when(F.isnan(x), x).otherwise(F.lit(float("-inf"))))


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _matrix(entries) -> str:
    return f"array({', '.join(entries)})"


def _product(a: str, b: str, k: int) -> str:
    """SQL for the product of two flattened matrices."""
    return _matrix(
        " + ".join(f"{a}[{i * k + h}] * {b}[{h * k + j}]" for h in range(k)) for i in range(k) for j in range(k)
    )


def _probabilities(df: DataFrame, k: int, rate_col: str) -> DataFrame:
    """Add ``p``: the flattened transition matrix over the branch of each row."""
    if rate_col == "rate":
        even, stay = f"(1d - decay) / {k}d", f"(1d - decay) / {k}d + decay"
        entries = _matrix(stay if i == j else even for i in range(k) for j in range(k))
        return df.selectExpr("*", f"{ER_DECAY.format(k=k)} as decay").selectExpr("*", f"{entries} as p").drop("decay")
    return df.withColumn("p", matrix_probabilities(k)(F.col("q"), F.col("branch_length")))


def tree_nodes(edges: DataFrame) -> DataFrame:
    """The nodes with their levels, stored, for several calls of ``forward_liks``."""
    final = lifted(edges, carry=("parent_id", "branch_length", "is_tip"))
    return materialize_even(
        final.select(
            *NODE, "parent_id", "is_tip", (F.col("hops") - 1).cast("int").alias("level"),
            F.coalesce("branch_length", F.lit(0.0)).alias("branch_length"),
        ),
        sort="level",
    )


def _problems(tip_states: DataFrame, nodes: DataFrame, group: list[str], rate_col: str) -> DataFrame:
    """All nodes of the trees of all problems; one tree's nodes go to ``SALT`` tasks."""
    problems = tip_states.groupBy(*group).agg(F.expr(f"first({rate_col}) as {rate_col}"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    salted = nodes.withColumn("salt", F.pmod(F.xxhash64("node_id"), F.lit(SALT)).cast("int"))
    return salted.join(problems.select("*", salts), ["tree_id", "salt"]).drop("salt")


def forward_liks(
    edges: DataFrame, tip_states: DataFrame, k: int, keys=("trait_id",), rate_col: str = "rate",
    nodes: DataFrame | None = None,
) -> Forward:
    """Normalised partial likelihoods ``l_1..l_k`` of every internal node above a tip
    with a state, with ``log_scale``: the logarithm of what the normalisations took out.

    A tip without a state says nothing.
    """
    keys = list(keys)
    nodes = tree_nodes(edges) if nodes is None else nodes
    deepest = nodes.agg(F.max("level")).first()[0] or 0
    work = _by_level if deepest <= SHALLOW else _by_contraction
    inner, total = work(nodes, tip_states, k, keys, rate_col, deepest)
    shares = tip_states.groupBy(*keys, "tree_id").agg(
        *[F.avg(F.when(F.col("state") == s, 1.0).otherwise(0.0)).alias(f"f_{s}") for s in range(1, k + 1)]
    )
    return Forward(inner, k, keys, rate_col, total, shares)


def _by_level(
    nodes: DataFrame, tip_states: DataFrame, k: int, keys: list[str], rate_col: str, deepest: int
) -> tuple[DataFrame, int]:
    """All trees and problems of a level together, from the deepest level up; each level
    is stored."""
    group = [*keys, "tree_id"]
    placed = tip_states.join(nodes.where("is_tip"), NODE).select(
        *group, "node_id", "parent_id", "branch_length", "level", rate_col,
        *[F.when(F.col("state") == s, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"l_{s}") for s in range(1, k + 1)],
        F.lit(0.0).alias("log_scale"),
    )
    tips = materialize_even(by_rows(placed, ["node_id"], tip_states.count()), sort="level")
    columns = tips.columns
    liks, logs, exps = _lik(k), _lik(k, "s"), _lik(k, "e")
    meet = [F.expr(f"first({rate_col}) as {rate_col}"), F.expr("sum(log_scale) as below")]
    meet += [F.expr(x) for x in _each(f"sum({LOG}) as {{1}}", _lik(k, "m"), logs)]
    sizes = {r["level"]: r["count"] for r in tips.groupBy("level").count().collect()}
    done: dict[int, DataFrame] = {}
    most = 0
    for level in range(deepest, 0, -1):
        here = tips.where(f"level = {level}")
        if level in done:
            here = here.unionByName(done[level])
        # inner nodes of a level are no more than their children
        most += sizes.get(level, 0)
        if rate_col != "rate":
            here = by_rows(here, ["node_id"], most, MATRIX_ROWS)
        met = (
            _messages(here, k, rate_col)
            .groupBy(*group, F.col("parent_id").alias("node_id"))
            .agg(*meet)
            .selectExpr("*", f"greatest({', '.join(logs)}) as top")
            .selectExpr("*", *_each("exp({} - top) as {}", logs, exps))
            .selectExpr("*", f"{' + '.join(exps)} as total")
        )
        above = nodes.where(f"level = {level - 1}").drop("is_tip")
        placed = met.join(above, NODE).selectExpr(
            *group, "node_id", "parent_id", "branch_length", "level", rate_col,
            *_each("{} / total as {}", exps, liks), "below + top + ln(total) as log_scale",
        )
        done[level - 1] = materialize_even(placed.select(*columns))
    every = reduce(DataFrame.unionByName, done.values()) if done else tips.where("false")
    # inner nodes of a tree that branches are fewer than its tips, and levels as many as stored
    return every.drop("level"), tips.count() * max(1, deepest)


def _by_contraction(
    nodes: DataFrame, tip_states: DataFrame, k: int, keys: list[str], rate_col: str, deepest: int
) -> tuple[DataFrame, int]:
    """Rounds of messages of all nodes that are done, and of doubled chains."""
    nodes = nodes.drop("level")
    group = [*keys, "tree_id"]
    node = [*group, "node_id"]
    own = [*node, "parent_id", "branch_length", rate_col]
    liks, logs, exps, msgs = _lik(k), _lik(k, "s"), _lik(k, "e"), _lik(k, "m")
    finished = [*own, *liks, "log_scale", "n_tips"]

    each = _problems(tip_states, nodes, group, rate_col)
    stated = tip_states.select(*node, "state")
    fresh = materialize(
        each.where("is_tip").join(stated, node, "left").select(
            *own, *[F.expr(f"case when state is null or state = {s} then 1d else 0d end as l_{s}") for s in range(1, k + 1)],
            F.lit(0.0).alias("log_scale"), F.col("state").isNotNull().cast("bigint").alias("n_tips"),
        )
    )
    children = nodes.where("parent_id is not null").groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(
        F.count("*").alias("pending"), F.bit_xor("node_id").alias("open_ids")
    )
    waiting = materialize(
        each.where("not is_tip").join(children, NODE).select(
            *own, "pending", "open_ids", *[F.lit(0.0).alias(c) for c in logs], F.lit(0.0).alias("log_scale"),
            F.lit(0).cast("bigint").alias("n_tips"), F.lit(None).cast("bigint").alias("target"),
            F.lit(None).cast("array<double>").alias("m"),
        )
    )
    columns = waiting.columns
    done: list[DataFrame] = []
    counts = waiting.agg(F.count("*").alias("n"), F.count("target").alias("chained")).first()
    total = counts["n"]
    while counts["n"]:
        sent = _messages(fresh, k, rate_col)
        arrived = sent.groupBy(*group, F.col("parent_id").alias("node_id")).agg(
            F.count("*").alias("got"), F.expr("bit_xor(node_id) as got_ids"),
            *[F.expr(x) for x in _each(f"sum({LOG}) as {{1}}", msgs, _lik(k, "a"))],
            F.sum("log_scale").alias("got_scale"), F.sum("n_tips").alias("got_tips"),
        )
        met = waiting.where("target is null").join(arrived, node, "left").selectExpr(
            *own, "pending - coalesce(got, 0) as pending", "open_ids ^ coalesce(got_ids, 0L) as open_ids",
            *_each("{0} + coalesce({1}, 0d) as {0}", logs, _lik(k, "a")),
            "log_scale + coalesce(got_scale, 0d) as log_scale", "n_tips + coalesce(got_tips, 0L) as n_tips", "target", "m",
        )
        # a node that waits for one child is a diagonal matrix over that child's message
        scaled = met.selectExpr("*", f"greatest({', '.join(logs)}) as top").selectExpr("*", *_each("exp({} - top) as {}", logs, exps))
        diagonal = _matrix(exps[i] if i == j else "0d" for i in range(k) for j in range(k))
        complete = scaled.where("pending = 0").selectExpr("*", f"{' + '.join(exps)} as total").selectExpr(
            *own, *_each("{} / total as {}", exps, liks), "log_scale + top + ln(total) as log_scale", "n_tips"
        )
        chained = scaled.where("pending = 1").withColumn("target", F.col("open_ids")).withColumn("m", F.expr(diagonal))
        chained = chained.withColumn("log_scale", F.expr("log_scale + top")).select(columns)
        parts = [met.where("pending > 1").select(columns), chained]
        if counts["chained"]:
            resolved, rest = _chains(waiting.where("target is not null"), sent, k, group, rate_col, counts["chained"])
            complete = complete.select(finished).unionByName(resolved.select(finished))
            parts.append(rest.select(columns))
        fresh = materialize(complete.select(finished))
        waiting = materialize(reduce(DataFrame.unionByName, parts))
        done.append(fresh)
        before = counts
        counts = waiting.agg(F.count("*").alias("n"), F.count("target").alias("chained")).first()
        if counts == before and fresh.isEmpty():
            raise DataError("a node of a tree has children that are no nodes of it")
    inner = reduce(DataFrame.unionByName, done or [fresh.where("false")])
    return inner.where("n_tips > 0").drop("n_tips"), total


def _chains(
    chained: DataFrame, sent: DataFrame, k: int, group: list[str], rate_col: str, total: int
) -> tuple[DataFrame, DataFrame]:
    """Nodes that wait for one other node: those whose node has sent its message, done;
    and the others, with their pointers doubled."""
    key = [*group, "target"]
    liks, msgs = _lik(k), _lik(k, "m")
    arrived = sent.select(
        *group, F.col("node_id").alias("target"), *msgs, F.col("log_scale").alias("got_scale"), F.col("n_tips").alias("got_tips")
    )
    own = [c for c in chained.columns if c not in ("log_scale", "n_tips")]
    placed = join_skewed(chained, arrived, key, total)
    sums = [f"{' + '.join(f'm[{i * k + j}] * {msgs[j]}' for j in range(k))} as {c}" for i, c in enumerate(_lik(k, "u"))]
    resolved = (
        placed.selectExpr(*own, "log_scale + got_scale as log_scale", "n_tips + got_tips as n_tips", *sums)
        .selectExpr("*", f"{' + '.join(_lik(k, 'u'))} as total")
        .selectExpr(
            *own, f"log_scale + case when total > 0 then ln(total) else {NAN} end as log_scale", "n_tips",
            *_each(f"case when total > 0 then {{}} / total else {NAN} end as {{}}", _lik(k, "u"), liks),
        )
    )
    # a node of the chain that is done now is met next time: it is no step to jump over
    open_ = chained.join(arrived.select(*key), key, "left_anti")
    step = _probabilities(open_, k, rate_col).selectExpr(
        *group, "node_id as target", "target as next", f"{_product('p', 'm', k)} as step",
        "log_scale as step_scale", "n_tips as step_tips",
    )
    jumped = (
        open_.join(step, key, "left")
        .selectExpr("*", f"case when step is null then m else {_product('m', 'step', k)} end as product")
        .selectExpr("*", "array_max(product) as top")
        .selectExpr(
            *[c for c in own if c not in ("target", "m")], "coalesce(next, target) as target",
            "case when step is null or not top > 0 then product else transform(product, x -> x / top) end as m",
            "log_scale + coalesce(step_scale, 0d) + case when step is null or not top > 0 then 0d else ln(top) end as log_scale",
            "n_tips + coalesce(step_tips, 0L) as n_tips",
        )
    )
    return resolved, jumped


def log_likelihoods(forward: Forward, root_prior: str = "flat") -> DataFrame:
    """Log-likelihood per problem and tree, from the root's partial likelihoods.

    ``root_prior``: ``flat``, ``likelihoods`` (the root's own, the choice for
    ``auto``), ``empirical`` (the shares of the states among the tips) or
    ``max_likelihood``.
    """
    root = forward.root
    if root_prior == "empirical":
        root = root.join(forward.shares, [*forward.keys, "tree_id"])
    liks = [F.col(c) for c in _lik(forward.k)]
    if root_prior == "flat":
        weighted = _sum(liks) / F.lit(float(forward.k))
    elif root_prior in ("auto", "likelihoods"):
        weighted = _sum([x * x for x in liks])
    elif root_prior == "empirical":
        weighted = _sum([x * F.col(f) for x, f in zip(liks, _lik(forward.k, "f"))])
    elif root_prior == "max_likelihood":
        weighted = F.greatest(*liks)
    else:
        raise ValueError(f"unknown root prior {root_prior!r}")
    return root.select(
        *forward.keys, "tree_id", forward.rate_col,
        (F.col("log_scale") + _log(weighted)).alias("log_likelihood"),
    )


def marginal_states(forward: Forward) -> DataFrame:
    """Posterior ``l_1..l_k`` of every internal node given all tips.

    The root keeps its partial likelihoods; going down, a node's share of its
    parent's message is replaced by the rest of the tree.  Impossible
    transitions give NaN rows (see ``unresolved_states``).
    """
    k, group = forward.k, [*forward.keys, "tree_id"]
    liks, msgs = _lik(k), _lik(k, "m")
    node = [*group, "node_id"]
    # the root is the map of anything to its likelihoods
    roots = forward.root.selectExpr(*node, "parent_id as anc", f"{_matrix(liks * k)} as t")
    sent = _probabilities(_messages(forward.all.where("parent_id is not null"), k, forward.rate_col), k, forward.rate_col)
    entries = _matrix(
        f"case when {msgs[i]} <> 0 then p[{i * k + j}] * {liks[j]} / {msgs[i]} else {NAN} end" for i in range(k) for j in range(k)
    )
    state = materialize(roots.unionByName(sent.selectExpr(*node, "parent_id as anc", f"{entries} as t")))
    pending = state.where("anc is not null")
    while n_pending := pending.count():
        above = state.selectExpr(*group, "node_id as anc", "anc as next", "t as above")
        jumped = materialize(
            join_skewed(pending, above, [*group, "anc"], n_pending).selectExpr(
                *node, "next as anc", f"{_product('above', 't', k)} as t"
            )
        )
        state = jumped.unionByName(state.where("anc is null"))
        pending = jumped.where("anc is not null")
    # all rows of a finished product are the posterior
    total = " + ".join(f"t[{j}]" for j in range(k))
    return state.selectExpr("*", f"{total} as total").selectExpr(
        *node, *[f"case when total > 0 then t[{j}] / total else {NAN} end as {c}" for j, c in enumerate(liks)]
    )


def long_states(posteriors: DataFrame, k: int, keys=("trait_id",)) -> DataFrame:
    """Posteriors as rows ``…, node_id, state, lik``."""
    rows = F.posexplode(F.array(*[F.col(c) for c in _lik(k)])).alias("pos", "lik")
    wide = posteriors.select(*keys, *NODE, rows)
    return wide.select(*keys, *NODE, (F.col("pos") + 1).alias("state"), "lik")


def unresolved_states(posteriors: DataFrame) -> DataFrame:
    """Report of nodes whose posterior is not a number."""
    return posteriors.where(F.isnan("l_1")).select(
        F.lit("WARNING").alias("severity"), F.lit("nan_posterior").alias("code"),
        F.concat_ws("/", "tree_id", "node_id").alias("subject"),
        F.lit("zero rates rule out necessary transitions; use another model").alias("detail"),
    )


def most_likely_state(k: int) -> Column:
    """Code of the largest posterior; ties go to the lowest code, NaN to null."""
    liks = [F.col(c) for c in _lik(k)]
    top = F.greatest(*liks)
    hits = [F.when(x >= top - F.lit(TIE), F.lit(s + 1)) for s, x in enumerate(liks)]
    return F.when(~F.isnan(top), F.coalesce(*hits))


def node_states(posteriors: DataFrame, k: int, keys=("trait_id",)) -> DataFrame:
    return posteriors.select(*keys, *NODE, most_likely_state(k).alias("class"))


# -- rate fit --------------------------------------------------------------------


def fit_mk(
    edges: DataFrame,
    tip_states: DataFrame,
    k: int,
    model: str = "ER",
    root_prior: str = "auto",
    rounds: int | None = None,
    keys=("trait_id",),
) -> DataFrame:
    """Maximum-likelihood rates per problem and tree: ``…, tree_id, rates
    array<double>, q array<double>, log_likelihood``.

    Every round evaluates a whole set of candidates per problem in one forward
    pass.  ER scans a geometric grid around one change per mean branch length and refines
    around the best, until the maximum of every problem is found or, where ``rounds`` are
    given, as often as that.  SYM and ARD start from the ER optimum and change one rate at a
    time, in four steps a round or ``STEPS``.
    """
    if model not in ("ER", "SYM", "ARD"):
        raise ValueError(f"model must be ER, SYM or ARD, got {model!r}")
    keys = list(keys)
    problem = [*keys, "tree_id"]
    nodes = tree_nodes(edges)
    tips = materialize_even(tip_states.select(*problem, "node_id", "state"))
    scale = nodes.where("parent_id is not null").groupBy("tree_id").agg(
        (F.lit(1.0) / F.avg("branch_length")).alias("rate")
    )
    grid = F.explode(F.array(*[F.col("rate") * F.lit(3.0**i) for i in range(-6, 7)])).alias("rate")
    asked = tips.select(*problem).distinct().join(scale, "tree_id").select(*problem, grid)
    seen, climb = None, rate_search()
    for _ in count() if rounds is None else range(rounds):
        cands = materialize(asked.withColumn("cand", F.monotonically_increasing_id()))
        scored = materialize_even(score_rates(edges, tips, k, cands, "rate", root_prior, keys, nodes).drop("cand"))
        seen = scored if seen is None else seen.unionByName(scored)
        looked = seen.groupBy(*problem).agg(
            F.sort_array(F.collect_list(F.struct("rate", "log_likelihood"))).alias("at")
        )
        best = materialize(
            looked.select(*problem, climb("at.rate", "at.log_likelihood").alias("best")).select(*problem, "best.*")
        )
        asked = best.select(*problem, F.explode("next").alias("rate"))
        if asked.isEmpty():
            break
    best = best.drop("next")
    if model == "ER":
        rates = F.array("rate")
        return best.select(*problem, rates.alias("rates"),
                           flat_q(k, "ER", rates).alias("q"), "log_likelihood")
    n = free_rates(k, model)
    best = best.select(*problem, F.array_repeat("rate", n).alias("rates"))
    for step in range(STEPS if rounds is None else 4 * rounds):
        factor = 3.0 ** (0.5 ** (step // 4))
        moves = [(-1, 1.0)] + [(i, f) for i in range(n) for f in (factor, 1.0 / factor)]
        move = F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(f).alias("f")) for i, f in moves
        ])).alias("move")
        moved = F.transform(
            "rates", lambda r, i: F.when(i == F.col("move.i"), r * F.col("move.f")).otherwise(r)
        )
        cands = best.select(*problem, "rates", move).select(*problem, moved.alias("rates"))
        cands = cands.withColumn("q", flat_q(k, model, F.col("rates")))
        best = _best(tips, nodes, edges, cands, k, problem, "q", root_prior)
    return best.select(*problem, "rates", "q", "log_likelihood")


def flat_q(k: int, model: str, rates: Column) -> Column:
    """Flattened rate matrix from the array of free rates."""
    place, n = {}, 0
    for i in range(k):
        for j in range(k):
            if i == j:
                continue
            if model == "ER":
                place[i, j] = 0
            elif model == "SYM" and j < i:
                place[i, j] = place[j, i]
            else:
                place[i, j], n = n, n + 1
    rate = {ij: F.get(rates, F.lit(p)) for ij, p in place.items()}
    for i in range(k):
        rate[i, i] = -_sum([rate[i, j] for j in range(k) if j != i])
    return F.array(*[rate[i, j] for i in range(k) for j in range(k)])


def score_rates(
    edges: DataFrame, tip_states: DataFrame, k: int, candidates: DataFrame, rate_col: str = "rate",
    root_prior: str = "flat", keys=("trait_id",), nodes: DataFrame | None = None,
) -> DataFrame:
    """``log_likelihood`` of every candidate: rows with the columns of a problem (``keys``
    and ``tree_id``), a number ``cand`` and ``rate`` or ``q``."""
    problem = [*keys, "tree_id"]
    states = tip_states.join(candidates.select(*problem, "cand", rate_col), problem)
    forward = forward_liks(edges, states, k, [*keys, "cand"], rate_col, nodes)
    return log_likelihoods(forward, root_prior)


def _best(tips, nodes, edges, cands, k, problem, rate_col, root_prior) -> DataFrame:
    """The candidate with the largest log-likelihood per problem."""
    keys = [c for c in problem if c != "tree_id"]
    numbered = materialize(cands.withColumn("cand", F.monotonically_increasing_id()))
    scored = score_rates(edges, tips, k, numbered, rate_col, root_prior, keys, nodes)
    top = scored.groupBy(*problem).agg(
        F.max_by("cand", "log_likelihood").alias("cand"),
        F.max("log_likelihood").alias("log_likelihood"),
    )
    return materialize_even(top.join(numbered, [*problem, "cand"]).drop("cand"))


# -- class trees -----------------------------------------------------------------


def class_tree(
    edges: DataFrame,
    tip_labels: DataFrame,
    model: str = "ER",
    rate: float | None = None,
    anc_category: str | None = None,
    root_prior: str = "auto",
    q=None,
) -> tuple[DataFrame, DataFrame]:
    """Label every branch with the class of the node below it.

    ``tip_labels`` has ``tree_id, node_id, species, phenotype`` for every tip.
    Internal classes are the most likely states, or ``anc_category`` throughout.
    ``rate`` fixes the ER rate and ``q`` the k x k rate matrix, states in the order of the
    legend; otherwise the rates are fitted, under ``root_prior``.  Returns the edges with
    ``class`` and the legend.
    """
    legend = class_legend(tip_labels)
    k = require_classes(legend)
    coded = code_tips(tip_labels, legend)
    if anc_category is not None:
        code = legend.where(F.col("category") == anc_category).first()
        if code is None:
            raise DataError(f"{anc_category!r} is not one of the categories")
        return forced_classes(edges, coded, code["integer"]), legend
    states = coded.select(F.lit("trait").alias("trait_id"), *NODE, F.col("class").alias("state"))
    if q is not None:
        flat = [float(x) for row in q for x in row]
        if len(flat) != k * k:
            raise DataError(f"a rate matrix of {k} states needed, got {len(flat)} cells")
        rated, rate_col = states.withColumn("q", F.array(*[F.lit(x) for x in flat])), "q"
    elif rate is not None:
        rated, rate_col = states.withColumn("rate", F.lit(float(rate))), "rate"
    else:
        fitted = fit_mk(edges, states, k, model, root_prior)
        rated, rate_col = states.join(fitted.select("trait_id", "tree_id", "q"),
                                      ["trait_id", "tree_id"]), "q"
    forward = forward_liks(edges, rated, k, ["trait_id"], rate_col)
    inner = node_states(marginal_states(forward), k).select(*NODE, "class")
    classes = inner.unionByName(coded.select(*NODE, F.col("class").cast("int").alias("class")))
    return edges.join(classes, NODE, "left"), legend
