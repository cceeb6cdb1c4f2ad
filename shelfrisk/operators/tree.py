"""Regression trees of all groups at once, grown from counted predictor tuples.

Rows are counted once: how many rows of a group share a tuple of predictor values, with their targets' sums. A node whose
tuples fit one row of a table is grown on there, level after level, by expressions over its array of tuples, so
many levels fit one plan without a shuffle. Larger nodes are first split level by level, each level an aggregate over all tuples,
until their parts fit. Afterwards subtrees that do not pay for their splits are removed (minimal cost-complexity
pruning). Surrogate splits are not built: the rows have no missing values.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrisk.operators.ordered import fits_one_task, running_totals
from shelfrisk.operators.schema import quoted
from shelfrisk.session import (BROADCAST_BYTES, TASK_ROWS, broadcast_if_small, materialise, row_count,
                               total_of)

# Improvements are compared as shares of the root's squared error, to this many digits; equal ones
# go to the earlier feature, then to the lower cut.
SCORE_DIGITS = 9
# Most tuples of a node that are kept as one array.
NODE_TUPLES = 50_000
# Levels that one query plan grows arrays by.
LEVELS_PER_PLAN = 4
# Largest tree, in nodes, that is sent as one value; rows walk down larger ones level by level.
TREE_NODES = 50_000


@dataclass
class TreeModel:
    """`nodes`: (group, node, depth, n, mean, risk, feature, cut, gain); a leaf has no feature.

    The root is node 1 and the children of node t are 2t (below the cut) and 2t + 1.
    """

    group: str
    features: list[str]
    nodes: DataFrame
    depth: int


def fit_trees(rows: DataFrame, group: str, target: str, features: list[str], cp: float = 0.0001, min_split: int = 20,
              min_bucket: int = 7, max_depth: int = 30, task_rows: int = TASK_ROWS, node_tuples: int = NODE_TUPLES) -> TreeModel:
    """Grow and prune one tree per group; groups need no minimum size (a small one is a single leaf)."""
    rules = _Rules(group, len(features), cp, min_split, min_bucket, max_depth)
    tuples = _tuples(rows, group, target, features)
    done, packed = [], []
    state = tuples.withColumn("node", F.lit(1).cast("long"))
    small = row_count(tuples) <= node_tuples
    for _ in range(max_depth + 1):
        if small:
            packed.append(_packed(state, group))
            break
        sizes = materialise(state.groupBy(group, "node").agg(F.count(F.lit(1)).alias("tuples")),
                            large=F.count_if(F.col("tuples") > node_tuples))
        fitting = broadcast_if_small(sizes.filter(F.col("tuples") <= node_tuples).select(group, "node"), rows=row_count(sizes))
        packed.append(_packed(state.join(fitting, [group, "node"], "left_semi"), group))
        if not total_of(sizes, "large"):
            break
        level = materialise(_best_splits(state.join(fitting, [group, "node"], "left_anti"), rules, task_rows))
        done.append(level)
        splits = level.filter(F.col("feature").isNotNull()).select(group, "node", "feature", "cut")
        state = materialise(_descend(state, broadcast_if_small(splits, rows=row_count(level)), group))
    done += _grown(reduce(DataFrame.unionByName, packed), rules)
    depth_of = F.length(F.bin("node")) - 1
    nodes = materialise(reduce(DataFrame.unionByName, done).withColumn("depth", depth_of), deepest=F.max(depth_of))
    names = F.array(*[F.lit(f) for f in features])
    labelled = _pruned(nodes, group, cp).withColumn("feature", F.when(F.col("feature").isNotNull(), F.get(names, F.col("feature"))))
    return TreeModel(group, features, materialise(labelled.select(
        group, "node", "depth", "n", "mean", "risk", "feature", "cut", "gain")), total_of(nodes, "deepest") or 0)


@dataclass
class _Rules:
    group: str
    features: int
    cp: float
    min_split: int
    min_bucket: int
    max_depth: int


def _tuples(rows: DataFrame, group: str, target: str, features: list[str]) -> DataFrame:
    """Stored (group, x, n, s, q, centre, root_risk): rows, sum and sum of squares of the target about the group's mean, per
    different tuple x. The rows are read and shuffled once, counted before they move."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    y = F.col(target).cast("double")
    counted = materialise(rows.filter(F.col(group).isNotNull()).groupBy(quoted(group), x.alias("x")).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), (F.count(y) * F.var_pop(y)).alias("inside")))
    centres = counted.groupBy(group).agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    away = F.col("mean") - F.col("centre")
    apart = counted.join(broadcast_if_small(centres, rows=row_count(counted)), group).select(
        group, "x", "n", (F.col("n") * away).alias("s"), (F.col("inside") + F.col("n") * away * away).alias("q"), "centre")
    roots = apart.groupBy(group).agg((F.sum("q") - F.pow(F.sum("s"), F.lit(2)) / F.sum("n")).alias("root_risk"))
    return materialise(apart.join(broadcast_if_small(roots, rows=row_count(counted)), group))


def _packed(state: DataFrame, group: str) -> DataFrame:
    """One row per node with its tuples as an array."""
    return state.groupBy(group, "node").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.any_value("centre").alias("centre"),
        F.any_value("root_risk").alias("root_risk"), F.collect_list(F.struct("x", "n", "s", "q")).alias("tuples"))


def _grown(nodes: DataFrame, rules: _Rules) -> list[DataFrame]:
    """Finished nodes of all trees below `nodes`, in stored tables of LEVELS_PER_PLAN levels each."""
    key = f"`{rules.group}`"
    state = nodes.selectExpr(key, "centre", "root_risk", "struct(node, n, s, q, tuples, cast(null as int) as feature, "
                             "cast(null as double) as cut, cast(null as double) as gain, false as done) as at")
    out = []
    while True:
        for _ in range(LEVELS_PER_PLAN):
            state = _one_level(state, rules)
        flat = state.selectExpr(key, "centre", "root_risk", "at.*")
        stored = materialise(flat, pending=F.count_if(~F.col("done")))
        out.append(stored.filter("done").selectExpr(key, "node", "n", "centre + s / n as mean", "q - s * s / n as risk", "root_risk",
                                                    "feature", "cut", "gain"))
        if not total_of(stored, "pending"):
            return out
        state = stored.filter("not done").selectExpr(key, "centre", "root_risk", "struct(node, n, s, q, tuples, feature, cut, gain, done) as at")


def _one_level(state: DataFrame, rules: _Rules) -> DataFrame:
    """Pending nodes become finished ones and, where a split is worth it, two pending children."""
    key = f"`{rules.group}`"
    # Spark does not repeat an expression inside a generator, so the search for the best split runs once per node.
    found = state.withColumn("best", F.expr(f"case when not at.done then {_best_of_node(rules)} end"))
    sides = []
    for side, child in (("<", "2 * at.node"), (">=", "2 * at.node + 1")):
        own = f"filter(at.tuples, t -> get(t.x, -best.early) {side} best.cut)"
        total = (f"aggregate({own}, named_struct('n', 0L, 's', 0D, 'q', 0D), "
                 "(a, t) -> named_struct('n', a.n + t.n, 's', a.s + t.s, 'q', a.q + t.q))")
        sides.append(f"struct({child} as node, {total} as total, {own} as tuples)")
    pending = "cast(null as int) as feature, cast(null as double) as cut, cast(null as double) as gain, false as done"
    children = (f"transform(array({', '.join(sides)}), c -> struct(c.node as node, c.total.n as n, c.total.s as s, c.total.q as q, "
                f"c.tuples as tuples, {pending}))")
    finished = ("struct(at.node as node, at.n as n, at.s as s, at.q as q, cast(null as array<struct<x: array<double>, n: bigint, s: double, "
                "q: double>>) as tuples, -best.early as feature, best.cut as cut, best.gain as gain, true as done)")
    return found.selectExpr(key, "centre", "root_risk", f"explode(case when at.done then array(at) when best is null then array({finished}) "
                            f"else concat(array({finished}), {children}) end) as at")


def _best_of_node(rules: _Rules) -> str:
    """The best split of the node `at`, as SQL: (score, early, low, cut, gain), or NULL if none is worth it.

    Per feature the tuples are sorted by its value and scanned once with the running sums of the side below the cut."""
    enough = (f"at.n >= {rules.min_split} and length(bin(at.node)) <= {rules.max_depth} "
              f"and at.q - at.s * at.s / at.n > cast({rules.cp!r} as double) * root_risk")
    gain = "(a.s * a.s / a.n + (at.s - a.s) * (at.s - a.s) / (at.n - a.n) - at.s * at.s / at.n)"
    none = "cast(null as struct<score: double, early: int, low: double, cut: double, gain: double>)"
    scans = []
    for i in range(rules.features):
        cut = (f"case when t.v > a.v and a.n >= {rules.min_bucket} and at.n - a.n >= {rules.min_bucket} then named_struct("
               f"'score', round(try_divide({gain}, root_risk), {SCORE_DIGITS}), 'early', {-i}, 'low', -a.v, 'cut', (a.v + t.v) / 2, 'gain', {gain}) end")
        scans.append(f"aggregate(array_sort(transform(at.tuples, t -> struct(get(t.x, {i}) as v, t.n as n, t.s as s))), "
                     f"named_struct('n', 0L, 's', 0D, 'v', cast(null as double), 'best', {none}), "
                     f"(a, t) -> named_struct('n', a.n + t.n, 's', a.s + t.s, 'v', t.v, 'best', greatest(a.best, {cut})), a -> a.best)")
    best = f"greatest({', '.join(scans)})" if len(scans) > 1 else scans[0]
    return f"get(filter(array(case when {enough} then {best} end), b -> b.score > 0), 0)"


def _best_splits(state: DataFrame, rules: _Rules, task_rows: int) -> DataFrame:
    """Per large node: size, mean, squared error and, where one is worth trying, the best split."""
    group = rules.group
    long = state.select(quoted(group), "node", "n", "s", "q", "centre", "root_risk", F.expr("posexplode(x) as (feature, value)"))
    counts = materialise(long.groupBy(quoted(group), "node", "feature", "value").agg(*[F.expr(e) for e in (
        "sum(n) as n", "sum(s) as s", "sum(q) as q", "max(centre) as centre", "max(root_risk) as root_risk")]))
    keys = [group, "node", "feature"]
    totals = running_totals(counts, keys, ["n", "s", "q"], small=fits_one_task(counts, keys, task_rows))
    # `_upto` is the side below the cut, the rest of `_all` the side above it.
    split = totals.selectExpr(
        "*", "q_all - s_all * s_all / n_all as risk",
        "s_upto * s_upto / n_upto + try_divide((s_all - s_upto) * (s_all - s_upto), n_all - n_upto) "
        "- s_all * s_all / n_all as gain")
    scored = split.selectExpr("*", f"round(try_divide(gain, root_risk), {SCORE_DIGITS}) as score")
    allowed = (f"length(bin(node)) <= {rules.max_depth} and next_value is not null and n_all >= {rules.min_split} "
               f"and n_upto >= {rules.min_bucket} and n_all - n_upto >= {rules.min_bucket} "
               f"and risk > cast({rules.cp!r} as double) * root_risk and score > 0")
    best = (f"max(case when {allowed} then named_struct('score', score, 'early', -feature, 'low', -value, "
            "'cut', (value + next_value) / 2, 'gain', gain) end) as best")
    nodes = scored.groupBy(quoted(group), "node").agg(*[F.expr(e) for e in (
        "max(n_all) as n", "max(centre + s_all / n_all) as mean", "max(risk) as risk",
        "max(root_risk) as root_risk", best)])
    return nodes.selectExpr(f"`{group}`", "node", "n", "mean", "risk", "root_risk", "-best.early as feature",
                            "best.cut as cut", "best.gain as gain")


def _descend(state: DataFrame, splits: DataFrame, group: str) -> DataFrame:
    """Tuples of split nodes, moved to the child they fall in."""
    moved = state.join(splits, [group, "node"])
    right = (F.get("x", F.col("feature")) >= F.col("cut")).cast("long")
    return moved.withColumn("node", F.col("node") * 2 + right).drop("feature", "cut")


def _pruned(nodes: DataFrame, group: str, cp: float) -> DataFrame:
    """Smallest subtree that minimises squared error plus `cp` times the root's error per leaf.

    A split needs more than `cp` of the root's error, so a level has at most 1 / `cp` of them and a tree fits one array.
    Its nodes are folded in post-order with a stack of the costs of subtrees: a leaf puts its cost on the stack, a split
    replaces its children's by their sum or, if that is no less, by its own cost as a leaf; then it is an end.
    """
    weak = nodes.filter(F.col("feature").isNotNull() & (F.col("gain") <= cp * F.col("root_risk"))).select(group).distinct()
    trees = materialise(nodes.join(weak, group, "left_semi").groupBy(group).agg(F.array_sort(F.collect_list(F.struct(
        # A node's path from the root with a last digit that sorts after both children's.
        F.concat(F.expr("substring(bin(node), 2)"), F.lit("2")).alias("path"), F.col("node"),
        (F.col("risk") + cp * F.col("root_risk")).alias("as_leaf"), F.col("feature").isNotNull().alias("is_split")))).alias("tree")))
    if not row_count(trees):
        return nodes
    below = "(element_at(a.stack, -1) + element_at(a.stack, -2))"
    rest = "slice(a.stack, 1, size(a.stack) - 2)"
    fold = ("aggregate(tree, named_struct('stack', cast(array() as array<double>), 'ends', cast(array() as array<bigint>)), "
            "(a, t) -> case when not t.is_split then named_struct('stack', array_append(a.stack, t.as_leaf), 'ends', a.ends) "
            f"when {below} >= t.as_leaf then named_struct('stack', array_append({rest}, t.as_leaf), 'ends', array_append(a.ends, t.node)) "
            f"else named_struct('stack', array_append({rest}, {below}), 'ends', a.ends) end, a -> a.ends)")
    ends = materialise(trees.selectExpr(f"`{group}`", f"explode({fold}) as node"))
    # Nodes under an end go, the end becomes a leaf.
    above = (nodes.select(group, F.col("node").alias("under"), F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("up"))
             .select(group, "under", "up", F.expr("shiftright(under, up)").alias("node")))
    reached = (above.join(broadcast_if_small(ends), [group, "node"], "left_semi").groupBy(group, F.col("under").alias("node"))
               .agg(F.max("up").alias("__up")))
    marked = nodes.join(broadcast_if_small(reached, rows=row_count(nodes)), [group, "node"], "left").filter("coalesce(__up, 0) = 0")
    return marked.withColumns({c: F.when(F.col("__up").isNull(), F.col(c)) for c in ("feature", "cut", "gain")}).drop("__up")


def predict_trees(rows: DataFrame, model: TreeModel, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Add `prediction`, the mean of the leaf each row falls in; rows of unknown groups are dropped."""
    group = model.group
    position = F.lit(None).cast("int")
    for i, f in enumerate(model.features):
        position = F.when(F.col("feature") == f, F.lit(i)).otherwise(position)
    nodes = model.nodes.select(group, "node", "depth", "mean", position.alias("at"), "cut")
    x = F.array(*[F.col(f).cast("double") for f in model.features])
    state = rows.withColumn("__x", x)
    largest = nodes.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    if largest <= tree_nodes:
        return _walk_in_row(state, nodes, group, model.depth, largest).drop("__x")
    return _walk_by_level(state, nodes, group).drop("__x")


def _walk_in_row(state: DataFrame, nodes: DataFrame, group: str, depth: int, largest: int) -> DataFrame:
    """Send each group's whole tree as an array with child positions; a row follows it in one expression."""
    placed = nodes.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("node")) - 1)
    left_child = placed.filter(F.col("node") % 2 == 0).select(
        group, F.shiftright("node", 1).alias("node"), F.col("place").alias("left"))
    right_child = placed.filter((F.col("node") % 2 == 1) & (F.col("node") > 1)).select(
        group, F.shiftright("node", 1).alias("node"), F.col("place").alias("right"))
    linked = placed.join(left_child, [group, "node"], "left").join(right_child, [group, "node"], "left")
    trees = materialise(linked.groupBy(group).agg(F.array_sort(F.collect_list(
        F.struct("place", "at", "cut", "left", "right", "mean"))).alias("__tree")))
    tree_bytes = row_count(trees) * largest * 48
    sent = F.broadcast(trees) if tree_bytes <= BROADCAST_BYTES else trees

    def step(at: Column, _: Column) -> Column:
        node = F.get("__tree", at)
        down = F.when(F.get("__x", node["at"]) >= node["cut"], node["right"]).otherwise(node["left"])
        return F.when(node["at"].isNull(), at).otherwise(down)

    leaf = F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step)
    return (state.join(sent, group).withColumn("prediction", F.get("__tree", leaf)["mean"]).drop("__tree"))


def _walk_by_level(state: DataFrame, nodes: DataFrame, group: str) -> DataFrame:
    """Move all rows down one level at a time with a join per level."""
    steps = materialise(nodes.select(group, "depth", F.col("node").alias("__node"), F.col("mean").alias("__mean"),
                                     F.col("at").alias("__at"), F.col("cut").alias("__cut")))
    sizes = dict(steps.groupBy("depth").count().collect())
    state = state.withColumns({"__node": F.lit(1).cast("long"), "prediction": F.lit(None).cast("double")})
    for depth in sorted(sizes):
        step = broadcast_if_small(steps.filter(F.col("depth") == depth).drop("depth"), rows=sizes[depth])
        state = state.join(step, [group, "__node"], "inner" if depth == 0 else "left")
        child = F.col("__node") * 2 + (F.get("__x", F.col("__at")) >= F.col("__cut")).cast("long")
        state = materialise(state.withColumns({
            "prediction": F.coalesce("__mean", "prediction"), "__node": child}).drop("__mean", "__at", "__cut"))
    return state.drop("__node")


def importance_rows(model: TreeModel) -> DataFrame:
    """Squared error removed by each feature's splits (group, variable, value); unused ones are absent."""
    used = model.nodes.filter(F.col("feature").isNotNull())
    return used.groupBy(model.group, F.col("feature").alias("variable")).agg(F.sum("gain").alias("value"))
