"""Structure of a directed graph (src, dst): strong components, condensation, dominators, sketched reach sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators.graph import MAX_DEPTH, fold, levels, reached_pairs, reversed_edges
from waymark.sources.shared import discard, materialize

# ---- strong components


def _trimmed(edges: DataFrame, max_rounds: int) -> DataFrame:
    """The edges between nodes that have edges in and out, again and again: those outside lie on no cycle."""
    n = edges.count()
    for _ in range(max_rounds):
        less = edges.join(edges.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(edges.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
        edges, old = materialize(less.select("src", "dst")), edges
        discard(old)
        m = edges.count()
        if m == n:
            return edges
        n = m
    raise RuntimeError(f"trimming did not settle in {max_rounds} rounds")


def _coloured(edges: DataFrame, max_rounds: int) -> DataFrame:
    """(node, colour): the least node that reaches each node, itself included. Only nodes whose colour has just changed pass it on."""
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    now = materialize(nodes.select("node", F.col("node").alias("colour"), F.lit(True).alias("fresh")))
    for _ in range(max_rounds):
        told = edges.join(now.where("fresh").select(F.col("node").alias("src"), "colour"), "src").groupBy(F.col("dst").alias("node")).agg(F.min("colour").alias("told"))
        new = now.join(told, "node", "left")
        less = F.coalesce(F.col("told") < F.col("colour"), F.lit(False))
        now, old = materialize(new.select("node", F.when(less, F.col("told")).otherwise(F.col("colour")).alias("colour"), less.alias("fresh"))), now
        discard(old)
        if now.where("fresh").isEmpty():
            return now.select("node", "colour")
    raise RuntimeError(f"colours did not settle in {max_rounds} rounds")


def _back_from_roots(edges: DataFrame, colours: DataFrame, max_rounds: int) -> DataFrame:
    """(node, component): nodes that reach the root of their colour within it."""
    c = lambda end, name: colours.select(F.col("node").alias(end), F.col("colour").alias(name))
    inside = materialize(edges.join(c("src", "a"), "src").join(c("dst", "b"), "dst").where("a = b").select("src", "dst"))
    last = found = colours.where("node = colour").select("node", F.col("colour").alias("component"))
    for _ in range(max_rounds):
        more = inside.join(last.select(F.col("node").alias("dst"), "component"), "dst").select(F.col("src").alias("node"), "component").distinct()
        last = materialize(more.join(found, "node", "left_anti"))
        if last.isEmpty():
            return found
        found = found.unionByName(last)
    raise RuntimeError(f"paths are longer than {max_rounds}")


def strong_components(edges: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """(node, component): the least node of those that each node reaches and is reached by, itself included, for every node with an edge.

    Nodes without edges in or out are trimmed, again and again. Of the rest, each
    takes the least node that reaches it as its colour; the nodes of a colour that
    reach its root are a component, and leave. Edges between colours join no
    component and go too. A round settles a component for each colour at least.
    """
    all_edges = materialize(edges.select("src", "dst").distinct())
    nodes = all_edges.select(F.col("src").alias("node")).union(all_edges.select("dst")).distinct()
    left, found = materialize(all_edges.where("src <> dst")), None
    for _ in range(max_rounds):
        left = _trimmed(left, max_rounds)
        if left.isEmpty():
            break
        colours = materialize(_coloured(left, max_rounds))
        own = materialize(_back_from_roots(left, colours, max_rounds))
        found = own if found is None else found.unionByName(own)
        c = lambda end, name: colours.join(own, "node", "left_anti").select(F.col("node").alias(end), F.col("colour").alias(name))
        left, old = materialize(left.join(c("src", "a"), "src").join(c("dst", "b"), "dst").where("a = b").select("src", "dst")), left
        discard(old)
        discard(colours)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if found is None:
        return nodes.select("node", F.col("node").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def condensed(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(src, dst): edges between different components, once each: a DAG of components, each named by its least node."""
    c = lambda end: components.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))
    return edges.select("src", "dst").join(c("src"), "src").join(c("dst"), "dst").where("c_src <> c_dst").select(F.col("c_src").alias("src"), F.col("c_dst").alias("dst")).distinct()


# ---- dominators


def dominator_paths(edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(src, dst, path): for each pair of a DAG with a trail, the nodes that are on every trail, in order; the last but one is the immediate dominator.

    Nodes come level by level, behind all that have an edge to them. The path of a
    node is what the paths of its predecessors, seen from the same source, have in
    common, and the node: the common beginning of a group of arrays is that of its
    least and its greatest.
    """
    edges = materialize(edges.select("src", "dst").distinct())
    deep = materialize(levels(reversed_edges(edges), max_depth).where("depth > 0").select(F.col("node").alias("dst"), "depth"))
    top = deep.agg(F.max("depth")).first()[0] or 0
    done = None
    for depth in range(1, top + 1):
        here = edges.join(deep.where(F.col("depth") == depth).select("dst"), "dst", "left_semi").select(F.col("src").alias("mid"), F.col("dst").alias("node"))
        paths = here.select(F.col("mid").alias("src"), "node", F.array("mid").alias("path"))
        if done is not None:
            paths = paths.union(done.join(here, done.dst == here.mid).select("src", "node", "path"))
        ends = paths.groupBy("src", "node").agg(F.min("path").alias("a"), F.max("path").alias("b"))
        # both begin alike up to the first place where they differ
        differ = F.filter(F.sequence(F.lit(1), F.least(F.size("a"), F.size("b"))), lambda i: F.element_at("a", i) != F.element_at("b", i))
        common = F.when(F.size(differ) == 0, F.least(F.size("a"), F.size("b"))).otherwise(F.get(differ, F.lit(0)) - 1)
        own = materialize(ends.select("src", F.col("node").alias("dst"), F.concat(F.slice("a", F.lit(1), common), F.array("node")).alias("path")))
        done = own if done is None else done.unionByName(own)
    return edges.select("src", "dst", F.array("src", "dst").alias("path")).limit(0) if done is None else done


def essential(edges: DataFrame) -> DataFrame:
    """(node, pairs): for inner nodes of a DAG, the pairs (a, b) whose every trail runs through the node: b's dominators seen from a, without the ends."""
    inner = F.slice("path", F.lit(2), F.size("path") - 2)
    return dominator_paths(edges).select(F.explode(inner).alias("node")).groupBy("node").agg(F.count("*").alias("pairs"))


# ---- sketched reach sizes

#: Size of a sketch (log2 of its counters) and its relative standard error; an estimate is off by more than SIGMAS of them once in 10^9.
LG_K, SIGMAS = 12, 6
ERROR = 1.04 / (1 << LG_K) ** 0.5


def reach_sketches(edges: DataFrame, weight: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, estimate): about how many nodes each node of a DAG reaches, from sketches that are merged along the levels; no pair is listed.

    weight (node): only these nodes are counted.
    """
    edges = materialize(edges.select("src", "dst").distinct())
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    counted = nodes if weight is None else nodes.join(weight.select("node").distinct(), "node", "left_semi")
    single = counted.groupBy("node").agg(F.hll_sketch_agg("node", LG_K).alias("self"))
    own = materialize(nodes.join(single, "node", "left"))
    values = fold(edges, own, {"reach": F.lit(None).cast("binary"), "all": F.col("self")}, {"reach": F.col("all"), "all": F.col("all")}, {n: lambda c: F.hll_union_agg(c) for n in ("reach", "all")},
                  {"reach": F.col("reach"), "all": F.when(F.col("self").isNull(), F.col("all")).otherwise(F.hll_union("all", F.coalesce("self", "all")))}, max_depth=max_depth)
    return values.select("node", F.coalesce(F.hll_sketch_estimate("reach"), F.lit(0)).alias("estimate"))


def most_reaching(edges: DataFrame, k: int, weight: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, n): the k nodes of a DAG that reach most nodes, ties by node; weight (node): only these count. Nodes that reach none are left out.

    Estimates with their error leave a few candidates, and only those are followed.
    """
    edges = materialize(edges.select("src", "dst").distinct())
    about = materialize(reach_sketches(edges, weight, max_depth).where("estimate > 0"))
    low, high = F.floor(F.col("estimate") * (1 - SIGMAS * ERROR)) - 1, F.ceil(F.col("estimate") * (1 + SIGMAS * ERROR)) + 1
    bar = about.select(low.alias("low")).orderBy(F.desc("low")).limit(k).agg(F.min("low").alias("bar"))  # one row
    chosen = materialize(about.crossJoin(F.broadcast(bar)).where(high >= F.col("bar")).select("node"))
    found = reach_counts(edges, chosen, weight, max_depth)
    discard(about)
    return found.orderBy(F.desc("n"), "node").limit(k)


def reach_counts(edges: DataFrame, start: DataFrame, weight: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, n): how many nodes each node of start (node) reaches, exactly; weight (node): only these count."""
    seen = reached_pairs(edges, start, max_depth)
    own = seen if weight is None else seen.join(weight.select(F.col("node").alias("at")).distinct(), "at", "left_semi")
    return own.groupBy("node").agg(F.count("*").alias("n"))
