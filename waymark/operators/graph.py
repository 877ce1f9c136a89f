"""Reachability, routes and counts of trails over an edge table (src, dst).

`src` needs `dst`: what a node needs is reached along edges, what it closes off
against them. Loops run level by level on DataFrames: each level is a join of
the frontier with the edges, and a written table cuts its lineage. Only pairs
that are new go on, so loops end on cyclic edges too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.sources.shared import discard, is_empty, materialize

MAX_DEPTH = 64


def reversed_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def closure(edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """All pairs (src, dst) with a path, and the length `depth` of the shortest."""
    edges = materialize(edges.select("src", "dst").distinct())
    frontier = edges.withColumn("depth", F.lit(1))
    seen = frontier
    step = edges.select(F.col("src").alias("dst"), F.col("dst").alias("next"))
    for depth in range(2, max_depth + 1):
        grown = frontier.join(step, "dst").select("src", F.col("next").alias("dst")).distinct()
        frontier = materialize(grown.join(seen, ["src", "dst"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
    raise RuntimeError(f"paths are longer than {max_depth}")


def reach(edges: DataFrame, start: DataFrame, max_depth: int = MAX_DEPTH, stop: bool = False) -> DataFrame:
    """Nodes reached from those in start (node), with the least depth. stop: end at max_depth without complaint."""
    edges = materialize(edges.select("src", "dst"))
    frontier = materialize(start.select("node").distinct())
    found = frontier.withColumn("depth", F.lit(0))
    for depth in range(1, max_depth + 1):
        grown = edges.join(frontier, edges.src == frontier.node, "left_semi").select(F.col("dst").alias("node")).distinct()
        new = materialize(grown.join(found, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if new.isEmpty():
            return found.where("depth > 0")
        found, frontier = found.unionByName(new), new.select("node")
    if stop:
        return found.where("depth > 0")
    raise RuntimeError(f"paths are longer than {max_depth}")


def reached_pairs(edges: DataFrame, start: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, at): what each node of start (node) reaches. Nothing is broadcast, so the driver gets no more from larger tables."""
    edges = materialize(edges.select("src", "dst").distinct(), broadcast=False)
    into = edges.select(F.col("src").alias("at"), F.col("dst").alias("next"))
    last = materialize(start.select("node", F.col("node").alias("at")).distinct(), broadcast=False)
    seen = None
    for _ in range(max_depth + 1):
        grown = last.join(into, "at").select("node", F.col("next").alias("at")).distinct()
        last = materialize(grown if seen is None else grown.join(seen, ["node", "at"], "left_anti"), broadcast=False)
        if last.isEmpty():
            return last if seen is None else seen
        seen = last if seen is None else seen.unionByName(last)
    raise RuntimeError(f"paths are longer than {max_depth}")


def one(edges: DataFrame, node: int) -> DataFrame:
    return edges.sparkSession.createDataFrame([(node,)], "node long")


def descendants(edges: DataFrame, node: int, **kw) -> DataFrame:
    """What a node needs, at any depth."""
    return reach(edges, one(edges, node), **kw)


def ancestors(edges: DataFrame, node: int, **kw) -> DataFrame:
    """What a node closes off, at any depth."""
    return reach(reversed_edges(edges), one(edges, node), **kw)


def trails(edges: DataFrame, node: int, max_depth: int) -> DataFrame:
    """Every trail of at most max_depth edges out of a node: its end, its nodes and its length. For a DAG or a small bound."""
    edges = materialize(edges.select("src", "dst"))
    level = one(edges, node).select("node", F.array("node").alias("route"), F.lit(0).alias("depth"))
    out = None
    for depth in range(1, max_depth + 1):
        level = level.join(edges, level.node == edges.src).where(~F.array_contains("route", F.col("dst"))).select(F.col("dst").alias("node"), F.concat("route", F.array("dst")).alias("route"), F.lit(depth).alias("depth"))
        level = materialize(level)
        out = level if out is None else out.unionByName(level)
    return out


def route(edges: DataFrame, start: int, end: int, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The shortest route as (route, depth); of equal ones the least in node order. Empty without one."""
    edges = materialize(edges.select("src", "dst").distinct())
    frontier = one(edges, start).select("node", F.array("node").alias("route"))
    seen = frontier.select("node")
    for depth in range(1, max_depth + 1):
        grown = frontier.join(edges, frontier.node == edges.src).groupBy(F.col("dst").alias("node")).agg(F.min(F.concat("route", F.array("dst"))).alias("route"))
        frontier = materialize(grown.join(seen, "node", "left_anti"))
        hit = frontier.where(F.col("node") == end)
        if not hit.isEmpty():
            return hit.select("route", F.lit(depth).alias("depth"))
        if frontier.isEmpty():
            return frontier.limit(0).select("route", F.lit(0).alias("depth"))
        seen = seen.union(frontier.select("node"))
    raise RuntimeError(f"paths are longer than {max_depth}")


def fold(edges: DataFrame, own: DataFrame, leaf: dict[str, Column], send: dict[str, Column], merge: dict[str, Callable[[str], Column]], keep: dict[str, Column] | None = None, by: tuple[str, ...] = (), max_depth: int = MAX_DEPTH) -> DataFrame:
    """Values of every node of a DAG from those of its targets: (*by, node, depth, values), depth being the longest trail out of the node.

    own (*by, node, ...): columns of each node that leaf and keep may use. A node
    without targets has the values `leaf`. A node that is done sends `send` along
    its in-edges, once for each edge; `merge` combines what arrives, also what was
    combined before, and once all targets have sent, `keep` makes the node's value
    of it. Only nodes that wait are written again. Refuses cyclic edges.
    """
    keys, keep = [*by, "node"], {n: F.col(n) for n in leaf} | (keep or {})
    edges = materialize(edges.select(*by, "src", "dst").distinct())
    waits = materialize(edges.groupBy(*by, F.col("src").alias("node")).agg(F.count("*").alias("targets")).join(own, keys))
    ends = edges.select(*by, F.col("dst").alias("node")).distinct().join(waits, keys, "left_anti")
    last = materialize(ends.join(own, keys).select(*keys, F.lit(0).alias("depth"), *(c.alias(n) for n, c in leaf.items())))
    done, waiting = last, None
    into = edges.select(*by, F.col("src").alias("to"), F.col("dst").alias("node"))
    for depth in range(1, max_depth + 2):
        sent = into.join(last, keys).select(*by, F.col("to").alias("node"), F.lit(1).cast("long").alias("got"), *(send.get(n, F.col(n)).alias(n) for n in leaf))
        if waiting is not None:
            sent = sent.unionByName(waiting)
        old = waiting
        merged = sent.groupBy(*keys).agg(F.sum("got").alias("got"), *(merge[n](n).alias(n) for n in leaf))
        step = materialize(merged.join(waits, keys).withColumn("ready", F.col("got") == F.col("targets")), "ready")
        last = step.where("ready").select(*keys, F.lit(depth).alias("depth"), *(keep[n].alias(n) for n in leaf))
        waiting = step.where("not ready").select(*keys, "got", *leaf)
        waiting.waymark_path = step.waymark_path
        if old is not None:
            discard(old, "ready=false")
        if last.isEmpty():
            if not waiting.isEmpty() or not is_empty(waits.join(done, keys, "left_anti")):
                raise RuntimeError("the edges have a cycle")
            return done
        if depth > max_depth:
            raise RuntimeError(f"a trail is longer than {max_depth}")
        done = done.unionByName(last)


def _counted(edges: DataFrame, max_depth: int) -> DataFrame:
    """edges (way, src, dst): (way, node, depth, n), the longest trail out of each node and the number of trails."""
    own = edges.select("way", F.col("src").alias("node")).union(edges.select("way", "dst")).distinct()
    n = F.lit(0).cast("decimal(38,0)")
    return fold(edges, own, {"n": n}, {"n": (1 + F.col("n")).cast("decimal(38,0)")}, {"n": lambda c: F.sum(c).cast("decimal(38,0)")}, by=("way",), max_depth=max_depth)


def levels(edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, depth): the longest trail that starts at each node of a DAG. Refuses cyclic edges."""
    return _counted(edges.withColumn("way", F.lit(0)), max_depth).select("node", "depth")


def path_counts(edges: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(node, ins, outs): trails of one edge or more that end at a node and that start at it, in a DAG.

    Counts are summed level by level, in both directions at once; no trail is listed.
    """
    both = edges.select(F.lit(0).alias("way"), "src", "dst").union(reversed_edges(edges).select(F.lit(1), "src", "dst"))
    done = _counted(both, max_depth)
    return done.groupBy("node").agg(F.max(F.when(F.col("way") == 1, F.col("n"))).alias("ins"), F.max(F.when(F.col("way") == 0, F.col("n"))).alias("outs"))


def trails_into(edges: DataFrame, node: int) -> DataFrame:
    """One row: the number of trails that end at a node of a DAG."""
    return path_counts(edges).where(F.col("node") == node).select(F.col("ins").cast("long").alias("trails"))


def core(edges: DataFrame, max_rounds: int = MAX_DEPTH) -> DataFrame:
    """The edges that are left when nodes without a source or without a target go, again and again: those of cycles and between them."""
    edges = materialize(edges.select("src", "dst").distinct())
    n = edges.count()
    for _ in range(max_rounds):
        starts, ends = edges.select("src").distinct(), edges.select("dst").distinct()
        less = edges.join(ends.select(F.col("dst").alias("src")), "src", "left_semi").join(starts.select(F.col("src").alias("dst")), "dst", "left_semi")
        edges, old = materialize(less.select("src", "dst")), edges
        discard(old)
        m = edges.count()
        if m == n:
            break
        n = m
    return edges


def on_cycles(edges: DataFrame) -> DataFrame:
    """Nodes that reach themselves, with the length of their shortest cycle. Pairs are followed on the core only."""
    return closure(core(edges)).where("src = dst").select(F.col("src").alias("node"), "depth")


def degrees(edges: DataFrame) -> DataFrame:
    """(node, n_in, n_out, degree) over distinct edges."""
    e = edges.select("src", "dst").distinct()
    ends = e.select(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")).union(e.select("dst", F.lit(1), F.lit(0)))
    return ends.groupBy("node").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), F.count("*").alias("degree"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node that is reachable when edges count both ways.

    Nodes hang on the least node around them; every round also takes the
    component of one's component, so that long chains settle in few rounds.
    """
    both = materialize(edges.select("src", "dst").union(reversed_edges(edges)).distinct())
    now = materialize(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("component")))
    for _ in range(max_rounds):
        near = both.join(now.select(F.col("node").alias("dst"), "component"), "dst").select(F.col("src").alias("node"), "component")
        least = near.union(now).groupBy("node").agg(F.min("component").alias("component"))
        jump = now.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = materialize(least.join(jump, "component", "left").select("node", F.least("component", F.coalesce("further", "component")).alias("component")))
        changed = is_empty(new.join(now.withColumnRenamed("component", "old"), "node").where("component <> old"))
        discard(now)
        now = new
        if changed:
            return now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def pair_counts(edges: DataFrame) -> DataFrame:
    """(src, dst, n): trails between each pair of a DAG, summed along the closure level by level."""
    edges = materialize(edges.select("src", "dst").distinct())
    deep = levels(edges)
    top = deep.agg(F.max("depth")).first()[0] or 0
    counts = None
    for depth in range(1, top + 1):
        here = edges.join(deep.where(F.col("depth") == depth).select(F.col("node").alias("src")), "src", "left_semi")
        more = here.select("src", "dst", F.lit(1).cast("decimal(38,0)").alias("n"))
        if counts is not None:
            via = counts.select(F.col("src").alias("mid"), F.col("dst").alias("end"), "n")
            more = more.union(here.join(via, here.dst == via.mid).select("src", F.col("end").alias("dst"), "n"))
        own = materialize(more.groupBy("src", "dst").agg(F.sum("n").cast("decimal(38,0)").alias("n")))
        counts = own if counts is None else counts.unionByName(own)
    return edges.withColumn("n", F.lit(1).cast("decimal(38,0)")).limit(0) if counts is None else counts


def set_cover(members: DataFrame, k: int, tally: list | None = None) -> DataFrame:
    """Greedy cover: (step, set_id, covered), at most k sets of members (set_id, item); ties go to the least set_id.

    What a set adds can only shrink, so its count of an earlier step is a bound.
    In each step only the sets whose bound is the greatest are counted again,
    until the best count reaches the bound of every other set. tally, if given,
    takes how many sets each step counted.
    """
    members = materialize(members.select("set_id", "item").distinct())
    bounds = materialize(members.groupBy("set_id").agg(F.count("*").alias("bound")))
    kind, steps, taken = members.schema["set_id"].dataType.simpleString(), [], None
    for step in range(1, k + 1):
        best, fresh = None, []  # best: (-count, set_id)
        while True:
            left = bounds.where(~F.col("set_id").isin(fresh)) if fresh else bounds
            top = left.orderBy(F.desc("bound"), "set_id").limit(LAZY).collect()
            if top and taken is None:  # nothing is covered yet: bounds are counts
                best = (-top[0].bound, top[0].set_id)
                break
            if not top or best is not None and (-top[0].bound, top[0].set_id) >= best:
                break
            ids = [r.set_id for r in top]
            own = members.where(F.col("set_id").isin(ids)).join(taken, "item", "left_anti").groupBy("set_id").agg(F.count("*").alias("n")).collect()
            counts = dict.fromkeys(ids, 0) | {r.set_id: r.n for r in own}
            fresh += ids
            lower = members.sparkSession.createDataFrame(list(counts.items()), f"set_id {kind}, now long")
            bounds, old = materialize(bounds.join(F.broadcast(lower), "set_id", "left").select("set_id", F.coalesce("now", "bound").alias("bound"))), bounds  # LAZY rows
            discard(old)
            best = min(x for x in (best, *((-n, i) for i, n in counts.items())) if x is not None)
        if tally is not None:
            tally.append(len(fresh))
        if best is None or not best[0]:
            break
        steps.append((step, best[1], -best[0]))
        new = members.where(F.col("set_id") == best[1]).select("item")
        taken = materialize(new if taken is None else taken.union(new).distinct())
    return members.sparkSession.createDataFrame(steps, f"step int, set_id {kind}, covered long")


#: Sets that are counted again at once.
LAZY = 8


#: Members of a class in one row, and sources of a target that meet in one task's group.
BLOCK, GROUP = 512, 2048


def _classes(edges: DataFrame, first: int | None = None) -> DataFrame:
    """(targets, sizes, members): the sources with the same targets, in rows of about BLOCK; targets come rarest first, sizes are their numbers of sources.

    first: only so many sources of each class, the least ones, in one row.
    """
    e = edges.select("src", "dst").dropna().distinct()
    counted = e.join(e.groupBy("dst").agg(F.count("*").alias("n")), "dst")
    sets = counted.groupBy("src").agg(F.sort_array(F.collect_list(F.struct("n", "dst"))).alias("t")).select("src", F.col("t.dst").alias("targets"), F.col("t.n").alias("sizes"))
    if first is not None:
        alike = Window.partitionBy("targets").orderBy("src")
        return sets.withColumn("k", F.row_number().over(alike)).where(F.col("k") <= first).groupBy("targets").agg(F.first("sizes").alias("sizes"), F.collect_list("src").alias("members"))
    blocks = sets.join(sets.groupBy("targets").agg(F.count("*").alias("many")), "targets").withColumn("block", F.pmod(F.xxhash64("src"), F.ceil(F.col("many") / BLOCK)))
    return blocks.groupBy("targets", "block").agg(F.first("sizes").alias("sizes"), F.collect_list("src").alias("members")).drop("block")


def _shared(classes: DataFrame, least: int = 1) -> DataFrame:
    """(xs, ys, alone, shared): once each, the pairs of rows of classes whose sources share `least` targets or more; alone: a row with itself.

    Two such sets meet in the rarest target they share, which is among all but the
    last least - 1 of both; no other meeting counts, so pairs need no grouping.
    Their join never broadcasts: a written class is small, its meetings are not.
    """
    prefix = F.size("targets") - least + 1
    met = classes.where(prefix > 0).select("targets", "members", F.array_min("members").alias("id"), F.explode(F.arrays_zip(F.slice("targets", F.lit(1), prefix).alias("dst"), F.slice("sizes", F.lit(1), prefix).alias("n"))).alias("at"))
    parts = F.ceil(F.col("at.n") / GROUP)
    x = met.select(F.col("at.dst").alias("dst"), F.pmod(F.xxhash64("id"), parts).alias("part"), F.col("id").alias("x"), F.col("targets").alias("xt"), F.col("members").alias("xs"))
    y = met.select(F.col("at.dst").alias("dst"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.col("id").alias("y"), F.col("targets").alias("yt"), F.col("members").alias("ys"))
    both = x.join(y.hint("merge"), ["dst", "part"]).where("x <= y").withColumn("common", F.array_intersect("xt", "yt"))
    return both.where((F.get("common", F.lit(0)) == F.col("dst")) & (F.size("common") >= least)).select("xs", "ys", (F.col("x") == F.col("y")).alias("alone"), F.size("common").cast("long").alias("shared"))


def _expanded(pairs: DataFrame) -> DataFrame:
    each = pairs.select("alone", "shared", "ys", F.explode("xs").alias("p")).select("alone", "shared", "p", F.explode("ys").alias("q")).where("not alone or p < q")
    return each.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "shared")


def shared_neighbours(edges: DataFrame, max_degree: int | None = None) -> DataFrame:
    """(a, b, shared): pairs a < b of sources with a common target. max_degree, if given, leaves out targets of more sources; None keeps all.

    Sources with the same targets are compared once, and pairs are written out
    where their classes meet, so none is shuffled.
    """
    e = edges.select("src", "dst").distinct()
    if max_degree is not None:
        e = e.join(e.groupBy("dst").count().where(F.col("count") <= max_degree), "dst", "left_semi")
    return _expanded(_shared(materialize(_classes(e))))


def most_shared(edges: DataFrame, k: int) -> DataFrame:
    """The k rows of `shared_neighbours` that share most, ties by a and b, without forming the others.

    Only pairs that share `least` targets are formed; least starts as high as k
    pairs can reach and is lowered until there are k. Of a class only the first
    k + 1 sources can be in such a pair: a further one has k others before it.
    """
    classes = materialize(_classes(edges, k + 1))
    few = next(m for m in range(2, k + 2) if m * (m - 1) // 2 >= k)
    top = classes.select(F.size("targets").alias("n"), F.explode("members")).orderBy(F.desc("n")).limit(few).collect()
    least, step = max(1, top[-1].n if top else 1), 1
    while True:
        pairs = materialize(_shared(classes, least))
        many = F.when(F.col("alone"), F.size("xs") * (F.size("xs") - 1) / 2).otherwise(F.size("xs") * F.size("ys"))
        if least == 1 or (pairs.agg(F.sum(many)).first()[0] or 0) >= k:
            return _expanded(pairs).orderBy(F.desc("shared"), "a", "b").limit(k)
        discard(pairs)
        least, step = max(1, least - step), 2 * step
