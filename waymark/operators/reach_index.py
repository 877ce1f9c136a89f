"""A stored reachability index of a DAG: interval labels over several spanning forests.

In each forest every node hangs below one of its predecessors, and nodes are
numbered in the order of a walk through the trees. Two intervals follow. The
numbers below a node in its tree are reached from it for certain. And the least
and greatest numbers of all that a node reaches hold those of whatever it
reaches: where one interval is not within the other, or the longest way out of a
node is no shorter, there is no way. Pairs that the labels leave open are walked
from one of their ends.
"""

from __future__ import annotations

from collections.abc import Generator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.graph import MAX_DEPTH, fold
from waymark.operators.records import ranked
from waymark.sources.shared import discard, materialize

FORESTS = 3


def _forests(edges: DataFrame, forests: int) -> DataFrame:
    """(forest, node, path): the nodes from the root of the node's tree down to it; forests differ by the predecessors that nodes hang below, and by the order of siblings."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(forests - 1))).alias("forest")
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct().select("node", trees)
    pick = F.xxhash64("forest", "src", "dst")
    above = edges.select("src", "dst", trees).groupBy("forest", F.col("dst").alias("node")).agg(F.min_by("src", F.struct(pick, "src")).alias("above"))
    # each node knows the way from an ancestor, itself out; every round doubles it
    mark = F.when(F.col("forest") % 2 == 0, F.col("node")).otherwise(-F.col("node"))
    now = materialize(nodes.join(above, ["forest", "node"], "left").select("forest", "node", "above", F.array(mark).alias("path")))
    for _ in range(MAX_DEPTH.bit_length() + 1):
        if now.where("above is not null").isEmpty():
            return now.select("forest", "node", "path")
        up = now.select("forest", F.col("node").alias("above"), F.col("above").alias("further"), F.col("path").alias("before"))
        now, old = materialize(now.join(up, ["forest", "above"], "left").select("forest", "node", F.col("further").alias("above"), F.concat(F.coalesce("before", F.array().cast("array<long>")), "path").alias("path"))), now
        discard(old)
    raise RuntimeError(f"trees are deeper than {2 * MAX_DEPTH}")


class ReachIndex:
    """labels (node, depth; n, end, low, high: arrays of a value for each forest) and edges of a DAG, as stored tables.

    n: the node's number; end: the last number below it in its tree; low and
    high: the least and greatest number of what it reaches, itself included.
    """

    def __init__(self, spark: SparkSession, labels: DataFrame, edges: DataFrame, forests: int) -> None:
        self.spark, self.labels, self.edges, self.forests = spark, labels, edges, forests

    @classmethod
    def build(cls, edges: DataFrame, forests: int = FORESTS, max_depth: int = MAX_DEPTH) -> ReachIndex:
        edges = materialize(edges.select("src", "dst").distinct())
        paths = _forests(edges, forests)
        numbered = materialize(ranked(paths, "forest", "path").select("forest", "node", F.col("rank").alias("n")))
        below = paths.select("forest", F.explode("path").alias("mark")).groupBy("forest", "mark").agg(F.count("*").alias("size")).select("forest", F.abs("mark").alias("node"), "size")
        both = numbered.join(below, ["forest", "node"])
        own = both.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("forest", "n", (F.col("n") + F.col("size") - 1).alias("end")))).alias("t")).select("node", F.col("t.n").alias("n"), F.col("t.end").alias("end"))  # a row for each forest
        own = materialize(own)
        lows, highs = [f"low{t}" for t in range(forests)], [f"high{t}" for t in range(forests)]
        n = {c: F.col("n")[int(c.lstrip("lowhig"))] for c in lows + highs}
        spans = fold(edges, own, n, {}, {c: F.min if c in lows else F.max for c in n}, {c: (F.least if c in lows else F.greatest)(F.col(c), n[c]) for c in n}, max_depth=max_depth)
        labels = own.join(spans, "node").select("node", "n", "end", F.array(*lows).alias("low"), F.array(*highs).alias("high"), "depth")
        return cls(edges.sparkSession, materialize(labels), edges, forests)

    def _every(self, test) -> Column:
        return reduce(lambda a, b: a & b, [test(t) for t in range(self.forests)])

    def _some(self, test) -> Column:
        return reduce(lambda a, b: a | b, [test(t) for t in range(self.forests)])

    def _struct(self, end: str, name: str) -> DataFrame:
        """(end, name): each node with its labels in one column."""
        return self.labels.select(F.col("node").alias(end), F.struct("n", "end", "low", "high", "depth").alias(name))

    def _verdict(self) -> Column:
        """Whether the node with the labels a reaches another with the labels b: true or false where they tell, null where they don't."""
        sure = self._some(lambda t: F.col("b.n")[t].between(F.col("a.n")[t], F.col("a.end")[t]))
        may = self._every(lambda t: (F.col("b.low")[t] >= F.col("a.low")[t]) & (F.col("b.high")[t] <= F.col("a.high")[t]))
        no = F.col("a").isNull() | F.col("b").isNull() | (F.col("b.depth") >= F.col("a.depth")) | ~may
        return F.when(no, F.lit(False)).when(sure, F.lit(True))

    def decided(self, pairs: DataFrame) -> DataFrame:
        """pairs (src, dst) with `reached`: true or false where labels tell, null where they don't. A node does not reach itself; unknown nodes reach nothing."""
        both = pairs.select("src", "dst").join(self._struct("src", "a"), "src", "left").join(self._struct("dst", "b"), "dst", "left")
        return both.select("src", "dst", self._verdict().alias("reached"))

    def told(self, sources: DataFrame) -> DataFrame:
        """(src, dst): the pairs out of sources (node) of which labels alone tell that there is a way: those below them in one of the trees."""
        spans = self.labels.join(sources.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("src"), F.posexplode(F.arrays_zip("n", "end")).alias("forest", "span")).where("span.end > span.n")
        below = spans.select("src", "forest", F.explode(F.sequence(F.col("span.n") + 1, F.col("span.end"))).alias("n"))
        at = self.labels.select(F.col("node").alias("dst"), F.posexplode("n").alias("forest", "n"))
        return self.decided(below.join(at, ["forest", "n"]).select("src", "dst").distinct()).where("reached").select("src", "dst")

    def reached(self, pairs: DataFrame) -> DataFrame:
        """pairs (src, dst) with `reached` true or false. Pairs that labels leave open are walked, from the side that has fewer rows to go on with, so about twice the work of the better side at most."""
        first = materialize(self.decided(pairs.distinct()))
        found, open_ = (first.where(c).select("src", "dst") for c in ("reached", "reached is null"))
        if not open_.isEmpty():
            sides = [self._down(open_), self._up(open_)]
            rows, ways = [next(side) for side in sides], None
            while ways is None:
                k = rows.index(min(rows))
                try:
                    rows[k] = next(sides[k])
                except StopIteration as end:
                    ways = end.value
            found = found.unionByName(ways)
        return pairs.join(found.withColumn("hit", F.lit(True)), ["src", "dst"], "left").select(*pairs.columns, F.coalesce("hit", F.lit(False)).alias("reached"))

    def _down(self, pairs: DataFrame) -> Generator[int, None, DataFrame]:
        """The pairs with a way, by steps from src along edges; yields the rows of the next step. Left out are nodes whose longest way out is shorter than that of all nodes sought."""
        depth = lambda end: self.labels.select(F.col("node").alias(end), "depth")
        last = materialize(pairs.join(depth("dst"), "dst").groupBy("src").agg(F.min("depth").alias("least")).select("src", "least", F.col("src").alias("at")), broadcast=False)
        into = seen = None
        while rows := last.count():  # ends, as labels are of a DAG
            yield rows
            if into is None:
                into = materialize(self.edges.join(depth("dst"), "dst").select(F.col("src").alias("at"), F.col("dst").alias("next"), "depth"), broadcast=False)
            grown = last.join(into, "at").where("depth >= least").select("src", "least", F.col("next").alias("at")).distinct()
            last = materialize(grown if seen is None else grown.join(seen, ["src", "at"], "left_anti"), broadcast=False)
            seen = last if seen is None else seen.unionByName(last)
        return pairs.join(seen.select("src", F.col("at").alias("dst")), ["src", "dst"], "left_semi")

    def _up(self, pairs: DataFrame) -> Generator[int, None, DataFrame]:
        """The pairs with a way, by steps from dst against edges; yields the rows of the next step.

        There is a way if src reaches a predecessor. Those that labels leave open are
        asked in turn, each once for a source, however many pairs lead to it; then
        what was found goes back along the edges asked.
        """
        last = seen = pairs.select("src", F.col("dst").alias("at"))
        asked, back, sources = [], None, None
        while rows := last.count():  # ends, as labels are of a DAG
            yield rows
            if back is None:
                back = materialize(self.edges.select(F.col("src").alias("before"), F.col("dst").alias("at")).join(self._struct("before", "b"), "before"), broadcast=False)
                sources = materialize(self._struct("src", "a").join(pairs.select("src").distinct(), "src", "left_semi"), broadcast=False)
            verdict = F.when(F.col("src") == F.col("before"), True).otherwise(self._verdict())
            asked.append(materialize(last.join(back, "at").join(sources, "src").select("src", "at", "before", verdict.alias("reached")).where("reached is null or reached"), broadcast=False))
            hit = asked[-1].where("reached").select("src", "at")  # those are followed no further
            open_ = asked[-1].where("reached is null").join(hit, ["src", "at"], "left_anti")
            last = materialize(open_.select("src", F.col("before").alias("at")).distinct().join(seen, ["src", "at"], "left_anti"), broadcast=False)
            seen = seen.unionByName(last)
        links = materialize(reduce(DataFrame.unionByName, asked), broadcast=False)
        last = hits = materialize(links.where("reached").select("src", "at").distinct(), broadcast=False)
        links = links.where("reached is null")
        while not last.isEmpty():
            told = links.join(last.select("src", F.col("at").alias("before")), ["src", "before"], "left_semi").select("src", "at").distinct()
            last = materialize(told.join(hits, ["src", "at"], "left_anti"), broadcast=False)
            hits = hits.unionByName(last)
        return pairs.join(hits.select("src", F.col("at").alias("dst")), ["src", "dst"], "left_semi")

    def descendants(self, node: int) -> DataFrame:
        """(node): what a node reaches."""
        return self._set(node, True)

    def ancestors(self, node: int) -> DataFrame:
        """(node): what reaches a node."""
        return self._set(node, False)

    def _set(self, node: int, down: bool) -> DataFrame:
        me = self.labels.where(F.col("node") == node).first()
        if me is None:
            return self.labels.select("node").limit(0)
        c = lambda name, t: F.col(name)[t]
        if down:
            may = self._every(lambda t: (c("low", t) >= me.low[t]) & (c("high", t) <= me.high[t]))
            sure = self._some(lambda t: c("n", t).between(me.n[t], me.end[t]))
        else:
            may = self._every(lambda t: (c("low", t) <= me.low[t]) & (c("high", t) >= me.high[t]))
            sure = self._some(lambda t: (c("n", t) <= me.n[t]) & (c("end", t) >= me.n[t]))
        deeper = F.col("depth") < me.depth if down else F.col("depth") > me.depth
        found = materialize(self.labels.where(deeper & may).select("node", sure.alias("sure")))
        out, open_ = found.where("sure").select("node"), found.where("not sure").select("node")
        step = self.edges.select(F.col("dst" if down else "src").alias("node"), F.col("src" if down else "dst").alias("near"))
        # edges into open nodes: one is reached as soon as a neighbour is
        step = step.join(open_, "node", "left_semi")
        last = out.union(self.spark.createDataFrame([(node,)], "node long"))
        for _ in range(MAX_DEPTH + 1):
            if open_.isEmpty():
                return out
            new = materialize(step.join(last.withColumnRenamed("node", "near"), "near", "left_semi").select("node").distinct().join(out, "node", "left_anti"))
            if new.isEmpty():
                return out
            out, last = out.union(new), new
        raise RuntimeError(f"paths are longer than {MAX_DEPTH}")
