"""Strong components, condensation, dominators and sketches against plain search."""

import random
from itertools import product

import pytest

from waymark.operators import graph, structure


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long").repartition(3)


def reached(pairs):
    out = {a: set() for p in pairs for a in p}
    for a in out:
        todo = [a]
        while todo:
            x = todo.pop()
            new = {d for s, d in pairs if s == x} - out[a]
            out[a] |= new
            todo += new
    return out


def dag(seed, n, share):
    rnd = random.Random(seed)
    return sorted({(a, b) for a, b in product(range(1, n), repeat=2) if b < a and rnd.random() < share})


@pytest.mark.parametrize("seed, n, share", [(1, 25, 0.06), (2, 30, 0.03), (3, 12, 0.3)])
def test_strong_components_and_condensation(spark, seed, n, share):
    rnd = random.Random(seed)
    pairs = [(a, b) for a, b in product(range(n), repeat=2) if rnd.random() < share] + [(100, 101), (101, 102), (102, 100), (200, 200), (100, 0)]
    r = reached(pairs)
    want = {a: min([a, *(b for b in r[a] if a in r[b])]) for a in r}
    e = edges(spark, pairs)
    got = structure.strong_components(e)
    assert {x.node: x.component for x in got.collect()} == want
    dense = {(want[a], want[b]) for a, b in pairs if want[a] != want[b]}
    c = structure.condensed(e, got)
    assert {(x.src, x.dst) for x in c.collect()} == dense
    graph.levels(c)  # a DAG: it isn't refused


def test_one_long_cycle(spark):
    pairs = [(i, (i + 1) % 40) for i in range(40)]
    assert {x.component for x in structure.strong_components(edges(spark, pairs)).collect()} == {0}


def test_dominators_are_on_every_trail(spark):
    pairs = dag(7, 14, 0.25)
    trails, level = {}, [list(p) for p in pairs]
    while level:
        for t in level:
            trails.setdefault((t[0], t[-1]), []).append(t)
        level = [t + [b] for t in level for a, b in pairs if a == t[-1]]
    want = {k: [n for n in ts[0] if all(n in t for t in ts)] for k, ts in trails.items()}
    assert {(x.src, x.dst): x.path for x in structure.dominator_paths(edges(spark, pairs)).collect()} == want
    count = {}
    for path in want.values():
        for n in path[1:-1]:
            count[n] = count.get(n, 0) + 1
    assert {x.node: x.pairs for x in structure.essential(edges(spark, pairs)).collect()} == count
    assert structure.essential(edges(spark, [])).count() == 0


def test_sketches_and_the_exact_rest(spark):
    pairs = dag(5, 60, 0.05) + [(1000, i) for i in range(2000, 3500)] + [(1001, 1000), (1002, 2500)]
    r = reached(pairs)
    e = edges(spark, pairs)
    for x in structure.reach_sketches(e).collect():
        assert abs(x.estimate - len(r[x.node])) <= structure.SIGMAS * structure.ERROR * len(r[x.node]) + 1
    top = sorted(((-len(v), a) for a, v in r.items() if v))[:7]
    assert [(x.node, x.n) for x in structure.most_reaching(e, 7).collect()] == [(a, -n) for n, a in top]
    even = spark.createDataFrame([(i,) for i in range(0, 4000, 2)], "node long")
    count = {a: sum(b % 2 == 0 for b in v) for a, v in r.items()}
    top = sorted((-n, a) for a, n in count.items() if n)[:5]
    assert [(x.node, x.n) for x in structure.most_reaching(e, 5, even).collect()] == [(a, -n) for n, a in top]
    assert structure.most_reaching(edges(spark, []), 5).count() == 0


def test_reached_pairs_broadcasts_nothing(spark):
    """Even small tables make broadcasts of many MB in the driver, in each round."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def plans():
        bus.waitUntilEmpty()
        done = store.executionsList()
        return {r.executionId(): r.physicalPlanDescription() for r in (done.apply(i) for i in range(done.size()))}

    before = plans()
    chain = edges(spark, [(i, i + 1) for i in range(6)])
    pairs = graph.reached_pairs(chain, chain.select(chain.src.alias("node")))
    assert sorted(map(tuple, pairs.collect())) == [(i, j) for i in range(6) for j in range(i + 1, 7)]
    made = [p for k, p in plans().items() if k not in before]
    assert any("Join" in p for p in made) and not any("Broadcast" in p for p in made)
