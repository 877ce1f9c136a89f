"""The small course ladder with known answers, cycles, and counts against enumeration."""

import random
from itertools import product

import pytest

from waymark.operators import graph

#: Art 2 -> Art 1, Art 3 -> Art 2 and Math 1, Art 4 -> Art 3
ART1, ART2, ART3, ART4, MATH1 = 1, 2, 3, 4, 5
LADDER = [(ART2, ART1), (ART3, ART2), (ART4, ART3), (ART3, MATH1)]


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def test_ladder(spark):
    e = edges(spark, LADDER)
    assert {r.node for r in graph.descendants(e, ART4).collect()} == {ART3, ART2, ART1, MATH1}
    assert {(r.node, r.depth) for r in graph.ancestors(e, MATH1).collect()} == {(ART3, 1), (ART4, 2)}
    assert max(r.depth for r in graph.levels(e).collect()) == 3
    r = graph.route(e, ART4, ART1).first()
    assert (r.route, r.depth) == ([ART4, ART3, ART2, ART1], 3)
    assert graph.route(e, ART1, ART4).count() == 0


def test_cycles_end_and_are_found(spark):
    e = edges(spark, [(1, 2), (2, 1), (3, 3), (4, 1)])
    assert {(r.src, r.dst) for r in graph.closure(e).collect()} == {(1, 2), (2, 1), (1, 1), (2, 2), (3, 3), (4, 1), (4, 2)}
    assert {r.node for r in graph.on_cycles(e).collect()} == {1, 2, 3}
    with pytest.raises(RuntimeError):
        graph.levels(e, max_depth=5)


def trails(pairs):
    out, level = [], [list(p) for p in pairs]
    while level:
        out += level
        level = [t + [b] for t in level for a, b in pairs if a == t[-1]]
    return out


def test_counts_equal_enumeration(spark):
    rnd = random.Random(4)
    pairs = sorted({(a, b) for a, b in product(range(1, 13), repeat=2) if b < a and rnd.random() < 0.3})
    every = trails(pairs)
    e = edges(spark, pairs)
    got = {r.node: (1 + int(r.ins)) * (1 + int(r.outs)) - 1 for r in graph.path_counts(e).collect()}
    assert got == {n: sum(n in t for t in every) for n in {x for p in pairs for x in p}}
    between = {}
    for t in every:
        between.setdefault((t[0], t[-1]), []).append(t)
    assert {(r.src, r.dst): int(r.n) for r in graph.pair_counts(e).collect()} == {k: len(v) for k, v in between.items()}


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(1, 150)] + [(300, 301), (302, 301)]
    random.Random(1).shuffle(pairs)
    got = {r.node: r.component for r in graph.components(edges(spark, pairs)).collect()}
    assert got == {**{i: 1 for i in range(1, 151)}, 300: 300, 301: 300, 302: 300}


def test_set_cover(spark):
    sets = {1: {1, 2, 3}, 2: {3, 4}, 3: {4, 5, 6, 7}, 4: {1}}
    members = spark.createDataFrame([(s, i) for s, own in sets.items() for i in own], "set_id long, item long")
    assert [(r.step, r.set_id, r.covered) for r in graph.set_cover(members, 9).orderBy("step").collect()] == [(1, 3, 4), (2, 1, 3)]


def test_empty(spark):
    e = edges(spark, [])
    assert graph.closure(e).count() == graph.levels(e).count() == graph.path_counts(e).count() == graph.components(e).count() == 0


def test_shared_neighbours_and_the_most_shared(spark):
    """equal sets are compared once, pairs are formed without grouping them, the best without the others."""
    import random
    from collections import Counter

    rng = random.Random(5)
    sets = {f"p{i:03}": frozenset(rng.sample(range(12), rng.choice([0, 1, 1, 2, 3, 5]))) for i in range(120)}
    sets |= {f"q{i:04}": frozenset({1, 2}) for i in range(graph.BLOCK + 100)}  # a class of two rows
    e = spark.createDataFrame([(p, f"o{t}") for p, own in sets.items() for t in own] + [(None, "o1"), ("p000", None)], "src string, dst string")
    names = sorted(sets)
    want = {(a, b): len(sets[a] & sets[b]) for i, a in enumerate(names) for b in names[i + 1:] if sets[a] & sets[b]}
    got = Counter(tuple(r) for r in graph.shared_neighbours(e).collect())
    assert got == Counter({(a, b, n): 1 for (a, b), n in want.items()})
    best = sorted(((a, b, n) for (a, b), n in want.items()), key=lambda x: (-x[2], x[0], x[1]))
    for k in (1, 20, 300):
        assert [tuple(r) for r in graph.most_shared(e, k).collect()] == best[:k]
    assert graph.most_shared(e.limit(0), 3).collect() == []
    few = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "src string, dst string")
    assert [tuple(r) for r in graph.most_shared(few, 3).collect()] == [("a", "b", 1)]


def test_shared_pairs_are_not_shuffled(spark):
    plan = graph.shared_neighbours(spark.createDataFrame([("a", "x"), ("b", "x")], "src string, dst string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_shared_pairs_are_not_broadcast(spark):
    """by its size on disk a table of classes seems small enough to broadcast, with its meetings it fills the driver."""
    plan = graph.shared_neighbours(spark.createDataFrame([("a", "x"), ("b", "x")], "src string, dst string"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_checks_of_written_tables_broadcast_little(spark, monkeypatch):
    """The joins that end a loop run under the settings of written steps, and these are put back."""
    from waymark.sources import shared

    name, seen = "spark.sql.autoBroadcastJoinThreshold", []
    before, whole = spark.conf.get(name), graph.is_empty

    def watched(df):
        check = df.isEmpty
        df.isEmpty = lambda: seen.append(spark.conf.get(name)) or check()
        return whole(df)

    monkeypatch.setattr(graph, "is_empty", watched)
    edges = spark.createDataFrame([(3, 2), (2, 1)], "src long, dst long")
    assert graph.trails_into(edges, 1).first().trails == 2
    assert {r.component for r in graph.components(edges).collect()} == {1}
    assert len(seen) > 1 and set(seen) == {shared._WRITING[name]} and spark.conf.get(name) == before
