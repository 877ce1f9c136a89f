"""The reachability index against plain search, on random DAGs and on one with chains and hubs."""

import random
from itertools import product

import pytest

from tests.test_structure import edges, reached
from waymark.operators.reach_index import ReachIndex
from waymark.operators import structure


def made(seed):
    rnd = random.Random(seed)
    pairs = {(a, b) for a, b in product(range(1, 40), repeat=2) if b < a and rnd.random() < 0.06}
    pairs |= {(100 + i, 101 + i) for i in range(20)} | {(100, 5), (110, 30), (200, 100), (201, 100)} | {(300, i) for i in range(1, 40, 3)}
    return sorted(pairs)


@pytest.mark.parametrize("forests", [1, 3])
def test_pairs_and_sets(spark, forests):
    pairs = made(forests)
    r = reached(pairs)
    index = ReachIndex.build(edges(spark, pairs), forests)
    every = spark.createDataFrame(list(product([*r, 999], repeat=2)), "src long, dst long")
    told = index.decided(every).collect()
    assert all(x.reached in (None, x.dst in r.get(x.src, ())) for x in told)
    assert sum(x.reached is not None for x in told) > (0.75 if forests == 1 else 0.9) * len(told)
    assert all(x.reached == (x.dst in r.get(x.src, ())) for x in index.reached(every).collect())
    for node in (100, 30, 5, 300):
        assert {x.node for x in index.descendants(node).collect()} == r[node]
        assert {x.node for x in index.ancestors(node).collect()} == {a for a in r if node in r[a]}
    assert index.descendants(999).count() == 0


def test_what_labels_tell_without_a_list_of_all_pairs(spark):
    """the pairs told to have a way come from the trees; they are those that `decided` tells of all pairs."""
    pairs = made(3)
    r = reached(pairs)
    index = ReachIndex.build(edges(spark, pairs))
    every = spark.createDataFrame(list(product([*r, 999], repeat=2)), "src long, dst long")
    want = {(x.src, x.dst) for x in index.decided(every).collect() if x.reached}
    got = [tuple(x) for x in index.told(every.select("src").withColumnRenamed("src", "node")).collect()]
    assert set(got) == want and len(got) == len(want)


def test_open_pairs_are_walked_from_the_better_side(spark, monkeypatch):
    """few nodes are reached from a course and many lead to one, so a walk back from the targets writes many times the pairs asked."""
    from waymark.operators import reach_index

    pairs = [(n, n // 2) for n in range(2, 1000) if n % 3] + [(n, n // 3) for n in range(5, 1000, 5)]
    r = reached(pairs)
    index = ReachIndex.build(edges(spark, pairs))
    asked = spark.createDataFrame([(a, b) for a in range(50, 1000, 50) for b in range(1, 1000) if b in r.get(a, ()) or (a + b) % 101 == 0], "src long, dst long")
    want = {(a, b) for a, b in asked.collect() if b in r.get(a, ())}
    rows, write = [], reach_index.materialize
    monkeypatch.setattr(reach_index, "materialize", lambda df, *a, **kw: (out := write(df, *a, **kw), rows.append(out.count()))[0])
    assert {(x.src, x.dst) for x in index.reached(asked).collect() if x.reached} == want
    assert sum(rows) < 2 * asked.count() + 2 * len(pairs)
    side = index._up(asked)  # the other finds the same
    with pytest.raises(StopIteration) as end:
        while next(side):
            pass
    assert {(x.src, x.dst) for x in end.value.value.collect()} == want


def test_cyclic_graphs_through_their_condensation(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (6, 4), (5, 7), (7, 5)]
    e = edges(spark, pairs)
    parts = structure.strong_components(e)
    name = {x.node: x.component for x in parts.collect()}
    index = ReachIndex.build(structure.condensed(e, parts))
    r = reached(pairs)
    got = {x.node for x in index.descendants(name[2]).collect()}
    assert {n for n in name if name[n] in got or name[n] == name[2]} == r[2]
