import math
import os

import duckdb
import numpy as np
import pytest

from waymark.llm import hard_negatives as m
from waymark.llm.queries import ORACLES

NAMES = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"


def brute(rows, every=50):
    """From the definition, one pair after the other."""
    own = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (anchor, label, v) in enumerate(own):
        if anchor % every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(v, w)), i, other) for b, (i, other, w) in enumerate(own) if b != a), key=lambda x: x[:2])
        for s, i, _ in [x for x in scored if x[2] == label][:5]:
            band = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(anchor, i, k + 1, x[1], -s, -x[0]) for k, x in enumerate(band[:3])]
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], "vec_id long, embedding array<float>, label int, score string, uid int").repartition(5)


def made(n, size, seed, spread=0.6):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((12, size))
    out = []
    for i in range(n):
        v = centres[rnd.integers(12)] + spread * rnd.standard_normal(size)
        out.append((i, (v / max(1.0, np.linalg.norm(v))).astype(np.float32).tolist(), int(rnd.integers(10))))
    return out


@pytest.mark.parametrize("size", [64, 5, 130])
def test_against_brute_force(spark, monkeypatch, size):
    rows = made(700, size, size)
    rows += [(50, rows[3][1], 4), (50, rows[3][1], 4), (7, rows[3][1], 4), (None, rows[3][1], 4), (800, None, 4), (850, rows[1][1], None), (900, [math.nan] * size, 1), (901, [None] * size, 1), (950, [], 1), (951, [math.inf] * size, 1), (1000, [0.0] * size, 2), (1050, rows[9][1][:3], 3)]
    rows += [(2000 + k, rows[100][1], 5) for k in range(150)]  # one vector many times: ties
    monkeypatch.setattr(m, "BLOCK", 200)
    got = m.hard_negatives(table(spark, rows))
    assert tuple(got.columns) == NAMES
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows))


def test_groups_of_queries_and_hot_labels(spark, monkeypatch):
    rows = [(i, v, label if i % 3 else 1) for i, v, label in made(900, 64, 4)]
    monkeypatch.setattr(m, "QUERIES", 4)
    monkeypatch.setattr(m, "GROUP", 2)
    got = m.hard_negatives(table(spark, rows), every=20)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, 20))


def test_large_components_and_empty_tables(spark):
    rows = [(i, [(-1.0) ** i * 40000.0 + i, 3.5 * i], i % 2) for i in range(60)] + [(61, [3e38, 1.0], 1)]
    got = m.hard_negatives(table(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows[:-1]))
    assert m.hard_negatives(table(spark, rows).limit(0)).count() == 0
    assert m.hard_negatives(table(spark, [(3, [1.0], 2)])).count() == 0


def test_intervals_hold_every_score_and_codes_narrow_them():
    rnd = np.random.default_rng(1)
    v = np.floor(256 * rnd.standard_normal((500, 64)) / 8).astype(np.int64)
    own = np.arange(500)
    rows, q = m.Rows(own, own, own * 0, v), m.Queries(own[:40], own[:40], own[:40], v[:40])
    true = v[:40] @ v.T
    i, j = np.arange(40)[:, None], own[None, :]
    before = np.inf
    for codes in range(1, m.CODES + 1):
        low, high = m.intervals(q, rows, i, j, codes)
        assert (low <= true).all() and (true <= high).all()
        assert (high - low).mean() < before
        before = (high - low).mean()
    # the same without rounding, from the definition of the first code
    assert (rows.vectors == v).all()
    r = v @ m.rotation(64).T
    b = np.where(r >= 0, 1.0, -1.0)
    assert np.allclose(rows.alignment[0], (r * b).sum(1) / 64) and np.allclose(((r - rows.alignment[0][:, None] * b) * b).sum(1), 0)


def test_filters_leave_few_pairs():
    rnd = np.random.default_rng(2)
    centres = rnd.standard_normal((30, 64))
    v = centres[rnd.integers(30, size=6000)] + 0.35 * rnd.standard_normal((6000, 64))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]).astype(np.int64)
    own = np.arange(6000)
    q = m.Queries(own[:120], own[:120], own[:120] * 0, v[:120])
    low, high = np.full((120, 1), -(1 << 60)), np.full((120, 1), 1 << 60)
    s = m.Search(q, low, high, True, 5)
    for at in range(0, 6000, 500):
        s.add(m.Rows(own[at : at + 500], own[at : at + 500], own[at : at + 500] * 0, v[at : at + 500]))
    pairs, scored = s.seen
    assert pairs == 120 * 5999 and scored < 0.2 * pairs  # the first block, of a twelfth, has nothing to go by


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql_agrees(spark, sf):
    path = f"/root/testdata/{sf}/embeddings.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}'")
    want = con.execute(ORACLES["op12_hard_negatives"])
    assert [d[0] for d in want.description] == list(NAMES)
    want = sorted(want.fetchall())
    assert want and sorted(tuple(r) for r in m.hard_negatives(spark.read.parquet(path)).collect()) == want
    assert os.path.exists(path)
