import random
import zlib

import numpy as np

from waymark.llm import toxicity_nnpu as m


def test_held_out_toxic_texts_are_found(spark):
    rnd = random.Random(1)
    words = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(500)]
    bad = ["zzvile", "qqfoul", "xxgrim"]
    docs, labels, toxic = [], [], set()
    for i in range(1500):
        own = rnd.choices(words, k=40)
        if i % 9 == 0:
            toxic.add(i)
            own[3:5] = rnd.choices(bad, k=2)
        docs.append((i, " ".join(own), "x"))
        if i % 2:
            labels.append((i, int(i in toxic)))
    docs += [(None, "a", "x"), (5000, None, "x"), (5001, "", "x"), docs[4]]
    got = m.toxicity(spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in got if r.held_out]
    hit = [r.predicted for r in held if r.doc_id in toxic]
    wrong = [r.predicted for r in held if r.doc_id not in toxic]
    assert sum(hit) / len(hit) > 0.9 and sum(wrong) / len(wrong) < 0.05
    pairs = [(a.score, b.score) for a in held if a.doc_id in toxic for b in held if b.doc_id not in toxic]
    assert sum(a > b for a, b in pairs) / len(pairs) > 0.95  # the chance that a toxic text outranks a clean one


def test_held_out_labels_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.predicted for r in m.toxicity(docs, labels).where("held_out").collect()}
    toxic = {}
    for r in labels.where("toxic is not null").collect():
        toxic[r.doc_id] = max(toxic.get(r.doc_id, 0), r.toxic)
    hit, wrong = ([got[d] for d, y in toxic.items() if y == k and d in got] for k in (1, 0))
    assert len(hit) > 100 and sum(hit) / len(hit) >= 0.9 and sum(wrong) / len(wrong) < 0.02


def test_the_cut_parts_labels_best():
    z, y = np.array([3.0, 2.0, 1.0, 0.0, -1.0]), np.array([True, True, False, True, False])
    assert m.best_cut(z, y) == -0.5 and m.best_cut(z[:4], y[:4] & (z[:4] > 1)) == 1.5
    assert m.best_cut(np.array([1.0, 0.0]), np.array([True, True])) == -1 / 2


def test_without_toxic_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert [r.score for r in m.toxicity(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")).collect()] == [0.0, 0.0]
    assert m.toxicity(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0


def test_gradient_against_differences():
    """Slopes are those of the risk; where the corrected part is below zero, that part alone is reversed."""
    rng = np.random.default_rng(5)
    p = np.arange(40) < 12

    def parts(z, prior):
        return prior * np.logaddexp(0, -z[p]).mean(), np.logaddexp(0, z[~p]).mean() - prior * np.logaddexp(0, z[p]).mean()

    for z, prior, negative in ((rng.normal(size=40), 0.3, False), (np.where(p, 3.0, -6.0) + rng.normal(size=40) / 9, 0.4, True)):
        assert (parts(z, prior)[1] < 0) == negative
        for i in (0, 5, 20, 39):
            d = np.zeros(40)
            d[i] = 1e-5
            up, down = parts(z + d, prior), parts(z - d, prior)
            want = -(up[1] - down[1]) if negative else sum(up) - sum(down)
            assert abs(m.slopes(z, p, prior)[i] - want / 2e-5) < 1e-8


def test_strides_change_nothing(monkeypatch):
    rng = np.random.default_rng(6)
    size = rng.integers(0, 60, 50)
    size[:2] = 0
    ends, at = np.cumsum(size), rng.integers(0, 1 << m.BITS, size.sum()).astype(np.int32)
    w, g, n = rng.normal(size=1 << m.BITS), rng.normal(size=50), rng.integers(0, 40, 50)
    whole = m.Sample(at, ends, n, size > 9)
    monkeypatch.setattr(m, "STRIDE", 64)
    cut = m.Sample(at, ends, n, size > 9)
    assert len(cut.strides) > 5 and np.allclose(whole.sums(w), cut.sums(w)) and np.allclose(whole.gradient(g), cut.gradient(g))


def test_long_texts_train_and_score_whole(spark):
    """Toxic words anywhere in texts of thousands of distinct words."""
    rnd = random.Random(3)
    pool = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(6000)]
    bad = ["zzvile", "qqfoul", "xxgrim"]
    docs = []
    for i in range(1800):
        own = rnd.choices(pool, k=1000 if i % 2 else 60)
        if i % 6 < 2:
            for w in bad * 40 if i % 2 else bad:
                own.insert(rnd.randrange(len(own)), w)
        docs.append((i, " ".join(own)))
    labels = [(i, int(i % 6 < 2)) for i in range(1800)]
    got = m.toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    hit = [r.predicted for r in got if r.doc_id % 6 < 2 and r.doc_id % 2]
    wrong = [r.predicted for r in got if r.doc_id % 6 >= 2]
    assert hit and sum(hit) / len(hit) > 0.9 and sum(wrong) / len(wrong) < 0.1
