import random

import corpus_pipeline


def grams(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute_kept(rows):
    sets, group = [grams(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    found = {}
    for (d, t), g in zip(rows, group):
        found.setdefault(g, []).append((d is None, d or 0))
    return sorted(min(v) for v in found.values())


def test_near_dedup_stage_against_brute_force(spark):
    rnd = random.Random(4)
    fresh = lambda n: ["".join(rnd.choices("abcdefghij", k=5)) for _ in range(n)]
    line, rows = fresh(25), []
    for i in range(70):
        base = fresh(rnd.randint(3, 150)) + (line if i % 2 else [])
        rows.append((1000 - i, " ".join(base)))
        for k in range(rnd.randint(0, 3)):
            own = list(base)
            for _ in range(rnd.randint(0, 1 + len(own) // 40)):
                own[rnd.randrange(len(own))] = "changed"
            rows.append((2000 + 10 * i + k, " ".join(own)))
    chain = fresh(100)
    for i in range(12):  # neighbours are near copies, the ends are not
        rows.append((5000 + i, " ".join(chain[4 * i :] + chain[: 4 * i])))
    rows += [(None, rows[3][1]), (None, "only null ids here and in its copy"), (None, "only null ids here and in its copy")]
    rows += [(7000, rows[5][1]), (7000, rows[40][1]), (8000, "twice the same row"), (8000, "twice the same row"), (9000, None), (9001, " "), (9002, "")]
    docs = spark.createDataFrame([(*r, "en", 1, 2) for r in rows], "doc_id long, text string, lang string, node int, did int")
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == brute_kept(rows)
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_texts_that_share_a_hash_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    from waymark.llm import near_copies

    whole = near_copies.node
    monkeypatch.setattr(near_copies, "node", lambda *more: whole(*more) if more else F.pmod(whole(), F.lit(7)))
    rnd = random.Random(6)
    rows = [(i, " ".join("".join(rnd.choices("abcdef", k=5)) for _ in range(40))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 3)] + [(200, ""), (201, " "), (None, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, text_hash int, clash int")
    named = near_copies.with_nodes(docs, "name")
    assert named.columns == [*docs.columns, "name"]
    names = {}
    for r in named.collect():
        names.setdefault((r.text or "").strip(), set()).add(r["name"])
    assert all(len(v) == 1 for v in names.values()) and len(set.union(*names.values())) == len(names) == 61
    kept = near_copies.drop_near_copies(docs).collect()
    assert sorted(r.doc_id for r in kept) == [r[0] for r in rows[:60]] + [200]


def test_pairs_of_a_large_group_are_formed_once(spark):
    """Copies of one text with many words changed share a hundred shingles or so: each pair that can be similar comes about once, and none that is similar lacks."""
    import numpy as np
    from pyspark.sql import functions as F

    from waymark.llm import near_copies

    rnd = random.Random(8)
    base, texts = [str(rnd.randrange(10**6)) for _ in range(400)], []
    for i in range(60):
        own = base + [str(rnd.randrange(10**6)) for _ in range(i % 7)]
        for _ in range(rnd.randint(2, 12)):
            own[rnd.randrange(len(own))] = str(rnd.randrange(10**6))
        texts.append(" ".join(own))
    sets = [near_copies.shingles(t.encode()) for t in texts]
    enough = lambda a, b: 9 * len(np.intersect1d(a, b)) >= 4 * (len(a) + len(b))
    similar = {(i, j) for i in range(60) for j in range(i + 1, 60) if enough(sets[i], sets[j])}
    order = spark.sparkContext.broadcast(np.zeros(near_copies.COUNTERS, np.uint8))
    every = near_copies.prefixes(spark.createDataFrame(list(enumerate(texts)), "node long, text string"), order)
    rest = every.where("n > 0").withColumn("root", F.col("node")).drop("odd")
    met = [(r.a, r.b) for r in near_copies._first_met(rest, every.where("n = 0").select("node", "odd")).collect()]
    again = rest.select("key", F.col("node").alias("a")).join(rest.select("key", F.col("node").alias("b")), "key").where("a < b").count()
    assert similar <= set(met) and len(similar) > 100
    assert len(met) < 1.05 * len(set(met)) and len(set(met)) < 4 * len(similar) and again > 20 * len(met)
