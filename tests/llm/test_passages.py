import random

import pytest

from waymark.llm.decontamination import MIN_HITS, SEEDS, decontaminate, passages


def brute(docs, items):
    """(doc, item, shift) with 12 equal tokens or more at 70 % or more in any stretch of the diagonal."""
    out = set()
    for d, text in docs:
        w = (text or "").split()
        for item, it in items:
            v = it.split()
            for shift in range(-len(v), len(w)):
                eq = [w[k + shift] == v[k] for k in range(len(v)) if 0 <= k + shift < len(w)]
                if len(v) < 12:
                    if len(v) >= 3 and len(eq) == len(v) and all(eq):
                        out.add((d, item, shift))
                elif sum(eq) >= 12 and any(sum(eq[i:j]) >= 12 and 10 * sum(eq[i:j]) >= 7 * (j - i) for i in range(len(eq)) for j in range(i + 12, len(eq) + 1)):
                    out.add((d, item, shift))
    return out


def test_every_passage_is_found(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("abcdefghij", k=5))
    fresh = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(fresh(rnd.choice([12, 15, 17, 20, 25, 40, 60])))) for i in range(20)] + [(None, " ".join(fresh(15))), (3, " ".join(fresh(16)))]
    items += [(30 + n, " ".join(fresh(n))) for n in range(1, 12)] + [(50, "a b c a b c a b c a b c a b c")]
    docs = []
    for i in range(200):
        part, rate = rnd.choice(items)[1].split(), rnd.choice([0, 0.05, 0.1, 0.2, 0.3])
        part = [word() if rnd.random() < rate else w for w in part][rnd.randint(0, 3):]
        docs.append((i, " ".join(fresh(rnd.randint(0, 30)) + part + fresh(rnd.randint(0, 30)))))
    for i, n in ((300, 17), (301, 20)):  # equal tokens only in pairs
        v = next(it for _, it in items if len(it.split()) >= n).split()[:n]
        docs.append((i, " ".join(word() if k % 3 == 2 else w for k, w in enumerate(v))))
    v = next(it for _, it in items if len(it.split()) == 60).split()
    docs += [(500 + i, " ".join(fresh(7) + it.split() + fresh(3))) for i, it in items[22:33]] + [(600, "a b c " * 30), (601, items[25][1].rpartition(" ")[0] + " zz")]
    docs += [(400, " ".join(v[:20] + fresh(19) + v[39:])), (401, None), (None, items[20][1]), (400, "other text of the same id")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got, want = passages(d, b).collect(), brute(docs, items)
    assert {(r.doc_id, r.item_id, r.start_word - r.item_word) for r in got} == want and {300, 301, 400, None, 600, *range(533, 542)} <= {x[0] for x in want}
    assert sorted((r.start_word, r.n_words) for r in got if r.doc_id == 400) == [(0, 20), (39, 21)]
    assert all((r.n_equal >= 12 or r.n_equal == r.n_words) and 10 * r.n_equal >= 7 * r.n_words for r in got)
    bad = {x[0] for x in want} - {400}
    assert sorted(str(r.doc_id) for r in decontaminate(d, b).collect()) == sorted([str(i) for i, _ in docs[:-1] if i not in bad and i != 400] + ["400"])
    assert passages(d.limit(0), b).count() == 0 and passages(d, b.limit(0)).count() == 0


@pytest.mark.parametrize("size", [11, 80])
def test_copies_with_a_gap_and_short_items(spark, size):
    """An item of which a text holds both ends, and whole short items."""
    rnd = random.Random(size)
    fresh = lambda n: ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(n)]
    item = fresh(size)
    ends = item[:20] + fresh(max(0, size - 40)) + item[20:][-20:]
    docs = spark.createDataFrame([(1, " ".join(fresh(30) + item + fresh(30)), "x"), (2, " ".join(ends), "x"), (3, " ".join(fresh(200)), "x")], "doc_id long, text string, did string")
    bench = spark.createDataFrame([(7, " ".join(item), "q")], "item_id long, text string, doc_id string")
    got = sorted((r.doc_id, r.start_word, r.n_words, r.n_equal) for r in passages(docs, bench).collect())
    if size == 80:
        assert got == [(1, 30, 80, 80), (2, 0, 20, 20), (2, 60, 20, 20)]
    else:
        assert got == [(1, 30, size, size), (2, 0, size, size)]
    assert [tuple(r) for r in decontaminate(docs, bench).collect()] == [tuple(docs.where("doc_id = 3").first())]


def test_every_overlap_holds_enough_seeds():
    """The least number of seeds over all patterns of 12 to 24 equal tokens at 70 %, by dynamic programming."""
    for equal in range(12, 25):
        other, best = 3 * equal // 7, {("1", 1, 0): 0}
        least = None
        for _ in range(equal + other - 1):
            step = {}
            for (last, a, z), n in best.items():
                for bit in "01":
                    own, key = last + bit, ((last + bit)[-4:], a + (bit == "1"), z + (bit == "0"))
                    if key[1] <= equal and key[2] <= other:
                        hits = n + sum(len(own) >= len(m) and all(b == "1" for b, k in zip(own[-len(m):], m) if k == "1") for m in SEEDS)
                        step[key] = min(hits, step.get(key, hits))
                        if bit == "1" and key[1] == equal:
                            least = step[key] if least is None else min(least, step[key])
            best = step
        assert least >= MIN_HITS


@pytest.mark.parametrize("most", [500_000, 0])
def test_texts_stay_where_they_are(spark, monkeypatch, most):
    """Few keys of texts are broadcast even where a written step broadcasts nothing by itself; many shuffle, with the same result."""
    from waymark.llm import decontamination as d

    monkeypatch.setattr(d, "BROADCAST_KEYS", most)
    item = " ".join(f"word{k}" for k in range(20))
    docs = spark.createDataFrame([(i, f"own{i} " * 30 + (item if i % 3 == 0 else "")) for i in range(60)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = decontaminate(docs, bench)
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in left.collect()) == [i for i in range(60) if i % 3]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ("BroadcastHashJoin" in plan) == (most > 0) and ("SortMergeJoin" in plan) == (most == 0)
