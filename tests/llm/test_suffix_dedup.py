import hashlib
import random

from waymark.llm.suffix_dedup import suffix_array_dedup


def brute(rows, k):
    texts = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in texts:
        for i in range(len(b) - k + 1):
            w = b[i : i + k]
            if d is not None:
                first[w] = min(first.get(w, d), d)
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - k + 1):
            f = first.get(b[i : i + k])
            if f is not None and (d is None or f < d):
                gone[i : i + k] = [True] * k
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, k, anchor):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in suffix_array_dedup(docs, k, anchor).collect()]
    assert sorted(got, key=str) == brute(rows, k)


def test_against_brute_force(spark):
    rnd = random.Random(5)
    parts = ["".join(rnd.choices("abcdé ", k=rnd.randint(5, 90))) for _ in range(12)]
    rows = [(i * 3, "".join(rnd.choices(parts, k=rnd.randint(0, 6))) + "".join(rnd.choices("ab", k=20))) for i in range(60)]
    rows += [(7, None), (8, ""), (None, parts[0] * 3), (None, parts[0] * 3), (9, "ab" * 400), (10, "ab" * 300), (3, rows[1][1]), (3, rows[2][1])]
    check(spark, rows, 50, 20)
    check(spark, rows, 12, 4)
    check(spark, rows[:0], 50, 20)


def test_long_texts_are_cut_in_pieces(spark, monkeypatch):
    import waymark.llm.suffix_dedup as m

    rnd = random.Random(2)
    long = "".join(rnd.choices("abcdefgh ", k=3000))
    ends = m.np.array([0, 10, 10, 3010, 3050])
    monkeypatch.setattr(m, "CHUNK", 300)
    covered = set()
    for lo, hi in m._pieces(ends, 50):
        covered |= {(lo + i) for i in range(hi - lo - 49)}
    assert covered >= set(range(10, 3010 - 49))
    check(spark, [(1, long), (2, long[100:2500] + "x" + long[2500:]), (3, "z" + long[::-1])], 50, 20)


def test_copies_in_one_task_are_dealt_apart(spark, monkeypatch):
    """Of a string that many documents of a task hold, only rows of the smallest travel under its rank."""
    import waymark.llm.suffix_dedup as m

    text = "".join(random.Random(7).choices("abcdefgh ", k=400))
    batch = m.pa.RecordBatch.from_pydict({"did": list(range(200, 0, -1)), "th": [1] * 200, "text": [text] * 200})
    for combine in (m.COMBINE, 1000):
        monkeypatch.setattr(m, "COMBINE", combine)
        out = m.pa.Table.from_batches(m._spans(50, 20)(iter([batch]))).to_pandas()
        assert out.known.sum() == len(out) * 199 // 200 if combine > 1000 else 0 < out.known.sum() < len(out)
        assert (out[~out.known].groupby(["a", "s"]).did.min() == 1).all() and out[out.known].a.nunique() == out.known.sum()
    check(spark, [(i, text[i % 3 :] + "z" * (i % 2)) for i in range(300)] + [(None, text), (5, text[:60])], 50, 20)
