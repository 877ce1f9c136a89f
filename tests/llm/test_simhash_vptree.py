import random

import numpy as np
import xxhash

from waymark.llm import simhash_vptree as m


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    prints = [brute_print(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(1)
    words = ["Ab", "cÉ", "de", "fg", "hi", " ", "jk", "lm"]
    rows = [(3 * i, " ".join(rnd.choices(words, k=rnd.randint(0, 12)))) for i in range(150)]
    base = rnd.choices(words, k=300)
    for i in range(60):
        own = list(base)
        own[rnd.randrange(300)] = rnd.choice(words)
        rows.append((1000 + i, "\n".join(own)))
    rows += [(None, rows[0][1]), (7, None), (8, " \t"), (7, None), (2, rows[160][1])]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, fp int, root int, component_id int")
    assert sorted((tuple(r) for r in m.simhash_near_dedup(docs).collect()), key=str) == brute_components(rows)
    assert m.simhash_near_dedup(docs.limit(0)).count() == 0


def test_tree_loses_no_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    near = base[:900] ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near]))
    nodes = m.fit_tree(fps, 6)
    at, shard = m.place(fps, nodes, 2)
    assert nodes[0] is not None and len(at) < 8 * len(fps)
    homes = {}
    for i, s in zip(at.tolist(), shard.tolist()):
        homes.setdefault(i, set()).add(s)
    for i in range(0, len(fps), 3):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2).tolist():
            assert homes[i] & homes[j]


def test_long_chain_is_one_component(spark):
    from waymark.llm.components import connected_components

    links = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(900, 901), (901, 900), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(401)}, 900: 900, 901: 900}


def test_overfull_shards_are_cut_again(spark, monkeypatch):
    from collections import Counter

    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    near = base[:400] ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near]))
    for name, value in (("OVERFULL", 300), ("REFIT", 256), ("SHARD", 64)):
        monkeypatch.setattr(m, name, value)
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    one = table.selectExpr("0L as shard", "fp")
    cut = m._refit(m.materialize(one), 2).collect()
    assert len({r.shard for r in cut}) > 4 and max(Counter(r.shard for r in cut).values()) < len(fps) / 2
    homes = {}
    for r in cut:
        homes.setdefault(np.int64(r.fp).view(np.uint64), set()).add(r.shard)
    assert len(homes) == len(fps)
    for x in fps[::7]:
        for y in fps[np.bitwise_count(fps ^ x) <= 2]:
            assert homes[x] & homes[y]
    got = {r.fp: r.root for r in m.hamming_components(table).collect()}
    linked = {int(np.int64(x)) for x in fps.view(np.int64) if (np.bitwise_count(fps ^ np.int64(x).view(np.uint64)) <= 2).sum() > 1}
    assert set(got) == linked
