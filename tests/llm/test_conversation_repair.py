import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from waymark.llm import conversation_repair as m

NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
LEGAL = re.compile(r"(s?(ua)+)?").fullmatch


def cheapest(rows):
    """(cost, audit, repaired rows) of (role, text, fault) rows: the least cost, then the least letters, by recursion over rows and legal beginnings."""

    def ways(x, role, text, fault):
        """Letter, cost and what follows, for one row after the initials x ('', 's', 'u' or 'a': the last one)."""
        cut = 5 * (fault == "truncated")
        yield "D", 2, x, None
        if fault in ("blank", "duplicate"):
            return
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[x]
        if role[:1] and role[:1] in follow:
            yield "K", cut, role[:1], (role, text)
        new = {"u": "user", "a": "assistant"}
        for c in "ua":
            if c in follow:
                yield "R", 1 + cut, c, (new[c], text)

    @functools.cache
    def go(i, x, inserts):
        best = []
        if i == len(rows):
            if x in ("", "a"):
                best.append((0, "", ()))
        else:
            for letter, cost, y, row in ways(x, *rows[i]):
                c, audit, tail = go(i + 1, y, 0)
                best.append((cost + c, letter + audit, ((row,) if row else ()) + tail))
        if inserts < 3:
            for c, role in (("u", "user"), ("a", "assistant")):
                if c in {"": "u", "s": "u", "u": "a", "a": "u"}[x]:
                    cost, audit, tail = go(i, c, inserts + 1)
                    best.append((5 + cost, "I" + audit, ((role, ""),) + tail))
        return min(best, default=(10**9, "", ()))

    for i in range(len(rows), -1, -1):  # from the end, so that the recursion stays shallow
        for x in ("", "s", "u", "a"):
            go(i, x, 0)
    return go(0, "", 0)


def brute(table):
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        s = lambda v: " " if v is None else str(v)
        kind, role, text = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20, s(role), s(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in rows:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, repaired = cheapest([(r, t, f) for (_, r, t), f in zip(rows, faults)])
        assert LEGAL("".join(r[:1] for r, _ in repaired))
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out.append((conv, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n, longest):
    rnd = random.Random(seed)
    out = []
    for conv in [*range(n), None]:
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "sage", "u"])
            text = rnd.choice([None, "", "  \t", "Yes.", "No", "ok!", "é?", "a\nb", f"t {rnd.randint(0, 9)}.", f"cut {rnd.randint(0, 99)}", f"full {rnd.randint(0, 999)}."])
            out.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]), role, text))
    return out


def damaged(spark, rows, **kw):
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, cost string, copies int").repartition(6)
    got = m.damaged_and_repaired(table, **kw)
    assert tuple(got.columns) == NAMES
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"most_rows": 3}, {"most_rows": 1}, {"most_chars": 80}])
def test_against_brute_force(spark, kw):
    rows = made(3, 60, 14)
    assert damaged(spark, rows, **kw) == brute(rows)


def test_one_long_conversation_in_many_chunks(spark, monkeypatch):
    rows = [(7, t, r, x) for _, t, r, x in made(5, 40, 30)] + [(8, 1, "user", "same.")] * 500 + [(9, t, "user", "hello.") for t in range(300)]
    monkeypatch.setattr(m, "MARK", 4)
    monkeypatch.setattr(m, "TOGETHER", 64)
    assert damaged(spark, rows, most_rows=16) == brute(rows)


def test_tables(spark):
    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.01/conversations.parquet"
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in pq.read_table(path).to_pylist()]
    want = brute(rows)
    assert sorted((tuple(r) for r in m.damaged_and_repaired(spark.read.parquet(path)).collect()), key=str) == want
    assert any(w[6] for w in want) and any(w[7].count("K") > 1 for w in want)


def test_conversations_without_rows(spark):
    dropped = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    got = damaged(spark, [(c, 0, "user", "x.") for c in dropped])
    assert got == sorted(((c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in dropped), key=str)
    assert damaged(spark, []) == []


def test_reruns_stop_when_vectors_differ_by_a_constant():
    rnd = np.random.default_rng(4)
    symbols, copies = rnd.choice(np.array([0, 1, 2, 3, 4, 5, 6, 7, 8], np.uint8), 5000), rnd.integers(1, 3, 5000)
    marks, before, ran = m.run_back(symbols, copies, m.END)
    assert ran == 5000
    other = np.array([7, 0, 3, 5])
    again = m.run_back(symbols, copies, other, marks, before)
    whole = m.run_back(symbols, copies, other)
    assert again[2] <= 3 * m.MARK and again[:2] == whole[:2]
