import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from waymark.llm import pii_bootstrap as pii

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    """Rows by what should become of them, and benchmark items."""
    rnd = random.Random(21)
    pool = ["".join(rnd.choices("abcdefghij", k=rnd.randint(3, 8))) for _ in range(4000)]
    fresh = lambda n: rnd.choices(pool, k=n)
    items = [(i, " ".join(fresh(30))) for i in range(6)] + [(7, "short item of five words"), (8, None)]
    stay, go, docs = [], [], {}

    def add(doc, words, keep):
        docs[doc] = words if isinstance(words, str) or words is None else " ".join(words)
        (stay if keep else go).append(doc)

    for i in range(120):
        add(i, fresh(rnd.randint(60, 250)), True)
    for i in range(20):  # near copies of kept documents: one word in a hundred changed
        own = docs[i].split()
        own[rnd.randrange(len(own))] = "altered"
        add(200 + i, own if len(own) > 80 else docs[i].split(), False)
    for i in range(6):  # passages of items, with a substitution
        part = items[i][1].split()
        part[11] = "other"
        add(300 + i, fresh(60) + part + fresh(60), False)
    add(310, fresh(70) + items[6][1].split() + fresh(30), False)
    for i in range(8):
        add(400 + i, [w + rnd.choice(["%%", "##"]) for w in fresh(90)], False)
    for i in range(10):
        add(500 + i, fresh(50) + ["mail", f"name{i}@mail.example.org", "or", f"+1 234 555 {1000 + i}"] + fresh(20), True)
    add(600, fresh(20), False)
    add(601, None, False)
    add(602, "", False)
    add(603, fresh(9000), True)
    rows = [(d, t, "en", "s", len(t or "")) for d, t in docs.items()]
    return rows + [rows[5], rows[6], (None, docs[7], "en", "s", 1)], stay, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, stay, items = planted()
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, stay


def test_run_against_brute_force(spark, folder):
    path, rows, stay = folder
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r[0]: r[1] for r in reversed(rows) if r[0] is not None}
    want = []
    for d in stay:
        own, at, out = text[d], 0, []
        for kind, a, b in sorted(pii.base_spans(own), key=lambda s: (s[1], -s[2])):
            out, at = out + [own[at:a], f"<{kind.upper()}>"], b
        e = t.encode("".join(out) + own[at:], add_special_tokens=False)
        back = t.decode(e.ids, skip_special_tokens=False)
        want.append((d, len(e.ids), hashlib.sha256(" ".join(map(str, e.ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, path).collect()) == sorted(want)


def test_stages_keep_columns_of_any_name(spark, folder):
    """All stages but the last, on columns that share names with what operators use inside, null ids, repeated rows and empty tables."""
    path, rows, _ = folder
    extra = ["_d", "_r", "_t", "_id", "spans", "did", "rid", "th", "node", "row", "kept", "n_words", "fence", "use", "component"]
    docs = spark.createDataFrame(rows[:12] + rows[-3:] + [(None, None, None, None, None), (9999, "x y " * 30000, "en", "s", 1)], SCHEMA)
    docs = docs.selectExpr("*", *(f"{i} as {c}" for i, c in enumerate(extra)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, path)
        assert got.columns == docs.columns, name
        assert {tuple(r)[5:] for r in got.collect()} == {tuple(range(len(extra)))}, name
        assert stage(spark, docs.limit(0), path).count() == 0, name
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, path).count() == docs.count() and last(spark, docs.limit(0), path).count() == 0
    one = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, path).collect()]
    assert len(one) == len(set(one))
