import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from waymark.llm import license_join as lic
from waymark.llm import pii_bootstrap as pii
from waymark.llm.merkle_fixity import audit, damaged, warc_record


def base_brute(text):
    text, out = text or "", []
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group())):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_fixed_patterns_against_plain_search():
    rnd = random.Random(6)
    bits = ["a", "b.c", "@", ".", "_", "1", "23", "255", "4111111111111111", " ", "-", "+", "(", ")", "é", "x@y.z", "1.2.3.4", "+1 (234) 555-1234", "%"]
    for _ in range(20000):
        text = "".join(rnd.choices(bits, k=rnd.randint(1, 14)))
        assert pii.base_spans(text) == base_brute(text), text


def pii_docs(spark):
    rows = [(i, f"please call desk +1 (234) 555-{1000 + i} today or mail box x{i}@mail.example.com now") for i in range(20)]
    rows += [(100 + i, f"please call desk AC{77001 + i} today friends") for i in range(3)]
    rows += [(200, "order 123456 boxes"), (201, None), (202, ""), (None, "é😀 mail box q@mail.example.com now"), (5, rows[5][1])]
    return spark.createDataFrame([(*r, "en", "s", len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long"), rows


def test_contexts_find_unseen_identifiers(spark):
    docs, rows = pii_docs(spark)
    got = pii.personal_data_report(docs).collect()
    assert len(got) == len(rows)
    want = sorted((str(d), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_brute(t)).encode()).hexdigest()) for d, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    found = {r.doc_id: r.spans for r in got}
    assert found[101] == "id:17:24" and found[200] == "" and found[201] == ""
    assert pii.personal_data_report(docs.limit(0)).count() == 0


def discovered_brute(texts):
    """What the bootstrap trusts beyond its seeds, from the definition."""
    graph, known = {}, set()
    for text in texts:
        for m in pii.mentions(text or "", base_brute(text)):
            if m["seed"]:
                known.add(m["what"])
            for c in m["contexts"]:
                graph.setdefault(c, set()).add(m["what"])
    found = set()
    while True:
        score, n = {}, {}
        for members in graph.values():
            k = len(members & known)
            if k >= 3 and k >= 0.8 * len(members):
                for w in members - known:
                    score[w] = score.get(w, 1.0) * (1 - k / (len(members) + 1))
                    n[w] = n.get(w, 0) + 1
        new = {w for w in score if n[w] >= 2 and 1 - score[w] >= 0.9}
        if not new:
            return found
        found |= new
        known |= new


def test_discovery_goes_on_to_the_end(spark):
    """A chain of contexts, each trusted only once the one before has given identifiers: four rounds."""
    rows = [f"aaa call +1 234 555 {10000 + i} zzz" for i in range(310)]
    for step, n in enumerate((64, 16, 4, 1)):
        a, z = ("call", "zzz") if step == 0 else (f"a{'x' * step}", f"z{'x' * step}")
        b, y = f"a{'x' * (step + 1)}", f"z{'x' * (step + 1)}"
        rows += [f"{p} K{step}{1000 + i} {q}" for i in range(n) for p, q in ((a, z), (b, y))]
    rows += ["order 12 34 56 now", "é" * 300 + "77001" + "é" * 300, None, "1 " * 5000, "call 12 34 56 zzz"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    want = discovered_brute(rows)
    got = {r.doc_id: r.spans for r in pii.personal_data_report(docs).collect()}
    found = {rows[d][int(x.split(":")[1]) : int(x.split(":")[2])].lower() for d, spans in got.items() for x in spans.split(",") if x.startswith("id:")}
    assert found == want and {"k01000", "k11000", "k21000", "k31000", "12 34 56"} <= want


def test_planted_identifiers_precision_and_recall(spark):
    """Codes that no fixed pattern matches, in the patterns of seeds; the words next to them alone stand beside years and amounts too."""
    rnd = random.Random(8)
    fill = lambda: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(rnd.randint(2, 30)))
    seed = lambda i: rnd.choice((f"u{i}@mail.example.com", f"+1 (234) 555-{1000 + i}", f"10.{i}.3.4"))
    code = lambda i: rnd.choice((f"EMP-{40000 + i}", f"ZX{70000 + i}Q", f"{1000 + i} {2000 + i}"))
    rows, planted = [], {}
    for before, after in (("his number is", "for records"), ("to reach at", "in person")):
        rows += [f"{fill()} {before} {seed(i)} {after} {fill()}" for i in range(150)]
        for i in range(20):
            head, what = f"{fill()} {before} ", code(len(planted))
            planted[len(rows)] = f"id:{len(head)}:{len(head) + len(what)}"
            rows.append(f"{head}{what} {after} {fill()}")
        a, z = before.split()[-1], after.split()[0]
        rows += [f"{fill()} {a} {rnd.randint(1900, 9999)} {z} {fill()}" for _ in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: [x for x in r.spans.split(",") if x.startswith("id:")] for r in pii.personal_data_report(docs).collect()}
    found = {(d, x) for d, spans in got.items() for x in spans}
    hits = found & set(planted.items())
    assert len(hits) >= 0.95 * len(planted) and len(hits) >= 0.95 * len(found)


def test_shapes():
    assert [pii.shape(x) for x in ("+1 (504) 555-2652", "AB-12x", "4080250821787625", "é1 ")] == ["+d1 (d3) d3-d4", "a-x3", "d16", "x2 "]


def test_redaction(spark):
    docs, rows = pii_docs(spark)
    docs = docs.selectExpr("*", "1 as _d", "2 as _t", "3 as spans", "4 as th")
    out = pii.redact(docs)
    assert out.columns == docs.columns and {tuple(r)[5:] for r in out.collect()} == {(1, 2, 3, 4)} and pii.redact(docs.limit(0)).count() == 0
    got = {r.doc_id: r for r in out.collect()}
    assert got[101].text == "please call desk <ID> today friends" and got[101].n_chars == len(got[101].text)
    assert got[200].text == "order 123456 boxes" and got[201].text is None
    assert got[3].text == "please call desk <PHONE> today or mail box <EMAIL> now"
    assert out.count() == len(rows)


def license_brute(text, templates):
    """Every window at every offset against every template."""
    words = [w.decode() for w in lic.words_of((text or "").encode())]
    places, base = [], set()
    for label, p in lic.PHRASES.items():
        p = p.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    labels, score, best = set(base), 1.0 if places else 0.0, {}
    for label, must, t in templates:
        own, must = t.split(), set(must.split())
        size = -(-len(own) * 5 // 4)
        for b in range(max(1, len(words) - size + 1)):
            block = set(words[b : b + size])
            share = len(set(own) & block) / len(set(own))
            if share >= 0.8:
                best[label] = max(best.get(label, (0, False)), (share, must <= block))
    for label, (share, tells) in best.items():
        score = max(score, share)
        if tells or not any(x == share and told for x, told in best.values()):
            labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9))


def license_rows():
    rnd = random.Random(9)
    pool = sorted({w for *_, t in lic.TEMPLATES for w in t.split()}) + ["foo", "bär", "x1"]
    rows = [(1, None), (2, ""), (3, "Released under the MIT License."), (4, "CC BY-NC cc by nc; Apache License, Version 2.0"), (None, "under-the_mit/license")]
    for i in range(150):
        words = rnd.choices(pool, k=rnd.randint(0, 200))
        t = list(rnd.choice(lic.TEMPLATES)[2].split())
        t = [w if rnd.random() > 0.08 else rnd.choice(pool) for w in t]
        if i % 3 == 0:
            rnd.shuffle(t)
        at = rnd.randint(0, len(words))
        rows.append((10 + i, " ".join(words[:at] + t[: rnd.randint(len(t) // 2, len(t))] + words[at:])))
    for i, (_, _, t) in enumerate(lic.TEMPLATES):
        rows.append((1000 + i, t.upper()))
    return rows + rows[6:9] + [(2000, " ".join(rnd.choices(pool, k=3000)))]


def test_license_join_against_brute_force(spark):
    rows = license_rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, labels string")
    got = sorted(((str(r.doc_id), (*tuple(r)[1:7], round(r.score, 9))) for r in lic.license_join(docs).collect()), key=str)
    assert got == sorted(((str(d), license_brute(t, lic.TEMPLATES)) for d, t in rows), key=str)
    whole = {d: labels.split(",") for d, (_, _, _, _, _, labels, _) in got}
    for i, (label, *_) in enumerate(lic.TEMPLATES):  # an identical text gets its label
        assert label in whole[str(1000 + i)]
    assert lic.license_join(docs.limit(0)).count() == 0


def test_positional_filter_removes_pairs(spark):
    """Regions with a rare word of a template and many rarer words of others, but few more frequent ones."""
    made = [lic.Template("a", "", "a b c d e", 0.8), lic.Template("z", "", "r s t u v", 0.8)]
    rank = {w: i for i, w in enumerate(b"r s t u v a b c d e".split())}
    for t in made:
        t.order = sorted(t.words, key=rank.get)
    regions = spark.createDataFrame([(1, 0, ["r", "s", "t", "b", "a", "d"]), (2, 0, ["e", "c", "a", "b"]), (3, 0, ["r", "s", "a"])], "row long, region int, words array<string>")
    got = {(r.row, r.template) for r in lic.candidates(regions, made, rank).collect()}
    # row 1 shares word b or a with the first template but holds only three words from there on; row 3 fails by length
    assert got == {(1, 1), (2, 0)}


def test_merkle_audit(spark):
    rows = [(i * 7, f"http://h/{i}", f"<p>{i}</p>") for i in range(700)] + [(7, "http://h/again", None), (None, None, "x"), (7, "http://h/again", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert audit(pages, pages).count() == 0
    assert audit(pages.limit(0), pages.limit(0)).count() == 0
    other = pages.where("page_id is null or page_id <> 70").replace("<p>9</p>", "<p>8</p>", ["html"]).union(spark.createDataFrame([(5, "n", "m")], pages.schema))
    got = {(r.page_id, r.problem) for r in audit(pages, other).collect()}
    assert got == {(70, "missing"), (63, "changed"), (5, "added")}
    lost = {(r.page_id, r.problem) for r in audit(pages, damaged(pages)).collect()}
    assert lost == {(i * 7, "changed") for i in range(700) if i * 7 % 997 == 0} | {(i * 7, "missing") for i in range(700) if i * 7 % 1499 == 1}


def audit_brute(left, right):
    """(page_id, problem) of each row, from multisets of records by id."""
    out = []
    for i in {r[0] for r in left + right}:
        a, b = (Counter((u or "", h or "") for k, u, h in rows if k == i) for rows in (left, right))
        lost, more = sum((a - b).values()), sum((b - a).values())
        out += [(i, "changed")] * min(lost, more) + [(i, "missing")] * max(0, lost - more) + [(i, "added")] * max(0, more - lost)
    return sorted(out, key=str)


def test_merkle_audit_of_copies_and_null_ids(spark):
    rnd = random.Random(5)
    schema = "page_id long, url string, html string, hash string"
    for trial in range(3):
        ids = [None, -1, 0, 5, 17, 4095, 4096, -40000, 1 << 40]
        left = [(rnd.choice(ids), rnd.choice(["u", None, "v"]), rnd.choice(["x", None, "yy", "z" * 50])) for _ in range(60)]
        right = [r for r in left if rnd.random() > 0.15] + [(rnd.choice(ids), "u", rnd.choice(["x", "new"])) for _ in range(5)]
        rnd.shuffle(right)
        a, b = (spark.createDataFrame([(*r, "extra") for r in rows], schema) for rows in (left, right))
        assert sorted(((r.page_id, r.problem) for r in audit(a, b).collect()), key=str) == audit_brute(left, right)
    four = [(7, "u", h) for h in "abcd"]
    a, b, none = (spark.createDataFrame([(*r, "") for r in rows], schema) for rows in (four, four[1:], [(-1, "u", "h")]))
    assert [(r.page_id, r.problem) for r in audit(a, b).collect()] == [(7, "missing")]
    other = none.withColumn("page_id", none.page_id + None)
    got = audit(none, other).collect()
    assert sorted((r.page_id, r.file, r.problem) for r in got if r.page_id) == [(-1, -1, "missing")] and [(r.file, r.problem) for r in got if r.page_id is None] == [(None, "added")]
    assert {r.problem for r in audit(a, a.limit(0)).collect()} == {"missing"}


def test_offsets_are_those_of_the_file(spark):
    """Each reported offset cuts the record out of the file's bytes."""
    rows = [(i, f"http://h/{i}", "p" * (i % 37)) for i in range(0, 900, 3)] + [(30, "http://h/copy", "q" * k) for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    body = pages.select("page_id", warc_record().alias("bytes"), F.sha2(warc_record(), 256).alias("hash")).orderBy("page_id", "hash").collect()
    file = b"".join(bytes(r.bytes) for r in body)
    got = audit(pages, pages.where("page_id % 5 <> 0")).collect()
    want = sorted((r.page_id, bytes(r.bytes)) for r in body if r.page_id % 5 == 0)
    assert sorted((r.page_id, file[r.offset : r.offset + r.length]) for r in got) == want
