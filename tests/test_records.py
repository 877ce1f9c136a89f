import pytest
from pyspark.sql import functions as F

from waymark.functions import keys, text
from waymark.operators import pages as pg
from waymark.operators import records as rec
from waymark.sources import readers
from waymark.sources.shared import shared_dir


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_cip_codes(spark):
    raw = ["11.0101", "110101", "1", "0", "51.38", "11.010", "1101011", " 11", "11.0101 ", "١١", "", None, "11.0101\n"]
    assert values(spark, keys.cip_code("x"), raw) == ["110101", "110101", "000001", "000000"] + [None] * 9


def test_titles_and_statements(spark):
    assert values(spark, text.normalised_title("x"), ["AP Biology*", "  Art & Design (2) ", "Honors  English"]) == ["biology", "art design 2", "english"]
    said = ["None", "n/a.", "–", " No prior Latin is required", "Algebra 1", "", None, "None but Algebra"]
    assert values(spark, text.states_a_prerequisite("x"), said) == [False, False, False, False, True, False, False, True]


def test_addresses(spark):
    assert values(spark, text.absolute("x", "h.org"), ["/a/b/?q=1#f", "https://h.org/", "https://h.org", "c"]) == ["https://h.org/a/b", "https://h.org/", "https://h.org/", "https://h.org/c"]
    assert values(spark, text.path_of("x", "h.org"), ["https://h.org/a/", "https://other.org/a", "/z"]) == ["/a", None, "/z"]
    assert values(spark, text.level("x"), ["/a", "/a/b", "/a/b/c", "/", "/a/b/c/d"]) == ["subject", "course", "pathway", None, None]
    assert values(spark, text.kind_of("x", ("cte", "career")), ["/cte/x", "/ctex/y", "/cte/career"]) == ["cte", None, None]


def test_table_cells(spark):
    """F1 to F4: cells of tables in markup, with rows in their order; a null text has no rows."""
    df = spark.createDataFrame([(1, "<TABLE><tr><TH>A&nbsp;&amp;lt;</TH><td class='n'><b>5</b>\n x</td></tr>\n<tr></tr><tr><td></td></tr></TABLE>"), (2, "no table"), (3, None)], "id long, html string")
    got = [tuple(r) for r in readers.table_cells(df, "html").orderBy("id", "row").collect()]
    assert got == [(1, 0, ["A &lt;", "5 x"]), (1, 1, []), (1, 2, [""])]


def test_markup(spark):
    assert values(spark, text.text_of("x"), ["<b>A&nbsp;&amp;lt;</b>\n<i>B</i>"]) == ["A &lt; B"]
    assert values(spark, text.readable("x"), ["<script>x</script>Hi <!-- no --> <style>s</style>You"]) == ["hi you"]
    assert values(spark, text.field_text("x", "h1"), ["<h1>Title<footer>x", "<p>none</p>"]) == ["Title", None]
    assert values(spark, text.field_items("x"), ["<li>Algebra,</li><li> </li><li>9</li>"]) == [["Algebra", "9"]]
    html = ["<nav><a href='/x'>X</a></nav>", "<nav>None</nav>", "<nav>an audition</nav>", "<nav></nav>", "<p>x</p>", "<nav>open <article>x</article>"]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    got = [r["class"] for r in pg.statement_classes(pages).orderBy("page_id").collect()]
    assert got == ["typed", "says-none", "prose", "typed-no-link", "no-field", "unbounded"]


def test_upsert_and_inserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "id long, name string, note string")
    new = spark.createDataFrame([(2, "B", "n"), (1, None, None), (3, "c", None), (3, "c", None)], old.schema)
    assert sorted(map(tuple, rec.upsert(old, new.dropDuplicates(), "id").collect())) == [(1, "a", "x"), (2, "B", "n"), (3, "c", None)]
    created = rec.insert_absent(old, new, "id")
    assert [r.id for r in created.collect()] == [3]
    again = rec.insert_absent(old.union(created), new, "id")
    assert again.count() == 0
    assert tuple(rec.write_counts(old, new, "k", "id").first()) == ("k", 3, 1, 2)
    edition = rec.insert_absent(old.select("id", "name"), new.select("id", "name"), "id", "name")
    assert edition.where("id = 2").count() == 1


def test_folded_rows(spark):
    rows = spark.createDataFrame([("p", "c", "B", "1", 1), ("p", "c", "A", "2", 2), ("p", "c", "B", "1", 3), ("p", "c", "", None, 4), ("p", "d", None, "3", 5)], "pathway_id string, course_id string, section string, credits string, pos long")
    got = {r.course_id: tuple(r)[2:] for r in rec.fold_rows(rows).collect()}
    assert got == {"c": ("B | A", 2, 4, "1", True), "d": (None, 0, 1, "3", False)}


def test_refusals(spark, tmp_path):
    df = spark.createDataFrame([(1, -1)], "id long, v long")
    with pytest.raises(rec.Refused):
        rec.refuse_invalid(df, v=F.col("v") >= 0)
    with pytest.raises(rec.Refused):
        rec.refuse_empty(df.limit(0), "the table")
    before = spark.createDataFrame([("d", 3)], "district string, value long")
    with pytest.raises(rec.Refused):
        rec.replace_record(before, before.limit(0), str(tmp_path / "m"), "district")
    assert [rec.slice_integrity(x, n).first().problem for x, n in ((df, 1), (df, 2), (df.limit(0), 0), (df.union(df), 2))] == [None, "count", "empty", "repeated"]
    assert rec.drifted(11, 100) and not rec.drifted(10, 20) and not rec.drifted(11, 110)
    fit = {r.field: (r.present, r.absent, r.distinct_values, r.collides, r.shared_values, r.usable) for r in rec.key_fitness(spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "k long, s string"), "k", "s").collect()}
    assert fit == {"k": (3, 0, 3, 0, 0, True), "s": (2, 1, 1, 1, 1, False)}


def test_sheets_and_files(spark, tmp_path):
    sheet = spark.createDataFrame([(0, ["t", "", ""]), (1, ["CIP2020Code", "CIP2020Title", "SOC2018Code"]), (2, ["11.0101", "x", "15-1252"]), (3, ["11.0102", "x", " "])], "row_no long, cells array<string>")
    assert [tuple(r) for r in readers.sheet_pairs(sheet).orderBy("row_no").collect()] == [(2, "11.0101", "15-1252"), (3, "11.0102", None)]
    with pytest.raises(ValueError):
        readers.column_at(sheet, readers.heading_row(sheet, "cip"), lambda c: "20" in c)
    assert readers.edition(["CIP2020Code", "CIP2020Title", "SOC2018Code"]) == "CIP2020-SOC2018"
    (tmp_path / "a.csv").write_bytes("﻿id,name\n1,é\n".encode())
    assert readers.read_csv(spark, str(tmp_path / "a.csv")).collect()[0].asDict() == {"id": "1", "name": "é"}
    names = spark.createDataFrame([("a.csv",), ("b.csv",)], "name string")
    with pytest.raises(Exception, match="one unrevised"):
        readers.unrevised_member(names).collect()


def test_stream_goes_on_from_its_checkpoint(spark):
    from waymark.streaming import jobs

    place = shared_dir(spark)
    spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "event_id long, event_type string, value double").write.parquet(f"{place}/in")
    schema = "event_id long, event_type string, value double"
    for _ in range(2):
        jobs.insert_stream(jobs.file_stream(spark, f"{place}/in", schema), f"{place}/out", f"{place}/c", "event_id")
    assert spark.read.parquet(f"{place}/out").count() == 2
    spark.createDataFrame([(3, "a", 1.0), (1, "late", 9.0), (None, "a", 1.0), (None, "b", 1.0)], schema).write.mode("append").parquet(f"{place}/in")
    jobs.insert_stream(jobs.file_stream(spark, f"{place}/in", schema), f"{place}/out", f"{place}/c", "event_id")
    assert sorted((r.event_id or 0, r.event_type) for r in spark.read.parquet(f"{place}/out").collect() if r.event_id) == [(1, "a"), (2, "b"), (3, "a")]
    assert spark.read.parquet(f"{place}/out").where("event_id is null").count() == 1


def test_late_rows_are_dropped(spark):
    from waymark.streaming import jobs

    place = shared_dir(spark)
    schema = "ts timestamp, value double"
    for i, rows in enumerate(([("2024-01-01 00:00:10", 1.0), ("2024-01-01 01:00:00", 1.0)], [("2024-01-01 00:00:20", 5.0), ("2024-01-01 02:00:00", 1.0)])):
        spark.createDataFrame(rows, "t string, value double").selectExpr("cast(t as timestamp) ts", "value").coalesce(1).write.mode("append").parquet(f"{place}/in{i}")
    for i in (0, 1):
        spark.read.parquet(f"{place}/in{i}").coalesce(1).write.mode("append").parquet(f"{place}/all")
        jobs.run_to_end(jobs.progress(jobs.file_stream(spark, f"{place}/all", schema)), f"{place}/out", f"{place}/c", "append")
    got = spark.read.parquet(f"{place}/out").where("start = timestamp'2024-01-01 00:00:00'").collect()
    assert [r.n for r in got] == [1]


def test_middle_values_and_ranks(spark):
    import random

    from waymark.operators import records as rec

    rnd = random.Random(2)
    rows = [("o", v) for v in [1e300, -1e300, *(rnd.random() for _ in range(90))]] + [(g, rnd.choice([1.5, 1.5, rnd.random() * 10**k, None])) for g, k in (("a", 1), ("b", 9), ("c", 0)) for _ in range(rnd.randint(30, 61))] + [("d", 7.0), ("e", None)]
    got = {r.g: (r.n, r.lower, r.upper) for r in rec.middle_values(spark.createDataFrame(rows, "g string, v double"), "v", "g", few=3).collect()}
    for g in "abcdo":  # o: outliers beside values that lie close
        own = sorted(v for k, v in rows if k == g and v is not None)
        assert got.pop(g) == (len(own), own[(len(own) - 1) // 2], own[len(own) // 2])
    assert not got
    names = [f"n{rnd.randint(0, 10**6)}" for _ in range(500)]
    found = rec.ranked(spark.createDataFrame([(x,) for x in names], "x string").repartition(7), "x").collect()
    assert [r.x for r in sorted(found, key=lambda r: r["rank"])] == sorted(names) and sorted(r["rank"] for r in found) == list(range(500))


def test_carry_over_ranges(spark):
    from waymark.operators import records as rec

    rows = [(i, f"b{i}" if i in (3, 4, 50) else None) for i in range(120) if i % 7]
    got = {r.i: r.carried for r in rec.carry_over_ranges(spark.createDataFrame(rows, "i long, b string"), "b", "i", 10).collect()}
    last = None
    for i, b in rows:
        last = b or last
        assert got[i] == last


def test_census_refuses_another_plan(spark, tmp_path):
    import pytest

    from waymark.operators.records import Refused
    from waymark.streaming import jobs

    spark.createDataFrame([(1, "a")], "event_id long, event_type string").write.parquet(str(tmp_path / "in"))
    stream = lambda: jobs.file_stream(spark, str(tmp_path / "in"), "event_id long, event_type string")
    jobs.resumable_census(stream(), str(tmp_path / "out"), str(tmp_path / "check"), 2)
    totals = lambda population: [(r.n, r.planned, r.complete) for r in jobs.census_totals(spark, str(tmp_path / "out"), 1, population).collect()]
    assert totals(2) == [(1, True, False)] and totals(1) == [(1, True, True)]  # a short plan is never complete
    # a batch that is replayed replaces its own part
    spark.read.parquet(str(tmp_path / "out" / "batch=0")).cache().write.mode("overwrite").parquet(str(tmp_path / "again"))
    spark.read.parquet(str(tmp_path / "again")).write.mode("overwrite").parquet(str(tmp_path / "out" / "batch=0"))
    assert totals(2) == [(1, True, False)]
    with pytest.raises(Refused):
        jobs.resumable_census(stream(), str(tmp_path / "out"), str(tmp_path / "check"), 3)


def test_character_references(spark):
    import html

    from waymark.functions.text import decoded

    cases = ["a &amp;lt; b", "&notit; &not", "&#39;&#x27;&#8217;&eacute&eacute;", "&#0; &#x110000; &#xD800; &#128; &#129; &#11; &#13;", "& &; &# &#x &zzz; &amp", "&CounterClockwiseContourIntegral;&NotEqualTilde;", "none", "", "&#99999999999999999999999;", "&lt&gt;x&copy2", "x&#x1F600;y&AMP"]
    got = [r.d for r in spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string").select("i", decoded("c").alias("d")).orderBy("i").collect()]
    assert got == [html.unescape(c) for c in cases]


def test_writes_take_absent_values_as_values(spark):
    from waymark.operators import records as rec

    schema = "src long, dst long, note string"
    old = spark.createDataFrame([(1, 2, None), (1, None, "x")], schema)
    same = spark.createDataFrame([(1, 2, None), (1, None, "x"), (1, None, None)], schema)
    assert [tuple(r) for r in rec.insert_absent(old, same, "src", "dst", "note").collect()] == [(1, None, None)]
    c = rec.write_counts(old, same, "edge", "src", "dst", "note").first()
    assert (c.looked_up, c.created, c.already_present) == (3, 1, 2)
    new = spark.createDataFrame([(1, None, "y"), (None, None, "z")], schema)
    assert sorted(map(str, (tuple(r) for r in rec.upsert(old, new, "src", "dst").collect()))) == sorted(map(str, [(1, 2, None), (1, None, "y"), (None, None, "z")]))


def test_gap_samples_against_a_walk(spark):
    import random
    from datetime import datetime, timedelta, timezone

    from pyspark.sql import functions as F

    from waymark.operators.sampling import gap_samples

    rnd = random.Random(6)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    secs = sorted(rnd.choice([rnd.uniform(0, 9000), rnd.uniform(4000, 4100), 7000.0, rnd.uniform(40000, 40500)]) for _ in range(400))
    times = [start + timedelta(microseconds=round(s * 1e6)) for s in secs]
    want, last = [], None
    for i, t in enumerate(times):
        if last is None or t >= last + timedelta(seconds=60):
            last = t
            want.append(t)
    if want[-1] != times[-1]:
        want.append(times[-1])
    df = spark.createDataFrame([(t,) for t in times] + [(None,)], "ts timestamp").repartition(4)
    for size in (4, 64, 1 << 16):
        got = sorted((r.us, r.total) for r in gap_samples(df, F.col("ts"), 60, size).select(F.unix_micros("at").alias("us"), "total").collect())
        assert got == [(round((t - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1)), sum(x <= t for x in times)) for t in want]
    assert gap_samples(df.limit(0), F.col("ts"), 60).count() == 0


def test_lazy_cover_counts_few_sets(spark):
    import random

    from waymark.operators import graph

    rnd = random.Random(8)
    sets = {s: set(rnd.sample(range(400), rnd.randint(1, 12))) for s in range(150)} | {1000: set(range(200)), 1001: set(range(150, 300)), 1002: set(range(290, 340))}
    want, left = [], {s: set(v) for s, v in sets.items()}
    for step in range(1, 4):
        s = min(left, key=lambda x: (-len(left[x]), x))
        want.append((step, s, len(left[s])))
        gone = set(left[s])
        left = {k: v - gone for k, v in left.items()}
    tally = []
    members = spark.createDataFrame([(s, i) for s, v in sets.items() for i in v], "set_id long, item long")
    assert [tuple(r) for r in graph.set_cover(members, 3, tally).orderBy("step").collect()] == want
    assert sum(tally) <= 2 * graph.LAZY  # of three times 153


def test_few_references_need_their_semicolon(spark):
    """F4 to F6: the page queries read eight references, whole ones only; browsers' way is `decoded`."""
    cut = ["<h1>a &amp b&amp</h1>", "<h1>&amp;lt; &copy;&nbsp;&#39;&eacute;</h1>"]
    assert values(spark, text.text_of("x", text.few_decoded), cut) == ["a &amp b&amp", "&lt; © '&eacute;"]
    assert values(spark, text.field_text("x", "h1", text.few_decoded), cut) == ["a &amp b&amp", "&lt; © '&eacute;"]
    assert values(spark, text.text_of("x"), cut) == ["a & b&", "&lt; © 'é"]
    pages = spark.createDataFrame([(1, cut[0])], "page_id long, html string")
    assert pg.page_records(pages, text.few_decoded).first().title == "a &amp b&amp"


def _parts(spark, tmp_path, rows):
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_programmes_once_where_codes_collide(spark, tmp_path):
    """keys of seven digits are cut to six, so a code and its name can come twice."""
    from waymark.plans import catalogue
    from waymark.plans.questions import SOC, SOC2

    n = 1000000
    place = _parts(spark, tmp_path, [(k, "x", "b", "t", 1, 1.0) for k in [*range(100000, 100200), *range(n, n + 2000)]])
    for name, soc in (("Q22_programmes_for", SOC), ("Q47_now_licensed", SOC2)):
        got = [tuple(r) for r in catalogue.QUERIES[name](spark, place).collect()]
        assert got and len(got) == len(set(got)), (name, soc)


def test_tally_medians_are_exact(spark, tmp_path):
    """the median of what arrives in several batches, also of a type without durations."""
    from waymark.streaming import jobs

    rows = [("a", float(v)) for v in [*range(100), 7, 7, 1000]] + [("b", None), ("c", 1.0), ("c", 2.5)]
    df = spark.createDataFrame(rows, "event_type string, value double")
    for k in range(3):
        df.where(F.coalesce(F.col("value"), F.lit(0.0)).cast("int") % 3 == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    jobs.durations_to_end(jobs.file_stream(spark, f"{tmp_path}/in", df.schema), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = {r.event_type: tuple(r)[1:] for r in jobs.tally_totals(spark, f"{tmp_path}/out").collect()}
    assert got == {"a": (103, 1000.0, 49.0), "b": (1, None, None), "c": (2, 2.5, 1.8)}


def test_written_steps_broadcast_small_tables_only(spark, monkeypatch):
    """F11 and the like: what is broadcast passes through the driver, so loops must not broadcast tables that grow."""
    from pyspark.sql import DataFrameWriter

    from waymark.sources.shared import materialize

    plans, write = [], DataFrameWriter.parquet

    def spy(self, path, *a, **kw):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *a, **kw)

    big = materialize(spark.range(100_000).select(F.xxhash64("id").alias("h"), "id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    materialize(big.join(big.withColumnRenamed("id", "other"), "h"))
    assert "BroadcastHashJoin" not in plans[0] and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


def test_pages_are_dealt_by_their_number(spark):
    """Catalogue pages are made and read in a task for each so many rows, however few bytes they have; filters stay above."""
    from waymark.plans import columns
    from waymark.sources import shared
    from waymark.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    n = t.v_course.count()
    rows = shared.dealt(t.v_course, "course_id", rows=20)
    assert rows.rdd.getNumPartitions() == -(-n // 20) > 4 and rows.count() == n
    assert shared.dealt(t.v_course.limit(0), "course_id").count() == 0
    plan = columns.p16_catalogue(t)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # pages are read where they are written


def test_only_routes_in_place_sort_nothing(spark):
    from waymark.plans import measures
    from waymark.sources.tables import Tables

    plan = measures.j10(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
