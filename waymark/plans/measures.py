"""Joins, aggregations, windows, set operations and quality measures (J, A, W, X, M)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from waymark.functions import keys, text
from waymark.functions.keys import NOT_OCCUPATIONS, TOTAL
from waymark.operators import pages as pg
from waymark.operators import records as rec
from waymark.operators import sampling, structure
from waymark.plans.columns import _HOST, _PATH, sheet
from waymark.plans.registry import query
from waymark.sources import readers
from waymark.sources.shared import materialize



def pct(part, whole, digits: int = 1):
    """Percent to a number of digits, half to even; null over nothing."""
    return F.bround(100.0 * part / F.nullif(whole, F.lit(0)), digits)


# ---- joins


@query("J1_resolved_links", """WITH link AS (SELECT src, dst AS href, ROW_NUMBER() OVER (PARTITION BY src, dst ORDER BY dst) AS n FROM (SELECT src, dst FROM v_requires UNION ALL SELECT src, dst FROM v_requires WHERE src % 10 = 0 UNION ALL SELECT course_id, course_id + 1000000 FROM v_course WHERE course_id % 50 = 0))
  SELECT CASE WHEN n > 1 THEN 'duplicated' WHEN href % 7 <> 0 AND EXISTS (SELECT 1 FROM v_course c WHERE c.course_id = href) THEN 'resolved' WHEN EXISTS (SELECT 1 FROM v_course c WHERE c.course_id = href) THEN 'off-level' ELSE 'unresolved' END AS outcome, count(*) AS n FROM link GROUP BY 1""")
def j1(t):
    """Prerequisite links against courses and pages: every seventh page is none of the courses."""
    e = t.v_requires
    far = t.v_course.where("course_id % 50 = 0").select("course_id", F.col("course_id") + 1000000)
    links = e.union(e.where("src % 10 = 0")).union(far).toDF("src", "href").withColumn("pos", F.col("href"))
    pages = t.v_course.select(F.col("course_id").alias("path"))
    found = pg.resolved_links(links, pages, pages.where("path % 7 <> 0"))
    return found.groupBy("outcome").agg(F.count("*").alias("n"))


@query("J2_pathway_edges", """WITH r AS (SELECT *, row_number() OVER (PARTITION BY pathway_id, course_id ORDER BY pos) AS n FROM v_pathway_rows)
  SELECT CASE WHEN n > 1 THEN 'duplicated' WHEN course_id % 9 = 0 THEN 'unresolved' WHEN course_id % 7 = 0 THEN 'off-level' ELSE 'resolved' END AS outcome, count(*) AS rows, count(DISTINCT concat(pathway_id, '|', course_id)) AS edges FROM r GROUP BY 1""")
def j2(t):
    """Pathway rows against published pages: every ninth course has none, every seventh page is none of a course."""
    pages = t.v_course.where("course_id % 9 <> 0").select(F.col("course_id").alias("path"))
    links = t.v_pathway_rows.select(F.col("pathway_id").alias("src"), F.col("course_id").alias("href"), "pos")
    found = pg.resolved_links(links, pages, pages.where("path % 7 <> 0"))
    return found.groupBy("outcome").agg(F.count("*").alias("rows"), F.count_distinct("src", "href").alias("edges"))


@query("J3_courses_to_subjects", "SELECT CASE WHEN right(subject, 1) = '3' THEN 'orphan' WHEN right(subject, 1) = '4' THEN 'off-level' ELSE 'attached' END AS outcome, count(*) AS n FROM v_course GROUP BY 1")
def j3(t):
    """Courses by whether their subject has a page, and that a subject's: pages of subjects in 3 are missing, those in 4 are courses'."""
    last = F.right("subject", F.lit(1))
    pages = t.v_in_subject.where(last != "3").select("subject", F.when(last == "4", "course").otherwise("subject").alias("page")).distinct()
    outcome = F.when(F.col("page").isNull(), "orphan").when(F.col("page") == "subject", "attached").otherwise("off-level")
    return t.v_course.join(pages, "subject", "left").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query("J4_crosswalk_scope", "SELECT (p.cip_code IS NOT NULL) AS in_scope, count(*) AS mappings FROM v_prepares_for m LEFT JOIN (SELECT DISTINCT cip_code FROM v_completion WHERE awards > 40) p ON p.cip_code = m.cip_code GROUP BY 1")
def j4(t):
    loaded = rec.refuse_empty(t.v_completion.where("awards > 40").select("cip_code").distinct(), "the table of loaded programmes")
    flagged = t.v_prepares_for.join(loaded.withColumn("there", F.lit(True)), "cip_code", "left")
    return flagged.groupBy(F.coalesce("there", F.lit(False)).alias("in_scope")).agg(F.count("*").alias("mappings"))


@query("J5_one_hop", "SELECT i.unitid, i.state, l.place_id FROM v_institution i JOIN v_located_in l ON l.unitid = i.unitid")
def j5(t):
    return t.v_institution.join(t.v_located_in, "unitid").select("unitid", "state", "place_id")


@query("J6_many_hops", "SELECT DISTINCT l.place_id, m.soc_code FROM v_located_in l JOIN v_offers o ON o.unitid = l.unitid JOIN v_prepares_for m ON m.cip_code = o.cip_code WHERE m.soc_code LIKE '11-%'")
def j6(t):
    """Places and occupations they reach; pairs are made distinct before each further hop."""
    mapped = t.v_prepares_for.where(F.col("soc_code").startswith("11-")).select("cip_code", "soc_code").distinct()
    placed = t.v_offers.join(t.v_located_in, "unitid").select("place_id", "cip_code").distinct()
    return placed.join(mapped, "cip_code").select("place_id", "soc_code").distinct()


@query("J7_semi", "SELECT course_id FROM v_course c WHERE EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id)")
def j7(t):
    return t.v_course.select("course_id").join(t.v_requires.select(F.col("src").alias("course_id")), "course_id", "left_semi")


@query("J8_anti", "SELECT course_id FROM v_course c WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id)")
def j8(t):
    return t.v_course.select("course_id").join(t.v_requires.select(F.col("src").alias("course_id")), "course_id", "left_anti")


@query("J9_anti_and_semi", "SELECT course_id FROM v_course c WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id) AND EXISTS (SELECT 1 FROM v_requires r WHERE r.dst = c.course_id) AND NOT EXISTS (SELECT 1 FROM v_includes i WHERE i.course_id = c.course_id AND i.pathway_id = 3)")
def j9(t):
    e, c = t.v_requires, t.v_course.select("course_id")
    return c.join(e, c.course_id == e.src, "left_anti").join(e, c.course_id == e.dst, "left_semi").join(t.v_includes.where("pathway_id = 3"), "course_id", "left_anti")


@query("J10_only_route_in_place", """WITH r AS (SELECT DISTINCT l.place_id, m.soc_code, o.unitid FROM v_located_in l JOIN v_offers o ON o.unitid = l.unitid JOIN v_prepares_for m ON m.cip_code = o.cip_code)
  SELECT place_id, soc_code, min(unitid) AS unitid FROM r GROUP BY place_id, soc_code HAVING count(DISTINCT unitid) = 1""")
def j10(t):
    """Occupations that one institution alone serves in its place: the anti-join for all institutions at once.

    Institutions are numbered, so that the least and the greatest of an occupation
    are hash-aggregated where routes meet and nothing is sorted. Neither minds
    routes that repeat, so every row of completions stands for an offer.
    """
    units = materialize(t.v_located_in.distinct().withColumn("no", F.monotonically_increasing_id()))
    placed = t.v_completion.select("unitid", "cip_code").join(units, "unitid")
    r = placed.join(t.v_prepares_for.hint("shuffle_hash"), "cip_code").groupBy("place_id", "soc_code").agg(F.min("no").alias("no"), F.max("no").alias("other"))
    return r.where("no = other").join(units.select("no", "unitid"), "no").select("place_id", "soc_code", "unitid")


@query("J11_required_not_listed", "SELECT DISTINCT i.pathway_id, r.dst AS need FROM v_includes i JOIN v_requires r ON r.src = i.course_id WHERE NOT EXISTS (SELECT 1 FROM v_includes o WHERE o.pathway_id = i.pathway_id AND o.course_id = r.dst)")
def j11(t):
    i, e = t.v_includes, t.v_requires
    need = i.join(e, i.course_id == e.src).select("pathway_id", F.col("dst").alias("need")).distinct()
    return need.join(i.select("pathway_id", F.col("course_id").alias("need")), ["pathway_id", "need"], "left_anti")


@query("J12_optional_counts", "SELECT p.cip_code, (SELECT count(DISTINCT soc_code) FROM v_prepares_for m WHERE m.cip_code = p.cip_code) AS occupations, (SELECT count(*) FROM v_offers o WHERE o.cip_code = p.cip_code) AS institutions, (SELECT CAST(coalesce(sum(awards), 0) AS BIGINT) FROM v_completion c WHERE c.cip_code = p.cip_code) AS awards FROM v_programme p")
def j12(t):
    """Every branch is counted before the join, so none multiplies another."""
    a = t.v_prepares_for.groupBy("cip_code").agg(F.count_distinct("soc_code").alias("occupations"))
    b = t.v_offers.groupBy("cip_code").agg(F.count("*").alias("institutions"))
    c = t.v_completion.groupBy("cip_code").agg(F.sum("awards").alias("awards"))
    return t.v_programme.select("cip_code").join(a, "cip_code", "left").join(b, "cip_code", "left").join(c, "cip_code", "left").fillna(0)


_CARRY = "SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS signup, event_type FROM events"


@query("J13_as_of", f"SELECT event_id, signup FROM ({_CARRY}) WHERE event_type = 'purchase'")
def j13(t):
    """The last signup of the same user before each purchase."""
    e = t.events.withColumn("_o", F.struct("ts", "event_id"))
    return rec.carry_forward(e, F.when(F.col("event_type") == "signup", F.col("event_id")), "_o", "user_id").where("event_type = 'purchase'").select("event_id", F.col("carried").alias("signup"))


@query("J14_theta_pairs", "SELECT a.soc_code, count(*) AS pairs FROM (SELECT DISTINCT cip_code, soc_code FROM v_prepares_for) a JOIN (SELECT DISTINCT cip_code, soc_code FROM v_prepares_for) b ON a.soc_code = b.soc_code AND a.cip_code < b.cip_code GROUP BY a.soc_code")
def j14(t):
    """Pairs of programmes with a common occupation, counted: n(n - 1) / 2 for each, without forming the pairs."""
    n = t.v_prepares_for.groupBy("soc_code").agg(F.count_distinct("cip_code").alias("n")).where("n > 1")
    return n.select("soc_code", F.expr("n * (n - 1) div 2").alias("pairs"))


@query("J15_points_at_both", "SELECT cip_code FROM v_prepares_for GROUP BY cip_code HAVING bool_or(soc_code LIKE '11-%') AND bool_or(soc_code LIKE '13-%')")
def j15(t):
    hit = t.v_prepares_for.groupBy("cip_code").agg(F.bool_or(F.col("soc_code").startswith("11-")).alias("a"), F.bool_or(F.col("soc_code").startswith("13-")).alias("b"))
    return hit.where("a and b").select("cip_code")


@query("J16_latest", "SELECT soc_code, year, median FROM (SELECT *, rank() OVER (PARTITION BY soc_code ORDER BY year DESC) AS r FROM v_earnings) WHERE r = 1")
def j16(t):
    """Records of each occupation's latest year, ties kept."""
    e = t.v_earnings
    latest = e.groupBy("soc_code").agg(F.max("year").alias("year"))
    return e.join(latest, ["soc_code", "year"]).select("soc_code", "year", "median")


@query("J17_above_midpoint", "SELECT soc_code, count(*) AS above FROM v_earnings WHERE median > (SELECT median FROM v_earnings ORDER BY median LIMIT 1 OFFSET (SELECT CAST(floor(count(*) / 2) AS BIGINT) FROM v_earnings)) GROUP BY soc_code")
def j17(t):
    from waymark.plans.questions import midpoint

    return t.v_earnings.crossJoin(F.broadcast(midpoint(t))).where("median > midpoint").groupBy("soc_code").agg(F.count("*").alias("above"))  # one row


@query("J18_title_match", """WITH c AS (SELECT p_name AS title, p_brand AS code FROM part WHERE p_partkey % 2 = 0), k AS (SELECT title, count(DISTINCT code) FILTER (WHERE code NOT LIKE '%#1%') AS n_pure, min(code) FILTER (WHERE code NOT LIKE '%#1%') AS pure, min(code) AS any_code, count(DISTINCT code) AS n_any FROM c GROUP BY title)
  SELECT p_partkey, coalesce(pure, any_code) AS code, (CASE WHEN pure IS NOT NULL THEN n_pure ELSE n_any END > 1) AS tied FROM part LEFT JOIN k ON k.title = p_name WHERE p_partkey % 2 = 1""")
def j18(t):
    """Titles of one catalogue to codes of another: pure codes before extensions, the lowest wins, ties are told."""
    key = text.normalised_title("p_name")
    other = t.part.where("p_partkey % 2 = 0").select(key.alias("key"), F.col("p_brand").alias("code")).distinct()
    pure = ~F.contains("code", F.lit("#1"))
    best = other.groupBy("key").agg(F.min(F.when(pure, F.col("code"))).alias("pure"), F.count_if(pure).alias("n_pure"), F.min("code").alias("low"), F.count("*").alias("n"))
    joined = t.part.where("p_partkey % 2 = 1").select("p_partkey", key.alias("key")).join(best, "key", "left")
    return joined.select("p_partkey", F.coalesce("pure", "low").alias("code"), (F.when(F.col("pure").isNotNull(), F.col("n_pure")).otherwise(F.col("n")) > 1).alias("tied"))


@query("J19_parent_fallback", """WITH held AS (SELECT soc_code FROM v_occ WHERE right(soc_code, 1) IN ('0', '2', '4'))
  SELECT soc_code, CASE WHEN soc_code IN (SELECT soc_code FROM held) THEN 'exact' WHEN soc_code LIKE '55%' THEN 'military' WHEN concat(left(soc_code, 6), '0') IN (SELECT soc_code FROM held) THEN 'rolled-up' ELSE 'absent' END AS bucket FROM v_occ""")
def j19(t):
    occ = t.v_occ
    held = occ.where(F.right("soc_code", F.lit(1)).isin("0", "2", "4"))
    broad = F.concat(F.left("soc_code", F.lit(6)), F.lit("0"))
    j = occ.withColumn("broad", broad).join(held.select("soc_code", F.lit(1).alias("e")), "soc_code", "left").join(held.select(F.col("soc_code").alias("broad"), F.lit(1).alias("p")), "broad", "left")
    return j.select("soc_code", F.when(F.col("e").isNotNull(), "exact").when(F.col("soc_code").startswith("55"), "military").when(F.col("p").isNotNull(), "rolled-up").otherwise("absent").alias("bucket"))


@query("J20_links_published", """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages), p AS (SELECT DISTINCT href FROM l WHERE length(href) % 2 = 0)
  SELECT page_id, count(*) AS links, count(p.href) AS resolved, CASE WHEN count(p.href) = count(*) THEN 'fully' WHEN count(p.href) = 0 THEN 'broken' ELSE 'partly' END AS verdict FROM l LEFT JOIN p ON p.href = l.href GROUP BY page_id""")
def j20(t):
    links = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)).alias("href"))
    published = links.where(F.length("href") % 2 == 0).select("href", F.lit(1).alias("there")).distinct()
    n, k = F.count("*"), F.count("there")
    return links.join(published, "href", "left").groupBy("page_id").agg(n.alias("links"), k.alias("resolved"), F.when(k == n, "fully").when(k == 0, "broken").otherwise("partly").alias("verdict"))


@query("J23_requirements", """SELECT label, count(*) AS edges, count(DISTINCT CASE WHEN label <> 'skipped' THEN id END) AS nodes FROM (SELECT CASE role WHEN 'user' THEN 'Course' WHEN 'assistant' THEN 'Pathway' ELSE 'skipped' END AS label, sha1(concat(CAST(conv_id AS VARCHAR), '|', trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS id FROM conversations WHERE trim(text) <> '') GROUP BY label""")
def j23(t):
    """Requirement edges and nodes from course and pathway records, one node for each owner and text; records of subject pages are counted and skipped."""
    c = t.conversations.where(F.trim("text") != "")
    label = F.when(F.col("role") == "user", "Course").when(F.col("role") == "assistant", "Pathway").otherwise("skipped")
    parts = c.select(label.alias("label"), keys.requirement_id("conv_id", "text").alias("id"))
    return parts.groupBy("label").agg(F.count("*").alias("edges"), F.count_distinct(F.when(F.col("label") != "skipped", F.col("id"))).alias("nodes"))


# ---- aggregations


@query("A1_count", "SELECT count(*) AS n FROM v_completion")
def a1(t):
    return t.v_completion.agg(F.count("*").alias("n"))


@query("A2_distinct", "SELECT count(DISTINCT unitid) AS units, count(DISTINCT cip_code) AS programmes FROM v_completion")
def a2(t):
    return t.v_completion.agg(F.count_distinct("unitid").alias("units"), F.count_distinct("cip_code").alias("programmes"))


@query("A2_approximate", "SELECT field, count(DISTINCT v) AS exact, TRUE AS within FROM (SELECT 'unitid' AS field, unitid AS v FROM v_completion UNION ALL SELECT 'cip_code', cip_code FROM v_completion UNION ALL SELECT 'pos', CAST(pos AS VARCHAR) FROM v_completion) GROUP BY field")
def a2_approximate(t):
    """Distinct values by mergeable sketches, a row of bytes for each task, beside the exact counts; within: off by no more than the sketches' bound."""
    c = t.v_completion
    long = c.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in ("unitid", "cip_code", "pos")))).alias("x")).select("x.*")
    about = long.groupBy("field").agg(F.hll_sketch_estimate(F.hll_sketch_agg("v", structure.LG_K)).alias("about"))
    exact = long.groupBy("field").agg(F.count_distinct("v").alias("exact"))
    return exact.join(about, "field").select("field", "exact", (F.abs(F.col("about") - F.col("exact")) <= F.lit(structure.SIGMAS * structure.ERROR) * F.col("exact") + 1).alias("within"))


@query("A3_group_count", "SELECT subject, count(*) AS courses FROM v_course GROUP BY subject ORDER BY courses DESC, subject LIMIT 10")
def a3(t):
    return t.v_course.groupBy("subject").agg(F.count("*").alias("courses")).orderBy(F.desc("courses"), "subject").limit(10)


@query("A4_group_figures", "SELECT unitid, CAST(sum(awards) AS BIGINT) AS total, max(awards) AS most, min(awards) AS least, string_agg(DISTINCT race, ',' ORDER BY race) AS races FROM v_completion GROUP BY unitid")
def a4(t):
    return t.v_completion.groupBy("unitid").agg(F.sum("awards").alias("total"), F.max("awards").alias("most"), F.min("awards").alias("least"), F.array_join(F.array_sort(F.collect_set("race")), ",").alias("races"))


@query("A5_having", "SELECT cip_code FROM v_prepares_for GROUP BY cip_code HAVING count(DISTINCT soc_code) = 1")
def a5(t):
    return t.v_prepares_for.groupBy("cip_code").agg(F.count_distinct("soc_code").alias("n")).where("n = 1").select("cip_code")


@query("A6_totals_and_breakdowns", """SELECT cip_code, CAST(sum(awards) AS BIGINT) AS naive, CAST(sum(CASE WHEN race = '99' AND sex = '99' THEN awards ELSE 0 END) AS BIGINT) AS totals, CAST(sum(CASE WHEN race <> '99' AND sex <> '99' THEN awards ELSE 0 END) AS BIGINT) AS breakdowns,
  CAST(sum(CASE WHEN race = '99' AND sex = '99' AND majornum = 1 THEN awards ELSE 0 END) AS BIGINT) AS first_majors, sum(CASE WHEN race = '99' AND sex = '99' THEN awards ELSE 0 END) = sum(CASE WHEN race <> '99' AND sex <> '99' THEN awards ELSE 0 END) AS agree FROM v_completion_demo GROUP BY cip_code""")
def a6(t):
    total, part = (F.col("race") == TOTAL) & (F.col("sex") == TOTAL), (F.col("race") != TOTAL) & (F.col("sex") != TOTAL)
    add = lambda c: F.sum(F.when(c, F.col("awards")).otherwise(0))
    # sums of sums: levels and institutions go before the totals are formed, which multiply rows
    few = t.v_completion.groupBy("cip_code", "majornum", "race", "sex").agg(F.sum("awards").alias("awards"))
    keys = ("cip_code", "majornum")
    sums = few.groupingSets([(*keys, "race", "sex"), (*keys, "race"), (*keys, "sex"), keys], *keys, "race", "sex").agg(F.sum("awards").alias("awards"))
    demo = sums.withColumns({c: F.coalesce(c, F.lit(TOTAL)) for c in ("race", "sex")})
    out = demo.groupBy("cip_code").agg(F.sum("awards").alias("naive"), add(total).alias("totals"), add(part).alias("breakdowns"), add(total & (F.col("majornum") == 1)).alias("first_majors"))
    return out.withColumn("agree", F.col("totals") == F.col("breakdowns"))


@query("A7_distinct_then_count", "SELECT count(*) AS units FROM (SELECT DISTINCT unitid FROM v_completion WHERE awards > 20)")
def a7(t):
    return t.v_completion.where("awards > 20").select("unitid").distinct().agg(F.count("*").alias("units"))


@query("A8_key_collisions", """WITH six AS (SELECT unitid, cip_code, race, sex, year, majornum, sum(awards) AS a FROM v_completion GROUP BY ALL), five AS (SELECT unitid, cip_code, race, sex, year, count(*) AS n, count(*) FILTER (WHERE a > 0) AS positive, sum(a) - max(a) AS lost FROM six GROUP BY unitid, cip_code, race, sex, year)
  SELECT CAST(sum(n) AS BIGINT) AS long_keys, count(*) AS short_keys, count(*) FILTER (WHERE n > 1) AS merged, count(*) FILTER (WHERE positive > 1) AS losing, CAST(sum(lost) AS BIGINT) AS amount_lost FROM five""")
def a8(t):
    return rec.key_collisions(t.v_completion, ["unitid", "cip_code", "race", "sex", "year"], "majornum", "awards")


@query("A9_folded_edges", """WITH s AS (SELECT pathway_id, course_id, section, min(pos) AS first_pos FROM v_pathway_rows WHERE section IS NOT NULL AND section <> '' GROUP BY ALL), j AS (SELECT pathway_id, course_id, string_agg(section, ' | ' ORDER BY first_pos, section) AS section, CAST(count(*) AS INT) AS sections FROM s GROUP BY pathway_id, course_id)
  SELECT r.pathway_id, r.course_id, any_value(j.section) AS section, coalesce(any_value(j.sections), 0) AS sections, count(*) AS n_rows, arg_min(r.credits, r.pos) AS credits, count(DISTINCT r.credits) > 1 AS conflict FROM v_pathway_rows r LEFT JOIN j ON j.pathway_id = r.pathway_id AND j.course_id = r.course_id GROUP BY r.pathway_id, r.course_id""")
def a9(t):
    return rec.fold_rows(t.v_pathway_rows)


@query("A10_coverage", "SELECT field, level, count(*) AS n_rows, count(*) FILTER (WHERE regexp_full_match(v, '[0-9]+')) AS published, count(*) FILTER (WHERE v = 'PS') AS suppressed, count(*) FILTER (WHERE v = 'NA') AS not_applicable, round_even(100.0 * CAST(count(*) FILTER (WHERE regexp_full_match(v, '[0-9]+')) AS DOUBLE) / count(*), 1) AS share FROM (SELECT level, 'm1' AS field, m1 AS v FROM v_earnings_raw UNION ALL SELECT level, 'm2', m2 FROM v_earnings_raw UNION ALL SELECT level, 'm3', m3 FROM v_earnings_raw) GROUP BY field, level")
def a10(t):
    long = t.v_earnings_raw.unpivot(["unitid", "level"], ["m1", "m2", "m3"], "field", "v")
    return long.groupBy("field", "level").agg(F.count("*").alias("n_rows"), F.count_if(F.col("v").rlike(r"\A[0-9]+\z")).alias("published"), F.count_if(F.col("v") == "PS").alias("suppressed"), F.count_if(F.col("v") == "NA").alias("not_applicable"), pct(F.count_if(F.col("v").rlike(r"\A[0-9]+\z")), F.count("*")).alias("share"))


@query("A10_shares", "SELECT field, round_even(100.0 * CAST(p AS DOUBLE) / n, 1) AS share FROM (SELECT field, count(*) AS n, count(*) FILTER (WHERE regexp_full_match(v, '[0-9]+')) AS p FROM (SELECT 'm1' AS field, m1 AS v FROM v_earnings_raw UNION ALL SELECT 'm2', m2 FROM v_earnings_raw) GROUP BY field)")
def a10_shares(t):
    long = t.v_earnings_raw.unpivot(["unitid"], ["m1", "m2"], "field", "v")
    return long.groupBy("field").agg(pct(F.count_if(F.col("v").rlike(r"\A[0-9]+\z")), F.count("*")).alias("share"))


_FLAGS = " UNION ALL ".join(f"SELECT '{f}' AS flag, {f} AS v FROM v_flags" for f in ("flag1", "flag2", "flag3", "flag4"))


@query("A11_flag_census", f"SELECT flag, count(*) FILTER (WHERE v = 1) AS grants, count(*) FILTER (WHERE v = 0) AS does_not, count(*) FILTER (WHERE v >= 0) AS answered, count(*) FILTER (WHERE v = -1) AS not_reported, count(*) FILTER (WHERE v = -2) AS not_applicable, count(*) FILTER (WHERE v = -3) AS poor, round_even(100.0 * CAST(count(*) FILTER (WHERE v = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE v >= 0), 0), 1) AS share_of_answered FROM ({_FLAGS}) GROUP BY flag")
def a11(t):
    long = t.v_flags.unpivot(["s_suppkey"], ["flag1", "flag2", "flag3", "flag4"], "flag", "v")
    n = lambda c: F.count_if(c)
    v = F.col("v")
    return long.groupBy("flag").agg(n(v == 1).alias("grants"), n(v == 0).alias("does_not"), n(v >= 0).alias("answered"), n(v == -1).alias("not_reported"), n(v == -2).alias("not_applicable"), n(v == -3).alias("poor"), pct(n(v == 1), n(v >= 0)).alias("share_of_answered"))


@query("A12_multiplicities", "SELECT rows_per_key, count(*) AS n_keys FROM (SELECT l_orderkey, count(*) AS rows_per_key FROM lineitem GROUP BY l_orderkey) GROUP BY rows_per_key")
def a12(t):
    return rec.spread(t.lineitem, "l_orderkey")


@query("A13_lifecycle", "SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS closed, count(*) FILTER (WHERE o_custkey % 3 = 0) AS succeeded, count(*) FILTER (WHERE o_orderstatus = 'F' AND o_custkey % 3 = 0) AS both_set, count(DISTINCT CASE WHEN o_custkey % 3 = 0 THEN o_custkey END) AS targets FROM orders")
def a13(t):
    closed, succ = F.col("o_orderstatus") == "F", F.col("o_custkey") % 3 == 0
    return t.orders.agg(F.count_if(closed).alias("closed"), F.count_if(succ).alias("succeeded"), F.count_if(closed & succ).alias("both_set"), F.count_distinct(F.when(succ, F.col("o_custkey"))).alias("targets"))


@query("A14_overlap_by_group", """WITH a AS (SELECT soc_code FROM v_occ WHERE right(soc_code, 1) IN ('1', '2', '3', '4', '5')), b AS (SELECT soc_code FROM v_occ WHERE right(soc_code, 1) IN ('4', '5', '6'))
  SELECT left(soc_code, 2) AS major, count(*) AS mine, count(*) FILTER (WHERE soc_code IN (SELECT soc_code FROM b)) AS shared, count(*) FILTER (WHERE soc_code NOT IN (SELECT soc_code FROM b)) AS exclusive, round_even(100.0 * CAST(count(*) FILTER (WHERE soc_code NOT IN (SELECT soc_code FROM b)) AS DOUBLE) / count(*), 1) AS share FROM a GROUP BY left(soc_code, 2) ORDER BY exclusive DESC, major""")
def a14(t):
    last = F.right("soc_code", F.lit(1))
    a, b = t.v_occ.where(last.isin(*"12345")), t.v_occ.where(last.isin(*"456")).withColumn("b", F.lit(1))
    return a.join(b, "soc_code", "left").groupBy(F.left("soc_code", F.lit(2)).alias("major")).agg(F.count("*").alias("mine"), F.count("b").alias("shared"), F.count_if(F.col("b").isNull()).alias("exclusive"), pct(F.count_if(F.col("b").isNull()), F.count("*")).alias("share")).orderBy(F.desc("exclusive"), "major")


@query("A15_fan_out", "SELECT count(*) AS parents, count(*) FILTER (WHERE n = 1) AS single, count(*) FILTER (WHERE n > 1) AS several, max(n) AS largest, min(soc_code) FILTER (WHERE n = 2) AS largest_code FROM (SELECT split_part(onet_code, '.', 1) AS soc_code, count(*) AS n FROM v_onet GROUP BY 1)")
def a15(t):
    n = t.v_onet.groupBy(keys.soc_of("onet_code").alias("soc_code")).agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("parents"), F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("several"), F.max("n").alias("largest"), F.max_by("soc_code", F.struct("n", F.translate("soc_code", "0123456789", "9876543210"))).alias("largest_code"))


@query("A16_hierarchy", "SELECT left(cip_code, 4) AS prefix, bool_or(right(cip_code, 2) = '00') AS has_family, count(*) AS n FROM v_programme GROUP BY left(cip_code, 4)")
def a16(t):
    return t.v_programme.groupBy(F.left("cip_code", F.lit(4)).alias("prefix")).agg(F.bool_or(F.right("cip_code", F.lit(2)) == "00").alias("has_family"), F.count("*").alias("n"))


@query("A17_unpivot_agrees", "SELECT count(*) AS wide, 3 * count(*) AS long, CAST(sum(CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS first_total, (SELECT count(*) FROM (UNPIVOT (SELECT CAST(l_quantity AS BIGINT) AS a, CAST(l_suppkey AS BIGINT) AS b, CAST(l_partkey AS BIGINT) AS c FROM lineitem) ON a, b, c INTO NAME f VALUE v)) = 3 * count(*) AS agrees FROM lineitem")
def a17(t):
    wide = t.lineitem.select("l_linenumber", *(F.col(c).cast("bigint").alias(c) for c in ("l_quantity", "l_suppkey", "l_partkey")))
    long = wide.unpivot(["l_linenumber"], ["l_quantity", "l_suppkey", "l_partkey"], "column", "v").agg(F.count("*").alias("long"))
    one = wide.agg(F.count("*").alias("wide"), F.sum(F.when(F.col("l_linenumber") == 1, F.col("l_quantity")).otherwise(0)).alias("first_total"))
    return one.crossJoin(long).select("wide", "long", "first_total", (F.col("wide") * 3 == F.col("long")).alias("agrees"))  # one row each


@query("A19_field_coverage", "SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key")
def a19(t):
    return t.events.select(F.explode(F.json_object_keys("props")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


@query("A20_census_with_remainder", "SELECT event_type AS kind, count(*) AS n FROM events WHERE event_type IN ('view', 'click') GROUP BY event_type UNION ALL SELECT 'remainder', count(*) FROM events WHERE event_type NOT IN ('view', 'click')")
def a20(t):
    kind = F.when(F.col("event_type").isin("view", "click"), F.col("event_type")).otherwise("remainder")
    return t.events.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("A21_run_tally", """SELECT event_type AS workflow, count(*) AS runs, count(*) FILTER (WHERE user_id % 3 = 0) AS success, count(*) FILTER (WHERE user_id % 3 = 1) AS failure, count(*) FILTER (WHERE user_id % 3 = 2) AS other,
  count(*) FILTER (WHERE event_id % 11 = 0) AS unfinished, count(value) FILTER (WHERE event_id % 11 <> 0) AS timed, round_even(median(value) FILTER (WHERE event_id % 11 <> 0), 1) AS median, max(value) FILTER (WHERE event_id % 11 <> 0) AS longest, count(*) FILTER (WHERE value > 50 AND event_id % 11 <> 0) AS over_floor,
  CAST(min(event_id) AS BIGINT) AS first_run, CAST(max(event_id) AS BIGINT) AS last_run FROM events GROUP BY event_type""")
def a21(t):
    """Runs by workflow. Every eleventh is unfinished: it has no duration, whatever its value says."""
    kind = F.col("user_id") % 3
    runs = t.events.withColumn("seconds", F.when(F.col("event_id") % 11 != 0, F.col("value")))
    out = runs.groupBy("event_type").agg(F.count("*").alias("runs"), F.count_if(kind == 0).alias("success"), F.count_if(kind == 1).alias("failure"), F.count_if(kind == 2).alias("other"), F.count_if(F.col("event_id") % 11 == 0).alias("unfinished"), F.count("seconds").alias("timed"), F.max("seconds").alias("longest"), F.count_if(F.col("seconds") > 50).alias("over_floor"), F.min("event_id").alias("first_run"), F.max("event_id").alias("last_run"))
    mid = rec.middle_values(runs, "seconds", "event_type").select("event_type", F.bround((F.col("lower") + F.col("upper")) / 2, 1).alias("median"))
    return out.join(mid, "event_type", "left").withColumnRenamed("event_type", "workflow")


@query("A22_band_stats", "SELECT CASE WHEN l_quantity < 10 THEN '0-9' WHEN l_quantity < 25 THEN '10-24' ELSE '25+' END AS band, count(*) AS n, round_even(avg(l_linenumber), 1) AS mean, max(l_quantity) AS worst FROM lineitem GROUP BY 1")
def a22(t):
    return t.lineitem.groupBy(pg.band("l_quantity", (10, 25)).alias("band")).agg(F.count("*").alias("n"), F.bround(F.avg("l_linenumber"), 1).alias("mean"), F.max("l_quantity").alias("worst"))


@query("A23_kinds_by_host", f"SELECT host, count(*) FILTER (WHERE kind = 'course') AS course, count(*) FILTER (WHERE kind = 'subject') AS subject, count(*) FILTER (WHERE kind IS NULL) AS other FROM (SELECT {_HOST} AS host, CASE len(list_filter(string_split({_PATH}, '/'), lambda x: x <> '')) WHEN 1 THEN 'subject' WHEN 2 THEN 'course' END AS kind FROM pages) GROUP BY host")
def a23(t):
    p = t.pages.select(text.host_of("url").alias("host"), text.level(text.path_of("url")).alias("kind"))
    return p.groupBy("host").agg(F.count_if(F.col("kind") == "course").alias("course"), F.count_if(F.col("kind") == "subject").alias("subject"), F.count_if(F.col("kind").isNull()).alias("other"))


_CENSUS = (("v_completion", "TRUE"), ("v_institution", "FALSE"), ("v_prepares_for", "TRUE"), ("v_geo", "FALSE"))


@query("A24_table_census", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows, {c} AS has_cip, CASE WHEN count(*) = 0 THEN 'empty' ELSE 'read' END AS status FROM {n}" for n, c in _CENSUS)
       + " UNION ALL SELECT 'late_runs', count(*), FALSE, CASE WHEN count(*) = 0 THEN 'empty' ELSE 'read' END FROM v_metrics WHERE run > 2 UNION ALL SELECT 'no_such_table', NULL, NULL, 'missing'")
def a24(t):
    """Rows of each table: one that has none is empty, one that isn't there is missing, and neither is a zero."""
    tables = {name: getattr(t, name) for name, _ in _CENSUS} | {"late_runs": t.v_metrics.where("run > 2"), "no_such_table": None}
    return rec.census(t.spark, tables, "cip")


@query("A26_by_creator", "SELECT source, count(*) AS n, count(lang) AS with_subject, count(DISTINCT sha256(text)) < count(*) AS repeats FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def a26(t):
    return t.documents.groupBy("source").agg(F.count("*").alias("n"), F.count("lang").alias("with_subject"), (F.count_distinct(F.sha2("text", 256)) < F.count("*")).alias("repeats")).orderBy(F.desc("n"), "source").limit(10)


@query("A27_table_shape", "SELECT left(soc_code, 2) AS state, count(*) AS n_rows, max(CASE WHEN right(soc_code, 1) = '5' THEN 2 ELSE 1 END) AS subject_columns, count(*) FILTER (WHERE right(soc_code, 1) IN ('1', '3')) AS structurable, round_even(100.0 * CAST(count(*) FILTER (WHERE right(soc_code, 1) IN ('1', '3')) AS DOUBLE) / count(*), 1) AS share FROM v_occ GROUP BY left(soc_code, 2)")
def a27(t):
    """Cells of a markup table: rows by state, columns beside the state's, and rows that can be read as numbers with their share."""
    last = F.right("soc_code", F.lit(1))
    cell = F.when(last.isin("1", "3"), "4").otherwise("by choice")
    more = F.when(last == "5", "<td>2</td>").otherwise("")
    html = t.v_occ.select(F.concat(F.lit("<table><tr><td>"), "soc_code", F.lit("</td><td>"), cell, F.lit("</td>"), more, F.lit("</tr></table>")).alias("html"))
    rows = readers.table_cells(html, "html")
    number = F.count_if(pg.cell_class(F.col("cells")[1]) == "number")
    return rows.groupBy(F.left(F.col("cells")[0], F.lit(2)).alias("state")).agg(F.count("*").alias("n_rows"), (F.max(F.size("cells")) - 1).alias("subject_columns"), number.alias("structurable"), pct(number, F.count("*")).alias("share"))


@query("A28_provenance", "SELECT source, kind, count(*) AS n FROM (SELECT subject AS source, 'Course' AS kind FROM v_course UNION ALL SELECT source_edition, 'Mapping' FROM v_prepares_for UNION ALL SELECT state, 'Institution' FROM v_institution) GROUP BY source, kind")
def a28(t):
    parts = t.v_course.select(F.col("subject").alias("source"), F.lit("Course").alias("kind")).union(t.v_prepares_for.select("source_edition", F.lit("Mapping"))).union(t.v_institution.select("state", F.lit("Institution")))
    return parts.groupBy("source", "kind").agg(F.count("*").alias("n"))


@query("A29_distinct_and_cube", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def a29(t):
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("A30_hosts", f"SELECT {_HOST} AS host, count(*) AS n FROM pages GROUP BY 1 ORDER BY n DESC, host LIMIT 8")
def a30(t):
    return t.pages.groupBy(text.host_of("url").alias("host")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(8)


@query("A31_external_ids", "SELECT type, count(*) AS n, bool_or(event_id % 50 = 0) AS carries FROM (SELECT event_id, unnest(CASE WHEN event_id % 2 = 0 THEN ['ror', 'grid'] ELSE ['ror'] END) AS type FROM events) GROUP BY type")
def a31(t):
    ids = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("ror"), F.lit("grid"))).otherwise(F.array(F.lit("ror")))
    return t.events.select("event_id", F.explode(ids).alias("type")).groupBy("type").agg(F.count("*").alias("n"), F.bool_or(F.col("event_id") % 50 == 0).alias("carries"))


@query("A32_code_census", "SELECT count(*) AS n_rows, count(DISTINCT name) AS names, count(*) FILTER (WHERE regexp_full_match(cip_code, '0000[0-9]{2}')) AS pure, count(DISTINCT left(cip_code, 4)) AS prefixes, bool_or(regexp_matches(name, '\\b(i|ii|iii|[0-9]|ring)$')) AS publishes_sequence FROM v_programme")
def a32(t):
    return t.v_programme.agg(F.count("*").alias("n_rows"), F.count_distinct("name").alias("names"), F.count_if(F.col("cip_code").rlike(r"\A0000[0-9]{2}\z")).alias("pure"), F.count_distinct(F.left("cip_code", F.lit(4))).alias("prefixes"), F.bool_or(F.col("name").rlike(r"\b(i|ii|iii|[0-9]|ring)$")).alias("publishes_sequence"))


@query("A33_rows_by_table", "SELECT 'part' AS name, count(*) AS n FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'nation', count(*) FROM nation")
def a33(t):
    wanted = {"part": {"p_partkey"}, "supplier": {"s_suppkey"}, "nation": {"n_name"}}
    out = None
    for name, columns in wanted.items():
        df = getattr(t, name)
        if not columns <= set(df.columns):
            raise rec.Refused(f"{name} lacks {columns - set(df.columns)}")
        own = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = own if out is None else out.union(own)
    return out


@query("A34_flag_values", "SELECT trim(p_type) AS flag, count(*) AS n FROM part GROUP BY 1")
def a34(t):
    return t.part.groupBy(F.trim("p_type").alias("flag")).agg(F.count("*").alias("n"))


@query("A35_any_heading", "SELECT count(*) FILTER (WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0) AS present, count(*) AS n FROM supplier")
def a35(t):
    a, b = F.when(F.col("s_suppkey") % 2 == 0, "5").otherwise("—"), F.when(F.col("s_suppkey") % 3 == 0, "7").otherwise("")
    return t.supplier.agg(F.count_if(F.exists(F.array(a, b), lambda x: ~x.isin("", "-", "—"))).alias("present"), F.count("*").alias("n"))


@query("A36_requirement_flags", f"SELECT flag, count(*) FILTER (WHERE v = 1) AS n, count(*) AS returned FROM ({_FLAGS}) GROUP BY flag")
def a36(t):
    long = t.v_flags.unpivot(["s_suppkey"], ["flag1", "flag2", "flag3", "flag4"], "flag", "v")
    return long.groupBy("flag").agg(F.count_if(F.col("v") == 1).alias("n"), F.count("*").alias("returned"))


@query("A37_dimension_from_facts", "SELECT DISTINCT cip_code FROM v_completion WHERE awards > 0")
def a37(t):
    return t.v_completion.where("awards > 0").select("cip_code").distinct()


@query("A38_counts_by_source", "SELECT 'orders' AS source, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'customer', count(*) FROM customer")
def a38(t):
    out = None
    for name in ("orders", "events", "customer"):
        own = rec.refuse_empty(getattr(t, name), name).agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
        out = own if out is None else out.union(own)
    return out


# ---- windows, sorts, limits and samples


@query("W1_first_wins", "SELECT unitid, cip_code, award_level, pos, awards FROM (SELECT *, row_number() OVER (PARTITION BY unitid, cip_code, award_level ORDER BY pos, awards) AS r FROM v_completion) WHERE r = 1")
def w1(t):
    c = t.v_completion.select("unitid", "cip_code", "award_level", "pos", "awards")
    return rec.first_wins(c, "pos", "unitid", "cip_code", "award_level")


@query("W2_ordered_pairs", "SELECT pathway_id, course_id, min(pos) AS first_pos, count(*) - 1 AS duplicates FROM v_pathway_rows GROUP BY pathway_id, course_id")
def w2(t):
    return t.v_pathway_rows.groupBy("pathway_id", "course_id").agg(F.min("pos").alias("first_pos"), (F.count("*") - 1).alias("duplicates"))


@query("W3_carried", f"SELECT event_id, signup FROM ({_CARRY})")
def w3(t):
    e = t.events.withColumn("_o", F.struct("ts", "event_id"))
    return rec.carry_forward(e, F.when(F.col("event_type") == "signup", F.col("event_id")), "_o", "user_id").select("event_id", F.col("carried").alias("signup"))


@query("W4_progress", """SELECT h, n, total, n - lag(n) OVER (ORDER BY h) AS change, round((total - lag(total) OVER (ORDER BY h)) / CAST((h - lag(h) OVER (ORDER BY h)) * 3600 AS DOUBLE), 9) AS rate, round(total / CAST((h - min(h) OVER () + 1) * 3600 AS DOUBLE), 9) AS rate_so_far
  FROM (SELECT h, n, CAST(sum(n) OVER (ORDER BY h) AS BIGINT) AS total FROM (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS h, count(*) AS n FROM events GROUP BY 1))""")
def w4(t):
    """Progress at each hour with rows: running total, rows a second since the sample before and since the start, over the seconds that passed. The windows run over hours."""
    hours = t.events.groupBy(F.floor(F.unix_timestamp("ts") / 3600).alias("h")).agg(F.count("*").alias("n"))
    w = Window.orderBy("h")
    out = hours.select("h", "n", F.sum("n").over(w).alias("total"), (F.col("n") - F.lag("n").over(w)).alias("change"), ((F.col("h") - F.lag("h").over(w)) * 3600).alias("elapsed"), ((F.col("h") - F.min("h").over(w) + 1) * 3600).alias("so_far"))
    return out.select("h", "n", "total", "change", F.round(F.col("n") / F.col("elapsed"), 9).alias("rate"), F.round(F.col("total") / F.col("so_far"), 9).alias("rate_so_far"))


_GAP = 21_600


@query("W4_gap_samples", f"""WITH RECURSIVE e AS (SELECT CAST(ts AS TIMESTAMP) AS ts FROM events), s AS (SELECT min(ts) AS t FROM e UNION ALL SELECT (SELECT min(ts) FROM e WHERE e.ts >= s.t + INTERVAL {_GAP} SECOND) FROM s WHERE s.t + INTERVAL {_GAP} SECOND <= (SELECT max(ts) FROM e)),
  a AS (SELECT t AS sampled FROM s WHERE t IS NOT NULL UNION SELECT max(ts) FROM e), c AS (SELECT sampled, (SELECT count(*) FROM e WHERE ts <= sampled) AS total FROM a)
  SELECT sampled, total, round((total - lag(total) OVER (ORDER BY sampled)) / (epoch_us(sampled) - lag(epoch_us(sampled)) OVER (ORDER BY sampled)) * 1000000.0, 6) AS rate FROM c""")
def w4_gap(t):
    """Samples at least six hours after the one before, and the last row; rows a second between them."""
    return sampling.gap_samples(t.events, F.col("ts").cast("timestamp"), _GAP).select(F.col("at").alias("sampled"), "total", F.round("rate", 6).alias("rate"))


@query("W5_upper_median", "SELECT median FROM v_earnings ORDER BY median LIMIT 1 OFFSET (SELECT CAST(floor(count(*) / 2) AS BIGINT) FROM v_earnings)")
def w5(t):
    from waymark.plans.questions import midpoint

    return midpoint(t).withColumnRenamed("midpoint", "median")


@query("W6_median", "SELECT event_type, round_even(median(value), 1) AS median FROM events GROUP BY event_type")
def w6(t):
    mid = rec.middle_values(t.events, "value", "event_type")
    return mid.select("event_type", F.bround((F.col("lower") + F.col("upper")) / 2, 1).alias("median"))


@query("W7_top_k", "SELECT l_partkey, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM lineitem GROUP BY l_partkey ORDER BY quantity DESC, l_partkey LIMIT 10")
def w7(t):
    return t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")).orderBy(F.desc("quantity"), "l_partkey").limit(10)


@query("W8_ordered", "SELECT subject, name, course_id FROM v_course ORDER BY subject, name, course_id")
def w8(t):
    return t.v_course.select("subject", "name", "course_id").orderBy("subject", "name", "course_id")


@query("W9_hash_sample", "SELECT url, sha1(url) AS h FROM pages ORDER BY h, url LIMIT 20")
def w9(t, n=20):
    return t.pages.select("url", F.sha1("url").alias("h")).orderBy("h", "url").limit(n)


@query("W10_even_sample", "SELECT p_name FROM (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT p_name FROM part)) WHERE i IN (SELECT floor(k * n / 7) FROM range(7) r(k))")
def w10(t, k=7):
    """Evenly spaced of the sorted distinct names."""
    ranked = rec.ranked(t.part.select("p_name").distinct(), "p_name")
    n = ranked.count()
    return ranked.where(F.col("rank").isin(*(i * n // k for i in range(k)))).select("p_name")


@query("W11_stride_pages", "SELECT doc_id, (doc_id // 50) AS page FROM documents WHERE (doc_id // 50) % 3 = 0")
def w11(t, size=50, stride=3):
    page = F.floor(F.col("doc_id") / size)
    return t.documents.select("doc_id", page.alias("page")).where(F.col("page") % stride == 0)


@query("W12_examples", "SELECT p_brand, p_partkey FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part) WHERE r <= 8")
def w12(t, k=8):
    return t.part.withColumn("r", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))).where(F.col("r") <= k).select("p_brand", "p_partkey")


@query("W13_head", "SELECT pos, awards FROM v_completion ORDER BY pos, unitid, cip_code, awards LIMIT 25")
def w13(t, n=25):
    return t.v_completion.orderBy("pos", "unitid", "cip_code", "awards").limit(n).select("pos", "awards")


@query("W15_banner_buckets", """SELECT row_no, c0 AS cell, CASE WHEN row_no > 1 THEN 'CIP2020Code' ELSE NULL END AS bucket FROM v_crosswalk_cells WHERE row_no <> 1""")
def w15(t):
    """Rows under the banner last passed, here in one sheet: banners are carried over stretches of rows first, then within each."""
    rows = sheet(t).select("row_no", F.col("cells")[0].alias("cell"))
    banner = F.col("cell") == "CIP2020Code"
    return rec.carry_over_ranges(rows, F.when(banner, F.col("cell")), "row_no").where(~banner).select("row_no", "cell", F.col("carried").alias("bucket"))


# ---- sets


@query("X1_code_overlap", """WITH a AS (SELECT DISTINCT soc_code FROM v_occ WHERE right(soc_code, 1) <> '1'), b AS (SELECT DISTINCT split_part(onet_code, '.', 1) AS soc_code FROM v_onet WHERE onet_code LIKE '%.03')
  SELECT count(*) FILTER (WHERE x AND y) AS "both", count(*) FILTER (WHERE NOT y) AS only_left, count(*) FILTER (WHERE NOT x) AS only_right FROM (SELECT soc_code, bool_or(s = 'a') AS x, bool_or(s = 'b') AS y FROM (SELECT soc_code, 'a' AS s FROM a UNION ALL SELECT soc_code, 'b' FROM b) GROUP BY soc_code)""")
def x1(t):
    a = t.v_occ.where(F.right("soc_code", F.lit(1)) != "1")
    b = t.v_onet.where(F.col("onet_code").endswith(".03")).select(keys.soc_of("onet_code").alias("soc_code"))
    return rec.code_overlap(a, b, "soc_code")


@query("X4_union", "SELECT soc_code AS code FROM v_occ UNION SELECT cip_code FROM v_programme")
def x4(t):
    return t.v_occ.select(F.col("soc_code").alias("code")).union(t.v_programme.select("cip_code")).distinct()


@query("X5_unparsed", "SELECT DISTINCT url FROM pages WHERE page_id % 4 = 0 AND url NOT IN (SELECT url FROM pages WHERE page_id % 4 <> 0)")
def x5(t):
    return t.pages.select("url").distinct().join(t.pages.where("page_id % 4 <> 0").select("url"), "url", "left_anti")


@query("X6_grown_and_shrunk", "SELECT 'gone' AS change, district FROM (SELECT district FROM v_metrics WHERE run = 1 AND value > 0 EXCEPT SELECT district FROM v_metrics WHERE run = 2 AND value > 0) UNION ALL SELECT 'new', district FROM (SELECT district FROM v_metrics WHERE run = 2 AND value > 0 EXCEPT SELECT district FROM v_metrics WHERE run = 1 AND value > 0)")
def x6(t):
    a, b = (t.v_metrics.where((F.col("run") == r) & (F.col("value") > 0)).select("district") for r in (1, 2))
    return a.exceptAll(b).select(F.lit("gone").alias("change"), "district").union(b.exceptAll(a).select(F.lit("new"), "district"))


@query("X7_pooled", f"SELECT DISTINCT path FROM (SELECT {_PATH} AS path FROM pages UNION ALL SELECT unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) FROM pages)")
def x7(t):
    own = t.pages.select(text.path_of("url").alias("path"))
    return own.union(t.pages.select(F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)))).distinct()


# ---- reconciliation and quality


@query("M1_slice_integrity", """SELECT name, rows, rows_unique, CASE WHEN rows = 0 THEN 'empty' WHEN rows <> reported THEN 'count' WHEN rows_unique <> rows THEN 'repeated' END AS problem FROM (
  SELECT 'orders' AS name, (SELECT count(*) FROM orders) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS rows_unique, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS reported
  UNION ALL SELECT 'keys of lines', (SELECT count(*) FROM lineitem), (SELECT count(DISTINCT l_orderkey) FROM lineitem), (SELECT count(*) FROM lineitem)
  UNION ALL SELECT 'suppliers', (SELECT count(*) FROM supplier), (SELECT count(*) FROM (SELECT DISTINCT * FROM supplier)), (SELECT max(s_suppkey) - min(s_suppkey) + 1 FROM supplier)
  UNION ALL SELECT 'late runs', (SELECT count(*) FROM v_metrics WHERE run > 2), 0, 0)""")
def m1(t):
    """Slices against what another table reports for them: whole, repeated rows, another count, empty."""
    keys_of_lines = t.lineitem.select("l_orderkey")
    ids = t.supplier.agg(F.max("s_suppkey") - F.min("s_suppkey") + 1).first()[0]
    slices = (("orders", t.orders, keys_of_lines.distinct().count()), ("keys of lines", keys_of_lines, t.lineitem.count()), ("suppliers", t.supplier, ids), ("late runs", t.v_metrics.where("run > 2"), 0))
    out = None
    for name, df, reported in slices:
        own = rec.slice_integrity(df, reported).select(F.lit(name).alias("name"), "rows", "rows_unique", "problem")
        out = own if out is None else out.union(own)
    return out


@query("M2_key_fitness", """SELECT field, count(value) AS present, count(*) - count(value) AS absent, count(DISTINCT value) AS distinct_values, count(value) - count(DISTINCT value) AS collides FROM (SELECT 'p_partkey' AS field, CAST(p_partkey AS VARCHAR) AS value FROM part UNION ALL SELECT 'p_name', p_name FROM part UNION ALL SELECT 'p_brand', p_brand FROM part) GROUP BY field""")
def m2(t):
    return rec.key_fitness(t.part, "p_partkey", "p_name", "p_brand").select("field", "present", "absent", "distinct_values", "collides")


def _counts(**tables):
    out = None
    for name, df in tables.items():
        own = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("kind"), "n")
        out = own if out is None else out.union(own)
    return out


@query("M3_read_back", "SELECT 'mapping' AS kind, (SELECT count(*) FROM v_prepares_for WHERE right(cip_code, 1) <> '3') AS before, (SELECT count(*) FROM v_prepares_for WHERE right(cip_code, 1) = '3') AS created, (SELECT count(*) FROM v_prepares_for) AS held, CAST(0 AS BIGINT) AS gap")
def m3(t):
    m = t.v_prepares_for
    three = F.right("cip_code", F.lit(1)) == "3"
    return rec.read_back(_counts(mapping=m.where(~three)), _counts(mapping=m.where(three)), _counts(mapping=m))


@query("M4_verified", "SELECT 'course' AS kind, count(*) AS expected, count(*) - 3 AS held, CAST(-3 AS BIGINT) AS gap, 'shortfall' AS verdict FROM v_course UNION ALL SELECT 'requires', count(*), count(*), 0, 'agrees' FROM v_requires")
def m4(t):
    n = t.v_course.orderBy("course_id").limit(3)
    return rec.reconcile(_counts(course=t.v_course, requires=t.v_requires), _counts(course=t.v_course.join(n, "course_id", "left_anti"), requires=t.v_requires))


@query("M5_present_properties", "SELECT 'lat' AS field, count(lat) AS present FROM v_geo UNION ALL SELECT 'lon', count(lon) FROM v_geo UNION ALL SELECT 's_suppkey', count(s_suppkey) FROM v_geo")
def m5(t):
    return rec.present_counts(t.v_geo, "lat", "lon", "s_suppkey")


@query("M6_preflight", "SELECT 'cip_code' AS field, count(*) FILTER (WHERE NOT regexp_full_match(cip_code, '[0-9]{6}')) AS invalid FROM v_completion UNION ALL SELECT 'awards', count(*) FILTER (WHERE awards < 0) FROM v_completion UNION ALL SELECT 'race', count(*) FILTER (WHERE race NOT IN ('A', 'N')) FROM v_completion")
def m6(t):
    return rec.invalid_counts(t.v_completion, cip_code=F.col("cip_code").rlike(r"\A[0-9]{6}\z"), awards=F.col("awards") >= 0, race=F.col("race").isin("A", "N"))


@query("M7_rekeyed", """WITH k AS (SELECT concat_ws('|', unitid, cip_code, race, sex, CAST(year AS VARCHAR)) AS old, sha1(concat(unitid, '|', cip_code, '|', CAST(award_level AS VARCHAR), '|', CAST(majornum AS VARCHAR), '|', coalesce(race, 'None'), '|', coalesce(sex, 'None'), '|', CAST(year AS VARCHAR))) AS id FROM v_completion),
  ids AS (SELECT id FROM k ORDER BY id LIMIT 25) SELECT 'old keys' AS held, (SELECT count(*) FROM k) > 0 AND NOT EXISTS (SELECT 1 FROM k JOIN ids ON ids.id = k.old) AS rekeyed UNION ALL SELECT 'new keys', (SELECT count(*) FROM k) > 0 AND NOT EXISTS (SELECT 1 FROM k JOIN ids ON ids.id = k.id) UNION ALL SELECT 'nothing', FALSE""")
def m7(t):
    """Tables of the old kind of keys, of the new kind, and an empty one, against new keys."""
    c = t.v_completion
    old, new = c.select(keys.joined_key("unitid", "cip_code", "race", "sex", "year").alias("id")), c.select(keys.completion_id().alias("id"))
    out = None
    for name, table in (("old keys", old), ("new keys", new), ("nothing", new.where("false"))):
        own = rec.keyed_otherwise(table, new, "id").select(F.lit(name).alias("held"), "rekeyed")
        out = own if out is None else out.union(own)
    return out


@query("M8_drift", f"SELECT count(*) FILTER (WHERE a <> b) AS changed, count(*) AS pages, (count(*) FILTER (WHERE a <> b) > 10 AND count(*) FILTER (WHERE a <> b) * 10 > count(*)) AS stop FROM (SELECT coalesce(CASE len(list_filter(string_split({_PATH}, '/'), lambda x: x <> '')) WHEN 1 THEN 'subject' WHEN 2 THEN 'course' WHEN 3 THEN 'pathway' END, '') AS a, CASE WHEN html LIKE '%<br>%' THEN 'pathway' ELSE coalesce(CASE len(list_filter(string_split({_PATH}, '/'), lambda x: x <> '')) WHEN 1 THEN 'subject' WHEN 2 THEN 'course' WHEN 3 THEN 'pathway' END, '') END AS b FROM pages)")
def m8(t):
    a = F.coalesce(text.level(text.path_of("url")), F.lit(""))
    b = F.coalesce(text.classified("url", "html", "<br>"), F.lit(""))
    n = t.pages.agg(F.count_if(a != b).alias("changed"), F.count("*").alias("pages"))
    return n.withColumn("stop", (F.col("changed") > 10) & (F.col("changed") * 10 > F.col("pages")))


@query("M9_resolution", """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages), p AS (SELECT DISTINCT href FROM l WHERE length(href) % 2 = 0),
  v AS (SELECT page_id, count(*) AS n, count(p.href) AS k FROM l LEFT JOIN p ON p.href = l.href GROUP BY page_id) SELECT count(*) AS stating, count(*) FILTER (WHERE n = k) AS fully, count(*) FILTER (WHERE k > 0 AND k < n) AS partly, count(*) FILTER (WHERE k = 0) AS broken, CAST(sum(k) AS BIGINT) AS resolvable, CAST(sum(n - k) AS BIGINT) AS dangling,
  (SELECT string_agg(href, ' ' ORDER BY href) FROM (SELECT DISTINCT href FROM l WHERE href NOT IN (SELECT href FROM p) ORDER BY href LIMIT 8)) AS examples, (SELECT count(*) FROM pages WHERE html LIKE '%<nav%' AND NOT regexp_matches(html, 'href="')) AS drifted FROM v""")
def m9(t):
    """Pages that state links by how many resolve, with eight that don't, and pages whose field is there without a link in it."""
    v = j20(t)
    n = lambda name: F.count_if(F.col("verdict") == name).alias(name)
    found = v.agg(F.count("*").alias("stating"), n("fully"), n("partly"), n("broken"), F.sum("resolved").alias("resolvable"), F.sum(F.col("links") - F.col("resolved")).alias("dangling"))
    links = t.pages.select(F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)).alias("href")).distinct()
    some = links.where(F.length("href") % 2 != 0).orderBy("href").limit(8).agg(F.array_join(F.array_sort(F.collect_list("href")), " ").alias("examples"))
    drift = pg.page_records(t.pages).agg(F.count_if("field_present_no_links").alias("drifted"))
    return found.crossJoin(some).crossJoin(drift)  # one row each


@query("M10_pairs", "SELECT count(*) FILTER (WHERE trim(c0) <> '' AND trim(c2) <> '') AS complete, count(*) FILTER (WHERE (trim(c0) <> '') <> (trim(c2) <> '')) AS partial FROM v_crosswalk_cells WHERE row_no > 1")
def m10(t):
    p = readers.sheet_pairs(sheet(t))
    a, b = F.col("left_code").isNotNull(), F.col("right_code").isNotNull()
    return p.agg(F.count_if(a & b).alias("complete"), F.count_if(a != b).alias("partial"))


@query("M11_zero_denominators", "SELECT a.district, round_even(100.0 * CAST(b.value AS DOUBLE) / nullif(a.value, 0), 1) AS share FROM v_metrics a JOIN v_metrics b ON a.district = b.district AND a.metric = b.metric WHERE a.run = 1 AND b.run = 2")
def m11(t):
    """The second run's figure as a share of the first's; nothing measured against zero is null, not zero."""
    m = t.v_metrics
    a, b = m.where("run = 1").select("district", "metric", F.col("value").alias("whole")), m.where("run = 2").select("district", "metric", F.col("value").alias("part"))
    return a.join(b, ["district", "metric"]).select("district", pct(F.col("part"), F.col("whole")).alias("share"))


@query("M12_census_flag", "SELECT count(*) AS sampled, (SELECT count(*) FROM supplier) AS population, count(*) >= (SELECT count(*) FROM supplier) AS census FROM v_geo")
def m12(t):
    both = t.v_geo.agg(F.count("*").alias("sampled")).crossJoin(t.supplier.agg(F.count("*").alias("population")))  # one row each
    return both.withColumn("census", F.col("sampled") >= F.col("population"))


@query("M13_empty_answers", """WITH a AS (SELECT 'no row' AS name, count(*) AS n, NULL::BIGINT AS x, NULL::BIGINT AS y FROM v_metrics WHERE run = 9
  UNION ALL SELECT 'nulls', 1, (SELECT sum(value)::BIGINT FROM v_metrics WHERE run = 9), (SELECT max(value) FROM v_metrics WHERE run = 9)
  UNION ALL SELECT 'zeros', 1, (SELECT count(*) FROM v_metrics WHERE run = 9), (SELECT min(value) FROM v_metrics)
  UNION ALL SELECT 'counted', 1, (SELECT count(*) FROM v_metrics), (SELECT min(value) FROM v_metrics)
  UNION ALL SELECT 'many rows', count(*), min(value), max(value) FROM v_metrics WHERE value = 0)
  SELECT name, n = 0 OR (n = 1 AND coalesce(x, 0) = 0 AND coalesce(y, 0) = 0) AS empty FROM a""")
def m13(t):
    """No rows, or a single row of nulls and zeros, is an empty answer."""
    m, late = t.v_metrics, t.v_metrics.where("run = 9")
    low = m.agg(F.min("value").alias("y"))
    answers = {
        "no row": late.select("value", "run"), "nulls": late.agg(F.sum("value").alias("x"), F.max("value").alias("y")),
        "zeros": late.agg(F.count("*").alias("x")).crossJoin(low), "counted": m.agg(F.count("*").alias("x")).crossJoin(low),  # one row each
        "many rows": m.where("value = 0").select("value"),
    }
    out = None
    for name, df in answers.items():
        own = rec.answers_emptily(df).select(F.lit(name).alias("name"), "empty")
        out = own if out is None else out.union(own)
    return out


@query("M14_foreign_rows", "SELECT (SELECT count(*) FROM v_course) + (SELECT count(*) FROM v_institution) + (SELECT count(*) FROM region) AS every, (SELECT count(*) FROM v_course) + (SELECT count(*) FROM v_institution) AS own, (SELECT count(*) FROM region) AS difference")
def m14(t):
    n = _counts(course=t.v_course, institution=t.v_institution, region=t.region)
    own = F.col("kind").isin("course", "institution")
    return n.agg(F.sum("n").alias("every"), F.sum(F.when(own, F.col("n"))).alias("own"), F.sum(F.when(~own, F.col("n"))).alias("difference"))


@query("M15_sheet_guards", """WITH s AS (SELECT 'one heading' AS name, row_no, c0, c1, c2 FROM v_crosswalk_cells UNION ALL SELECT 'two headings', row_no, c0, c1, c2 FROM v_crosswalk_cells UNION ALL SELECT 'two headings', 3, 'CIP2020Code', 'x', 'SOC2018Title'
    UNION ALL SELECT 'no heading', row_no, c0, c1, c2 FROM v_crosswalk_cells WHERE row_no <> 1 UNION ALL SELECT 'blank first', row_no, CASE WHEN row_no = 1 THEN '' ELSE c0 END, c1, CASE WHEN row_no = 1 THEN 'CIP2020Code' ELSE c2 END FROM v_crosswalk_cells),
  h AS (SELECT * FROM s WHERE row_no < 12 AND (regexp_matches(lower(c0), 'cip.*code$') OR regexp_matches(lower(c1), 'cip.*code$') OR regexp_matches(lower(c2), 'cip.*code$')))
  SELECT n.name, count(h.name) AS candidates, coalesce(bool_and(trim(h.c0) <> ''), FALSE) AS first_heading, coalesce(bool_and(h.c2 = 'SOC2018Code'), FALSE) AS expected, count(h.name) = 1 AND coalesce(bool_and(trim(h.c0) <> '' AND h.c2 = 'SOC2018Code'), FALSE) AS usable
  FROM (SELECT DISTINCT name FROM s) n LEFT JOIN h ON h.name = n.name GROUP BY n.name""")
def m15(t):
    """The crosswalk sheet, and copies of it with a second heading row, without one, and with a blank first heading."""
    own = sheet(t)
    first = F.col("row_no") == 1
    second = own.where(first).select(F.lit(3).cast("long").alias("row_no"), F.array(F.lit("CIP2020Code"), F.lit("x"), F.lit("SOC2018Title"), F.lit("")).alias("cells"))
    blank = F.when(first, F.array(F.lit(""), F.col("cells")[1], F.lit("CIP2020Code"), F.col("cells")[3])).otherwise(F.col("cells"))
    sheets = {"one heading": own, "two headings": own.unionByName(second), "no heading": own.where(~first), "blank first": own.withColumn("cells", blank)}
    out = None
    for name, df in sheets.items():
        found = readers.sheet_guards(df, "cip", 2, "SOC2018Code").select(F.lit(name).alias("name"), "candidates", "first_heading", "expected", "usable")
        out = found if out is None else out.union(found)
    return out


@query("M16_minimum_size", "SELECT count(*) AS classes, count(*) >= 10 AS whole FROM v_occ")
def m16(t, floor=10):
    n = t.v_occ.agg(F.count("*").alias("classes"))
    return n.select("classes", (F.col("classes") >= floor).alias("whole")).where(F.assert_true(F.col("classes") >= floor, F.lit("the vocabulary is cut short")).isNull())


@query("L1_keyed_load", """WITH kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unitid, cip_code, award_level, majornum, race, sex, year ORDER BY pos, unitid, cip_code, awards) AS r FROM v_completion WHERE coalesce(awards, 0) > 0) WHERE r = 1)
  SELECT sha1(concat(unitid, '|', cip_code, '|', CAST(award_level AS VARCHAR), '|', CAST(majornum AS VARCHAR), '|', coalesce(race, 'None'), '|', coalesce(sex, 'None'), '|', CAST(year AS VARCHAR))) AS id, unitid, cip_code, awards FROM kept WHERE right(cip_code, 1) <> '9'""")
def l1(t):
    """The spine load in one job: key, zero rows dropped, first row of a key kept, and only what is not held yet."""
    c = t.v_completion.where(F.coalesce("awards", F.lit(0)) > 0).withColumn("id", keys.completion_id())
    held = c.where(F.right("cip_code", F.lit(1)) == "9").select("id")
    new = rec.first_wins(c.select("id", "pos", "unitid", "cip_code", "awards"), "pos", "id")
    return new.join(held, "id", "left_anti").select("id", "unitid", "cip_code", "awards")


@query("L2_crosswalk_load", f"SELECT DISTINCT m.cip_code, m.soc_code FROM v_prepares_for m WHERE m.soc_code NOT IN {NOT_OCCUPATIONS} AND EXISTS (SELECT 1 FROM v_completion c WHERE c.cip_code = m.cip_code)")
def l2(t):
    m = t.v_prepares_for.where(~F.col("soc_code").isin(*NOT_OCCUPATIONS))
    return m.join(t.v_completion.select("cip_code"), "cip_code", "left_semi").select("cip_code", "soc_code").distinct()


# ---- what the figures above leave out


@query("A25_label_uniqueness", "SELECT 'course' AS vocabulary, count(*) AS terms, count(DISTINCT name) AS labels, count(*) = count(DISTINCT name) AS is_unique FROM v_course UNION ALL SELECT 'occupation', count(*), count(DISTINCT title), count(*) = count(DISTINCT title) FROM v_onet UNION ALL SELECT 'brand', count(*), count(DISTINCT subject), count(*) = count(DISTINCT subject) FROM v_course")
def a25_labels(t):
    """Terms and different labels of each vocabulary."""
    c = t.v_course
    terms = c.select(F.lit("course").alias("vocabulary"), F.col("name").alias("label")).unionAll(t.v_onet.select(F.lit("occupation"), "title")).unionAll(c.select(F.lit("brand"), "subject"))
    n, k = F.count("*"), F.count_distinct("label")
    return terms.groupBy("vocabulary").agg(n.alias("terms"), k.alias("labels"), (n == k).alias("is_unique"))


@query("A30_host_count", f"SELECT count(*) AS urls, count(DISTINCT {_HOST}) AS hosts FROM pages")
def a30_count(t):
    return t.pages.agg(F.count("*").alias("urls"), F.count_distinct(text.host_of("url")).alias("hosts"))


@query("X1_naive_and_rolled", """WITH a AS (SELECT DISTINCT soc_code FROM v_occ), b AS (SELECT onet_code, split_part(onet_code, '.', 1) AS soc_code FROM v_onet WHERE onet_code LIKE '%.03' UNION SELECT soc_code, soc_code FROM v_occ WHERE right(soc_code, 1) = '7')
  SELECT (SELECT count(*) FROM a WHERE soc_code IN (SELECT onet_code FROM b)) AS naive, (SELECT count(*) FROM a WHERE soc_code IN (SELECT soc_code FROM b)) AS rolled""")
def x1_naive(t):
    """Codes that match as they are written, beside those that match once they are rolled up."""
    a = t.v_occ
    b = t.v_onet.where(F.col("onet_code").endswith(".03")).select("onet_code").union(a.where(F.right("soc_code", F.lit(1)) == "7")).distinct()
    both = a.join(b.select(F.col("onet_code").alias("soc_code"), F.lit(1).alias("n")).distinct(), "soc_code", "left").join(b.select(keys.soc_of("onet_code").alias("soc_code"), F.lit(1).alias("r")).distinct(), "soc_code", "left")
    return both.agg(F.count("n").alias("naive"), F.count("r").alias("rolled"))


@query("W11_reach", """WITH p AS (SELECT doc_id // 50 AS page, count(*) AS n FROM documents GROUP BY 1), s AS (SELECT greatest(1, count(*) // 7) AS stride, count(*) AS pages, CAST(sum(n) AS BIGINT) AS total FROM p),
  r AS (SELECT stride, pages, total, count(*) AS pages_read, CAST(sum(n) AS BIGINT) AS rows_read FROM p, s WHERE page % stride = 0 GROUP BY ALL)
  SELECT pages, stride, pages_read, rows_read, round_even(100.0 * CAST(rows_read AS DOUBLE) / total, 1) AS share, concat(pages_read, ' of ', pages, ' pages, every ', stride, ', ', rows_read, ' of ', total, ' rows') AS reach FROM r""")
def w11_reach(t, size=50, wanted=7):
    """What a sample of about `wanted` pages really reaches: the stride follows from the population."""
    p = t.documents.groupBy(F.floor(F.col("doc_id") / size).alias("page")).agg(F.count("*").alias("n"))
    s = p.agg(F.greatest(F.lit(1).cast("long"), F.floor(F.count("*") / wanted)).alias("stride"), F.count("*").alias("pages"), F.sum("n").alias("total"))
    r = p.crossJoin(F.broadcast(s)).where(F.col("page") % F.col("stride") == 0).groupBy("stride", "pages", "total").agg(F.count("*").alias("pages_read"), F.sum("n").alias("rows_read"))  # one row
    reach = F.format_string("%d of %d pages, every %d, %d of %d rows", "pages_read", "pages", "stride", "rows_read", "total")
    return r.select("pages", "stride", "pages_read", "rows_read", pct(F.col("rows_read"), F.col("total")).alias("share"), reach.alias("reach"))


@query("M4_keyed_without_property", "SELECT 'geo' AS kind, count(s_suppkey) AS keyed, count(*) FILTER (WHERE s_suppkey IS NOT NULL AND lat IS NULL) AS without FROM v_geo UNION ALL SELECT 'course', count(course_id), count(*) FILTER (WHERE course_id IS NOT NULL AND name IS NULL) FROM v_course")
def m4_without(t):
    """Nodes that have their key and lack a property they should have: a count of nodes alone would pass them."""
    lacks = lambda df, kind, key, value: df.agg(F.lit(kind).alias("kind"), F.count(key).alias("keyed"), F.count_if(F.col(key).isNotNull() & F.col(value).isNull()).alias("without"))
    return lacks(t.v_geo, "geo", "s_suppkey", "lat").union(lacks(t.v_course, "course", "course_id", "name"))


@query("A23_read_rates", f"""WITH p AS (SELECT {_HOST} AS host, CASE WHEN page_id % 11 = 0 THEN 404 WHEN page_id % 13 = 0 THEN 500 ELSE 200 END AS status, contains(html, '<a ') AS links FROM pages)
  SELECT host, count(*) AS asked, count(*) FILTER (WHERE status = 200) AS read, count(*) FILTER (WHERE status = 404) AS not_found, count(*) FILTER (WHERE status = 500) AS failed, round_even(100.0 * CAST(count(*) FILTER (WHERE status = 200 AND links) AS DOUBLE) / nullif(count(*) FILTER (WHERE status = 200), 0), 1) AS with_links FROM p GROUP BY host""")
def a23_rates(t):
    """Pages by what became of the request; shares are of the pages that were read, not of those asked for."""
    status = F.when(F.col("page_id") % 11 == 0, 404).when(F.col("page_id") % 13 == 0, 500).otherwise(200)
    p = t.pages.select(text.host_of("url").alias("host"), status.alias("status"), F.contains("html", F.lit("<a ")).alias("links"))
    read = F.col("status") == 200
    return p.groupBy("host").agg(F.count("*").alias("asked"), F.count_if(read).alias("read"), F.count_if(F.col("status") == 404).alias("not_found"), F.count_if(F.col("status") == 500).alias("failed"), pct(F.count_if(read & F.col("links")), F.count_if(read)).alias("with_links"))
