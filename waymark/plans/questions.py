"""The question catalogue: lookups, one-hop, change impact, traversals, multi-domain and whole-graph questions.

Each question is a function of the tables with its anchors as parameters.
Codes in questions are canonical, as in the tables. Counts of awards use total
rows only where demographic rows are at hand. Top-k questions break ties by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.keys import NOT_OCCUPATIONS, TOTAL
from waymark.operators import graph, structure
from waymark.operators import records as rec
from waymark.plans import graph_queries as gq
from waymark.plans.registry import query
from waymark.sources.tables import Tables

CIP, SOC, SOC2, UNITID, PLACE, SCHOOL = "000160", "15-0002", "11-0005", "000005", "state|NATION_13", 9
COURSE, GATE = gq.COURSE, gq.GATE
#: The school that teaches COURSE.
TEACHES_COURSE = 10
CERTIFICATE = 1
MARKER = "data-pathway"


def named(t: Tables, df: DataFrame, key: str = "node") -> DataFrame:
    return df.join(t.v_course.select(F.col("course_id").alias(key), "name"), key)


def programmes_of(t: Tables, unitid: str) -> DataFrame:
    return t.v_offers.where(F.col("unitid") == unitid)


# ---- lookups


@query("Q1_programme", f"SELECT cip_code, name FROM v_programme WHERE cip_code = '{CIP}'")
def q1(t, cip=CIP):
    return t.v_programme.where(F.col("cip_code") == cip)


@query("Q2_occupation", f"SELECT soc_code FROM v_occ WHERE soc_code = '{SOC}'")
def q2(t, soc=SOC):
    return t.v_occ.where(F.col("soc_code") == soc)


@query("Q3_institutions", "SELECT count(*) AS institutions FROM v_institution")
def q3(t):
    return t.v_institution.agg(F.count("*").alias("institutions"))


@query("Q4_schools_districts", "SELECT count(DISTINCT ncessch) AS schools, count(DISTINCT leaid) AS districts FROM v_in_district")
def q4(t):
    return t.v_in_district.agg(F.count_distinct("ncessch").alias("schools"), F.count_distinct("leaid").alias("districts"))


@query("Q5_mappings", "SELECT count(*) AS mappings FROM v_prepares_for")
def q5(t):
    return t.v_prepares_for.agg(F.count("*").alias("mappings"))


@query("Q6_mapped_programmes", "SELECT count(DISTINCT cip_code) AS programmes FROM v_prepares_for")
def q6(t):
    return t.v_prepares_for.agg(F.count_distinct("cip_code").alias("programmes"))


@query("Q7_mapped_occupations", "SELECT count(DISTINCT soc_code) AS occupations FROM v_prepares_for")
def q7(t):
    return t.v_prepares_for.agg(F.count_distinct("soc_code").alias("occupations"))


@query("Q8_courses_of_subject", "SELECT count(*) AS courses FROM v_course WHERE subject = 'Brand#2'")
def q8(t, subject="Brand#2"):
    return t.v_course.where(F.col("subject") == subject).agg(F.count("*").alias("courses"))


@query("Q9_course_fields", f"SELECT name, kind FROM v_course WHERE course_id = {COURSE}")
def q9(t, course=COURSE):
    return t.v_course.where(F.col("course_id") == course).select("name", "kind")


@query("Q10_schools_of_course", f"SELECT ncessch, leaid FROM v_teaches JOIN v_in_district USING (ncessch) WHERE course_id = {COURSE}")
def q10(t, course=COURSE):
    return t.v_teaches.where(F.col("course_id") == course).join(t.v_in_district, "ncessch").select("ncessch", "leaid")


@query("Q11_award_levels", f"SELECT DISTINCT award_level FROM v_completion WHERE unitid = '{UNITID}'")
def q11(t, unitid=UNITID):
    return t.v_completion.where(F.col("unitid") == unitid).select("award_level").distinct()


@query("Q12_where_is_it", f"SELECT name, place_id FROM v_institution JOIN v_located_in USING (unitid) WHERE unitid = '{UNITID}'")
def q12(t, unitid=UNITID):
    return t.v_institution.where(F.col("unitid") == unitid).join(t.v_located_in, "unitid").select("name", "place_id")


@query("Q13_completed_here", f"SELECT CAST(coalesce(sum(awards), 0) AS BIGINT) AS completions FROM v_completion_demo WHERE unitid = '{UNITID}' AND race = '99' AND sex = '99' AND award_level = 1")
def q13(t, unitid=UNITID, award_level=1):
    """Totals rows only, so no award counts twice."""
    c = t.v_completion_demo.where((F.col("unitid") == unitid) & (F.col("race") == TOTAL) & (F.col("sex") == TOTAL) & (F.col("award_level") == award_level))
    return c.agg(F.coalesce(F.sum("awards"), F.lit(0)).alias("completions"))


@query("Q14_description", f"SELECT name, subject AS source FROM v_course WHERE course_id = {COURSE}")
def q14(t, course=COURSE):
    return t.v_course.where(F.col("course_id") == course).select("name", F.col("subject").alias("source"))


@query("Q15_courses_of_pathway_kind", "SELECT DISTINCT course_id, name FROM v_includes JOIN v_course USING (course_id) WHERE pathway_id < 3")
def q15(t, below=3):
    return t.v_includes.where(F.col("pathway_id") < below).select("course_id").distinct().join(t.v_course.select("course_id", "name"), "course_id")


@query("Q16_free_text", "SELECT count(DISTINCT conv_id) AS with_free_text FROM conversations WHERE trim(text) <> ''")
def q16(t):
    return t.conversations.where(F.trim("text") != "").agg(F.count_distinct("conv_id").alias("with_free_text"))


@query("Q17_pay", f"SELECT year, median, source FROM v_earnings WHERE soc_code = '{SOC}'")
def q17(t, soc=SOC):
    return t.v_earnings.where(F.col("soc_code") == soc).select("year", "median", "source")


@query("Q18_trend", f"SELECT soc_code, year, count(*) AS records FROM v_earnings WHERE soc_code = '{SOC}' GROUP BY soc_code, year ORDER BY year")
def q18(t, soc=SOC):
    return t.v_earnings.where(F.col("soc_code") == soc).groupBy("soc_code", "year").agg(F.count("*").alias("records")).orderBy("year")


# ---- one hop


@query("Q21_leads_to", f"SELECT DISTINCT soc_code FROM v_prepares_for WHERE cip_code = '{CIP}'")
def q21(t, cip=CIP):
    return t.v_prepares_for.where(F.col("cip_code") == cip).select("soc_code").distinct()


@query("Q22_programmes_for", f"SELECT DISTINCT p.cip_code, p.name FROM v_prepares_for m JOIN v_programme p ON p.cip_code = m.cip_code WHERE soc_code = '{SOC}'")
def q22(t, soc=SOC):
    return t.v_prepares_for.where(F.col("soc_code") == soc).select("cip_code").distinct().join(t.v_programme, "cip_code").select("cip_code", "name").distinct()


@query("Q23_offered_near", f"SELECT DISTINCT i.unitid, i.name FROM v_offers o JOIN v_institution i ON i.unitid = o.unitid JOIN v_located_in l ON l.unitid = i.unitid WHERE o.cip_code LIKE '0001%' AND l.place_id = '{PLACE}'")
def q23(t, prefix="0001", place=PLACE):
    near = t.v_located_in.where(F.col("place_id") == place).select("unitid")
    return t.v_offers.where(F.col("cip_code").startswith(prefix)).select("unitid").distinct().join(near, "unitid", "left_semi").join(t.v_institution, "unitid").select("unitid", "name")


@query("Q24_really_graduates", f"SELECT i.unitid, i.name, CAST(sum(c.awards) AS BIGINT) AS conferred FROM v_completion_demo c JOIN v_institution i ON i.unitid = c.unitid WHERE c.cip_code = '{CIP}' AND c.race = '99' AND c.sex = '99' AND EXISTS (SELECT 1 FROM v_offers o WHERE o.unitid = c.unitid AND o.cip_code = c.cip_code) GROUP BY i.unitid, i.name ORDER BY conferred DESC, i.unitid")
def q24(t, cip=CIP):
    c = t.v_completion_demo.where((F.col("cip_code") == cip) & (F.col("race") == TOTAL) & (F.col("sex") == TOTAL))
    offered = c.join(t.v_offers, ["unitid", "cip_code"], "left_semi").groupBy("unitid").agg(F.sum("awards").alias("conferred"))
    return offered.join(t.v_institution, "unitid").select("unitid", "name", "conferred").orderBy(F.desc("conferred"), "unitid")


@query("Q25_at_certificate_level", f"SELECT DISTINCT i.unitid, i.name FROM v_completion c JOIN v_institution i ON i.unitid = c.unitid WHERE c.award_level = {CERTIFICATE} AND c.cip_code LIKE '00001%'")
def q25(t, prefix="00001", award_level=CERTIFICATE):
    c = t.v_completion.where((F.col("award_level") == award_level) & F.col("cip_code").startswith(prefix)).select("unitid").distinct()
    return c.join(t.v_institution, "unitid").select("unitid", "name")


@query("Q26_with_prerequisite", "SELECT count(DISTINCT src) AS courses_with_a_prerequisite FROM v_requires")
def q26(t):
    return t.v_requires.agg(F.count_distinct("src").alias("courses_with_a_prerequisite"))


@query("Q27_immediate_prerequisite", f"SELECT dst AS node, name FROM v_requires JOIN v_course ON course_id = dst WHERE src = {COURSE}")
def q27(t, course=COURSE):
    return named(t, t.v_requires.where(F.col("src") == course).select(F.col("dst").alias("node")))


@query("Q28_named_by", f"SELECT src AS node, name FROM v_requires JOIN v_course ON course_id = src WHERE dst = {GATE}")
def q28(t, course=GATE):
    return named(t, t.v_requires.where(F.col("dst") == course).select(F.col("src").alias("node")))


@query("Q29_graduates", f"SELECT CAST(sum(awards) AS BIGINT) AS graduates FROM v_completion_demo WHERE cip_code = '{CIP}' AND race = '99' AND sex = '99'")
def q29(t, cip=CIP):
    return t.v_completion_demo.where((F.col("cip_code") == cip) & (F.col("race") == TOTAL) & (F.col("sex") == TOTAL)).agg(F.sum("awards").alias("graduates"))


@query("Q30_district_of_school", f"SELECT ncessch, leaid, r_name AS name FROM v_in_district JOIN region ON r_regionkey = leaid WHERE ncessch = {SCHOOL}")
def q30(t, school=SCHOOL):
    return t.v_in_district.where(F.col("ncessch") == school).join(t.region, F.col("leaid") == F.col("r_regionkey")).select("ncessch", "leaid", F.col("r_name").alias("name"))


@query("Q31_mapped_to_group", f"SELECT DISTINCT o.cip_code FROM v_offers o JOIN v_prepares_for m ON m.cip_code = o.cip_code WHERE o.unitid = '{UNITID}' AND m.soc_code LIKE '29-%'")
def q31(t, unitid=UNITID, group="29-"):
    mapped = t.v_prepares_for.where(F.col("soc_code").startswith(group))
    return programmes_of(t, unitid).join(mapped, "cip_code", "left_semi").select("cip_code").distinct()


@query("Q32_reached_by_certificate", f"SELECT DISTINCT m.soc_code FROM v_prepares_for m WHERE m.cip_code LIKE '00001%' AND EXISTS (SELECT 1 FROM v_completion c WHERE c.cip_code = m.cip_code AND c.award_level = {CERTIFICATE})")
def q32(t, prefix="00001", award_level=CERTIFICATE):
    awarded = t.v_completion.where(F.col("award_level") == award_level).select("cip_code")
    return t.v_prepares_for.where(F.col("cip_code").startswith(prefix)).join(awarded, "cip_code", "left_semi").select("soc_code").distinct()


@query("Q33_earnings_of_graduates", f"SELECT DISTINCT e.soc_code, e.year, e.median, e.source FROM v_earnings e JOIN v_prepares_for m ON m.soc_code = e.soc_code WHERE m.cip_code = '{CIP}' ORDER BY e.year DESC, e.median")
def q33(t, cip=CIP):
    own = t.v_prepares_for.where(F.col("cip_code") == cip).select("soc_code")
    return t.v_earnings.join(own, "soc_code", "left_semi").distinct().orderBy(F.desc("year"), "median")


@query("Q34_entry_points_at_school", f"SELECT c.course_id, c.name FROM v_teaches s JOIN v_course c ON c.course_id = s.course_id WHERE s.ncessch = {SCHOOL} AND NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id)")
def q34(t, school=SCHOOL):
    taught = t.v_teaches.where(F.col("ncessch") == school).select("course_id")
    needs = t.v_requires.select(F.col("src").alias("course_id"))
    return taught.join(needs, "course_id", "left_anti").join(t.v_course.select("course_id", "name"), "course_id")


@query("Q35_reachable_occupations", f"SELECT DISTINCT m.soc_code FROM v_offers o JOIN v_prepares_for m ON m.cip_code = o.cip_code WHERE o.unitid = '{UNITID}'")
def q35(t, unitid=UNITID):
    return t.v_prepares_for.join(programmes_of(t, unitid), "cip_code", "left_semi").select("soc_code").distinct()


@query("Q36_dead_ends", "SELECT p.cip_code, p.name FROM v_programme p JOIN (SELECT cip_code FROM v_prepares_for GROUP BY cip_code HAVING count(DISTINCT soc_code) = 1) d ON d.cip_code = p.cip_code")
def q36(t):
    single = t.v_prepares_for.groupBy("cip_code").agg(F.count_distinct("soc_code").alias("n")).where("n = 1").select("cip_code")
    return t.v_programme.join(single, "cip_code")


@query("Q37_most_routes", "SELECT soc_code, count(DISTINCT cip_code) AS routes FROM v_prepares_for GROUP BY soc_code ORDER BY routes DESC, soc_code LIMIT 20")
def q37(t, k=20):
    return t.v_prepares_for.groupBy("soc_code").agg(F.count_distinct("cip_code").alias("routes")).orderBy(F.desc("routes"), "soc_code").limit(k)


@query("Q42_pathways_by_district", "SELECT pathway_id % 5 AS district, count(DISTINCT pathway_id) AS pathways FROM v_includes GROUP BY pathway_id % 5")
def q42(t):
    return t.v_includes.groupBy((F.col("pathway_id") % 5).alias("district")).agg(F.count_distinct("pathway_id").alias("pathways"))


# ---- change impact


@query("Q43_leads_to_all", "SELECT cip_code, string_agg(soc_code, ',' ORDER BY soc_code) AS leads_to FROM v_prepares_for GROUP BY cip_code")
def q43(t):
    return t.v_prepares_for.groupBy("cip_code").agg(F.array_join(F.array_sort(F.collect_list("soc_code")), ",").alias("leads_to"))


@query("Q43_edition_changes", """WITH old AS (SELECT cip_code, soc_code FROM v_prepares_for WHERE right(cip_code, 1) <> '7'), new AS (SELECT cip_code, soc_code FROM v_prepares_for WHERE right(soc_code, 1) <> '3')
  SELECT cip_code, soc_code, 'lost' AS change FROM (SELECT * FROM old EXCEPT SELECT * FROM new) UNION ALL SELECT cip_code, soc_code, 'gained' FROM (SELECT * FROM new EXCEPT SELECT * FROM old)""")
def q43_changes(t):
    """Two editions of the crosswalk compared both ways."""
    m = t.v_prepares_for.select("cip_code", "soc_code")
    old, new = m.where(F.right("cip_code", F.lit(1)) != "7"), m.where(F.right("soc_code", F.lit(1)) != "3")
    flags = old.withColumn("o", F.lit(1)).withColumn("n", F.lit(0)).union(new.withColumn("o", F.lit(0)).withColumn("n", F.lit(1)))
    sides = flags.groupBy("cip_code", "soc_code").agg(F.max("o").alias("o"), F.max("n").alias("n")).where("o <> n")
    return sides.select("cip_code", "soc_code", F.when(F.col("o") == 1, "lost").otherwise("gained").alias("change"))


@query("Q45_feeds", f"SELECT DISTINCT cip_code FROM v_prepares_for WHERE soc_code = '{SOC}'")
def q45(t, soc=SOC):
    return t.v_prepares_for.where(F.col("soc_code") == soc).select("cip_code").distinct()


@query("Q46_was_feeding", f"SELECT DISTINCT m.cip_code, m.soc_code FROM v_offers o JOIN v_prepares_for m ON m.cip_code = o.cip_code WHERE o.unitid = '{UNITID}' AND o.cip_code LIKE '%5'")
def q46(t, unitid=UNITID, ending="5"):
    gone = programmes_of(t, unitid).where(F.col("cip_code").endswith(ending))
    return t.v_prepares_for.join(gone, "cip_code", "left_semi").select("cip_code", "soc_code").distinct()


@query("Q47_now_licensed", f"SELECT DISTINCT p.cip_code, p.name FROM v_prepares_for m JOIN v_programme p USING (cip_code) WHERE m.soc_code = '{SOC2}'")
def q47(t, soc=SOC2):
    return q22(t, soc)


@query("Q48_loses_prerequisite", f"SELECT r.src AS node, c.name, (SELECT count(*) FROM v_requires o WHERE o.src = r.src) - 1 AS left_after_removal FROM v_requires r JOIN v_course c ON c.course_id = r.src WHERE r.dst = {GATE}")
def q48(t, gone=GATE):
    return named(t, gq.g20(t, gone))


@query("Q49_downstream", gq.WALK + f"SELECT src AS node, name FROM cl JOIN v_course ON course_id = src WHERE dst = {GATE}")
def q49(t, course=GATE):
    return named(t, graph.ancestors(t.v_requires, course).select("node"))


@query("Q50_code_retired", f"SELECT (SELECT count(DISTINCT soc_code) FROM v_prepares_for WHERE cip_code = '{CIP}') AS occupations_unreached, (SELECT count(DISTINCT unitid) FROM v_offers WHERE cip_code = '{CIP}') AS institutions_affected, (SELECT CAST(coalesce(sum(awards), 0) AS BIGINT) FROM v_completion WHERE cip_code = '{CIP}') AS awards_already_conferred")
def q50(t, cip=CIP):
    """Each branch is counted before they meet, so that sums are not multiplied."""
    own = F.col("cip_code") == cip
    a = t.v_prepares_for.where(own).agg(F.count_distinct("soc_code").alias("occupations_unreached"))
    b = t.v_offers.where(own).agg(F.count_distinct("unitid").alias("institutions_affected"))
    c = t.v_completion.where(own).agg(F.coalesce(F.sum("awards"), F.lit(0)).alias("awards_already_conferred"))
    return a.crossJoin(b).crossJoin(c)  # one row each


@query("Q51_points_at_both", "SELECT cip_code FROM v_prepares_for WHERE soc_code LIKE '11-%' INTERSECT SELECT cip_code FROM v_prepares_for WHERE soc_code LIKE '17-%'")
def q51(t, a="11-", b="17-"):
    hit = t.v_prepares_for.groupBy("cip_code").agg(F.bool_or(F.col("soc_code").startswith(a)).alias("a"), F.bool_or(F.col("soc_code").startswith(b)).alias("b"))
    return hit.where("a and b").select("cip_code")


@query("Q52_lost_route_in_region", f"""SELECT DISTINCT m.soc_code FROM v_offers o JOIN v_prepares_for m ON m.cip_code = o.cip_code JOIN v_located_in l ON l.unitid = o.unitid WHERE o.unitid = '{UNITID}'
  AND NOT EXISTS (SELECT 1 FROM v_prepares_for m2 JOIN v_offers o2 ON o2.cip_code = m2.cip_code JOIN v_located_in l2 ON l2.unitid = o2.unitid WHERE m2.soc_code = m.soc_code AND l2.place_id = l.place_id AND o2.unitid <> '{UNITID}')""")
def q52(t, closing=UNITID):
    here = t.v_located_in.where(F.col("unitid") == closing).select("place_id")
    others = t.v_located_in.where(F.col("unitid") != closing).join(here, "place_id", "left_semi").select("unitid")
    own = q35(t, closing)
    still = t.v_prepares_for.join(t.v_offers.join(others, "unitid", "left_semi"), "cip_code", "left_semi").select("soc_code")
    return own.join(still, "soc_code", "left_anti")


@query("Q53_pathways_break", f"SELECT DISTINCT i.pathway_id FROM v_teaches s JOIN v_includes i ON i.course_id = s.course_id WHERE s.ncessch = {TEACHES_COURSE} AND s.course_id = {COURSE}")
def q53(t, school=TEACHES_COURSE, course=COURSE):
    taught = t.v_teaches.where((F.col("ncessch") == school) & (F.col("course_id") == course))
    return t.v_includes.join(taught, "course_id", "left_semi").select("pathway_id").distinct()


@query("Q54_newly_reachable", gq.WALK + f"SELECT count(DISTINCT src) AS newly_reachable FROM cl WHERE dst = {GATE}")
def q54(t, course=GATE):
    return graph.ancestors(t.v_requires, course).agg(F.count("*").alias("newly_reachable"))


@query("Q55_ranking", "SELECT m.cip_code, e.year, CAST(max(e.median) AS BIGINT) AS median FROM v_prepares_for m JOIN v_earnings e ON e.soc_code = m.soc_code GROUP BY m.cip_code, e.year ORDER BY median DESC, m.cip_code, e.year")
def q55(t):
    best = t.v_earnings.groupBy("soc_code", "year").agg(F.max("median").alias("median"))
    return t.v_prepares_for.select("cip_code", "soc_code").join(best, "soc_code").groupBy("cip_code", "year").agg(F.max("median").alias("median")).orderBy(F.desc("median"), "cip_code", "year")


@query("Q56_inbound_links", f"SELECT c.course_id AS node, c.name, count(*) AS inbound_links FROM v_requires r JOIN v_course c ON c.course_id = r.dst WHERE r.dst = {GATE} GROUP BY c.course_id, c.name")
def q56(t, renamed=GATE):
    return named(t, t.v_requires.where(F.col("dst") == renamed).groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("inbound_links")))


@query("Q60_reachable_after_mapping", f"SELECT DISTINCT m.soc_code FROM v_offers o JOIN v_prepares_for m USING (cip_code) WHERE o.unitid = '{UNITID}'")
def q60(t, unitid=UNITID):
    return q35(t, unitid)


# ---- traversals


@query("Q61_closes_off", gq.WALK + "SELECT src AS node, name FROM cl JOIN v_course ON course_id = src WHERE dst = 7")
def q61(t, course=7):
    return q49(t, course)


@query("Q62_shortest_route", gq.TRAILS + f"SELECT depth AS steps, array_to_string(nodes, '>') AS route FROM trail WHERE src = {COURSE} AND dst = 1 ORDER BY depth, nodes LIMIT 1")
def q62(t, start=COURSE, end=1):
    return gq.g8(t, start, end).select(F.col("depth").alias("steps"), "route")


@query("Q63_still_missing", gq.WALK + "SELECT dst AS node, name FROM cl JOIN v_course ON course_id = dst WHERE src = 160 AND dst NOT IN (1, 2, 10)")
def q63(t, target=COURSE, completed=gq.COMPLETED):
    return named(t, gq.x2(t, target, completed))


@query("Q64_carries_over", gq.WALK + "SELECT DISTINCT a.dst AS node, name FROM cl a JOIN cl b ON a.dst = b.dst JOIN v_course ON course_id = a.dst WHERE a.src = 160 AND b.src = 130")
def q64(t, a=COURSE, b=130):
    return named(t, gq.x3(t, a, b))


@query("Q65_take_next", gq.WALK + "SELECT dst AS node, name FROM cl n JOIN v_course ON course_id = n.dst WHERE n.src = 160 AND n.dst NOT IN (1, 2, 10) AND NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = n.dst AND r.dst NOT IN (1, 2, 10))")
def q65(t, target=COURSE, completed=gq.COMPLETED):
    return named(t, gq.g13(t, target, completed))


@query("Q66_deepest_chain", gq.TRAILS + "SELECT CAST(max(depth) AS INT) AS deepest_chain FROM trail")
def q66(t):
    return graph.levels(t.v_requires).agg(F.max("depth").alias("deepest_chain"))


@query("Q67_outside_every_chain", "SELECT count(*) AS outside_every_chain FROM v_course c WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id) AND NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.dst = c.course_id)")
def q67(t):
    e, c = t.v_requires, t.v_course.select("course_id")
    return c.join(e, c.course_id == e.src, "left_anti").join(e, c.course_id == e.dst, "left_anti").agg(F.count("*").alias("outside_every_chain"))


@query("Q68_single_point_of_failure", gq.TRAILS + """, pair AS (SELECT src, dst, count(*) AS n FROM trail GROUP BY src, dst)
  SELECT a.dst AS node, count(*) AS pairs FROM pair a JOIN pair b ON a.dst = b.src JOIN pair p ON p.src = a.src AND p.dst = b.dst WHERE a.n * b.n = p.n GROUP BY a.dst ORDER BY pairs DESC, node LIMIT 1""")
def q68(t):
    return structure.essential(t.v_requires).orderBy(F.desc("pairs"), "node").limit(1)


@query("Q69_ancestor_set", gq.WALK + "SELECT dst AS node, name FROM cl JOIN v_course ON course_id = dst WHERE src = 130")
def q69(t, course=130):
    return named(t, graph.descendants(t.v_requires, course).select("node"))


@query("Q70_unlocks", gq.WALK + "SELECT src AS node, name FROM cl JOIN v_course ON course_id = src WHERE dst = 13")
def q70(t, course=13):
    return q49(t, course)


@query("Q71_cycles", gq.WALK + "SELECT src AS node FROM cl WHERE src = dst")
def q71(t):
    return graph.on_cycles(t.v_requires).select("node")


@query("Q72_furthest_apart", gq.WALK + "SELECT src, dst, depth AS distance FROM cl ORDER BY distance DESC, src, dst LIMIT 5")
def q72(t, k=5):
    return gq.g9(t, k).select("src", "dst", F.col("depth").alias("distance"))


@query("Q73_chains_to", gq.TRAILS + "SELECT count(*) AS chains FROM trail WHERE dst = 3")
def q73(t, target=3):
    return graph.trails_into(t.v_requires, target).select(F.col("trails").alias("chains"))


@query("Q74_on_most_paths", gq.TRAILS + "SELECT node, name, count(*) AS paths_through FROM (SELECT unnest(nodes) AS node FROM trail) JOIN v_course ON course_id = node GROUP BY node, name ORDER BY paths_through DESC, node LIMIT 10")
def q74(t, k=10):
    return named(t, gq.g12(t)).orderBy(F.desc("paths_through"), "node").limit(k)


@query("Q76_opens_most", gq.WALK + "SELECT dst AS node, name, count(DISTINCT src) AS opens FROM cl JOIN v_course ON course_id = dst WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = cl.dst) GROUP BY dst, name ORDER BY opens DESC, node LIMIT 10")
def q76(t, k=10):
    return named(t, gq.g14(t)).orderBy(F.desc("opens"), "node").limit(k)


@query("Q77_reachable_from_school", gq.TRAILS + "SELECT DISTINCT src AS taught, dst AS root, depth FROM trail JOIN v_teaches s ON s.course_id = src WHERE ncessch = 3 AND NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = trail.dst)")
def q77(t, school=3):
    return gq.g16(t, school)


@query("Q78_cover", gq.cover_sql(4))
def q78(t, k=4):
    return gq.g24(t, k)


@query("Q79_across_subjects", gq.TRAILS + "SELECT a.subject AS from_subject, b.subject AS to_subject, count(*) AS chains FROM trail JOIN v_in_subject a ON a.course_id = src JOIN v_in_subject b ON b.course_id = dst WHERE a.subject <> b.subject GROUP BY a.subject, b.subject ORDER BY chains DESC, from_subject, to_subject LIMIT 10")
def q79(t, k=10):
    return gq.j21(t, k)


# ---- several domains


@query("Q82_latest_pay_in_place", f"""WITH o AS (SELECT DISTINCT m.soc_code FROM v_located_in l JOIN v_offers f ON f.unitid = l.unitid JOIN v_prepares_for m ON m.cip_code = f.cip_code WHERE l.place_id = '{PLACE}' AND m.soc_code <> '99-9999'),
  latest AS (SELECT soc_code, max(year) AS latest FROM v_earnings GROUP BY soc_code)
  SELECT DISTINCT o.soc_code, latest, e.median FROM o JOIN latest ON latest.soc_code = o.soc_code JOIN v_earnings e ON e.soc_code = o.soc_code AND e.year = latest ORDER BY e.median DESC, o.soc_code LIMIT 25""")
def q82(t, place=PLACE, k=25):
    near = t.v_located_in.where(F.col("place_id") == place).select("unitid")
    cips = t.v_offers.join(near, "unitid", "left_semi").select("cip_code").distinct()
    socs = t.v_prepares_for.where(~F.col("soc_code").isin(*NOT_OCCUPATIONS)).join(cips, "cip_code", "left_semi").select("soc_code").distinct()
    own = t.v_earnings.join(socs, "soc_code", "left_semi")
    latest = own.groupBy("soc_code").agg(F.max("year").alias("latest"))
    return own.join(latest, "soc_code").where("year = latest").select("soc_code", "latest", "median").distinct().orderBy(F.desc("median"), "soc_code").limit(k)


def midpoint(t: Tables) -> DataFrame:
    """One row: the median record's value, the upper of the two middle ones."""
    return rec.middle_values(t.v_earnings, "median").select(F.col("upper").alias("midpoint"))


@query("Q85_above_median", f"""WITH mid AS (SELECT median AS midpoint FROM v_earnings ORDER BY median LIMIT 1 OFFSET (SELECT CAST(floor(count(*) / 2) AS BIGINT) FROM v_earnings)),
  o AS (SELECT DISTINCT m.soc_code FROM v_prepares_for m WHERE m.soc_code <> '99-9999' AND EXISTS (SELECT 1 FROM v_completion c WHERE c.cip_code = m.cip_code AND c.award_level = {CERTIFICATE}))
  SELECT DISTINCT o.soc_code, e.median, midpoint FROM o JOIN v_earnings e ON e.soc_code = o.soc_code, mid WHERE e.median > midpoint ORDER BY e.median DESC, o.soc_code LIMIT 25""")
def q85(t, award_level=CERTIFICATE, k=25):
    awarded = t.v_completion.where(F.col("award_level") == award_level).select("cip_code")
    socs = t.v_prepares_for.where(F.col("soc_code") != "99-9999").join(awarded, "cip_code", "left_semi").select("soc_code").distinct()
    own = t.v_earnings.join(socs, "soc_code", "left_semi").crossJoin(F.broadcast(midpoint(t)))  # one row
    return own.where("median > midpoint").select("soc_code", "median", "midpoint").distinct().orderBy(F.desc("median"), "soc_code").limit(k)


@query("Q86_supplied", f"SELECT m.soc_code, (SELECT CAST(sum(awards) AS BIGINT) FROM v_completion_demo WHERE cip_code = '{CIP}' AND race = '99' AND sex = '99') AS graduates_supplied FROM v_prepares_for m WHERE m.cip_code = '{CIP}' AND m.soc_code <> '99-9999'")
def q86(t, cip=CIP):
    socs = t.v_prepares_for.where((F.col("cip_code") == cip) & (F.col("soc_code") != "99-9999")).select("soc_code")
    return socs.crossJoin(F.broadcast(q29(t, cip).withColumnRenamed("graduates", "graduates_supplied")))  # one row


@query("Q91_routes_and_levels", f"SELECT DISTINCT c.unitid, i.name, c.award_level FROM v_completion c JOIN v_institution i ON i.unitid = c.unitid WHERE EXISTS (SELECT 1 FROM v_prepares_for m WHERE m.cip_code = c.cip_code AND m.soc_code = '{SOC}') AND EXISTS (SELECT 1 FROM v_offers o WHERE o.unitid = c.unitid AND o.cip_code = c.cip_code)")
def q91(t, soc=SOC):
    offered = t.v_offers.join(t.v_prepares_for.where(F.col("soc_code") == soc), "cip_code", "left_semi")
    awarded = t.v_completion.join(offered, ["unitid", "cip_code"], "left_semi").select("unitid", "award_level").distinct()
    return awarded.join(t.v_institution, "unitid").select("unitid", "name", "award_level")


# ---- the whole graph


@query("Q95_isolated_and_linked", "SELECT (SELECT count(*) FROM v_course c WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id OR r.dst = c.course_id)) AS isolated, (SELECT count(DISTINCT src) FROM v_requires) AS in_a_chain")
def q95(t):
    return gq.g18(t)


@query("Q96_internal_edges", "SELECT a.subject, count(*) AS internal_edges FROM v_requires JOIN v_in_subject a ON a.course_id = src JOIN v_in_subject b ON b.course_id = dst AND a.subject = b.subject GROUP BY a.subject ORDER BY internal_edges DESC, a.subject")
def q96(t):
    return gq.j22(t).orderBy(F.desc("internal_edges"), "subject")


@query("Q97_hubs", "SELECT soc_code, count(*) AS degree FROM v_prepares_for GROUP BY soc_code ORDER BY degree DESC, soc_code LIMIT 20")
def q97(t, k=20):
    return t.v_prepares_for.groupBy("soc_code").agg(F.count("*").alias("degree")).orderBy(F.desc("degree"), "soc_code").limit(k)


@query("Q98_communities", f"SELECT a.cip_code AS a, b.cip_code AS b, count(DISTINCT a.soc_code) AS shared FROM v_prepares_for a JOIN v_prepares_for b ON a.soc_code = b.soc_code AND a.cip_code < b.cip_code WHERE a.soc_code NOT IN {NOT_OCCUPATIONS} GROUP BY a.cip_code, b.cip_code ORDER BY shared DESC, a.cip_code, b.cip_code LIMIT 20")
def q98(t, k=20):
    return graph.most_shared(gq.mapped(t), k)


@query("Q99_most_central", "SELECT node, name, degree FROM (SELECT c.course_id AS node, c.name, (SELECT count(*) FROM v_requires r WHERE r.src = c.course_id) + (SELECT count(*) FROM v_requires r WHERE r.dst = c.course_id) AS degree FROM v_course c) ORDER BY degree DESC, node LIMIT 20")
def q99(t, k=20):
    return named(t, gq.g17(t).orderBy(F.desc("degree"), "node").limit(k))


@query("Q100_single_route", "SELECT soc_code FROM v_prepares_for WHERE soc_code <> '99-9999' GROUP BY soc_code HAVING count(DISTINCT cip_code) = 1 ORDER BY soc_code LIMIT 25")
def q100(t, k=25):
    return t.v_prepares_for.where(F.col("soc_code") != "99-9999").groupBy("soc_code").agg(F.count_distinct("cip_code").alias("n")).where("n = 1").select("soc_code").orderBy("soc_code").limit(k)


@query("Q101_chained_by_kind", "SELECT i.pathway_id % 2 AS kind, count(DISTINCT i.course_id) AS chained_courses FROM v_includes i WHERE EXISTS (SELECT 1 FROM v_requires r WHERE r.src = i.course_id) GROUP BY i.pathway_id % 2")
def q101(t):
    chained = t.v_requires.select(F.col("src").alias("course_id"))
    return t.v_includes.join(chained, "course_id", "left_semi").groupBy((F.col("pathway_id") % 2).alias("kind")).agg(F.count_distinct("course_id").alias("chained_courses"))


@query("Q102_would_extend", gq.WALK + "SELECT dst AS node, count(DISTINCT src) AS would_extend FROM cl WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = cl.dst) GROUP BY dst ORDER BY would_extend DESC, node LIMIT 10")
def q102(t, k=10):
    return gq.g14(t).select("node", F.col("opens").alias("would_extend")).orderBy(F.desc("would_extend"), "node").limit(k)


# ---- the demonstration questions that are not among the above


@query("D1_sources", "SELECT source, kind, count(*) AS nodes FROM (SELECT subject AS source, 'Course' AS kind FROM v_course UNION ALL SELECT state, 'Institution' FROM v_institution UNION ALL SELECT source_edition, 'Mapping' FROM v_prepares_for) GROUP BY source, kind")
def d1(t):
    parts = t.v_course.select(F.col("subject").alias("source"), F.lit("Course").alias("kind")).union(t.v_institution.select("state", F.lit("Institution"))).union(t.v_prepares_for.select("source_edition", F.lit("Mapping")))
    return parts.groupBy("source", "kind").agg(F.count("*").alias("nodes"))


@query("D2_catalogue_size", "SELECT (SELECT count(*) FROM v_course) AS courses, (SELECT count(DISTINCT subject) FROM v_in_subject) AS subjects, (SELECT count(DISTINCT pathway_id) FROM v_includes) AS pathways")
def d2(t):
    a, b, c = t.v_course.agg(F.count("*").alias("courses")), t.v_in_subject.agg(F.count_distinct("subject").alias("subjects")), t.v_includes.agg(F.count_distinct("pathway_id").alias("pathways"))
    return a.crossJoin(b).crossJoin(c)  # one row each


@query("D3_courses_by_subject", "SELECT subject, count(*) AS courses FROM v_in_subject GROUP BY subject ORDER BY courses DESC, subject LIMIT 10")
def d3(t, k=10):
    return t.v_in_subject.groupBy("subject").agg(F.count("*").alias("courses")).orderBy(F.desc("courses"), "subject").limit(k)


@query("D4_pathway_kinds", "SELECT pathway_id % 3 AS kind, count(DISTINCT pathway_id) AS pathways FROM v_includes GROUP BY pathway_id % 3")
def d4(t):
    return t.v_includes.groupBy((F.col("pathway_id") % 3).alias("kind")).agg(F.count_distinct("pathway_id").alias("pathways"))


@query("D5_pathways_without_courses", "SELECT n_nationkey * 2 AS pathway_id FROM nation WHERE n_nationkey * 2 NOT IN (SELECT pathway_id FROM v_includes) GROUP BY n_nationkey * 2")
def d5(t):
    published = t.nation.select((F.col("n_nationkey") * 2).alias("pathway_id")).distinct()
    return published.join(t.v_includes, "pathway_id", "left_anti")


@query("D6_courses_of_pathway", "SELECT c.name AS course, r.section AS route, r.credits FROM v_pathway_rows r JOIN v_course c ON c.course_id = r.course_id WHERE r.pathway_id = 7")
def d6(t, pathway=7):
    rows = t.v_pathway_rows.where(F.col("pathway_id") == pathway)
    return rows.join(t.v_course, "course_id").select(F.col("name").alias("course"), F.col("section").alias("route"), "credits")


@query("D7_credits", "SELECT pathway_id, count(*) AS courses, sum(CAST(credits AS DOUBLE)) AS credits FROM v_pathway_rows GROUP BY pathway_id ORDER BY credits DESC, pathway_id LIMIT 10")
def d7(t, k=10):
    return t.v_pathway_rows.groupBy("pathway_id").agg(F.count("*").alias("courses"), F.sum(F.col("credits").try_cast("double")).alias("credits")).orderBy(F.desc("credits"), "pathway_id").limit(k)


@query("D8_stating_a_prerequisite", "SELECT (SELECT count(*) FROM v_course) AS courses, (SELECT count(*) FROM v_course c WHERE EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id)) AS stating")
def d8(t):
    c = t.v_course.select("course_id")
    stating = c.join(t.v_requires.select(F.col("src").alias("course_id")), "course_id", "left_semi").agg(F.count("*").alias("stating"))
    return c.agg(F.count("*").alias("courses")).crossJoin(stating)  # one row each


@query("D9_conditions", "SELECT substring(text, 1, 62) AS condition, count(*) AS courses FROM conversations GROUP BY substring(text, 1, 62) ORDER BY courses DESC, condition LIMIT 8")
def d9(t, k=8):
    return t.conversations.groupBy(F.substring("text", 1, 62).alias("condition")).agg(F.count("*").alias("courses")).orderBy(F.desc("courses"), "condition").limit(k)


@query("D10_where_to_start", "SELECT count(*) AS openers FROM v_course c WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id) AND EXISTS (SELECT 1 FROM v_requires r WHERE r.dst = c.course_id)")
def d10(t):
    e, c = t.v_requires, t.v_course.select("course_id")
    return c.join(e, c.course_id == e.src, "left_anti").join(e, c.course_id == e.dst, "left_semi").agg(F.count("*").alias("openers"))


@query("D11_standing_alone", "SELECT count(*) AS alone FROM v_course c WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = c.course_id) AND NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.dst = c.course_id) AND NOT EXISTS (SELECT 1 FROM v_includes i WHERE i.course_id = c.course_id)")
def d11(t):
    e, c = t.v_requires, t.v_course.select("course_id")
    return c.join(e, c.course_id == e.src, "left_anti").join(e, c.course_id == e.dst, "left_anti").join(t.v_includes, "course_id", "left_anti").agg(F.count("*").alias("alone"))


@query("D12_in_most_pathways", "SELECT course_id, count(*) AS pathways FROM v_includes GROUP BY course_id ORDER BY pathways DESC, course_id LIMIT 8")
def d12(t, k=8):
    return t.v_includes.groupBy("course_id").agg(F.count("*").alias("pathways")).orderBy(F.desc("pathways"), "course_id").limit(k)


@query("D13_subjects_gating", "SELECT subject, count(*) AS gated FROM v_in_subject s WHERE EXISTS (SELECT 1 FROM v_requires r WHERE r.src = s.course_id) GROUP BY subject ORDER BY gated DESC, subject LIMIT 8")
def d13(t, k=8):
    gated = t.v_in_subject.join(t.v_requires.select(F.col("src").alias("course_id")), "course_id", "left_semi")
    return gated.groupBy("subject").agg(F.count("*").alias("gated")).orderBy(F.desc("gated"), "subject").limit(k)


@query("D14_pass_first", gq.TRAILS + f"SELECT depth AS steps_back, name AS must_pass_first FROM trail JOIN v_course ON course_id = dst WHERE src = {COURSE} AND depth <= 8")
def d14(t, course=COURSE):
    return named(t, graph.trails(t.v_requires, course, 8)).select(F.col("depth").alias("steps_back"), F.col("name").alias("must_pass_first"))


@query("D15_longest_chains", gq.TRAILS + "SELECT src, dst, CAST(max(depth) AS INT) AS steps FROM trail WHERE depth <= 8 GROUP BY src, dst ORDER BY steps DESC, src, dst LIMIT 6")
def d15(t, k=6, max_depth=8):
    """The pairs with the longest chains of at most max_depth steps between them."""
    e = t.v_requires
    step = e.select(F.col("src").alias("dst"), F.col("dst").alias("next"))
    level, longest = e.withColumn("steps", F.lit(1)), None
    for depth in range(2, max_depth + 1):
        longest = level if longest is None else longest.unionByName(level)
        grown = level.join(step, "dst").select("src", F.col("next").alias("dst"), F.lit(depth).alias("steps")).distinct()
        level = graph.materialize(grown)
        if level.isEmpty():
            break
    return longest.unionByName(level).groupBy("src", "dst").agg(F.max("steps").alias("steps")).orderBy(F.desc("steps"), "src", "dst").limit(k)


@query("D20_unlisted_most", gq.TRAILS + "SELECT pathway_id, dst AS unlisted, count(*) AS reached_by FROM v_includes i JOIN trail ON src = i.course_id WHERE NOT EXISTS (SELECT 1 FROM v_includes o WHERE o.pathway_id = i.pathway_id AND o.course_id = dst) GROUP BY pathway_id, dst ORDER BY reached_by DESC, pathway_id, unlisted LIMIT 10")
def d20(t, k=10):
    return gq.unlisted(t).select("pathway_id", F.col("need").alias("unlisted"), "reached_by").orderBy(F.desc("reached_by"), "pathway_id", "unlisted").limit(k)


@query("D21_hardest_pathway", gq.WALK + "SELECT pathway_id, count(DISTINCT dst) AS unlisted FROM v_includes i JOIN cl ON src = i.course_id WHERE NOT EXISTS (SELECT 1 FROM v_includes o WHERE o.pathway_id = i.pathway_id AND o.course_id = dst) GROUP BY pathway_id ORDER BY unlisted DESC, pathway_id LIMIT 8")
def d21(t, k=8):
    listed = t.v_includes.select("pathway_id", "course_id")
    cl = graph.closure(t.v_requires)
    needs = listed.join(cl, listed.course_id == cl.src).select("pathway_id", F.col("dst").alias("course_id")).distinct().join(listed, ["pathway_id", "course_id"], "left_anti")
    return needs.groupBy("pathway_id").agg(F.count("*").alias("unlisted")).orderBy(F.desc("unlisted"), "pathway_id").limit(k)


@query("D22_totals_and_breakdowns", f"""SELECT CAST(sum(awards) AS BIGINT) AS naive, CAST(sum(CASE WHEN race = '99' AND sex = '99' THEN awards ELSE 0 END) AS BIGINT) AS totals,
  CAST(sum(CASE WHEN race <> '99' AND sex <> '99' THEN awards ELSE 0 END) AS BIGINT) AS breakdowns, CAST(sum(CASE WHEN race = '99' AND sex = '99' AND majornum = 1 THEN awards ELSE 0 END) AS BIGINT) AS first_majors FROM v_completion_demo WHERE cip_code = '{CIP}'""")
def d22(t, cip=CIP):
    total, parts = (F.col("race") == TOTAL) & (F.col("sex") == TOTAL), (F.col("race") != TOTAL) & (F.col("sex") != TOTAL)
    add = lambda cond: F.sum(F.when(cond, F.col("awards")).otherwise(0))
    return t.v_completion_demo.where(F.col("cip_code") == cip).agg(F.sum("awards").alias("naive"), add(total).alias("totals"), add(parts).alias("breakdowns"), add(total & (F.col("majornum") == 1)).alias("first_majors"))


@query("D23_colleges", f"SELECT i.name AS college, CAST(sum(awards) AS BIGINT) AS awards FROM v_completion_demo c JOIN v_institution i ON i.unitid = c.unitid WHERE c.cip_code = '{CIP}' AND race = '99' AND sex = '99' AND majornum = 1 GROUP BY i.name ORDER BY awards DESC, college LIMIT 8")
def d23(t, cip=CIP, k=8):
    c = t.v_completion_demo.where((F.col("cip_code") == cip) & (F.col("race") == TOTAL) & (F.col("sex") == TOTAL) & (F.col("majornum") == 1))
    return c.groupBy("unitid").agg(F.sum("awards").alias("awards")).join(t.v_institution, "unitid").groupBy(F.col("name").alias("college")).agg(F.sum("awards").alias("awards")).orderBy(F.desc("awards"), "college").limit(k)


@query("D24_colleges_any_row", f"SELECT count(DISTINCT unitid) AS colleges FROM v_completion WHERE cip_code = '{CIP}'")
def d24(t, cip=CIP):
    return t.v_completion.where(F.col("cip_code") == cip).select("unitid").distinct().agg(F.count("*").alias("colleges"))
