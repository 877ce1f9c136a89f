"""Graph operators (G1 to G25) over the course graph and the crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.keys import NOT_OCCUPATIONS
from waymark.operators import graph, structure
from waymark.operators.reach_index import ReachIndex
from waymark.plans.registry import query
from waymark.sources.tables import Tables

#: A course with a long way down, and one that much hangs on.
COURSE, GATE = 160, 5
#: Courses already passed in the questions about what is missing.
COMPLETED = (1, 2, 10)

WALK = """WITH RECURSIVE walk AS (SELECT src, dst, 1 AS depth FROM v_requires
  UNION SELECT w.src, r.dst, w.depth + 1 FROM walk w JOIN v_requires r ON w.dst = r.src),
  cl AS (SELECT src, dst, CAST(min(depth) AS INT) AS depth FROM walk GROUP BY src, dst) """
TRAILS = """WITH RECURSIVE trail AS (SELECT src, dst, 1 AS depth, [src, dst] AS nodes FROM v_requires
  UNION ALL SELECT w.src, r.dst, w.depth + 1, list_append(w.nodes, r.dst) FROM trail w JOIN v_requires r ON w.dst = r.src) """


def named(t: Tables, nodes: DataFrame, key: str = "node") -> DataFrame:
    return nodes.join(t.v_course.select(F.col("course_id").alias(key), "name"), key)


@query("G1_descendants", WALK + f"SELECT dst AS node, depth FROM cl WHERE src = {COURSE}")
def g1(t, node=COURSE):
    return graph.descendants(t.v_requires, node)


@query("G2_ancestors", WALK + f"SELECT src AS node, depth FROM cl WHERE dst = {GATE}")
def g2(t, node=GATE):
    return graph.ancestors(t.v_requires, node)


@query("G3_bounded_trails", TRAILS + f"SELECT dst AS node, array_to_string(nodes, '>') AS route, depth FROM trail WHERE src = {COURSE} AND depth <= 8")
def g3(t, node=COURSE, max_depth=8):
    return graph.trails(t.v_requires, node, max_depth).select("node", F.array_join("route", ">").alias("route"), "depth")


@query("G4_closure", WALK + "SELECT src, dst, depth FROM cl")
def g4(t):
    return graph.closure(t.v_requires)


_INDEXES: dict[tuple[str, str], ReachIndex] = {}


def index_of(t: Tables) -> ReachIndex:
    """The reachability index of a folder's courses, built and stored once for an application."""
    key = (t.spark.sparkContext.applicationId, t.dir)
    if key not in _INDEXES:
        _INDEXES[key] = ReachIndex.build(t.v_requires)
    return _INDEXES[key]


@query("G4_index_decides", WALK + """, p AS (SELECT a.course_id AS src, b.course_id AS dst FROM v_course a JOIN v_course b ON a.course_id % 50 = 0)
  SELECT count(*) AS pairs, count(cl.src) AS reached, CAST(0 AS BIGINT) AS told_wrongly FROM p LEFT JOIN cl ON cl.src = p.src AND cl.dst = p.dst""")
def g4_index(t):
    """Every 50th course against all: pairs, those with a way, and pairs of which the labels alone say otherwise.

    Listed are the pairs with a way, by a walk that uses no labels, and those that
    labels say have one. Of all others labels say nothing or the truth, so they
    are only counted.
    """
    c, index = t.v_course.select(F.col("course_id").alias("node")), index_of(t)
    asked = c.where("node % 50 = 0")
    walked = graph.materialize(graph.reached_pairs(t.v_requires, asked).select(F.col("node").alias("src"), F.col("at").alias("dst")))
    listed = graph.materialize(walked.union(index.told(asked)).distinct().join(c.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst"))
    told = index.decided(listed).withColumnRenamed("reached", "told")
    both = index.reached(listed).join(told, ["src", "dst"]).join(walked.withColumn("way", F.lit(True)), ["src", "dst"], "left")
    found = both.agg(F.count_if("reached").alias("reached"), F.count_if(F.col("told") != F.coalesce("way", F.lit(False))).alias("told_wrongly"))
    pairs = asked.agg(F.count("*").alias("a")).crossJoin(c.agg(F.count("*").alias("b"))).select((F.col("a") * F.col("b")).alias("pairs"))
    return pairs.crossJoin(found)  # one row each


@query("G1_descendants_indexed", WALK + f"SELECT dst AS node FROM cl WHERE src = {COURSE}")
def g1_indexed(t, node=COURSE):
    return index_of(t).descendants(node)


@query("G2_ancestors_indexed", WALK + f"SELECT src AS node FROM cl WHERE dst = {GATE}")
def g2_indexed(t, node=GATE):
    return index_of(t).ancestors(node)


@query("G5_closes_off_most", WALK + "SELECT dst AS node, count(*) AS closes_off FROM cl GROUP BY dst ORDER BY closes_off DESC, node LIMIT 10")
def g5(t, k=10):
    """Sketches of all, exact counts of the candidates they leave."""
    return structure.most_reaching(graph.reversed_edges(t.v_requires), k).withColumnRenamed("n", "closes_off")


@query("G6_closed_off_by_subject", WALK + f"SELECT subject, count(DISTINCT src) AS closed_off FROM cl JOIN v_in_subject s ON s.course_id = src WHERE dst = {GATE} GROUP BY subject")
def g6(t, node=GATE):
    """The flagship: courses that stay closed without the gate, by subject."""
    blocked = index_of(t).ancestors(node)
    return blocked.join(t.v_in_subject, blocked.node == F.col("course_id")).groupBy("subject").agg(F.count_distinct("node").alias("closed_off"))


@query("G7_gates_most_of_a_kind", WALK + "SELECT dst AS node, count(DISTINCT src) AS behind FROM cl JOIN v_course c ON c.course_id = src WHERE c.name LIKE 'red%' GROUP BY dst ORDER BY behind DESC, node LIMIT 8")
def g7(t, prefix="red", k=8):
    kind = t.v_course.where(F.col("name").startswith(prefix)).select(F.col("course_id").alias("node"))
    return structure.most_reaching(graph.reversed_edges(t.v_requires), k, kind).withColumnRenamed("n", "behind")


@query("G8_shortest_route", TRAILS + f"SELECT array_to_string(nodes, '>') AS route, depth FROM trail WHERE src = {COURSE} AND dst = 1 ORDER BY depth, nodes LIMIT 1")
def g8(t, start=COURSE, end=1):
    return graph.route(t.v_requires, start, end).select(F.array_join("route", ">").alias("route"), "depth")


@query("G9_farthest_pairs", WALK + "SELECT src, dst, depth FROM cl ORDER BY depth DESC, src, dst LIMIT 5")
def g9(t, k=5):
    return graph.closure(t.v_requires).orderBy(F.desc("depth"), "src", "dst").limit(k)


@query("G10_longest_chains", TRAILS + "SELECT src AS node, CAST(max(depth) AS INT) AS depth FROM trail GROUP BY src HAVING max(depth) = (SELECT max(depth) FROM trail)")
def g10(t):
    deep = graph.levels(t.v_requires)
    return deep.join(F.broadcast(deep.agg(F.max("depth").alias("depth"))), "depth").select("node", "depth")  # one row


@query("G11_trails_into", TRAILS + f"SELECT count(*) AS trails FROM trail WHERE dst = {GATE}")
def g11(t, node=GATE):
    return graph.trails_into(t.v_requires, node)


@query("G12_trails_through", TRAILS + "SELECT node, count(*) AS paths_through FROM (SELECT unnest(nodes) AS node FROM trail) GROUP BY node")
def g12(t):
    return graph.path_counts(t.v_requires).select("node", ((1 + F.col("ins")) * (1 + F.col("outs")) - 1).cast("long").alias("paths_through"))


_DONE = ", ".join(map(str, COMPLETED))


@query("G13_next_steps", WALK + f"""SELECT n.dst AS node FROM cl n WHERE n.src = {COURSE} AND n.dst NOT IN ({_DONE})
  AND NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = n.dst AND r.dst NOT IN ({_DONE}))""")
def g13(t, target=COURSE, completed=COMPLETED):
    edges = t.v_requires
    missing = index_of(t).descendants(target).where(~F.col("node").isin(*completed))
    unmet = edges.where(~F.col("dst").isin(*completed)).select(F.col("src").alias("node"))
    return missing.join(unmet, "node", "left_anti")


@query("G14_entry_points", WALK + "SELECT dst AS node, count(DISTINCT src) AS opens FROM cl WHERE NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = cl.dst) GROUP BY dst")
def g14(t):
    edges = t.v_requires
    roots = edges.select(F.col("dst").alias("node")).distinct().join(edges.select(F.col("src").alias("node")), "node", "left_anti")
    return structure.reach_counts(graph.reversed_edges(edges), roots).withColumnRenamed("n", "opens")


def unlisted(t: Tables) -> DataFrame:
    """(pathway_id, need, reached_by, from_courses): required by a pathway's courses and not in it; counted by trails and by courses."""
    edges, listed = t.v_requires, t.v_includes.select("pathway_id", "course_id").distinct()
    # trails are counted for each pair along the closure, so none is listed
    pairs = graph.pair_counts(edges)
    needs = listed.join(pairs, listed.course_id == pairs.src).groupBy("pathway_id", F.col("dst").alias("need")).agg(F.sum("n").cast("long").alias("reached_by"), F.count_distinct("src").alias("from_courses"))
    return needs.join(listed.select("pathway_id", F.col("course_id").alias("need")), ["pathway_id", "need"], "left_anti")


@query("G15_unlisted_requirements", TRAILS + """SELECT pathway_id, dst AS need, count(*) AS reached_by, count(DISTINCT src) AS from_courses FROM v_includes i JOIN trail ON src = i.course_id
  WHERE NOT EXISTS (SELECT 1 FROM v_includes o WHERE o.pathway_id = i.pathway_id AND o.course_id = dst) GROUP BY pathway_id, dst""")
def g15(t):
    return unlisted(t)


@query("G16_taught_to_root", TRAILS + "SELECT DISTINCT src AS taught, dst AS root, depth FROM trail JOIN v_teaches s ON s.course_id = src WHERE ncessch = 10 AND NOT EXISTS (SELECT 1 FROM v_requires r WHERE r.src = trail.dst)")
def g16(t, school=10, max_depth=graph.MAX_DEPTH):
    edges = t.v_requires
    roots = edges.select("dst").distinct().join(edges.select(F.col("src").alias("dst")), "dst", "left_anti")
    level = t.v_teaches.where(F.col("ncessch") == school).select(F.col("course_id").alias("taught"), F.col("course_id").alias("node"))
    out = None
    for depth in range(1, max_depth + 1):
        level = graph.materialize(level.join(edges, level.node == edges.src).select("taught", F.col("dst").alias("node")).distinct())
        if level.isEmpty():
            break
        own = level.join(roots, level.node == roots.dst, "left_semi").select("taught", F.col("node").alias("root"), F.lit(depth).alias("depth"))
        out = own if out is None else out.unionByName(own)
    return level.select("taught", F.col("node").alias("root"), F.lit(0).alias("depth")) if out is None else out


@query("G17_degree", "SELECT c.course_id AS node, (SELECT count(*) FROM v_requires r WHERE r.src = c.course_id) + (SELECT count(*) FROM v_requires r WHERE r.dst = c.course_id) AS degree FROM v_course c")
def g17(t):
    d = graph.degrees(t.v_requires)
    return t.v_course.select(F.col("course_id").alias("node")).join(d, "node", "left").select("node", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


@query("G18_isolated", "SELECT count(*) FILTER (WHERE NOT linked) AS isolated, count(*) FILTER (WHERE needs) AS in_a_chain FROM (SELECT course_id, EXISTS (SELECT 1 FROM v_requires r WHERE r.src = course_id) AS needs, EXISTS (SELECT 1 FROM v_requires r WHERE r.src = course_id OR r.dst = course_id) AS linked FROM v_course)")
def g18(t):
    e, c = t.v_requires, t.v_course.select("course_id")
    alone = c.join(e, c.course_id == e.src, "left_anti").join(e, c.course_id == e.dst, "left_anti").agg(F.count("*").alias("isolated"))
    return alone.crossJoin(e.agg(F.count_distinct("src").alias("in_a_chain")))  # one row each


@query("G19_shared_occupations", f"SELECT a.cip_code AS a, b.cip_code AS b, count(DISTINCT a.soc_code) AS shared FROM v_prepares_for a JOIN v_prepares_for b ON a.soc_code = b.soc_code AND a.cip_code < b.cip_code WHERE a.soc_code NOT IN {NOT_OCCUPATIONS} GROUP BY a.cip_code, b.cip_code")
def g19(t):
    """Pairs of programmes by the occupations they share; the codes that stand for no occupation are no hubs."""
    return graph.shared_neighbours(mapped(t))


def mapped(t: Tables) -> DataFrame:
    """Programmes (src) and their occupations (dst), without the codes that stand for none."""
    return t.v_prepares_for.where(~F.col("soc_code").isin(*NOT_OCCUPATIONS)).select(F.col("cip_code").alias("src"), F.col("soc_code").alias("dst"))


@query("G20_removal", f"SELECT r.src AS node, (SELECT count(*) FROM v_requires o WHERE o.src = r.src) - 1 AS left_after_removal FROM v_requires r WHERE r.dst = {GATE}")
def g20(t, gone=GATE):
    e = t.v_requires
    touched = e.where(F.col("dst") == gone).select("src")
    return e.join(touched, "src", "left_semi").groupBy(F.col("src").alias("node")).agg((F.count("*") - 1).alias("left_after_removal"))


@query("G21_cycles", """WITH RECURSIVE e AS (SELECT src, dst FROM v_requires UNION SELECT dst, src FROM v_requires WHERE src % 97 = 0), w AS (SELECT src, dst FROM e UNION SELECT w.src, e.dst FROM w JOIN e ON w.dst = e.src) SELECT src AS node FROM w WHERE src = dst""")
def g21(t):
    """Nodes of components of several, or with an edge to themselves."""
    e = graph.materialize(with_cycles(t))
    parts = structure.strong_components(e)
    several = parts.groupBy("component").agg(F.count("*").alias("n")).where("n > 1")
    own = e.where("src = dst").select(F.col("src").alias("node"))
    return parts.join(several, "component", "left_semi").select("node").union(own).distinct()


_CYCLIC = """WITH RECURSIVE e AS (SELECT src, dst FROM v_requires UNION SELECT dst, src FROM v_requires WHERE src % 97 = 0), w AS (SELECT src, dst FROM e UNION SELECT w.src, e.dst FROM w JOIN e ON w.dst = e.src),
  mutual AS (SELECT a.src AS node, min(a.dst) AS low FROM w a JOIN w b ON a.src = b.dst AND a.dst = b.src GROUP BY a.src),
  parts AS (SELECT n.node, least(n.node, low) AS component FROM (SELECT src AS node FROM e UNION SELECT dst FROM e) n LEFT JOIN mutual ON mutual.node = n.node),
  c AS (SELECT DISTINCT a.component AS src, b.component AS dst FROM e JOIN parts a ON a.node = e.src JOIN parts b ON b.node = e.dst WHERE a.component <> b.component) """


def with_cycles(t: Tables) -> DataFrame:
    """The course edges, those of every 97th course turned round as well, so that there are cycles."""
    e = t.v_requires
    return e.union(graph.reversed_edges(e.where("src % 97 = 0")))


@query("G21_strong_components", _CYCLIC + "SELECT node, component FROM parts")
def g21_components(t):
    return structure.strong_components(with_cycles(t))


def condensation(t: Tables) -> DataFrame:
    e = graph.materialize(with_cycles(t))
    return structure.condensed(e, structure.strong_components(e))


@query("G10_longest_chains_condensed", _CYCLIC + ", up AS (SELECT src AS node, 1 AS depth FROM c UNION SELECT c.src, depth + 1 FROM up JOIN c ON c.dst = up.node) SELECT node, CAST(max(depth) AS INT) AS depth FROM up GROUP BY node")
def g10_condensed(t):
    """Longest chains over strong components, where the edges have cycles."""
    return graph.levels(condensation(t)).where("depth > 0")


@query("G12_trails_through_condensed", _CYCLIC + ", trail AS (SELECT src, dst, [src, dst] AS nodes FROM c UNION ALL SELECT t.src, c.dst, list_append(t.nodes, c.dst) FROM trail t JOIN c ON t.dst = c.src) SELECT node, count(*) AS paths_through FROM (SELECT unnest(nodes) AS node FROM trail) GROUP BY node")
def g12_condensed(t):
    return graph.path_counts(condensation(t)).select("node", ((1 + F.col("ins")) * (1 + F.col("outs")) - 1).cast("long").alias("paths_through"))


@query("G11_trails_into_condensed", _CYCLIC + f", trail AS (SELECT src, dst FROM c UNION ALL SELECT t.src, c.dst FROM trail t JOIN c ON t.dst = c.src) SELECT count(*) AS trails FROM trail WHERE dst = (SELECT component FROM parts WHERE node = {GATE})")
def g11_condensed(t, node=GATE):
    e = graph.materialize(with_cycles(t))
    parts = graph.materialize(structure.strong_components(e))
    return graph.trails_into(structure.condensed(e, parts), parts.where(F.col("node") == node).first().component)


@query("G21_acyclic", WALK + "SELECT count(*) AS on_cycles FROM cl WHERE src = dst")
def g21_acyclic(t):
    return graph.on_cycles(t.v_requires).agg(F.count("*").alias("on_cycles"))


@query("G22_single_points", TRAILS + """, pair AS (SELECT src, dst, count(*) AS n FROM trail GROUP BY src, dst)
  SELECT a.dst AS node, count(*) AS pairs FROM pair a JOIN pair b ON a.dst = b.src JOIN pair p ON p.src = a.src AND p.dst = b.dst WHERE a.n * b.n = p.n GROUP BY a.dst""")
def g22(t):
    return structure.essential(t.v_requires)


@query("G23_components", """WITH RECURSIVE e AS (SELECT src, dst FROM v_requires UNION SELECT dst, src FROM v_requires),
  w AS (SELECT src AS node, least(src, min(dst)) AS least, 0 AS round FROM e GROUP BY src
    UNION ALL SELECT node, least, round FROM (SELECT w.node, least(w.least, min(n.least)) AS least, w.round + 1 AS round FROM w JOIN e ON e.src = w.node JOIN w n ON n.node = e.dst AND n.round = w.round WHERE w.round < 40 GROUP BY w.node, w.least, w.round))
  SELECT node, least AS component FROM w WHERE round = (SELECT max(round) FROM w)""")
def g23(t):
    return graph.components(t.v_requires)


def cover_sql(k: int) -> str:
    """Greedy cover, a pair of tables for each step: the best set of what is left, and what it leaves."""
    parts = ["l0 AS MATERIALIZED (SELECT DISTINCT pathway_id AS set_id, course_id AS item FROM v_includes)"]
    for i in range(k):
        parts.append(f"b{i + 1} AS MATERIALIZED (SELECT set_id, count(*) AS covered FROM l{i} GROUP BY set_id ORDER BY covered DESC, set_id LIMIT 1)")
        parts.append(f"l{i + 1} AS MATERIALIZED (SELECT * FROM l{i} WHERE item NOT IN (SELECT item FROM l{i} JOIN b{i + 1} USING (set_id)))")
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(f"SELECT CAST({i} AS INT) AS step, set_id, covered FROM b{i}" for i in range(1, k + 1))


@query("G24_set_cover", cover_sql(6))
def g24(t, k=6):
    return graph.set_cover(t.v_includes.select(F.col("pathway_id").alias("set_id"), F.col("course_id").alias("item")), k)


_BOTH = " UNION ALL ".join(f"SELECT '{n}' AS edge, count(*) AS out_edges, count(*) AS in_edges, 2 * count(*) AS undirected FROM {n}" for n in ("v_requires", "v_includes", "v_prepares_for", "v_offers"))


@query("G25_edge_directions", _BOTH)
def g25(t):
    """Edges counted from the tail, from the head and both ways: a check that none is lost."""
    out = None
    for name, a, b in (("v_requires", "src", "dst"), ("v_includes", "pathway_id", "course_id"), ("v_prepares_for", "cip_code", "soc_code"), ("v_offers", "unitid", "cip_code")):
        e = getattr(t, name).select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))
        ends = e.select(F.explode(F.array(F.struct(F.lit(0).alias("head"), F.col("a").alias("n")), F.struct(F.lit(1).alias("head"), F.col("b").alias("n")))).alias("x"))
        own = ends.groupBy("x.head", "x.n").agg(F.count("*").alias("c")).agg(F.sum(F.when(F.col("head") == 0, F.col("c"))).alias("out_edges"), F.sum(F.when(F.col("head") == 1, F.col("c"))).alias("in_edges"), F.sum("c").alias("undirected")).select(F.lit(name).alias("edge"), "out_edges", "in_edges", "undirected")
        out = own if out is None else out.unionByName(own)
    return out


@query("W14_depth_profile", WALK + f", first AS (SELECT src, min(depth) AS depth FROM cl WHERE dst = {GATE} GROUP BY src) SELECT CAST(k AS INT) AS depth, (SELECT count(*) FROM first WHERE first.depth <= k) AS closed_off FROM range(1, 9) r(k)")
def w14(t, node=GATE, k=8):
    """Courses closed off within 1 to k steps."""
    found = graph.ancestors(t.v_requires, node)
    steps = found.sparkSession.range(1, k + 1).select(F.col("id").cast("int").alias("k"))
    return steps.join(found, F.col("depth") <= F.col("k"), "left").groupBy(F.col("k").alias("depth")).agg(F.count("node").alias("closed_off"))


@query("X2_needed_not_completed", WALK + f"SELECT dst AS node FROM cl WHERE src = {COURSE} EXCEPT SELECT unnest([{_DONE}])::BIGINT")
def x2(t, target=COURSE, completed=COMPLETED):
    done = t.spark.createDataFrame([(c,) for c in completed], "node long")
    return index_of(t).descendants(target).join(done, "node", "left_anti")


@query("X3_shared_ancestors", WALK + f"SELECT dst AS node FROM cl WHERE src = {COURSE} INTERSECT SELECT dst FROM cl WHERE src = 130")
def x3(t, a=COURSE, b=130):
    index = index_of(t)
    return index.descendants(a).intersect(index.descendants(b))


@query("J21_chains_across_subjects", TRAILS + "SELECT a.subject AS from_subject, b.subject AS to_subject, count(*) AS chains FROM trail JOIN v_in_subject a ON a.course_id = src JOIN v_in_subject b ON b.course_id = dst WHERE a.subject <> b.subject GROUP BY a.subject, b.subject ORDER BY chains DESC, from_subject, to_subject LIMIT 10")
def j21(t, k=10):
    pairs, s = graph.pair_counts(t.v_requires), t.v_in_subject
    a, b = (s.select(F.col("course_id").alias(key), F.col("subject").alias(name)) for key, name in (("src", "from_subject"), ("dst", "to_subject")))
    both = pairs.join(a, "src").join(b, "dst").where("from_subject <> to_subject")
    return both.groupBy("from_subject", "to_subject").agg(F.sum("n").cast("long").alias("chains")).orderBy(F.desc("chains"), "from_subject", "to_subject").limit(k)


@query("J22_internal_edges", "SELECT a.subject, count(*) AS internal_edges FROM v_requires JOIN v_in_subject a ON a.course_id = src JOIN v_in_subject b ON b.course_id = dst AND a.subject = b.subject GROUP BY a.subject")
def j22(t):
    e, s = t.v_requires, t.v_in_subject
    a = s.select(F.col("course_id").alias("src"), "subject")
    b = s.select(F.col("course_id").alias("dst"), "subject")
    return e.join(a, "src").join(b, ["dst", "subject"]).groupBy("subject").agg(F.count("*").alias("internal_edges"))
