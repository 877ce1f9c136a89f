"""Input tables and the derived pathway tables over them.

The derived tables are plain SQL that Spark and other engines read alike. They
are inlined where a query uses them, so nothing is registered in the session
and Catalyst prunes and pushes through them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")

VIEWS: dict[str, str] = {
    "v_course": "SELECT p_partkey AS course_id, p_name AS name, p_brand AS subject, p_type AS kind FROM part",
    "v_requires": """SELECT DISTINCT src, dst FROM (
        SELECT p_partkey AS src, CAST(floor(p_partkey / 2) AS BIGINT) AS dst FROM part WHERE p_partkey > 1 AND p_partkey % 3 <> 0
        UNION ALL
        SELECT p_partkey AS src, CAST(floor(p_partkey / 3) AS BIGINT) AS dst FROM part WHERE p_partkey % 5 = 0
      ) e WHERE dst >= 1 AND dst <> src""",
    "v_in_subject": "SELECT p_partkey AS course_id, p_brand AS subject FROM part WHERE p_partkey % 11 <> 0",
    "v_pathway_rows": """SELECT l_suppkey % 42 AS pathway_id, l_partkey AS course_id,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS section,
        CAST(CAST(l_quantity AS INT) % 4 + 1 AS STRING) AS credits,
        l_orderkey * 10 + l_linenumber AS pos
      FROM lineitem WHERE l_orderkey % 5 = 0""",
    "v_includes": "SELECT pathway_id, course_id, COUNT(*) AS n_rows, COUNT(DISTINCT section) AS n_sections FROM v_pathway_rows GROUP BY pathway_id, course_id",
    "v_institution": "SELECT lpad(CAST(s_suppkey AS STRING), 6, '0') AS unitid, s_name AS name, n_name AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "v_located_in": "SELECT unitid, concat('state|', state) AS place_id FROM v_institution",
    "v_programme": "SELECT lpad(CAST(p_partkey AS STRING), 6, '0') AS cip_code, p_name AS name FROM part",
    "v_offers": "SELECT DISTINCT lpad(CAST(l_suppkey AS STRING), 6, '0') AS unitid, lpad(CAST(l_partkey AS STRING), 6, '0') AS cip_code FROM lineitem",
    "v_prepares_for": """SELECT lpad(CAST(p_partkey AS STRING), 6, '0') AS cip_code,
        concat(CAST(11 + 2 * (p_partkey % 23) AS STRING), '-', lpad(CAST(p_partkey % 97 AS STRING), 4, '0')) AS soc_code,
        'CIP2020-SOC2018' AS source_edition FROM part WHERE p_partkey % 31 <> 0
      UNION ALL
      SELECT lpad(CAST(p_partkey AS STRING), 6, '0'),
        concat(CAST(11 + 2 * (p_partkey % 5) AS STRING), '-', lpad(CAST(p_partkey % 7 AS STRING), 4, '0')),
        'CIP2020-SOC2018' FROM part WHERE p_partkey % 3 = 0
      UNION ALL
      SELECT lpad(CAST(p_partkey AS STRING), 6, '0'), '99-9999', 'CIP2020-SOC2018' FROM part WHERE p_partkey % 31 = 0""",
    "v_completion": """SELECT lpad(CAST(l_suppkey AS STRING), 6, '0') AS unitid, lpad(CAST(l_partkey AS STRING), 6, '0') AS cip_code,
        l_linenumber AS award_level, CAST(1 + l_orderkey % 2 AS INT) AS majornum,
        l_returnflag AS race, l_linestatus AS sex, 2022 AS year,
        CASE WHEN l_discount < 0.02 THEN CAST(0 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS awards,
        l_orderkey * 10 + l_linenumber AS pos
      FROM lineitem""",
    "v_completion_demo": """SELECT unitid, cip_code, award_level, majornum, coalesce(race, '99') AS race, coalesce(sex, '99') AS sex,
        CAST(sum(awards) AS BIGINT) AS awards
      FROM v_completion
      GROUP BY GROUPING SETS ((unitid, cip_code, award_level, majornum, race, sex), (unitid, cip_code, award_level, majornum, race),
        (unitid, cip_code, award_level, majornum, sex), (unitid, cip_code, award_level, majornum))""",
    "v_earnings": """SELECT concat(CAST(11 + 2 * (o_custkey % 23) AS STRING), '-', lpad(CAST(o_custkey % 97 AS STRING), 4, '0')) AS soc_code,
        CAST(year(o_orderdate) AS INT) AS year, CAST(floor(o_totalprice) AS BIGINT) AS median, o_orderpriority AS source
      FROM orders""",
    "v_teaches": "SELECT n_nationkey AS ncessch, p_partkey AS course_id FROM nation JOIN part ON p_partkey % 25 = n_nationkey",
    "v_in_district": "SELECT n_nationkey AS ncessch, n_regionkey AS leaid FROM nation",
    "v_occ": "SELECT DISTINCT soc_code FROM v_prepares_for",
    # crosswalk sheet: a title row, a heading row, then mappings with dotted codes; every 13th row lacks its occupation
    "v_crosswalk_cells": """SELECT CAST(0 AS BIGINT) AS row_no, 'Crosswalk' AS c0, '' AS c1, '' AS c2, '' AS c3
      UNION ALL SELECT CAST(1 AS BIGINT), 'CIP2020Code', 'CIP2020Title', 'SOC2018Code', 'SOC2018Title'
      UNION ALL
      SELECT 2 + CAST(cip_code AS BIGINT) * 100000 + CAST(substring(soc_code, 1, 2) AS BIGINT) * 97 + CAST(right(soc_code, 4) AS BIGINT), concat(substring(cip_code, 1, 2), '.', substring(cip_code, 3, 4)),
        concat('Programme ', cip_code), CASE WHEN right(cip_code, 2) = '13' THEN '' ELSE soc_code END, concat('Occupation ', soc_code)
      FROM v_prepares_for""",
    "v_flags": "SELECT s_suppkey, CAST(s_suppkey % 5 - 3 AS INT) AS flag1, CAST((s_suppkey + 1) % 5 - 3 AS INT) AS flag2, CAST((s_suppkey + 2) % 5 - 3 AS INT) AS flag3, CAST(s_suppkey % 2 AS INT) AS flag4 FROM supplier",
    "v_geo": "SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 11 = 0 THEN 0.0 ELSE s_acctbal / 200 END AS lat, CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 11 = 0 THEN 0.001 ELSE s_acctbal / 100 END AS lon FROM supplier",
    "v_earnings_raw": """SELECT o_orderkey AS unitid, o_orderstatus AS level,
        CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 3 = 0 THEN 'PS' WHEN CAST(floor(o_totalprice) AS BIGINT) % 5 = 0 THEN 'NA' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS m1,
        CASE WHEN o_custkey % 3 = 0 THEN 'PS' WHEN o_custkey % 5 = 0 THEN 'NA' ELSE CAST(o_custkey AS STRING) END AS m2,
        CASE WHEN o_orderkey % 4 = 0 THEN 'NA' ELSE CAST(o_orderkey AS STRING) END AS m3
      FROM orders""",
    # O*NET-like codes: a suffix on every occupation, several for some
    "v_onet": """SELECT concat(soc_code, '.00') AS onet_code, concat('Title ', soc_code) AS title FROM v_occ
      UNION ALL SELECT concat(soc_code, '.03'), concat('Title ', soc_code, ' special') FROM v_occ WHERE right(soc_code, 1) IN ('1', '4')""",
    "v_metrics": """SELECT 1 AS run, n_name AS district, 'courses' AS metric, CAST(n_nationkey % 4 AS BIGINT) AS value FROM nation
      UNION ALL SELECT 2, n_name, 'courses', CAST(CASE WHEN n_nationkey % 10 = 3 THEN 0 ELSE n_nationkey % 4 END AS BIGINT) FROM nation""",
}


def needed(sql: str) -> list[str]:
    """Derived tables that a query names, those they build on first."""
    out: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(re.findall(r"\bv_\w+", text))):
            if name in VIEWS and name not in out:
                visit(VIEWS[name])
                out.append(name)

    visit(sql)
    return out


def inlined(sql: str) -> str:
    """The query with the derived tables it names as common table expressions."""
    names = needed(sql)
    if not names:
        return sql
    own = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    if m := re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql, re.I):
        return f"WITH {'RECURSIVE ' if m[1] else ''}{own}, {sql[m.end() :]}"
    return f"WITH {own} {sql}"


class Tables:
    """The tables of a folder: attributes are DataFrames, sql() runs a query over them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        if name in VIEWS:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        files = re.compile(rf"\b(FROM|JOIN)\s+({'|'.join(BASE)})\b", re.I)
        return self.spark.sql(files.sub(lambda m: f"{m[1]} parquet.`{self.dir}/{m[2]}.parquet`", inlined(text)))
