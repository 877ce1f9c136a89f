"""Readers and writers of landed slices, files, sheets and exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_slice(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A landed JSON slice with its declared schema; nothing is inferred."""
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a heading row, all strings; a byte order mark before the first heading is dropped."""
    df = spark.read.option("header", True).option("multiLine", False).csv(path)
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})


def unrevised_member(names: DataFrame, column: str = "name") -> DataFrame:
    """The one CSV member of an archive's file names that is not a revision; refuses none and several."""
    found = names.where(F.col(column).endswith(".csv") & ~F.col(column).endswith("_rv.csv"))
    return found.agg(F.count("*").alias("n"), F.min(column).alias(column)).select(
        F.when(F.assert_true(F.col("n") == 1, F.lit("an archive must have one unrevised member")).isNull(), F.col(column)).alias(column))


def unrevised_members(names: DataFrame, archive: str, column: str = "name") -> DataFrame:
    """For each archive the number of its unrevised CSV members, and the one there must be; null where there is none or there are several."""
    real = F.col(column).endswith(".csv") & ~F.col(column).endswith("_rv.csv")
    found = names.groupBy(archive).agg(F.count_if(real).alias("candidates"), F.min(F.when(real, F.col(column))).alias("one"))
    return found.select(archive, "candidates", F.when(F.col("candidates") == 1, F.col("one")).alias(column))


def code_tokens(df: DataFrame, text: str, *by: str) -> DataFrame:
    """Code-shaped tokens (dd.dddd, dd-dddd) by group: how many, and up to five samples."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"(?<![0-9.-])([0-9]{2}[.-][0-9]{4})(?![0-9.-])"), 1)
    each = df.select(*by, F.explode(found).alias("token")).groupBy(*by, "token").agg(F.count("*").alias("n"))
    first = each.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("token"))).where("rank <= 5")  # tasks drop what is beyond five before rows move
    shown = first.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("token")), ",").alias("samples"))
    total = each.groupBy(*by).agg(F.sum("n").alias("tokens"))
    named = shown.withColumnsRenamed({c: f"_{c}" for c in by})
    same = reduce(lambda a, b: a & b, (total[c].eqNullSafe(named[f"_{c}"]) for c in by))
    return total.join(named, same).drop(*(f"_{c}" for c in by))


# ---- sheets: rows of (row_no, cells)


def heading_rows(sheet: DataFrame, name: str, within: int = 12) -> DataFrame:
    """Rows at the top whose cells have a heading that holds the name and ends in "code": at most `within`."""
    hit = F.exists("cells", lambda c: F.lower(c).contains(name.lower()) & F.lower(c).endswith("code"))
    return sheet.where((F.col("row_no") < within) & hit)


def heading_row(sheet: DataFrame, name: str, within: int = 12) -> DataFrame:
    """The first of the heading rows."""
    return heading_rows(sheet, name, within).orderBy("row_no").limit(1)


def sheet_guards(sheet: DataFrame, name: str, at: int, expected: str) -> DataFrame:
    """One row: candidates for the heading row, whether its first cell is filled and the one at a place reads as expected; usable if one row passes all."""
    head = heading_rows(sheet, name)
    out = head.agg(
        F.count("*").alias("candidates"), F.coalesce(F.bool_and(F.trim(F.col("cells")[0]) != ""), F.lit(False)).alias("first_heading"),
        F.coalesce(F.bool_and(F.col("cells")[at] == expected), F.lit(False)).alias("expected"))
    return out.withColumn("usable", (F.col("candidates") == 1) & F.col("first_heading") & F.col("expected"))


def column_at(sheet: DataFrame, heading: DataFrame, test) -> int:
    """Position of the one heading that passes the test; refuses none and several."""
    cells = heading.select("cells").first()
    if cells is None:
        raise ValueError("no heading row")
    at = [i for i, c in enumerate(cells[0]) if test(c)]
    if len(at) != 1:
        raise ValueError(f"{len(at)} headings match")
    return at[0]


def sheet_pairs(sheet: DataFrame, left: str = "cip", right: str = "soc") -> DataFrame:
    """row_no, left and right codes below the heading row; blanks are null."""
    head = heading_row(sheet, left)
    a, b = (column_at(sheet, head, lambda c, n=n: n in c.lower() and c.lower().endswith("code")) for n in (left, right))
    first = head.first()["row_no"]
    blank = lambda i: F.nullif(F.trim(F.col("cells")[i]), F.lit(""))
    return sheet.where(F.col("row_no") > first).select("row_no", blank(a).alias("left_code"), blank(b).alias("right_code"))


def edition(headings: list[str]) -> str:
    """CIP2020-SOC2018 from headings that end in Code."""
    return "-".join(h[: -len("Code")] for h in headings if h.endswith("Code"))


# ---- sitemaps, envelopes, tables in markup


def sitemap_urls(sitemap: DataFrame, text: str, furniture: tuple[str, ...]) -> DataFrame:
    """Distinct addresses of a sitemap's text without those below furniture paths."""
    url = F.explode(F.regexp_extract_all(F.col(text), F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), 1))
    path = F.regexp_replace("url", "^[a-z]+://[^/]+", "")
    keep = F.lit(True)
    for p in furniture:
        keep = keep & ~path.startswith(p)
    return sitemap.select(url.alias("url")).where(keep).distinct()


ENVELOPE = "decoded_resource variant"


def resources(envelopes: DataFrame, payload: str, kind: str) -> DataFrame:
    """Nodes of a type out of JSON-LD envelopes: the graph's, or the resource itself without a graph.

    Adds `node` (variant) to the other columns; payloads that do not parse have no nodes.
    """
    doc = F.try_parse_json(F.col(payload))
    graph = F.try_variant_get(doc, "$.decoded_resource['@graph']", "array<variant>")
    own = F.array(F.try_variant_get(doc, "$.decoded_resource", "variant"))
    nodes = envelopes.withColumn("node", F.explode(F.coalesce(graph, own))).drop(payload)
    kinds = as_list(F.col("node"), "$['@type']")
    return nodes.where(F.exists(kinds, lambda k: k.contains(kind)))


def as_list(node: Column, path: str) -> Column:
    """A field that is a scalar or a list, as an array of strings; empty where it is absent."""
    many = F.try_variant_get(node, path, "array<string>")
    one = F.try_variant_get(node, path, "string")
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))


def ids(node: Column, path: str) -> Column:
    """The ids of a field that is a text, an object with an @id, or a list of either; empty where it is absent."""
    many = F.try_variant_get(node, path, "array<variant>")
    one = F.try_variant_get(node, path, "variant")
    each = F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<variant>"))
    return F.filter(F.transform(each, lambda x: F.coalesce(F.try_variant_get(x, "$['@id']", "string"), F.try_variant_get(x, "$", "string"))), lambda x: x.isNotNull())


def language_text(node: Column, path: str) -> Column:
    """A text that is a string, a language map (en-US, en, else the first) or a list of strings (joined)."""
    as_map = F.try_variant_get(node, path, "map<string,string>")
    listed = F.try_variant_get(node, path, "array<string>")
    plain = F.try_variant_get(node, path, "string")
    return F.coalesce(F.array_join(listed, ", "), as_map["en-US"], as_map["en"], F.get(F.map_values(as_map), F.lit(0)), F.when(as_map.isNull() & listed.isNull(), plain))


def is_reference(value: Column) -> Column:
    return value.rlike("^(https?://|ce-)")


def table_cells(df: DataFrame, markup: str) -> DataFrame:
    """Other columns, row (from 0), and cells of each table row in the markup."""
    from waymark.functions.text import text_of

    rows = F.regexp_extract_all(F.col(markup), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)
    cells = F.transform(F.regexp_extract_all(F.col("body"), F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), 1), lambda x: text_of(x))  # a function of two would be given the cell's place, too
    return df.select(*(c for c in df.columns if c != markup), F.posexplode(rows).alias("row", "body")).select(*(c for c in df.columns if c != markup), "row", cells.alias("cells"))


def export_tables(tables: dict[str, DataFrame], path: str) -> None:
    """One CSV folder with headings for each node label or edge type."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
