"""Catalogue pages: records, statement classes, pathway rows and link resolution."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.keys import collapsed
from waymark.functions.text import decoded, field_in, field_items, field_pieces, field_text, items_of, path_of, segments, states_a_prerequisite, text_of
from waymark.sources.shared import dealt, materialize


def page_records(pages: DataFrame, decode: Callable[[Column], Column] = decoded) -> DataFrame:
    """title, links, items and a drift flag of each page: a navigation field without links. decode: how the title's references are read."""
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)
    title = field_text("html", "h1", decode)
    return pages.select(
        *(c for c in pages.columns if c != "html"),
        F.when(F.lower(title) != "page not found", title).alias("title"), links.alias("links"), field_items("html").alias("items"),
        ((F.size(links) == 0) & F.contains("html", F.lit("<nav"))).alias("field_present_no_links"))


def catalogue_records(pages: DataFrame) -> DataFrame:
    """The record of each catalogue page that has a title: description, requirement text, grades and prerequisite links.

    Pages without a heading, and those that were not found, are no courses.
    field_present_no_links: the prerequisite field is there but no link was read from it.
    """
    names = ("prerequisite-courses", "recommended", "description", "grades")
    # the fields' markup is cut out once, then read
    pieces = pages.withColumn("_pieces", field_pieces("html"))
    cut = pieces.select("*", *(field_in(F.col("_pieces"), n).alias(f"_{n}") for n in names), text_of(F.regexp_extract("html", r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)).alias("title"))
    block = F.coalesce(F.col("_prerequisite-courses"), F.lit(""))
    whole = F.regexp_extract_all(block, F.lit(r'(?s)<a href="[^"]+"[^>]*>.*?</a>'), 0)
    links = F.transform(whole, lambda x: F.struct(F.regexp_extract(x, '^<a href="([^"]+)"', 1).alias("href"), text_of(x).alias("name")))
    told = cut.where((F.col("title") != "") & ~F.lower("title").startswith("page not found"))
    text = lambda n: F.nullif(text_of(F.col(f"_{n}")), F.lit(""))
    return told.select(
        *(c for c in pages.columns if c != "html"), "title", links.alias("prerequisite_links"), text("recommended").alias("requirements_text"),
        text("description").alias("description"), items_of(F.col("_grades")).alias("grade_levels"),
        (F.col("_prerequisite-courses").isNotNull() & (F.size(whole) == 0)).alias("field_present_no_links"))


def seconds_between(started: Column | str, ended: Column | str) -> Column:
    """Whole seconds; null where a stamp is missing or unreadable or the end comes first."""
    a, b = (F.try_to_timestamp(F.col(x) if isinstance(x, str) else x, F.lit("yyyy-MM-dd'T'HH:mm:ss")) for x in (started, ended))
    gap = F.unix_timestamp(b) - F.unix_timestamp(a)
    return F.when(gap >= 0, gap)


def band(value: Column | str, bounds: tuple[int, ...]) -> Column:
    """Name of the band a value falls in; the last has no upper bound."""
    value = F.col(value) if isinstance(value, str) else value
    out, low = F.when(F.lit(False), ""), 0
    for b in bounds:
        out = out.when(value < b, f"{low}-{b - 1}")
        low = b
    return out.otherwise(f"{low}+")


def cell_class(cell: Column) -> Column:
    """number, names courses or prose; null for blanks and dashes."""
    bare = F.trim(cell)
    return F.when(bare.isin("", "-", "–", "—"), None).when(bare.rlike(r"\A[0-9]+(\.[0-9]+)?\z"), "number").when(bare.rlike(r"(?i)\bincl\."), "names courses").otherwise("prose")


def pathway_rows(pages: DataFrame, *key: str, html: str = "html") -> DataFrame:
    """key, pos, href, credits and section of each course row: the section is that of the heading last passed."""
    parts = F.regexp_extract_all(html, F.lit(r'(?s)<h3 class="section">.*?</h3>|<div class="row">.*?</div>'), 0)
    each = pages.select(*key, F.posexplode(parts).alias("pos", "part"))
    head = F.regexp_extract("part", '(?s)<h3 class="section">(.*?)</h3>', 1)
    from pyspark.sql import Window

    w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("section", F.last(F.when(F.col("part").startswith("<h3"), head), ignorenulls=True).over(w)).where(F.col("part").startswith("<div"))
    found = lambda pattern: F.nullif(F.regexp_extract("part", pattern, 1), F.lit(""))
    return placed.select(*key, "pos", found('href="([^"]+)"').alias("href"), found('(?s)<span class="credits">(.*?)</span>').alias("credits"), F.nullif("section", F.lit("")).alias("section"))


class _Field(HTMLParser):
    """Whether a field element closes before the next section does, its text and its links."""

    def __init__(self, tag: str, ends: tuple[str, ...]) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.ends, self.depth = tag, ends, 0
        self.seen = self.closed = self.cut = False
        self.text, self.links = [], []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag and not self.closed:
            self.seen, self.depth = True, self.depth + 1
        elif self.depth and tag in self.ends:
            self.cut, self.depth = True, 0
        elif self.depth and tag == "a":
            self.links.append(dict(attrs).get("href") or "")

    def handle_endtag(self, tag):
        if tag == self.tag and self.depth:
            self.depth -= 1
            self.closed = self.depth == 0

    def handle_data(self, data):
        if self.depth:
            self.text.append(data)


def read_fields(pages: DataFrame, tag: str = "nav", ends: tuple[str, ...] = ("article", "footer")) -> DataFrame:
    """url, field present, bounded, text and links of one field of each page, by walking its markup."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, html in zip(batch["page_id"], batch["html"]):
                p = _Field(tag, ends)
                p.feed(html or "")
                out.append((page, p.seen, p.closed and not p.cut, " ".join("".join(p.text).split()), p.links))
            yield pd.DataFrame(out, columns=["page_id", "present", "bounded", "text", "links"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, present boolean, bounded boolean, text string, links array<string>")


def statement_classes(pages: DataFrame) -> DataFrame:
    """page_id and class: typed, typed-no-link, prose, says-none, no-field or unbounded."""
    f = read_fields(pages)
    none = F.lower(F.trim("text")).isin("none", "n/a", "na", "nil", "-", "–", "—")
    kind = (F.when(~F.col("present"), "no-field").when(~F.col("bounded"), "unbounded").when(F.size("links") > 0, "typed")
            .when(F.col("text") == "", "typed-no-link").when(none, "says-none").otherwise("prose"))
    return f.select("page_id", kind.alias("class"))


#: The class prefix of named fields; from the HTML standard, elements without an end tag, with an end tag that may be left out, and whose content is no text of the page.
_NAME = "field--name-field-"
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_OPTIONAL_END = ("html", "head", "body", "li", "dt", "dd", "p", "rt", "rp", "optgroup", "option", "colgroup", "caption", "thead", "tbody", "tfoot", "tr", "td", "th")
_NO_TEXT = ("script", "style", "template", "noscript")
#: A whole tag, quoted values with their angle brackets included, and the value of an attribute after its name.
_TAG = r"""^<[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>"""
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag; empty without it."""
    found = rf"(?is)\s{name}{_VALUE}"
    return F.concat(*(F.regexp_extract(tag, found, k) for k in (1, 2, 3)))


def _tags(pages: DataFrame, key: str) -> DataFrame:
    """key, parts (the page cut before each angle bracket), pos, name, opens and fields (names by its class) of each tag that has an end tag as a rule."""
    no_text = rf"(?is)<({'|'.join(_NO_TEXT)})\b.*?</\1\s*>|<!--.*?-->"
    body = F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), no_text, " "), r"(?is)(</(article|main)\b|<footer\b).*", "")
    each = pages.select(F.col(key), F.split(body, "(?=<)").alias("parts")).select(key, "parts", F.posexplode("parts").alias("pos", "part"))
    name = F.lower(F.regexp_extract("part", r"^</?([A-Za-z][^\s/>]*)", 1))
    named = F.filter(F.split(_attribute(F.regexp_extract("part", _TAG, 0), "class"), r"\s+"), lambda c: c.startswith(_NAME))
    out = each.select(key, "parts", "pos", name.alias("name"), ~F.col("part").startswith("</"), named).toDF(key, "parts", "pos", "name", "opens", "fields")
    return out.where((F.col("name") != "") & ~F.col("name").isin(*_VOID, *_OPTIONAL_END))


def named_fields(pages: DataFrame, key: str) -> DataFrame:
    """key, field, bounded, text and links of each named field of each page. Pages without fields give no rows.

    Start and end tags are matched by nesting depth, for each element name alone:
    a start tag ends at the next tag of its name that goes back below its depth.
    So each element is an interval. Depth over all names tells which elements
    cross: it is the same before and behind an element that crosses none. A field
    is bounded if its interval is closed and no tag within it, or its own, belongs
    to an element that crosses another or stays open. Elements whose end tags may
    be left out don't count. The first field of a name counts; fields within a
    field are part of it; the article's or main part's end and the footer end all.
    """
    from pyspark.sql import Window

    page = Window.partitionBy(key).orderBy("pos")  # the tags of one page
    alike = Window.partitionBy(key, "name").orderBy("pos")
    tags = _tags(dealt(pages.select(key, "html"), key), key)  # every tag carries its page, so tasks are bounded by pages
    level = F.sum(F.when(F.col("opens"), 1).otherwise(-1)).over(alike)
    # a start tag and its end tag share the depth that holds between them
    deep = tags.withColumn("depth", F.when(F.col("opens"), level).otherwise(level + 1))
    same = Window.partitionBy(key, "name", "depth").orderBy("pos")
    ahead, behind = F.lead("opens").over(same), F.lag("opens").over(same)
    paired = deep.withColumns({"mate": F.when(F.col("opens") & ~ahead, F.lead("pos").over(same)), "ends": F.coalesce(~F.col("opens") & behind, F.lit(False))})
    # end tags without a start tag mean nothing
    live = paired.where(F.col("opens") | F.col("ends"))
    by = F.when(F.col("opens") & F.col("mate").isNotNull(), 1).when(F.col("ends"), -1).otherwise(0)
    total = F.sum(by).over(page)
    # the depth outside the element, the same for a start tag and its end tag
    outside = live.withColumn("outside", F.when(F.col("opens"), total - by).otherwise(total))
    mate = Window.partitionBy(key, "name", "depth").orderBy("pos")
    other = F.when(F.col("opens"), F.lead("outside").over(mate)).otherwise(F.lag("outside").over(mate))
    odd = (F.col("opens") & F.col("mate").isNull()) | (F.col("outside") != other)
    counted = outside.withColumn("odd", odd).withColumn("odds", F.sum(F.when(F.col("odd"), 1).otherwise(0)).over(page))
    upto = Window.partitionBy(key, "name", "depth").orderBy("pos")
    spans = counted.withColumn("odds_at_end", F.lead("odds").over(upto)).where(F.col("opens") & (F.size("fields") > 0))
    bounded = F.col("mate").isNotNull() & ~F.col("odd") & (F.col("odds_at_end") == F.col("odds"))
    found = spans.select(key, "parts", "pos", "mate", bounded.alias("bounded"), F.get("fields", F.lit(0)).alias("field"))
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    apart = found.withColumn("reach", F.max(F.coalesce("mate", F.lit(1 << 30))).over(before)).where(F.coalesce(F.col("pos") > F.col("reach"), F.lit(True)))
    first = apart.withColumn("n", F.row_number().over(Window.partitionBy(key, "field").orderBy("pos"))).where("n = 1")
    # the field's markup: what follows its start tag, up to its end tag
    last = F.coalesce(F.col("mate"), F.size("parts"))
    inner = F.slice("parts", F.col("pos") + 1, last - F.col("pos"))
    links = F.filter(F.transform(F.filter(inner, lambda x: x.rlike(r"(?i)^<a\s")), lambda x: decoded(_attribute(F.regexp_extract(x, _TAG, 0), "href"))), lambda x: x != "")
    text = collapsed(decoded(F.array_join(F.transform(inner, lambda x: F.regexp_replace(x, _TAG, "")), "")))
    return first.select(key, F.substr("field", F.lit(len(_NAME) + 1)).alias("field"), "bounded", text.alias("text"), links.alias("links"))


def catalogue_statements(pages: DataFrame, key: str, host: str, published: DataFrame) -> DataFrame:
    """key, class, links and resolved of each page's prerequisite statement.

    class: typed (the field of links has one to a course path), typed-no-link,
    prose (the text field states something), says-none, unbounded (its field
    can't be told from what follows), or no-field. links: distinct course paths;
    resolved: how many of them are published (path).
    """
    f = named_fields(pages, key).where(F.col("field").isin("prerequisite-courses", "pr"))
    one = lambda name: F.max(F.when(F.col("field") == name, F.struct("bounded", "text", "links")))
    rows = pages.select(key).join(f.groupBy(key).agg(one("prerequisite-courses").alias("t"), one("pr").alias("p")), key, "left")
    paths = F.array_distinct(F.filter(F.transform("t.links", lambda x: path_of(x, host)), lambda x: F.size(segments(x)) == 2))
    rows = rows.withColumn("paths", F.when(F.col("t.bounded"), paths))
    kind = (F.when(~F.col("t.bounded"), "unbounded").when(F.size("paths") > 0, "typed").when(F.col("t").isNotNull(), "typed-no-link")
            .when(~F.col("p.bounded"), "unbounded").when(states_a_prerequisite("p.text"), "prose").when(F.col("p").isNotNull(), "says-none").otherwise("no-field"))
    rows = materialize(rows.select(key, kind.alias("class"), "paths"))  # read twice
    hits = rows.select(key, F.explode("paths").alias("path")).join(published.select("path").distinct(), "path", "left_semi").groupBy(key).agg(F.count("*").alias("resolved"))
    out = rows.join(hits, key, "left")
    return out.select(key, "class", F.greatest(F.coalesce(F.size("paths"), F.lit(0)), F.lit(0)).alias("links"), F.coalesce("resolved", F.lit(0)).alias("resolved"))


def resolved_links(links: DataFrame, pages: DataFrame, courses: DataFrame) -> DataFrame:
    """links (src, href) with outcome resolved, off-level (a page that is no course), unresolved or duplicated.

    The first of equal links by pos keeps its outcome; the others are duplicated.
    """
    from pyspark.sql import Window

    ranked = links.withColumn("_n", F.row_number().over(Window.partitionBy("src", "href").orderBy("pos")))
    a = courses.select(F.col("path").alias("href"), F.lit(1).alias("_c")).distinct()
    b = pages.select(F.col("path").alias("href"), F.lit(1).alias("_p")).distinct()
    joined = ranked.join(a, "href", "left").join(b, "href", "left")
    return joined.select("src", "href", "pos", F.when(F.col("_n") > 1, "duplicated").when(F.col("_c").isNotNull(), "resolved").when(F.col("_p").isNotNull(), "off-level").otherwise("unresolved").alias("outcome"))
