"""Canonical codes and surrogate keys, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Codes that stand for "no occupation", the aggregate series, and the totals of race and sex.
NOT_OCCUPATIONS = ("99-9999", "00-0000")
AGGREGATE_SERIES = "00"
TOTAL = "99"

#: Names of the major occupation groups by two-digit prefix.
SOC_GROUPS = {
    "11": "Management", "13": "Business and Financial Operations", "15": "Computer and Mathematical",
    "17": "Architecture and Engineering", "19": "Life, Physical, and Social Science", "21": "Community and Social Service",
    "23": "Legal", "25": "Educational Instruction and Library", "27": "Arts, Design, Entertainment, Sports, and Media",
    "29": "Healthcare Practitioners and Technical", "31": "Healthcare Support", "33": "Protective Service",
    "35": "Food Preparation and Serving Related", "37": "Building and Grounds Cleaning and Maintenance",
    "39": "Personal Care and Service", "41": "Sales and Related", "43": "Office and Administrative Support",
    "45": "Farming, Fishing, and Forestry", "47": "Construction and Extraction", "49": "Installation, Maintenance, and Repair",
    "51": "Production", "53": "Transportation and Material Moving", "55": "Military Specific",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cip_code(raw: Column | str) -> Column:
    """Six digits from dd.dddd or up to six digits; null for anything else."""
    raw = _col(raw).cast("string")
    return F.when(raw.rlike(r"\A[0-9]{2}\.[0-9]{4}\z"), F.replace(raw, F.lit("."), F.lit(""))).when(raw.rlike(r"\A[0-9]{1,6}\z"), F.lpad(raw, 6, "0"))


def joined_key(*parts: Column | str) -> Column:
    """sha1 over the parts with | between them; null counts as None."""
    return F.sha1(F.concat_ws("|", *(F.coalesce(_col(p).cast("string"), F.lit("None")) for p in parts)))


def completion_id(unitid="unitid", cip="cip_code", award_level="award_level", majornum="majornum", race="race", sex="sex", year="year") -> Column:
    return joined_key(unitid, cip, award_level, majornum, race, sex, year)


def collapsed(text: Column | str) -> Column:
    """Runs of white space of any script to one space, ends trimmed."""
    return F.trim(F.regexp_replace(_col(text), r"(?U)\s+", " "))


def requirement_id(url: Column | str, text: Column | str) -> Column:
    return F.sha1(F.concat(_col(url).cast("string"), F.lit("|"), collapsed(text)))


def soc_of(onet: Column | str) -> Column:
    """The occupation of a code with a suffix after a dot."""
    return F.substring_index(_col(onet), ".", 1)


def soc_group(soc: Column | str) -> Column:
    """Name of the major group; SOC xx for prefixes without one."""
    prefix = F.substring(_col(soc), 1, 2)
    names = F.create_map(*(F.lit(x) for kv in SOC_GROUPS.items() for x in kv))
    return F.coalesce(names[prefix], F.concat(F.lit("SOC "), prefix))


def cip_tier(cip: Column | str) -> Column:
    """family, series or leaf of a dotted code; other where it has another shape."""
    c = _col(cip)
    return (F.when(c.rlike(r"\A[0-9]{2}\.0000\z"), "family").when(c.rlike(r"\A[0-9]{2}\.[0-9]{2}00\z"), "series")
            .when(c.rlike(r"\A[0-9]{2}\.[0-9]{4}\z"), "leaf").otherwise("other"))


def dotted(cip: Column | str) -> Column:
    c = _col(cip)
    return F.concat(F.substring(c, 1, 2), F.lit("."), F.substring(c, 3, 4))


def squashed(text: Column | str) -> Column:
    """A heading without case, spaces and punctuation."""
    return F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]", "")
