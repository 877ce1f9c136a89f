"""Text, markup and URL fields, as column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import _col, collapsed

#: Named references with their characters, from the standard library's table: with the semicolon, and the old ones that may do without.
_NAMED = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
_BARE = {n: c for n, c in html5.items() if not n.endswith(";")}
_LONGEST = max(map(len, _BARE))


def _by_start(names: dict[str, str]) -> str:
    """The names below their first two characters, as an expression that Spark makes a constant of: a lookup walks the few that begin alike."""
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    starts: dict[str, list[str]] = {}
    for name, character in names.items():
        starts.setdefault(name[:2], []).append(f"{quoted(name)}, {quoted(character)}")
    return "map(" + ", ".join(f"{quoted(k)}, map({', '.join(own)})" for k, own in starts.items()) + ")"


_NAMED_MAP, _BARE_MAP = _by_start(_NAMED), _by_start(_BARE)


#: What a field says where nothing is required, and the words of a sentence that denies a requirement.
_NOTHING = ("none", "n/a", "na", "nil", "not applicable", "-", "–", "—")
_BEFORE = ("prior", "previous", "prerequisite")
_ASKED = ("required", "necessary", "needed")


def _character(code: Column) -> Column:
    """The character that a numeric reference means: 128 to 159 as in Windows-1252, none for controls, a replacement for what is no character."""
    windows = {k: bytes([k]).decode("cp1252", "ignore") or chr(k) for k in range(128, 160)}
    table = F.map_from_arrays(F.array(*map(F.lit, windows)), F.array(*map(F.lit, windows.values())))
    point = F.decode(F.unhex(F.lpad(F.hex(F.least(code, F.lit(0x10FFFF))), 8, "0")), "UTF-32")
    control = ((code < 32) & ~code.isin(9, 10, 12, 13)) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code % 65536 >= 65534)
    return (F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), "\ufffd").when(code.between(128, 159), table[code.cast("int")])
            .when(control, "").otherwise(point))


def _once(value: Column, use) -> Column:
    """use(value), where use names the value several times and it is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _dereferenced(part: Column) -> Column:
    """The text after an ampersand with its reference, if it is one, replaced; else with the ampersand before it."""
    named, bare = F.expr(_NAMED_MAP), F.expr(_BARE_MAP)
    number = lambda x, base: F.when(F.length(F.ltrim(x, F.lit("0"))) > 8, F.lit(1 << 40)).otherwise(F.conv(F.right(F.concat(F.lit("0"), x), F.lit(9)), base, 10).cast("long"))  # noqa: E731  more digits name no character
    digits, hexed = (F.regexp_extract(part, p, 1) for p in ("^#([0-9]+)", "^#[xX]([0-9a-fA-F]+)"))
    rest = F.regexp_replace(part, "^#([0-9]+|[xX][0-9a-fA-F]+);?", "")
    coded = F.when(digits != "", F.concat(_once(number(digits, 10), _character), rest)).when(hexed != "", F.concat(_once(number(hexed, 16), _character), rest))

    def by_name(name: Column) -> Column:
        start = F.left(name, F.lit(2))
        whole = F.when(F.substr(part, F.length(name) + 1, F.lit(1)) == ";", named[start][name])
        # an old name without its semicolon: the longest that the text begins with
        known = F.try_element_at(F.filter(F.transform(F.sequence(F.lit(2), F.lit(_LONGEST)), lambda k: F.left(name, k)), lambda x: bare[start][x].isNotNull()), F.lit(-1))
        old = lambda k: F.when(k.isNotNull(), F.concat(bare[start][k], F.substr(part, F.length(k) + 1)))
        return F.coalesce(_once(whole, lambda w: F.when(w.isNotNull(), F.concat(w, F.substr(part, F.length(name) + 2)))), F.when(bare[start].isNotNull(), _once(known, old)), F.concat(F.lit("&"), part))

    return F.when(part.startswith("#"), F.coalesce(coded, F.concat(F.lit("&"), part))).otherwise(_once(F.regexp_extract(part, "^([A-Za-z0-9]+)", 1), by_name))


def decoded(text: Column | str) -> Column:
    """Character references of markup replaced, each once: &amp;lt; becomes &lt;."""
    joined = lambda parts: F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), _dereferenced), ""))
    return _once(_col(text), lambda t: F.when(F.contains(t, F.lit("&")), _once(F.split(t, "&", -1), joined)).otherwise(t))


#: The references that `few_decoded` knows, in the order of replacement: the ampersand's last, so that each is replaced once.
_FEW = {"&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def few_decoded(text: Column | str) -> Column:
    """The commonest character references replaced, with their semicolon only; a reference cut short stays as it stands."""
    return reduce(lambda t, x: F.replace(t, F.lit(x[0]), F.lit(x[1])), _FEW.items(), _col(text))


def text_of(markup: Column | str, decode: Callable[[Column], Column] = decoded) -> Column:
    """Markup without tags, entities decoded, white space collapsed. decode: `decoded`, as browsers do, or `few_decoded`."""
    return collapsed(decode(F.regexp_replace(_col(markup), "<[^>]*>", " ")))


def readable(markup: Column | str) -> Column:
    """What a reader sees, lower case: scripts, styles and comments go with their content."""
    bare = F.regexp_replace(_col(markup), r"(?is)<(script|style)\b[^>]*>.*?</\1>|<!--.*?-->", " ")
    return F.lower(text_of(bare))


def field_text(markup: Column | str, name: str, decode: Callable[[Column], Column] = decoded) -> Column:
    """Text of the element `name` up to its end, the article's, the footer or the text's end; null without the element."""
    found = F.regexp_extract(_col(markup), rf"(?is)<{name}\b[^>]*>(.*?)(</{name}>|</article>|<footer|\z)", 1)
    return F.when(_col(markup).rlike(rf"(?i)<{name}\b"), text_of(found, decode))


def field_items(markup: Column | str) -> Column:
    """Texts of list items; trailing commas go and blanks are dropped."""
    items = F.regexp_extract_all(_col(markup), F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), 1)
    clean = F.transform(items, lambda x: F.regexp_replace(text_of(x), r"[\s,]+$", ""))
    return F.filter(clean, lambda x: x != "")


#: The class tokens of a catalogue's fields, their labels and their items.
_FIELD, _NAME, _LABEL, _ITEM = "field", "field--name-field-", "field__label", "field__item"


def _opening(token: str, elements: str = r"\w+") -> str:
    """Pattern of a start tag whose class has a token; the token may be a pattern."""
    return rf'<(?:{elements})\s(?:[^>]*\s)?class="(?:[^"]*\s)?{token}(?=[\s"])[^>]*>'


def field_markup(markup: Column | str, name: str) -> Column:
    """Markup inside the named field of a catalogue page, without its label; null without the field.

    The page is cut before the start tag of each field; the piece whose class
    names the field is taken, up to the article's end or the footer.
    """
    return field_in(field_pieces(markup), name)


def field_pieces(markup: Column | str) -> Column:
    """Markup cut before the start tag of each field."""
    return F.split(_col(markup), f"(?={_opening(rf'{_FIELD}(?:--[-0-9A-Za-z]+)*', 'div|span')})")


def field_in(pieces: Column, name: str) -> Column:
    """`field_markup` from the page's pieces."""
    classes = lambda piece: F.split(F.regexp_extract(piece, r'^<[^>]*\sclass="([^"]*)"', 1), r"\s+")
    own = F.get(F.filter(pieces, lambda piece: F.array_contains(classes(piece), f"{_NAME}{name}")), F.lit(0))
    inside = F.regexp_replace(F.get(F.split(own, "</article>|<footer", 2), F.lit(0)), "^<[^>]*>", "")
    # the label goes with its element, up to the end tag of the same name
    label = rf'(?s)<(\w+)\s(?:[^>]*\s)?class="(?:[^"]*\s)?{_LABEL}(?=[\s"])[^>]*>.*?</\1\s*>'
    return F.regexp_replace(inside, label, " ")


def named_field(markup: Column | str, name: str) -> Column:
    """Text of the named field; null without it or without text."""
    return F.nullif(text_of(field_markup(markup, name)), F.lit(""))


def named_items(markup: Column | str, name: str) -> Column:
    """Texts of the items of the named field, without the commas between them; blanks are dropped. Empty without the field."""
    return items_of(field_markup(markup, name))


def items_of(field: Column) -> Column:
    """Texts of the items in a field's markup."""
    pieces = F.split(F.coalesce(field, F.lit("")), _opening(_ITEM))
    items = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda x: F.substring_index(x, "</div", 1))
    return F.filter(F.transform(items, lambda x: F.regexp_replace(text_of(x), r"^[\s,]+|[\s,]+$", "")), lambda x: x != "")


#: Programme markers that say nothing about a course's subject.
MARKERS = ("ap", "ib", "aice", "advanced placement", "honors", "dual enrollment")


def normalised_title(title: Column | str, drop_parentheticals: bool = False) -> Column:
    """Words of a title in lower case, without asterisks, programme markers and whatever else is no letter or digit, one space between."""
    bare = F.translate(F.lower(_col(title)), "*", "")
    bare = F.regexp_replace(bare, r"\([^)]*\)", " ") if drop_parentheticals else bare
    bare = F.regexp_replace(bare, rf"\b({'|'.join(MARKERS)})\b", " ")
    return F.array_join(F.filter(F.split(bare, "[^a-z0-9]+"), lambda w: w != ""), " ")


def states_a_prerequisite(text: Column | str) -> Column:
    """False for blank text, for a field that only says that nothing is required, and where a sentence denies it. References are decoded first."""
    bare = F.lower(collapsed(F.translate(decoded(text), "\u00a0", " ")))
    said = F.regexp_replace(F.regexp_replace(bare, r"\Aprerequisites?\s*[:-]?\s*(?=\S)", ""), r"\s*[.;:]\z", "")
    denied = F.exists(F.split(bare, r"\."), lambda s: s.rlike(rf"\bno\s+({'|'.join(_BEFORE)})\b.*\b({'|'.join(_ASKED)})\b"))
    return F.coalesce((bare != "") & ~said.isin(*_NOTHING) & ~denied, F.lit(False))


def absolute(href: Column | str, host: str) -> Column:
    """An address without query and fragment and without a trailing slash, resolved against the host."""
    bare = F.regexp_replace(_col(href), "[?#].*$", "")
    full = F.when(bare.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), bare).otherwise(F.concat(F.lit(f"https://{host}/"), F.regexp_replace(bare, "^/+", "")))
    trimmed = F.regexp_replace(full, "/+$", "")
    return F.when(trimmed.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+$"), F.concat(trimmed, F.lit("/"))).otherwise(trimmed)


def host_of(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(url), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1))


def path_of(url: Column | str, host: Column | str | None = None) -> Column:
    """Path without a trailing slash; null on another host."""
    bare = F.regexp_replace(_col(url), "[?#].*$", "")
    path = F.regexp_replace(F.regexp_replace(bare, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]+", ""), "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    if host is None:
        return path
    own = host_of(url)
    return F.when((own == "") | (own == (F.lit(host) if isinstance(host, str) else host)), path)


def segments(path: Column | str) -> Column:
    return F.filter(F.split(_col(path), "/"), lambda x: x != "")


def level(path: Column | str) -> Column:
    """subject, course or pathway by the depth of a path."""
    return F.element_at(F.create_map(F.lit(1), F.lit("subject"), F.lit(2), F.lit("course"), F.lit(3), F.lit("pathway")), F.size(segments(path)))


def classified(url: Column | str, markup: Column | str, marker: str) -> Column:
    """pathway where the markup has the marker, else the level of the path."""
    return F.when(_col(markup).contains(marker), "pathway").otherwise(level(path_of(url)))


def kind_of(path: Column | str, markers: tuple[str, ...]) -> Column:
    """The one marker that is a whole segment of the path; null with none or several."""
    found = F.array_intersect(segments(path), F.array(*map(F.lit, markers)))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def term_count(text: Column | str, term: str) -> Column:
    low = F.lower(_col(text))
    return F.floor((F.length(low) - F.length(F.replace(low, F.lit(term), F.lit("")))) / len(term)).cast("long")


def first_term(text: Column | str, terms: tuple[str, ...]) -> Column:
    """The first of the terms, in their order, that the text contains."""
    return F.get(F.filter(F.array(*map(F.lit, terms)), lambda t: F.contains(F.lower(_col(text)), t)), F.lit(0))
