"""Pages of canonical markup read by the JVM alone: proof that a page is canonical, and its struct.

A page is canonical if it is a run of text, wrapper tags and the constructs below, each of which is closed in itself and holds
nothing else: the grid's table with rows of cells and a pager, hidden inputs, spans and dropdowns of options. Tags and attributes
are then in lower case with double quotes, no element is left open and none is repaired,
so that patterns and a tree can't differ. Character references other than the four of ENTITIES, a second grid, an id that two elements have, other
elements (paragraphs, lists, scripts, comments, ...) and rows of very many cells make a page uncanonical: a tree is for those.

One pattern is the proof, in one pass. What may be repeated without bound is repeated possessively: Java's patterns recurse where a
group may be given back, and loop where it may not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafline.plans.specs import GRID_ID, TAIL

ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))
#: Text, and what stands between the quotes of an attribute: no control signs, and no references but ENTITIES.
TEXT = r"[^<&\x01-\x06]*+(?:&(?:amp|lt|gt|quot);[^<&\x01-\x06]*+)*+"
VALUE = r'[^"<>&\x01-\x06]*+(?:&(?:amp|lt|gt|quot);[^"<>&\x01-\x06]*+)*+'
#: Attributes of a tag; without an id.
A = rf'(?:\s[a-z-]++="{VALUE}")*+'
B = rf'(?:\s(?!id=)[a-z-]++="{VALUE}")*+'
CELL = rf"<td{A}>(?:<font{A}>({TEXT})</font>)?+</td>"
#: A cell and its text in a page that is proven, where the first '>' ends a tag.
PROVEN_CELL = r"<td[^>]*+>(?:<font[^>]*+>([^<]*+))?+"
LINK = rf"<td{A}>(?:<a{A}><font{A}>{TEXT}</font></a>|<span{B}><font{A}>{TEXT}</font></span>)</td>"
HEADING = rf"<th{A}>{TEXT}</th>"
OPTION = rf"<option{A}>{TEXT}</option>"
INPUT = rf"<input{A}\s?/?>"
SPAN = rf"<span{A}>{TEXT}</span>"
TABLE = rf'<table{B} id="{GRID_ID}"{B}>'
WRAPPER = rf"</?(?:html|body|form|div|center){A}>|<!DOCTYPE [^<>&\x01-\x06]*+>"
#: Cells and white space of a row at most.
WIDTH = 400
ROW = rf"<tr{A}>(?:\s|{CELL}){{0,{WIDTH}}}+</tr>"
PAGER = rf"<tr{A}>\s*+<td{A}>\s*+<table{B}>\s*+<tr{A}>(?:\s|{LINK}){{1,{WIDTH}}}+</tr>\s*+</table>\s*+</td>\s*+</tr>"
GRID = rf"{TABLE}\s*+(?:<tr{A}>(?:\s|{HEADING}){{1,{WIDTH}}}+</tr>)?+(?:\s|{ROW}|{PAGER})*+</table>"
SELECT = rf"<select{A}>(?:\s|{OPTION})*+</select>"
OTHERS = rf"(?:[^<&\x01-\x06]++|&(?:amp|lt|gt|quot);|{SELECT}|{SPAN}|{INPUT}|{WRAPPER})*+"
CANONICAL = rf"\A{OTHERS}(?:{GRID}{OTHERS})?+\z"


def is_canonical(html: Column, only_grid: bool = False) -> Column:
    """only_grid: of a page that is asked for its grid alone, whose ids but the grid's tell nothing."""
    proven = html.isNotNull() & F.rlike(html, F.lit(CANONICAL))
    return proven if only_grid else proven & _unique_ids(html)


def _let(value: Column, use) -> Column:
    """use(value), in which value is computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _unique_ids(html: Column) -> Column:
    ids = F.regexp_extract_all(html, F.lit(rf'<(?:input|span|select){B}\sid="([^"]*)"'), F.lit(1))
    return _let(ids, lambda x: F.size(F.array_distinct(x)) == F.size(x))


def _decoded(text: Column) -> Column:
    out = text
    for code, sign in ENTITIES:
        out = F.replace(out, F.lit(code), F.lit(sign))
    return F.when(text.contains("&"), out).otherwise(text)


def _text(text: Column) -> Column:
    """Decoded, null where there is none."""
    return F.when(text != "", _decoded(text))


def _attribute(tag: Column, name: str) -> Column:
    """Of the first tag in it, null where there is none."""
    pattern = F.lit(rf'^<[a-z]+(?:\s(?!{name}=)[a-z-]++="[^"<>]*+")*+\s{name}="')
    return F.when(F.rlike(tag, pattern), _decoded(F.regexp_extract(tag, rf'^<[a-z]+(?:\s(?!{name}=)[a-z-]++="[^"<>]*+")*+\s{name}="([^"]*)"', 1)))


def _inner(element: Column) -> Column:
    return F.regexp_extract(element, "^<[^>]*>([^<]*)<", 1)


def _entries(elements: Column, value) -> Column:
    """(id, value) of elements that have both."""
    pairs = F.transform(elements, lambda e: F.struct(_attribute(e, "id").alias("key"), value(e).alias("value")))
    return F.filter(pairs, lambda p: p["key"].isNotNull() & (p["key"] != "") & p["value"].isNotNull())


def _option_array(element: Column) -> Column:
    options = F.regexp_extract_all(element, F.lit(OPTION), F.lit(0))
    return F.transform(options, lambda o, k: F.struct(k.alias("pos"), _attribute(o, "value").alias("value"), _text(_inner(o)).alias("name")))


def _row(row: Column, k: Column) -> Column:
    """row: of a page that is proven, from behind the row before to the row's end tag, which is left out."""
    none = F.array_repeat(F.lit(None).cast("string"), len(TAIL))
    cells = F.transform(F.regexp_extract_all(row, F.lit(PROVEN_CELL), F.lit(1)), _text)
    plain = F.struct(k.alias("row_ord"), F.slice(F.concat(cells, none), 1, len(TAIL)).alias("cells"), F.lit(False).alias("has_table"), F.lit(None).cast("string").alias("pager"))
    last = F.try_element_at(F.regexp_extract_all(row, F.lit(rf"<font{A}>([^<]*)</font>"), F.lit(1)), F.lit(-1))
    pager = F.struct(k.alias("row_ord"), none.alias("cells"), F.lit(True).alias("has_table"), _text(last).alias("pager"))
    return F.when(row.contains("<table"), pager).otherwise(plain)


def grid(html: Column) -> Column:
    """The grid of a canonical page. No text and no attribute holds a '<', so a row ends where its end tag stands: what such tags cut
    the page into is one piece for each row, and pieces in which a table ends, behind the last row and behind a pager's own."""
    rows = F.filter(F.split(html, "</tr>"), lambda piece: ~piece.contains("</table"))
    return F.transform(F.slice(rows, F.lit(2), F.lit(1 << 30)), lambda r, k: _row(r, k + 1))


def parts(html: Column) -> dict[str, Column]:
    """Of a canonical page: entries of inputs, spans and selects, and the grid."""
    find = lambda pattern: F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    return {
        "inputs": _entries(find(INPUT), lambda e: _attribute(e, "value")),
        "spans": _entries(find(SPAN), lambda e: _text(_inner(e))),
        "selects": _entries(F.transform(F.split(html, "(?=<select)"), lambda s: F.regexp_extract(s, r"(?s)^<select.*</select>", 0)), _option_array),
        "grid": grid(html),
    }
