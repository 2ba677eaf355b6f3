"""Page markup to plain text and to links, with built-in expressions only.

A page is one row, so everything here is row-local: no explode, no shuffle. The
work is staged over helper columns (`with_*` functions) so that each regular
expression runs once per page; one nested expression would be repeated by Spark
wherever its value is used more than once.
"""

import json
from html.entities import html5

from pyspark.sql import functions as F

from ..fixed import ANNUAL_FORMS, DROPPED_ELEMENTS, RAW_ELEMENTS, TABLE_CLASS, WHITESPACE_CHARS
from .fold import walk
from .once import with_once
from .text import strip, stripped_lines

_RAW = "|".join(RAW_ELEMENTS)
_DROPPED = "|".join(DROPPED_ELEMENTS)
# Numeric references 128 to 159 are read as windows-1252, where it defines them.
_CODES = range(0x80, 0xA0)
_UNDEFINED = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
CP1252_CODES = "".join(map(chr, _CODES))
CP1252_CHARS = "".join(
    chr(c) if c in _UNDEFINED else bytes([c]).decode("cp1252") for c in _CODES
)

# Possessive loops (`++`, `*+`) keep matching iterative: a long tag cannot overflow
# the stack and an unbalanced quote cannot backtrack over the whole page. Patterns
# start with a plain `<` and skip to the next one, so text is passed over quickly.
# Each piece below is what follows that `<`.
_ATTRS = r"""(?:[^>=]++|=++\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+"""
_COMMENT = r"!--(?:[^-]++|-(?!->))*+-->"
_ANY_TAG = rf"(?:[a-z]{_ATTRS}|[!/?][^>]*+)>"


def _raw_element(name):
    """A script or style element, whose content knows no tags but its own end."""
    return rf"{name}(?:[\s/]{_ATTRS})?>(?:[^<]++|<(?!/{name}[\s/>]))*+(?:</{name}[^>]*+>)?"


_ANY_RAW = "(?:" + "|".join(map(_raw_element, RAW_ELEMENTS)) + ")"


# Everything that is not text, token by token: what looks like a tag inside a comment or an
# attribute value is not one. Body tags stay.
_TOKEN = (
    rf"(?i)<(?!/?body[\s/>]|/html\s*>)(?:{_COMMENT}"
    rf"|(?:{_RAW})(?:\s[^<>]*)?/>"
    rf"|{_ANY_RAW}|{_ANY_TAG})"
)
_DROPPED_TAG = rf"(?i)<(/?)({_DROPPED})(?=[\s/>])"
# A page with a body is cut down to the first one; a page without is left whole.
_BODY = rf"(?is)\A.*?<body(?:[\s/]{_ATTRS})?>((?:[^<]++|<(?!/(?:body|html)\s*>))*+).*\z"
_BODY_TAG = rf"(?i)<(?:/?body(?:[\s/]{_ATTRS})?|/html\s*)>"
_LITERAL = r"<!\[CDATA\[((?:[^\]]++|\](?!\]>))*+)\]\]>"
_REFERENCE = r"&(#[xX][0-9A-Fa-f]+|#[0-9]+|[A-Za-z][-.A-Za-z0-9]*);?"


def named_references():
    """Map literal from reference name to text, built from the standard table.

    A map is searched from its start, so the names met in practice come first.
    """
    common = ("amp", "nbsp", "lt", "gt", "quot", "apos", "copy", "middot", "mdash", "ndash")
    standard = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
    ordered = {name: standard[name] for name in common} | standard
    return F.from_json(F.lit(json.dumps(ordered)), "map<string,string>")


def _char(reference, names):
    """The text one reference stands for. Unknown names stay, without semicolon."""
    is_hex = reference.rlike("^#[xX]")
    hex_digits = F.ltrim(F.substring(reference, 3, 1 << 30), F.lit("0"))
    digits = F.when(~is_hex, F.substring(reference, 2, 1 << 30)).when(
        F.length(hex_digits) <= 6, F.conv(F.concat(F.lit("0"), hex_digits), 16, 10)
    )
    code = digits.try_cast("bigint")
    valid = (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    decoded = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    number = F.when(valid, F.translate(decoded, CP1252_CODES, CP1252_CHARS))
    name = F.coalesce(F.try_element_at(names, reference), F.concat(F.lit("&"), reference))
    return F.when(reference.startswith("#"), F.coalesce(number, F.lit("�"))).otherwise(name)


def decode_references(col, names):
    """Replace character references in one pass, so `&amp;lt;` becomes `&lt;`."""
    chars = F.transform(
        F.regexp_extract_all(col, F.lit(_REFERENCE), 1), lambda r: _char(r, names)
    )
    pieces = F.zip_with(
        F.split(col, _REFERENCE, -1),
        chars,
        lambda text, char: F.concat(text, F.coalesce(char, F.lit(""))),
    )
    return F.when(col.contains("&"), F.array_join(pieces, "")).otherwise(col)


def _visible(df, page, out):
    """Replace the page in column `page` by the text outside dropped elements, as `out`.

    The page is cut into tags and the texts between them. One walk over the tags of dropped
    elements finds the outermost ones, counting those of its name inside each; of the texts
    the stretches between them are kept. An element that is not closed runs to the end.
    """
    marks, texts, hidden = (f"__{out}_{n}" for n in ("marks", "texts", "hidden"))
    has_dropped = F.col(page).rlike(_DROPPED_TAG)
    # Pages without dropped elements need no more than one replacement.
    tags = F.when(has_dropped, F.regexp_extract_all(F.col(page), F.lit(_TOKEN), 0))

    def mark(tag, i):
        # An element closed in its own tag holds nothing.
        name = F.when(~tag.endswith("/>"), F.lower(F.regexp_extract(tag, "^" + _DROPPED_TAG, 2)))
        return F.struct(i.alias("at"), name.alias("name"), tag.startswith("</").alias("closes"))

    marked = F.filter(F.transform(tags, mark), lambda m: m["name"] != "")
    df = df.withColumn(marks, F.coalesce(marked, F.array().cast("array<struct<at:int,name:string,closes:boolean>>")))
    df = df.withColumn(texts, F.when(has_dropped, F.split(F.col(page), _TOKEN, -1)))

    def step(s, m):
        inside = s["name"] != ""
        same = inside & (s["name"] == m["name"])
        depth = s["depth"] + F.when(same, F.when(m["closes"], -1).otherwise(1)).otherwise(0)
        opens = ~inside & ~m["closes"]
        ends = same & (depth == 0)
        name = F.when(opens, m["name"]).when(ends, "").otherwise(s["name"])
        begin = F.when(opens, m["at"]).otherwise(s["begin"])
        gave = F.when(ends, F.array(F.struct(s["begin"].alias("begin"), m["at"].alias("end"))))
        return (
            {"name": name, "depth": F.when(opens, 1).otherwise(depth), "begin": begin},
            F.coalesce(gave, F.array().cast("array<struct<begin:int,end:int>>")),
        )

    state = {"name": F.lit(""), "depth": F.lit(0), "begin": F.lit(0)}
    walked = walk(F.col(marks), state, "struct<begin:int,end:int>", step)
    df = with_once(df, hidden, walked)
    # Text i stands before tag i: what is kept begins behind the end of one element and goes
    # to the beginning of the next, or to the end unless the last one is open.
    last = F.when(F.col(hidden)["name"] != "", F.col(hidden)["begin"]).otherwise(F.size(texts) - 1)
    begins = F.concat(F.array(F.lit(0)), F.transform(F.col(hidden)["out"], lambda h: h["end"] + 1))
    ends = F.concat(F.transform(F.col(hidden)["out"], lambda h: h["begin"]), F.array(last))
    kept = F.zip_with(begins, ends, lambda b, e: F.slice(F.col(texts), b + 1, F.greatest(e - b + 1, F.lit(0))))
    plain = F.regexp_replace(F.col(page), _TOKEN, "\n")
    df = df.withColumn(out, F.when(F.col(texts).isNotNull(), F.array_join(F.flatten(kept), "\n")).otherwise(plain))
    return df.drop(marks, texts, hidden)


def with_plain_text(df, html, out):
    """Add `out`, the readable text of the page in column `html`."""
    page, visible, bare, decoded = (f"__{out}_{n}" for n in ("page", "visible", "bare", "decoded"))
    literal = F.when(
        F.col(html).contains("<![CDATA["), F.regexp_replace(F.col(html), _LITERAL, "\n$1\n")
    ).otherwise(F.col(html))
    df = _visible(df.withColumn(page, literal), page, visible)
    body = F.regexp_replace(F.col(visible), _BODY, "$1")
    df = df.withColumn(bare, F.regexp_replace(body, _BODY_TAG, "\n"))
    df = df.withColumn(decoded, decode_references(F.col(bare), named_references()))
    lines = F.filter(stripped_lines(F.col(decoded)), lambda line: line != "")
    return with_once(df, out, F.array_join(lines, "\n")).drop(page, visible, bare, decoded)


# --- links of an index page ---------------------------------------------------

# The first letter tells most tags from these.
_UNSEEN = rf"<(?=[!{''.join(sorted({n[0] + n[0].upper() for n in RAW_ELEMENTS}))}])(?i:{_COMMENT}|{_ANY_RAW})"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""


def _attribute(name):
    """From the name of a tag to the value of one attribute, passing over others."""
    return (
        rf"(?:[\s/]++(?!(?i:{name})[\s=])[^\s=>]++(?:\s*+=\s*+{_VALUE})?+)*+"
        rf"[\s/]++(?i:{name})\s*+=\s*+"
    )


_HAS_CLASS = (
    rf"""(?:"(?:[^"]*\s)?{TABLE_CLASS}(?:\s[^"]*)?\""""
    rf"""|'(?:[^']*\s)?{TABLE_CLASS}(?:\s[^']*)?'"""
    rf"""|{TABLE_CLASS}(?=[\s>]))"""
)


def _tag(letters):
    """What follows the `<` of a tag of tables, or of rows (`r`) or cells (`d`)."""
    other = f"[{letters}{letters.upper()}]|" if letters else ""
    return rf"/?[tT](?:{other}(?i:able))[\s/>]"


def _up_to(letters):
    """Markup up to the next such tag."""
    return rf"(?>[^<]*)(?:<(?!{_tag(letters)})[^<]*)*+"


def _with_tables(letters, depth):
    """Markup up to the next such tag, with the whole tables before it."""
    run = _up_to(letters)
    whole = rf"<(?i:table)(?:[\s/]{_ATTRS})?>{_tables(depth - 1)}(?<=</(?i:ta))(?i:ble)\s*>"
    return rf"{run}(?:{whole}{run})*+"


def _tables(depth):
    """Markup with the whole tables inside it, up to the `b` of the next other tag of a table.

    Tags are many, and few letters are a `b`: this looks at those only.
    """
    run = r"(?>[^bB]*)(?:[bB](?!(?<=</?[tT][aA].)(?i:le)[\s/>])[^bB]*)*+"
    if not depth:
        return run
    return rf"{run}(?:(?<=<(?i:ta))(?i:ble)(?:[\s/]{_ATTRS})?>{_tables(depth - 1)}(?<=</(?i:ta))(?i:ble)\s*>{run})*+"


# Tables are mostly flat or hold a few others inside each other: patterns read these, a walk,
# which takes many times as long, all others. What is found ends with `</ta`.
# Every row and cell is found where it begins, its content by looking ahead, so that those
# of inner tables are found as well.
_FLAT = 12
_FLAT_TABLE = rf"<(?i:table){_attribute('class')}{_HAS_CLASS}({_ATTRS}>{_tables(_FLAT)}(?<=</(?i:ta)))(?i:ble)\s*>"
_FLAT_ROW = rf"<[tT][rR](?=((?:[\s/]{_ATTRS})?>{_with_tables('r', _FLAT)}))"
_FLAT_CELL = rf"<[tT][dD](?=(?:[\s/]{_ATTRS})?>({_with_tables('dr', _FLAT)}))"
_ANY_HREF = rf"<[aA]{_attribute('href')}({_VALUE})"

# The text of an annual form type, each run of it between tags padded with white space.
_PADDING = f"(?:[{WHITESPACE_CHARS}]|&nbsp;)*+"


def _annual_type(tag):
    """The markup of a cell that holds an annual form type and, besides, tags of the pattern `tag`."""
    tags = rf"(?:{_PADDING}{tag})++{_PADDING}"
    forms = "|".join(rf"(?:{tags})?+".join(f"[{c}{c.lower()}]" for c in form) for form in ANNUAL_FORMS)
    return rf"(?:{tags}|{_PADDING})(?:{forms})(?:{tags}|{_PADDING})"


_ANNUAL_CELL = rf"\A{_annual_type(f'<(?i:{_ANY_TAG})')}\z"

# --- the same at once, for tables of plain markup: a row's tags hold no other `<`, its links and
# type no references but `&nbsp;`, and tables inside it no links. What differs is left to the others.
_PLAIN_ATTRS = r"""(?:[^<>=]+|=++\s*+(?:"[^"<]*+"|'[^'<]*+'|(?!["'])))*+"""
_PLAIN_VALUE = r"""(?:"[^"<]*+"|'[^'<]*+'|[^\s<>"'][^\s<>]*+(?=[\s>]))"""
_PLAIN_TAG = rf"<(?!{_tag('dr')})(?:[a-zA-Z]{_PLAIN_ATTRS}|[!/?][^<>]*+)>"
_PLAIN_HEAD = rf"(?:[\s/]{_PLAIN_ATTRS})?+>"
_PLAIN_LINK = (
    rf"(?:[\s/]++(?!(?i:href)[\s=])[^\s<>=]++(?:\s*+=\s*+{_PLAIN_VALUE})?+)*+[\s/]++(?i:href)\s*+=\s*+"
)


def _plain_value(ends):
    """An address without references that ends in a certain way."""
    return rf"""(?:"[^"<&]*+{ends}"|'[^'<&]*+{ends}'|[^\s<>&"'][^\s<>&]*+{ends}(?=[\s>]))"""


_ENDS_ANNUAL = r"(?<=\.(?i:htm))(?<!-(?i:index\.htm))"
_ENDS_OTHER = r"(?:(?<!\.(?i:htm))|(?<=-(?i:index\.htm)))"
_ROW_END = r"(?=<(?:/?(?i:tr)|/(?i:table))[\s/>]|\z)"
_CELL_END = r"(?=<(?:/?(?i:t[dr])|/(?i:table))[\s/>]|\z)"
_UP_TO_LINK = rf"(?>[^<]*)(?:<(?![aA][\s/]|{_tag('r')})[^<]*)*+"


def _without_links(depth):
    """Markup with the whole tables inside it, up to the next link or other tag of a table."""
    run = rf"(?>[^<]*)(?:<(?![aA][\s/]|{_tag('')})[^<]*)*+"
    return rf"{run}(?:<(?i:table){_PLAIN_HEAD}{_without_links(depth - 1)}</(?i:table)\s*>{run})*+" if depth else run


_UP_TO_FIRST_LINK = (
    rf"{_UP_TO_LINK}(?:<(?i:table){_PLAIN_HEAD}{_without_links(_FLAT)}</(?i:table)\s*>{_UP_TO_LINK})*+"
)
_BETWEEN_CELLS = rf"{_up_to('dr')}(?:</[tT][dD]{_up_to('dr')})*+"
_CELL = rf"<[tT][dD]{_PLAIN_HEAD}"
# Behind the name of its tag, a row that surely is not of an annual form: its first link is none of
# a page, or its fourth cell is of another type or missing.
_OTHER_ROW = (
    rf"{_PLAIN_HEAD}(?:{_UP_TO_FIRST_LINK}(?:{_ROW_END}|<[aA]{_PLAIN_LINK}{_plain_value(_ENDS_OTHER)})"
    rf"|{_BETWEEN_CELLS}(?:{_CELL}{_BETWEEN_CELLS}){{0,3}}+(?:{_ROW_END}"
    rf"|{_CELL}(?!{_annual_type(_PLAIN_TAG)}{_CELL_END})(?:[^<&]+|&nbsp;|{_PLAIN_TAG})*+{_CELL_END}))"
)
# A row that surely is, up to its first link.
_ANNUAL_ROW = (
    rf"{_PLAIN_HEAD}(?={_BETWEEN_CELLS}(?:{_CELL}{_BETWEEN_CELLS}){{3}}+{_CELL}{_annual_type(_PLAIN_TAG)}{_CELL_END})"
    rf"{_UP_TO_LINK}<[aA]{_PLAIN_LINK}{_plain_value(_ENDS_ANNUAL)}"
)
# The first row that is or that might be, which gives one character only.
_FIRST_ROW = rf"<[tT][rR](?=[\s/>])(?!{_OTHER_ROW})({_ANNUAL_ROW}|[\s/>])"
_OTHER_ROWS = rf"(?s)<[tT][rR](?=(?:[\s/]{_ATTRS})?>)(.*)"
# The first link that is or that might be one of a page.
_FIRST_HREF = rf"<[aA](?!{_PLAIN_LINK}{_plain_value(_ENDS_OTHER)}){_attribute('href')}({_VALUE})"


# From the end of the document table's own tag on, to the end of the page.
_AFTER_TABLE_TAG = rf"(?s)<(?i:table){_attribute('class')}{_HAS_CLASS}{_ATTRS}(>.*)"
# Tags that rows, cells and tables begin and end with, and links with an address.
_TABLE_TAG = (
    rf"(?:<(?i:table|t[dr])(?:[\s/]{_ATTRS})?>|</(?i:table)\s*>|</(?i:t[dr])[^>]*+>"
    rf"|<[aA]{_attribute('href')}{_VALUE}{_ATTRS}>?)"
)
_TAG_NAME = r"(?i)^<(/?t(?:able|[dr])|a)"
_HREF = rf"^<[aA]{_attribute('href')}({_VALUE})"
_KINDS = {"table": 1, "/table": 2, "tr": 3, "/tr": 4, "td": 5, "/td": 6, "a": 7}


def _unquoted(written):
    quoted = written.startswith('"') | written.startswith("'")
    return F.when(quoted, F.substring(written, F.lit(2), F.length(written) - 2)).otherwise(written)


def _href(written, names):
    return decode_references(_unquoted(written), names)


def _table_tags(tags):
    """The tags with their places, by number of their kind."""

    def tag(written, i):
        name = F.lower(F.regexp_extract(written, _TAG_NAME, 1))
        kind = F.lit(None).cast("int")
        for text, number in _KINDS.items():
            kind = F.when(name == text, number).otherwise(kind)
        return F.struct(i.alias("at"), kind.alias("kind"))

    return F.transform(tags, tag)


def _nothing_open():
    return F.struct(*[F.lit(n).alias(name) for name, n in (("row", -1), ("cell", -1), ("cells", 0), ("links", 0))])


_ENDED = "struct<kind:int,at:int,end:int,cells:int,links:int>"


def _ended(kind, at, end, cells=0, links=0):
    values = {"kind": kind, "at": at, "end": end, "cells": cells, "links": links}
    return F.struct(*[(v if hasattr(v, "alias") else F.lit(v)).alias(n) for n, v in values.items()])


def _table_walk(tags):
    """Where the rows and cells of a table and of those inside it end, and the table itself.

    A stack holds the open row and cell of every open table. A cell ends with the next cell or
    row of its table, a row with the next one, both with their table. A row knows how
    many cells and links stand before it: its own are the next ones before its end.
    """
    nothing = F.array().cast(f"array<{_ENDED}>")

    def step(s, t):
        kind, at, stack = t["kind"], t["at"], s["stack"]
        top = F.element_at(stack, -1)
        cell = (kind >= 2) & (kind <= 6) & (top["cell"] >= 0)
        row = (kind >= 2) & (kind <= 4) & (top["row"] >= 0)
        gave = F.concat(
            F.when(cell, F.array(_ended(5, top["cell"], at))).otherwise(nothing),
            F.when(row, F.array(_ended(3, top["row"], at, top["cells"], top["links"]))).otherwise(nothing),
        )
        begins = F.struct(at.alias("row"), F.lit(-1).alias("cell"), s["cells"].alias("cells"), s["links"].alias("links"))
        goes_on = F.struct(
            F.when(kind == 4, -1).otherwise(top["row"]).alias("row"),
            F.when(kind == 5, at).otherwise(-1).alias("cell"),
            top["cells"].alias("cells"),
            top["links"].alias("links"),
        )
        outer = F.slice(stack, F.lit(1), F.size(stack) - 1)
        after = (
            F.when(kind == 7, stack)
            .when(kind == 1, F.concat(stack, F.array(_nothing_open())))
            .when(kind == 2, outer)
            .otherwise(F.concat(outer, F.array(F.when(kind == 3, begins).otherwise(goes_on))))
        )
        on = F.size(stack) > 0
        return (
            {
                "stack": F.when(on, after).otherwise(stack),
                "cells": s["cells"] + F.when(on & (kind == 5), 1).otherwise(0),
                "links": s["links"] + F.when(on & (kind == 7), 1).otherwise(0),
                "end": F.when(on & (kind == 2) & (F.size(stack) == 1), at).otherwise(s["end"]),
            },
            F.when(on, gave).otherwise(nothing),
        )

    state = {"stack": F.array(_nothing_open()), "cells": F.lit(0), "links": F.lit(0), "end": F.lit(-1)}
    return walk(tags, state, _ENDED, step)



def _table_end(tags):
    """Where the table ends; -1 if it does not."""

    def step(s, t):
        depth = s["depth"] + F.when(t["kind"] == 1, 1).when(t["kind"] == 2, -1).otherwise(0)
        return F.struct(
            F.when(s["depth"] > 0, depth).otherwise(0).alias("depth"),
            F.when((s["depth"] == 1) & (t["kind"] == 2), t["at"]).otherwise(s["end"]).alias("end"),
        )

    zero = F.struct(F.lit(1).alias("depth"), F.lit(-1).alias("end"))
    return F.aggregate(F.filter(tags, lambda t: t["kind"] <= 2), zero, step)["end"]


def _type_of(markup, names):
    """The text of a cell in upper case, each run of it stripped."""
    nodes = F.transform(
        F.split(markup, f"(?i)<{_ANY_TAG}", -1), lambda text: strip(decode_references(text, names))
    )
    return F.upper(F.array_join(nodes, ""))


def _is_annual_type(markup, names):
    # References other than `&nbsp;` are seldom; only where there are any, they are read.
    return markup.rlike(_ANNUAL_CELL) | (markup.contains("&") & _type_of(markup, names).isin(*ANNUAL_FORMS))


def _first_href(markup, names):
    # As the one element of an array, what was matched is used without matching again.
    first = F.array(F.regexp_extract(markup, _ANY_HREF, 1))
    return F.get(F.transform(first, lambda written: _href(written, names)), 0)


def _flat_choice(table, rule, names):
    """The link chosen from a table that patterns can read."""
    hrefs = F.transform(F.regexp_extract_all(table, F.lit(_ANY_HREF), 1), lambda written: _href(written, names))
    if rule == "B":
        return F.get(F.filter(hrefs, _is_page), 0)
    rows = F.slice(F.regexp_extract_all(table, F.lit(_FLAT_ROW), 1), 2, 1 << 30)
    linked = F.transform(rows, lambda row: F.struct(row.alias("row"), _first_href(row, names).alias("href")))
    # The type is read only of rows whose first link qualifies.
    annual = F.filter(
        linked,
        lambda r: _is_annual_page(r["href"])
        & _is_annual_type(F.get(F.regexp_extract_all(r["row"], F.lit(_FLAT_CELL), 1), 3), names),
    )
    return F.coalesce(F.get(annual, 0)["href"], F.get(F.filter(hrefs, _is_annual_page), 0))


def _is_annual_page(href):
    low = F.lower(href)
    return low.endswith(".htm") & ~low.endswith("-index.htm")


def _is_page(href):
    return (href.endswith(".htm") | href.endswith(".html")) & ~F.lower(href).contains("index")


def with_primary_link(df, html, rule="A", href="href", has_table="has_table"):
    """Add the link of the main document listed on an index page.

    Rule A prefers the first table row of an annual form type and falls back to the
    first page link of the table; rule B takes the first page link. Rows hold the cells and
    links of tables inside them, at any depth. `href` is null
    when there is none, `has_table` tells whether the document table exists.
    """
    names = named_references()
    seen, flat, content, there, unread = (f"__{href}_{n}" for n in ("seen", "flat", "content", "there", "unread"))
    df = df.withColumn(seen, F.regexp_replace(F.col(html), _UNSEEN, ""))
    # What is found starts with the end of the table's own tag, so it is never empty.
    df = df.withColumn(flat, F.nullif(F.regexp_extract(F.col(seen), _FLAT_TABLE, 1), F.lit("")))
    other = F.when(F.col(flat).isNull(), F.regexp_extract(F.col(seen), _AFTER_TABLE_TAG, 1))
    df = df.withColumn(content, F.nullif(other, F.lit("")))
    df = df.withColumn(there, F.col(flat).isNotNull() | F.col(content).isNotNull())
    known, page, more = F.lit(False), F.lit(None), []
    if rule == "A":
        df, page, known, more = _with_plain_choice(df, flat, href)
    # A table goes on only to be read row by row.
    df = df.withColumn(unread, F.when(~F.coalesce(known, F.lit(False)), F.substring(F.col(flat), F.lit(1), F.length(flat) - len("</ta"))))
    df, walked, helpers = _with_walked_choice(df, content, rule, href, names)
    read = F.when(F.col(unread).isNotNull(), _flat_choice(F.col(unread), rule, names)).otherwise(walked)
    df = with_once(df, href, F.when(known, page).otherwise(read))
    df = df.withColumn(has_table, F.col(there))
    return df.drop(seen, flat, content, there, unread, *more, *helpers)


def _with_plain_choice(df, flat, href):
    """The link chosen under rule A from a table of plain markup, and whether it is known so.

    Returns the table with helper columns, these two and the helpers.
    """
    row, link, page, known = helpers = [f"__{href}_{n}" for n in ("row", "link", "page", "known")]
    df = df.withColumn(row, F.regexp_extract(F.regexp_extract(F.col(flat), _OTHER_ROWS, 1), _FIRST_ROW, 1))
    # A row of an annual form comes first.
    written = F.when(F.length(row) > 1, F.regexp_extract(F.col(row), _ANY_HREF, 1)).when(
        F.col(row) == "", F.regexp_extract(F.col(flat), _FIRST_HREF, 1)
    )
    df = df.withColumn(link, written)
    address = _unquoted(F.col(link))
    df = df.withColumn(page, F.when(_is_annual_page(address) & ~address.contains("&"), address))
    df = df.withColumn(known, (F.col(link) == "") | F.col(page).isNotNull())
    return df, F.col(page), F.col(known), helpers


def _with_walked_choice(df, content, rule, href, names):
    """The link chosen by a walk over the tags behind the table's own, which `content` holds.

    Returns the table with helper columns, the choice and the helpers; where there is no content, the
    choice is null.
    """
    written, tags, links, walked = helpers = [f"__{href}_{n}" for n in ("written", "tags", "links", "walked")]
    df = df.withColumn(written, F.regexp_extract_all(F.col(content), F.lit(_TABLE_TAG), 0))
    df = df.withColumn(tags, _table_tags(F.col(written)))
    there = F.col(tags).isNotNull()
    df = with_once(df, walked, F.when(there, _table_end(F.col(tags)) if rule == "B" else _table_walk(F.col(tags))))
    end = F.col(walked) if rule == "B" else F.col(walked)["end"]
    inside = F.filter(F.col(tags), lambda t: (t["kind"] == 7) & ((end < 0) | (t["at"] < end)))
    found = F.transform(
        inside,
        lambda t: F.struct(t["at"].alias("at"), _href(F.regexp_extract(F.get(F.col(written), t["at"]), _HREF, 1), names).alias("href")),
    )
    df = df.withColumn(links, found)
    hrefs = F.transform(F.col(links), lambda a: a["href"])
    if rule == "B":
        return df, F.get(F.filter(hrefs, _is_page), 0), helpers
    texts, rows, cells = more = [f"__{href}_{n}" for n in ("texts", "rows", "cells")]
    df = df.withColumn(texts, F.split(F.col(content), _TABLE_TAG, -1))
    # What is still open ends with the page.
    last, stack, ended = F.size(F.col(tags)), F.col(walked)["stack"], F.col(walked)["out"]
    open_rows = F.transform(
        F.filter(stack, lambda o: o["row"] >= 0), lambda o: _ended(3, o["row"], last, o["cells"], o["links"])
    )
    open_cells = F.transform(F.filter(stack, lambda o: o["cell"] >= 0), lambda o: _ended(5, o["cell"], last))

    def by_place(kind, still_open):
        own = F.concat(F.filter(ended, lambda e: e["kind"] == kind), still_open)
        return F.array_sort(F.transform(own, lambda e: F.struct(*[e[n].alias(n) for n in ("at", "end", "cells", "links")])))

    df = df.withColumn(rows, by_place(3, open_rows)).withColumn(cells, by_place(5, open_cells))

    def annual(r):
        link, fourth = F.get(F.col(links), r["links"]), F.get(F.col(cells), r["cells"] + 3)
        markup = F.array_join(F.slice(F.col(texts), fourth["at"] + 2, fourth["end"] - fourth["at"]), "<br>")
        return (
            (link["at"] < r["end"])
            & _is_annual_page(link["href"])
            & (fourth["at"] < r["end"])
            & _is_annual_type(markup, names)
        )

    # The first row is passed over.
    row = F.get(F.filter(F.slice(F.col(rows), 2, 1 << 30), annual), 0)
    chosen = F.coalesce(F.get(F.col(links), row["links"])["href"], F.get(F.filter(hrefs, _is_annual_page), 0))
    return df, chosen, helpers + more
