"""The main text of web pages by block rules in two passes.

A page is cut into blocks of text at block-level tags. The first pass labels a block by
its stop-word density, length and link density, and by the containers it stands in; short
blocks and those of middling density stay undecided. The second gives them the label of
the nearest decided neighbours. Inside an article or main element text is content unless
it is links, so only link density decides there, and neighbours are looked for there alone.

A form, and an element whose class, id or role names what is not the article, silences what
is inside, but no main element, no article that is not small beside the page's others, and
not itself if it holds most of the page's text of many stop words: such a wrapper is around
the page (`with-sidebar`, the one form of a page) rather than beside its text.

Each page is worked on by itself, in the task that read it, in time that grows with its size
however deep its elements; nothing is shuffled.

Defined results: null or empty HTML, and a page with no main text, give an empty text of 0
characters. Unclosed elements end where HTML lets them, a cut-off tag at the end is
dropped. Equal rows give equal rows. Other columns pass through; one named like the result
is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Characters below which a block is short, and above which a good one needs no neighbour.
SHORT, LONG = 70, 200
#: Shares of stop words among words, and of linked characters.
FEW_STOP_WORDS, MANY_STOP_WORDS = 0.18, 0.22
LINKS, LINKS_IN_CONTENT = 0.2, 0.5
#: Share of the page's rich text from which a wrapper is around it, and of the richest
#: article's from which another is no teaser.
MOST_TEXT, LARGE_ARTICLE = 0.75, 0.5

# Elements of HTML by how they are read.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var"
).split()
SILENT = "script style noscript template svg math head title iframe object select textarea button canvas audio video".split()
RAW = "script style textarea title".split()
CONTENT = "article main".split()
BOILERPLATE = "nav footer aside menu dialog".split()
#: An element of the first kind ends an open one of the second kind.
CLOSES = {
    "li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "tr": ["tr", "td", "th"], "td": ["td", "th"],
    "th": ["td", "th"], "option": ["option"],
}
SCOPES = "ul ol dl table div section article main body html".split()

# Words in class, id and role that name what is not the article.
NOT_CONTENT = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice alert popup modal overlay newsletter subscribe signup sidebar aside menu nav navbar navigation "
    "breadcrumb breadcrumbs footer comment comments disqus replies respond share sharing social related recommended "
    "login search toolbar pagination pager copyright widget contentinfo complementary dialog".split()
)
#: Of these, what readers wrote; there may be far more of it than of the article.
REPLIES = set("comment comments disqus replies respond".split())
#: A name that begins with one of these tells of another element: with-sidebar, no-sidebar.
OF_OTHERS = set("with without no not has have is".split())
PAGE_HEADER = set("header masthead topbar".split())

# Frequent function words of the languages served.
STOP_WORDS = set(
    (
        "a about after all also an and any are as at be been but by can do for from had has have he her his how i if in into "
        "is it its may more most no not of on one or our out she so some such than that the their them then there these "
        "they this to up was we were what when which who will with would you your "
        "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou où par "
        "pas plus pour qu que qui sa se ses son sont sur un une vous y été être "
        "aber als am an auch auf aus bei bin bis da das dass dem den der des die durch ein eine einem einen einer es für "
        "hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so und uns vom von vor war was "
        "wenn wie wir wird zu zum zur über "
        "al algo como con cuando de del desde donde el ella ellos en entre era es esta este esto fue ha hay la las le lo los "
        "me mi muy más ni no nos o para pero por porque que quien se ser si sin sobre son su sus también te tiene un una "
        "uno y ya"
    ).split()
)

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-z/!?][^>]*+(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_TELLING = re.compile("class|id|role|hidden|style", re.IGNORECASE)
_NAMES = re.compile(r"[a-z]+", re.IGNORECASE)
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    content: int
    silent: bool
    #: The innermost wrapper or article it is in, by number; -1 for none.
    wrap: int = -1
    label: str = ""


@dataclass(slots=True)
class _Open:
    name: str
    bad: bool
    content: int
    #: The innermost wrapper or article, by number; -1 for none.
    wrap: int = -1


class _Stack:
    """Open elements, and of each name the places where it is open."""

    def __init__(self) -> None:
        self.open: list[_Open] = [_Open("", False, 0)]
        self.places: dict[str, list[int]] = {}

    def push(self, element: _Open) -> None:
        self.places.setdefault(element.name, []).append(len(self.open))
        self.open.append(element)

    def close(self, names: list[str], scopes: list[str]) -> None:
        """Closes the innermost element of one of `names`, unless one of `scopes` is open in it."""
        own = max((p[-1] for n in names if (p := self.places.get(n))), default=0)
        if own and own >= max((p[-1] for n in scopes if (p := self.places.get(n))), default=0):
            for element in self.open[own:]:
                self.places[element.name].pop()
            del self.open[own:]


def _named(name: str, rest: str, content: int) -> tuple[bool, str]:
    """Is the element no part of the article, or else what wrapper is it by its names?"""
    bad = name in BOILERPLATE or name in SILENT or (name == "header" and not content)
    kind = "named" if name == "form" else ""
    if not rest or not _TELLING.search(rest):
        return bad, kind
    words: set[str] = set()
    for key, *values in _ATTRIBUTE.findall(rest):
        value = "".join(values).lower()
        match key.lower():
            case "hidden":
                bad = True
            case "aria-hidden":
                bad |= value == "true"
            case "style":
                bad |= "display:none" in value.replace(" ", "")
            case "class" | "id" | "role":
                for token in value.split():
                    own = _NAMES.findall(token)
                    if own and not (len(own) > 1 and own[0] in OF_OTHERS):
                        words.update(own)
    if name in ("html", "body", "main"):
        return bad, kind
    if name == "article":
        words &= {"comment", "comments", "ad", "ads", "promo", "related"}
    elif content:
        words &= NOT_CONTENT
    else:
        words &= NOT_CONTENT | PAGE_HEADER
    return bad, "replies" if words & REPLIES else "named" if words else kind


def _rich(block: Block) -> int:
    """Characters of a block of many stop words and few links."""
    if len(block.text) < SHORT or block.linked > LINKS * len(block.text):
        return 0
    words = _LETTERS.findall(block.text.lower())
    return len(block.text) if sum(w in STOP_WORDS for w in words) >= MANY_STOP_WORDS * max(len(words), 1) else 0


def _silence(found: list[Block], wraps: list[str], parents: list[int]) -> None:
    """Silences the blocks in wrappers that are not around the page's text.

    `wraps` holds the kind of each wrapper, `parents` the one around it, which has a smaller
    number, or -1.
    """
    in_content: list[bool] = []
    for kind, parent in zip(wraps, parents):
        in_content.append(kind in CONTENT or (parent >= 0 and in_content[parent]))
    rich, chars, articles = [0] * len(wraps), [0] * len(wraps), [0] * len(wraps)
    total = in_articles = 0
    for block in found:
        if not block.silent:
            size = _rich(block)
            total += size
            if (w := block.wrap) >= 0:
                own = len(block.text) if in_content[w] else 0
                in_articles += own
                rich[w] += size
                chars[w] += len(block.text)
                articles[w] += own
    for w in range(len(wraps) - 1, -1, -1):
        if (parent := parents[w]) >= 0:
            rich[parent] += rich[w]
            chars[parent] += chars[w]
            articles[parent] += articles[w]
    largest = max((n for n, kind in zip(rich, wraps) if kind == "article"), default=0)
    # Per wrapper or article: does it speak?
    speaks = []
    for n, kind, size, own in zip(rich, wraps, chars, articles):
        # Articles and main elements outside show that it is beside them, if they have text.
        around = size > (1 if own else 4) * (in_articles - own)
        match kind:
            case "main":
                speaks.append(True)
            case "article":
                speaks.append(n >= LARGE_ARTICLE * largest)
            case "replies":
                speaks.append(0 < n == total and around)
            case _:
                speaks.append(n > 0 and n >= MOST_TEXT * total and around)
    # The innermost content that speaks, or wrapper that does not, decides.
    silent: list[bool] = []
    for kind, parent, speaking in zip(wraps, parents, speaks):
        decides = speaking if kind in CONTENT else not speaking
        silent.append(kind not in CONTENT if decides else parent >= 0 and silent[parent])
    for block in found:
        if block.wrap >= 0 and silent[block.wrap]:
            block.silent = True


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with characters in links and the content they are in."""
    out: list[Block] = []
    stack = _Stack()
    parts: list[str] = []
    linked = 0
    contents = 0
    wraps: list[str] = []
    parents: list[int] = []

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                top = stack.open[-1]
                out.append(Block(text, linked, top.content, top.bad, top.wrap))
            parts.clear()
            linked = 0

    def wrap(kind: str, parent: int) -> int:
        wraps.append(kind)
        parents.append(parent)
        return len(wraps) - 1

    at = 0
    for found in _MARKUP.finditer(page):
        if found.start() > at:
            text = entities.unescape(page[at : found.start()])
            parts.append(text)
            if any(x.name == "a" for x in stack.open[-4:]):
                linked += len(text.strip())
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append(" ")
            continue
        inline = name in INLINE
        if not inline:
            flush()
        if found["end"]:
            stack.close([name], [] if not inline else SCOPES)
        elif name not in VOID:
            if not inline:
                stack.close(["p"], SCOPES + ["td", "th", "li", "button"])
            if name in CLOSES:
                stack.close(CLOSES[name], ["ul", "ol", "dl", "table"])
            top = stack.open[-1]
            bad, kind = _named(name, found["rest"], top.content)
            bad |= top.bad
            content, within = top.content, top.wrap
            if not bad and kind:
                within = wrap(kind, within)
            if name in CONTENT and not bad and not kind:
                if not content:
                    contents += 1
                    content = contents
                within = wrap(name, within)
            stack.push(_Open(name, bad, content, within))
    if at < len(page):
        parts.append(entities.unescape(page[at:]))
    flush()
    if any(kind not in CONTENT for kind in wraps):
        _silence(out, wraps, parents)
    return out


def label(block: Block) -> str:
    """First pass: good, bad, near (good unless its neighbours say no) or short."""
    if block.silent:
        return "bad"
    links = block.linked / len(block.text)
    if links > (LINKS_IN_CONTENT if block.content else LINKS):
        return "bad"
    if block.content:
        words = _LETTERS.findall(block.text.lower())
        return "good" if len(block.text) >= SHORT and sum(w in STOP_WORDS for w in words) >= FEW_STOP_WORDS * len(words) else "short"
    if "©" in block.text:
        return "bad"
    if len(block.text) < SHORT:
        return "bad" if links else "short"
    words = _LETTERS.findall(block.text.lower())
    density = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
    if density >= MANY_STOP_WORDS:
        return "good" if len(block.text) > LONG else "near"
    return "near" if density >= FEW_STOP_WORDS else "bad"


def inherit(section: list[Block]) -> None:
    """Second pass: undecided blocks of one section take the nearest decided label.

    Where the nearest of both sides are as far, or a near block has a good one on either
    side, good wins in a content element and for near blocks, bad elsewhere.
    """
    decided = [i for i, b in enumerate(section) if b.label in ("good", "bad")]
    fresh: dict[int, str] = {}
    k = 0
    for i, block in enumerate(section):
        if block.label in ("good", "bad"):
            continue
        while k < len(decided) and decided[k] < i:
            k += 1
        left = decided[k - 1] if k else None
        right = decided[k] if k < len(decided) else None
        near = [section[j].label for j in (left, right) if j is not None]
        if not near:
            fresh[i] = "good" if block.content or block.label == "near" else "bad"
        elif block.label == "near":
            fresh[i] = "good" if "good" in near else "bad"
        elif len(set(near)) == 1:
            fresh[i] = near[0]
        elif i - left != right - i:
            fresh[i] = section[left if i - left < right - i else right].label
        else:
            fresh[i] = "good" if block.content else "bad"
    for i, value in fresh.items():
        section[i].label = value


def extract(page: str | None) -> str:
    """The main text of one page."""
    found = blocks(page or "")
    sections: dict[int, list[Block]] = {}
    for block in found:
        block.label = label(block)
        if not block.silent:
            sections.setdefault(block.content, []).append(block)
    for section in sections.values():
        inherit(section)
    return "\n".join(b.text for b in found if b.label == "good")


def main_text(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Adds `text`, the page's main text, and `n_chars`, its length; drops `html`."""
    keep = [f for f in pages.schema if f.name not in (html, text, n_chars)]
    schema = T.StructType([*keep, T.StructField(text, T.StringType(), False), T.StructField(n_chars, T.LongType(), False)])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(html)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(texts, pa.string()), sizes], names=[*names, text, n_chars])

    return pages.mapInArrow(run, schema)
