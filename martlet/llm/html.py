"""Main-text extraction by two-pass block rules.

A page is cut into blocks at block-level tags. Pass 1 decides a block by where
it stands and what it holds: inside a menu, header, footer, sidebar, notice,
advert, form or comment section it is bad; inside an article it is good, unless
it is in a list with most of its characters in links; elsewhere it is bad with
most of its characters in links, and length and stop-word density make it good,
bad, or leave it open when it is short.

What marks a section comes in four kinds. Menus, footers, asides, dialogs, page
headers and hidden elements always count. A form, a whole class, id or role
name (``widget``) or a name that begins or ends with such a word
(``sidebar-left``) counts unless the page's main article is or lies in it.
Names of reader comments and related pages (``comments-area``) do so too, and
articles inside them are the main article only if the page is empty without them.
A name that tells of a layout or a state (``has-sidebar``, ``comments-open``)
counts only where no article is inside. The main article is the one with the
most characters outside links, nested articles and sections of its own.

Pass 2 gives every open block the label of its nearest decided neighbours: good
when both sides, or the nearer one, are good. On a page that would be empty so
far, the longest form is taken for a wrapper of the page, and then blocks are
judged by length (in UTF-8 bytes) and links alone, as in a language or a style
whose words the stop list does not know.

Defined cases: a null or empty page, or one without a good block, gives the
empty string; tags that are never closed end with the page; repeated pages are
extracted alike; an empty table gives no rows. Nothing is cut off by length. Work
is linear in the page, however its tags nest or miss their partners.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm._text import pieces, with_columns

# Fixed values.
SILENT = frozenset("script style noscript template svg math iframe object canvas head title select option textarea button audio video".split())
BOILER_TAGS = frozenset("nav footer aside dialog menu".split())
BOILER_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login menu modal nav navbar navigation newsletter notice notification popup promo related "
    "replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# Of reader comments and related pages.
RESPONSE_WORDS = frozenset(
    "comment comments commentlist commentform disqus discussion recommendations recommended related replies reply respond responses".split()
)
# First and last parts of names that tell of a layout or a state.
LAYOUT_PARTS = frozenset("has with without no is show hide".split())
STATE_PARTS = frozenset("open closed on off enabled disabled allowed active".split())
ARTICLE_WORDS = frozenset("articlebody article-body article-content entry-content post-content post-body story-body".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose end tag may be left out, and what starts end them.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
STOP_WORDS = frozenset(
    "a an and are as at be but by for from has have he her his i in is it its not of on or she that the their they this "
    "to was we were which with you "
    "au aux avec ce dans de des du elle en est et il je la le les leur mais ne nous ou par pas plus pour qui que sa se "
    "ses son sur un une vous "
    "aber als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit "
    "nach nicht noch oder sich sie sind so um und uns von vor wie wir zu zum zur "
    "al como con del el ella en entre era ha las lo los más mi muy no nos o para pero por porque se sin sobre su sus "
    "también te todo y ya".split()
)

MAX_LINK_DENSITY = 0.5
SHORT_CHARS = 70
LONG_CHARS = 200
STOP_LOW, STOP_HIGH = 0.20, 0.30

GOOD, BAD, OPEN = 1, 0, None
_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[^a-z0-9]+")
_WORD = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

LAYOUT, SECTION, RESPONSE = 1, 2, 3

LISTS = frozenset("ul ol dl menu".split())


def kind_of(name: str, begins: bool) -> int:
    """What a class, id or role name marks: RESPONSE, SECTION, LAYOUT or nothing (0).

    On an article itself (``begins``) only whole names and short names of responses count.
    """
    if name in RESPONSE_WORDS:
        return RESPONSE
    if name in BOILER_WORDS:
        return SECTION
    parts = [p for p in _TOKEN.split(name) if p]
    if not any(p in BOILER_WORDS or p in RESPONSE_WORDS for p in parts):
        return 0
    if parts[0] in LAYOUT_PARTS or parts[-1] in STATE_PARTS:
        return 0 if begins else LAYOUT
    if begins:
        return RESPONSE if parts[0] in RESPONSE_WORDS and len(parts) <= 2 else 0
    if parts[0] in RESPONSE_WORDS or parts[-1] in RESPONSE_WORDS:
        return RESPONSE
    return SECTION if parts[0] in BOILER_WORDS or parts[-1] in BOILER_WORDS else LAYOUT


class _Mark:
    """An element whose tag or name may mark a section, and the marked one round it."""

    __slots__ = ("around", "kind", "form", "response", "chars", "holds", "cleared", "bad")

    def __init__(self, around, kind: int, form: bool):
        self.around, self.kind, self.form = around, kind, form
        self.response = kind == RESPONSE or (around is not None and around.response)
        self.chars, self.holds, self.cleared, self.bad = 0, False, False, False


class _Article:
    """An element that begins an article, by the innermost mark it is or lies in."""

    __slots__ = ("mark", "chars")

    def __init__(self, mark):
        self.mark, self.chars = mark, 0


class _Blocks(HTMLParser):
    """Collects the text, link characters and standing of each block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Text, link characters, in article, in boilerplate, innermost mark, innermost list in the article.
        self.blocks: list[tuple[str, int, bool, bool, _Mark | None, list | None]] = []
        # Tag, silent, innermost article, boilerplate, innermost mark, list as [characters, in links].
        self.open: list[tuple[str, bool, _Article | None, bool, _Mark | None, list | None]] = []
        self.places: dict[str, list[int]] = {}  # of the open elements, by tag
        self.block_places: list[int] = []
        self.marks: list[_Mark] = []
        self.articles: list[_Article] = []
        self.parts: list[str] = []
        self.linked = 0

    def _state(self):
        return self.open[-1][1:] if self.open else (False, None, False, None, None)

    def cut(self):
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                _, article, boiler, mark, entries = self._state()
                self.blocks.append((text, self.linked, article is not None, boiler, mark, entries))
                plain = len(text) - self.linked
                if not boiler:
                    if mark is not None:
                        mark.chars += plain
                    if article is not None and article.mark is mark:
                        article.chars += plain
                if entries is not None:
                    entries[0] += len(text)
                    entries[1] += self.linked
            self.parts = []
        self.linked = 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.cut()
            self._close_implied(tag)
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        silent, article, boiler, mark, entries = self._state()
        names = " ".join(v.lower() for k, v in attrs if v and k in ("class", "id", "role")).split()
        begins = tag in ("article", "main") or not ARTICLE_WORDS.isdisjoint(names)
        if tag not in ("html", "body", "main"):
            hidden = any(k == "hidden" or (k == "style" and v and _HIDDEN.search(v)) for k, v in attrs)
            boiler = boiler or tag in BOILER_TAGS or (tag == "header" and article is None and not begins) or hidden
            kind = max((kind_of(name, begins) for name in names), default=0)
            kind = max(kind, SECTION) if tag == "form" else kind
            if kind:
                mark = _Mark(mark, kind, tag == "form")
                self.marks.append(mark)
        if begins:
            article, entries = _Article(mark), None
            if not boiler and not silent:
                self.articles.append(article)
        elif article is not None and tag in LISTS:
            entries = [0, 0]
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.block_places.append(len(self.open))
        self.open.append((tag, silent or tag in SILENT, article, boiler, mark, entries))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close_implied(self, tag):
        """End an open p, li, cell or list entry that this start tag ends."""
        if self.block_places:
            at = self.block_places[-1]
            name = self.open[at][0]
            if name == "p" or tag in CLOSED_BY.get(name, ()):
                self._pop(at)

    def _pop(self, at):
        while len(self.open) > at:
            tag = self.open.pop()[0]
            self.places[tag].pop()
            if tag in BLOCKS:
                self.block_places.pop()

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.cut()
        places = self.places.get(tag)
        # An inline end tag closes nothing outside its block.
        if places and (tag in BLOCKS or not self.block_places or places[-1] > self.block_places[-1]):
            self._pop(places[-1])

    def handle_data(self, data):
        if not self._state()[0]:
            self.parts.append(data)
            if self.places.get("a"):
                self.linked += len(data)

    def _clear(self, mark):
        """This mark and those round it no longer count."""
        while mark is not None and not mark.cleared:
            mark.cleared, mark = True, mark.around

    def labels(self) -> list:
        """Both passes with the marks that still count."""
        for mark in self.marks:  # outer ones first
            stands = not mark.cleared and not (mark.kind == LAYOUT and mark.holds)
            mark.bad = stands or (mark.around is not None and mark.around.bad)
        out = []
        for text, linked, article, boiler, mark, entries in self.blocks:
            linked_list = entries is not None and entries[1] > MAX_LINK_DENSITY * entries[0]
            out.append(first_pass(text, linked, article, boiler or (mark is not None and mark.bad), linked_list))
        return second_pass(out)

    def good(self) -> list[str]:
        """The texts of the blocks that the page keeps."""

        def chosen(labels):
            return [b[0] for b, label in zip(self.blocks, labels) if label]

        def longest(articles):
            return max((a for a in articles if a.chars), key=lambda a: a.chars, default=None)

        own = [a for a in self.articles if a.mark is None or not a.mark.response]
        for article in own:
            if article.mark is not None:
                article.mark.holds = True
        for mark in reversed(self.marks):
            if mark.holds and mark.around is not None:
                mark.around.holds = True
        main = longest(own)
        if main is not None:
            self._clear(main.mark)
        texts = chosen(self.labels())
        other = longest(a for a in self.articles if a.mark is not None and a.mark.response)
        if other is not None and not texts:
            self._clear(other.mark)
            texts = chosen(self.labels())
        if not texts:
            form = max((m for m in self.marks if m.form and m.chars >= LONG_CHARS), key=lambda m: m.chars, default=None)
            if form is not None:
                self._clear(form)
                texts = chosen(self.labels())
        if not texts:
            free = [b for b in self.blocks if not b[3] and (b[4] is None or not b[4].bad) and _WORD.search(b[0])]
            free = [b[0] for b in free if b[1] <= MAX_LINK_DENSITY * len(b[0])]
            texts = free if any(len(t.encode()) >= SHORT_CHARS for t in free) else []
        return texts


def first_pass(text: str, linked: int, article: bool, boiler: bool, linked_list: bool = False):
    """GOOD, BAD or OPEN for one block."""
    if boiler or linked_list:
        return BAD
    if article:
        return GOOD
    if linked > MAX_LINK_DENSITY * len(text):
        return BAD
    words = _WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if len(text) < SHORT_CHARS:
        return BAD if linked else OPEN
    if stops >= STOP_HIGH or (stops >= STOP_LOW and len(text) >= LONG_CHARS):
        return GOOD
    return OPEN if stops >= STOP_LOW else BAD


def second_pass(labels: list) -> list:
    """Open blocks take the nearest decided label; a tie between good and bad is bad."""
    n = len(labels)
    before, after = [(BAD, n + 1)] * n, [(BAD, n + 1)] * n
    for at, near in ((range(n), before), (range(n - 1, -1, -1), after)):
        label, far = BAD, n + 1
        for i in at:
            label, far = (labels[i], 0) if labels[i] is not OPEN else (label, far + 1)
            near[i] = (label, far)
    out = []
    for i, label in enumerate(labels):
        if label is OPEN:
            (one, d1), (two, d2) = before[i], after[i]
            label = one if one == two or d1 < d2 else two if d2 < d1 else BAD
        out.append(label)
    return out


def main_text(html: str) -> str:
    """The good blocks of a page, one to a line."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.cut()
    return "\n".join(parser.good())


def extract(pages: DataFrame, keep: list[str], column: str = "html") -> DataFrame:
    """``keep`` columns of every page with ``text`` and ``n_chars``."""
    schema = T.StructType(
        [pages.schema[c] for c in keep]
        + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches):
        for batch, pages_html in pieces(batches, column):
            texts = [main_text(h.decode("utf-8", "replace")) if h else "" for h in pages_html.to_pylist()]
            yield with_columns(
                batch, keep, text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64())
            )

    return pages.select(*dict.fromkeys([*keep, column])).mapInArrow(run, schema)


def extracted_pages(pages: DataFrame) -> DataFrame:
    """``op8``: main text of every page."""
    return extract(pages, ["page_id", "url"])
