"""Main text of web pages, by equivalence classes of the tokens of a host's pages.

Tokens are elements, told apart by their path from the root (names, classes, ids), and blocks of text, told apart by the
element they are in. A token's occurrence vector says how often it is on each page of the host; tokens with one vector are
a class. Pages made from one template share its elements and its fixed texts in the same numbers, so these make classes
of many tokens on many pages, while what was filled in differs from page to page. A class is valid if enough elements of
enough pages are in it and it nests: its members lie in one another, or in the one class around it. A fixed text belongs to a
valid class with the same vector around it; on each page it must also come in the class's order. Taking out fixed texts leaves the slots.

Which slots are the article follows from the elements around them: the article (or main part, or what is named so)
without menus, headers, footers, side bars, notices, adverts, forms and comments; where a page names none, all
slots outside those and outside blocks of links.

Vectors are never built: a class is recognised by the number of its pages and two sums over hashes of page and count, which
combine before the shuffle, so a host with a third of all pages is no hot key. Pages are read twice and not shuffled,
unless the templates with fixed texts are too large to be broadcast.
"""

from __future__ import annotations

import bisect
import html as entities
import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.llm.rows import map_rows
from tidemark.session import stage, staged_bytes

#: A class needs so many pages, and so many elements.
SUPPORT, ELEMENTS = 10, 3
#: Templates of up to so many file bytes are broadcast; larger ones are joined.
BROADCAST_BYTES = 8 * 1024 * 1024
#: Path hashes a task remembers. Bounds memory, not results.
REMEMBERED = 200_000

# HTML's element names by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math object select".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption search".split()
)
#: A start tag of these closes an open one of the second, as far up as the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NOT_TEXT = frozenset("nav aside footer form button dialog menu search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words in class names and ids of what is not the article, and names of what is.
ASIDE = frozenset(
    "ad ads advert advertisement adverts adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar footer header masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended comment comments disqus respond reply replies pagination pager widget toolbar skip form".split()
)
ARTICLE = frozenset("article content post entry story main articlebody postbody maincontent maintext".split())
#: Words that make a name one of layout: "with-sidebar" is not the side bar.
LAYOUT = frozenset("with has no without wrapper layout container page wrap outer grid row col left right".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z|(?=<))"
    r"|</?[a-zA-Z][^<>]*+>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    """A block of text: its token, which main part of the page it is in, and the share of it that is links."""

    __slots__ = ("text", "token", "place", "links")

    def __init__(self, text: str, path: int, place: str | None, links: float) -> None:
        self.text, self.place, self.links = text, place, links
        self.token = _token(text, path)


def _token(text: str, above: int) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), above % (1 << 64)) - (1 << 63)


def _named(value: str) -> tuple[bool, bool]:
    """Whether a class or id names something beside the article, and whether it names the article."""
    beside = article = False
    for name in value.split():
        words = _WORD.findall(_CAMEL.sub(" ", name).lower())
        if not words or LAYOUT & set(words):
            continue
        whole = "".join(words)
        if whole in ARTICLE or set(words) <= ARTICLE | {"body", "text"} and len(words) > 1:
            article = True
        elif words[0] in ASIDE or words[-1] in ASIDE:
            beside = True
    return beside, article


class Page:
    """One pass over a page's text: its tokens in order, its blocks, and which main parts it has."""

    def __init__(self, text: str, paths: dict) -> None:
        self.tokens: list[tuple[int, int, int]] = []  # token, token of the element around it, 1 for text
        self.blocks: list[Block] = []
        self.places: set[str] = set()
        self._paths = paths
        #: open elements: name, path, dropped, place, whether a link
        self._open: list[tuple[str, int, bool, str | None, bool]] = []
        self._count: dict[str, int] = {}
        self._run: list[str] = []
        self._linked = 0
        self._read(text)
        self._flush()

    def _read(self, text: str) -> None:
        at, low = 0, None
        while True:
            m = _TAG.search(text, at)
            if m is None:
                self._say(text[at:])
                return
            self._say(text[at : m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                if m[0].startswith("<![CDATA["):
                    self._say(m[0][9:].removesuffix("]]>"))
                continue
            name = name.lower()
            if m[1]:
                self._end(name)
                continue
            self._start(name, m[3])
            if name in RAW and not m[3].endswith("/"):
                low = low if low is not None else text.lower()
                if len(low) != len(text):  # a character whose small form is longer: places would differ
                    low = text
                close = low.find(f"</{name}", at)
                at = len(text) if close < 0 else close

    def _say(self, text: str) -> None:
        if text and not (self._open and self._open[-1][2]):
            self._run.append(text)
            if self._open and self._open[-1][4]:
                self._linked += len(text)

    def _flush(self) -> None:
        if self._run:
            raw = "".join(self._run)
            text = " ".join(entities.unescape(raw).split())
            if text:
                path, place = (self._open[-1][1], self._open[-1][3]) if self._open else (0, None)
                block = Block(text, path, place, self._linked / len(raw))
                self.blocks.append(block)
                self.tokens.append((block.token, path, 1))
            self._run, self._linked = [], 0

    def _pop_to(self, depth: int) -> None:
        if any(e[0] in BLOCK for e in self._open[depth:]):
            self._flush()
        for name, *_ in self._open[depth:]:
            self._count[name] -= 1
        del self._open[depth:]

    def _find(self, names: set[str], barriers: set[str]) -> int | None:
        """Depth of the nearest open element of these names, not looking beyond a barrier."""
        if not any(self._count.get(n) for n in names):
            return None
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] in names:
                return i
            if self._open[i][0] in barriers:
                return None
        return None

    def _start(self, name: str, rest: str) -> None:
        if name == "br":
            self._say(" ")
            return
        if name in BLOCK:
            if (depth := self._find({"p"}, {"td", "th", "button", "object"})) is not None:
                self._pop_to(depth)
            self._flush()
        if name in CLOSES and (depth := self._find(*CLOSES[name])) is not None:
            self._pop_to(depth)
        if name in ("td", "th"):
            self._say(" ")
        above = self._open[-1] if self._open else ("", 0, False, None, False)
        key = (above[1], name, rest)
        known = self._paths.get(key)
        if known is None:
            if len(self._paths) > REMEMBERED:
                self._paths.clear()
            known = self._paths[key] = self._describe(above[1], name, rest)
        path, beside, article, role = known
        place = above[3]
        if name == "article":
            place = "article"
        elif (name == "main" or role == "main") and place != "article":
            place = "main"
        elif article and place is None and name not in ("html", "body"):
            place = "named"
        dropped = above[2]
        if name not in ("html", "body", "main"):
            dropped = dropped or name in NOT_TEXT or name in RAW or role in ROLES or beside
            # the header of a page; that of an article keeps its headings
            dropped = dropped or name == "header" and place != "article"
        dropped = name == "head" or dropped and name != "body"
        if not dropped and place:
            self.places.add(place)
        self.tokens.append((path, above[1], 0))
        if name in VOID or rest.endswith("/") and name not in BLOCK:
            return
        self._open.append((name, path, dropped, place, above[4] or name == "a"))
        self._count[name] = self._count.get(name, 0) + 1

    @staticmethod
    def _describe(above: int, name: str, rest: str) -> tuple[int, bool, bool, str]:
        beside = article = hidden = False
        role, signs = "", []
        if rest.strip(" /"):
            for m in _ATTRIBUTE.finditer(rest):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key in ("class", "id"):
                    b, a = _named(value)
                    beside, article = beside or b, article or a
                    # ids are numbered within a page and over pages
                    signs.append(" ".join(sorted(value.split())) if key == "class" else re.sub(r"\d+", "", value))
                elif key == "role":
                    role = value.strip().lower()
                elif key == "itemprop" and value.strip().lower() == "articlebody":
                    article = True
                elif key == "hidden" or key == "aria-hidden" and value == "true":
                    hidden = True
        return _token("\0".join(["<", name, *signs]), above), hidden or beside and not article and name not in HEADINGS, article, role

    def _end(self, name: str) -> None:
        if name == "p" and not self._count.get("p"):
            self._flush()
            return
        depth = self._find({name}, {"table", "article", "body"} - {name} if name not in ("html", "body", "article", "main", "div", "section") else set())
        if depth is not None:
            self._pop_to(depth)


def host(url: str = "url"):
    """The host in lower case; pages without one are one host."""
    return F.lower(F.coalesce(F.regexp_extract(col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def classes(pages: DataFrame, url: str = "url", html: str = "html", support: int = SUPPORT, elements: int = ELEMENTS) -> DataFrame:
    """Members of the valid classes of each host: `host` (a hash), `class`, `token`, `kind` (1: a fixed text), `place`.

    `place` is ascending in the order of the members in pages. Equal pages count as often as they come.
    """
    text = F.coalesce(col(html), F.lit(""))
    own = pages.select(F.xxhash64(host(url)).alias("host"), F.xxhash64(host(url), text).alias("page"), text.alias("html"))

    def run(batches):
        paths: dict = {}
        for hosts, ids, texts in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for h, page, t in zip(hosts, ids, texts):
                seen: dict = {}
                for place, (token, above, kind) in enumerate(Page(t, paths).tokens):
                    if token in seen:
                        seen[token][2] += 1
                    else:
                        seen[token] = [above, kind, 1, place]
                out[0] += [h] * len(seen)
                out[1] += [page] * len(seen)
                out[2] += seen.keys()
                for j, values in enumerate(zip(*seen.values())):
                    out[3 + j] += values
            yield out

    found = map_rows(own, 0, "host long, page long, token long, above long, kind int, times long, place long", run)
    vector = F.xxhash64("page", "times")
    tokens = found.groupBy("host", "token").agg(
        F.min("above").alias("above"),
        F.min("kind").alias("kind"),
        F.count(F.lit(1)).alias("pages"),
        F.bit_xor(vector).alias("x"),
        F.sum(F.pmod(F.xxhash64("times", "page"), F.lit(1 << 30))).alias("s"),
        F.sum("place").alias("place"),
    )
    often = tokens.where(F.col("pages") >= support)
    often = stage(often.withColumn("class", F.xxhash64("pages", "x", "s")).drop("x", "s", "pages"), "page-tokens")

    around = often.where("kind = 0").select("host", F.col("token").alias("above"), F.col("class").alias("above_class"))
    placed = often.join(around, ["host", "above"], "left").withColumn("above_class", F.coalesce("above_class", F.lit(0)))
    tags = placed.where("kind = 0")
    # each class nests in the class around its first element
    outer = tags.groupBy("host", "class").agg(F.min_by("above_class", "place").alias("outer"))
    nested = tags.join(outer, ["host", "class"]).where("above_class = class OR above_class = outer")
    large = nested.groupBy("host", "class").agg(F.count(F.lit(1)).alias("n"), F.first("outer").alias("outer")).where(F.col("n") >= elements).drop("n")
    members = nested.join(large.select("host", "class"), ["host", "class"])
    inner = outer.select("host", F.col("class").alias("above_class"), F.col("outer").alias("beyond"))
    texts = placed.where("kind = 1").join(large, ["host", "class"]).join(inner, ["host", "above_class"], "left")
    texts = texts.where("above_class = class OR above_class = outer OR beyond = class")
    columns = ["host", "class", "token", "kind", "place"]
    return members.select(*columns).union(texts.select(*columns))


def _rising(places: list[int]) -> set[int]:
    """Indices of a longest rising subsequence."""
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, place in enumerate(places):
        j = bisect.bisect_left(ends, place)
        before.append(at[j - 1] if j else -1)
        ends[j : j + 1] = [place]
        at[j : j + 1] = [i]
    found, i = set(), at[-1] if at else -1
    while i >= 0:
        found.add(i)
        i = before[i]
    return found


def fixed_texts(page: Page, template: list) -> set[int]:
    """Tokens of the texts that the template says are fixed, where they come in its order on this page."""
    if not template:
        return set()
    member = {t["token"]: t for t in template}
    lines: dict = {}
    for token in dict.fromkeys(token for token, *_ in page.tokens):
        if token in member:
            lines.setdefault(member[token]["class"], []).append(member[token])
    fixed = set()
    for line in lines.values():
        rising = _rising([t["place"] for t in line])
        fixed |= {t["token"] for i, t in enumerate(line) if i in rising and t["kind"] == 1}
    return fixed


def main_text(page: Page, template: list = ()) -> str:
    """The slots of the page's main part, joined by empty lines."""
    places = [p for p in ("article", "main", "named") if p in page.places]
    if places:
        own = [b for b in page.blocks if b.place == places[0] or places[0] == "named" and b.place is not None]
    else:
        own = [b for b in page.blocks if b.links <= 0.5]
    fixed = fixed_texts(page, template)
    slots = [b for b in own if b.token not in fixed]
    return "\n\n".join(b.text for b in slots or own)


def extract(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url: str = "url", html: str = "html", support: int = SUPPORT, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """`keep` columns, `text` (the main part: blocks in page order, joined by an empty line) and `n_chars`.

    Character references are decoded and white space within a block is one space; nothing else is changed or cut. A null
    or empty page, or one without such text, gives an empty text. Every row gives a row, also repeated ones. Pages without a
    host are treated as one host. Hosts with fewer than `support` pages have no template: there the elements alone decide. Where all of a
    page's text is fixed, as on a host whose pages are copies of one, it cannot be told from what was filled in and stays.
    Other columns play no part, whatever their names.
    """
    members = classes(pages, url, html, support)
    with_text = members.where("kind = 1").select("host", "class").distinct()
    template = members.join(with_text, ["host", "class"])
    listed = F.collect_list(F.struct("class", "token", "kind", "place")).alias("template")
    templates = stage(template.groupBy("host").agg(listed), "templates")
    small = staged_bytes(templates) <= broadcast_bytes
    own = pages.select(*[col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.xxhash64(host(url)).alias("host"), F.coalesce(col(html), F.lit("")).alias("html"))
    own = own.join(F.broadcast(templates) if small else templates, "host", "left").select(*[f"k{i}" for i in range(len(keep))], "html", "template")

    def run(batches):
        paths: dict = {}
        for *kept, texts, found in batches:
            yield [*kept, [main_text(Page(t, paths), f or []) for t, f in zip(texts, found)]]

    done = map_rows(own, len(keep), "text string", run, rows=500)
    return done.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "text", F.length("text").cast("long").alias("n_chars"))
