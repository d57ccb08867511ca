"""Main text of web pages by wrappers inferred per host.

The token stream of a page (start tags, end tags, texts) becomes nested lists.  A wrapper is a union-free regular
expression over the same tokens: items in order, each possibly optional or repeated, and texts that are either
constant or slots.  Streams of one host are aligned one after another: where labels differ, the unmatched items
become optional; neighbours with one label, or with a pattern of labels that comes again, become a repeated
group; texts that differ become a slot.  Two wrappers align the same way, so tasks infer partial wrappers over their
pages and those are merged in two rounds, whatever share of the pages a host has.

The wrapper decides where a host keeps its article: the container with most variable text outside the places
that tags, roles and names declare to be menus, adverts and the like; and which constant texts inside it are
furniture.  A host with a single page has a wrapper without variable text; there the declarations decide alone.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, without

#: How tags behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
FORMAT = frozenset("b i em strong u s small big font tt abbr cite code sub sup mark q ins del kbd samp var time bdi bdo".split())
INLINE = FORMAT | frozenset("a span label".split())
#: Parts that stand within a line, so that the text around them is one block.
WITHIN = INLINE | frozenset("button select object canvas map audio video".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: What declares a part to be no article text, and what declares an article.
FURNITURE_TAGS = frozenset("nav footer aside form button select dialog menu head object canvas map audio video fieldset".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead footer sidebar side aside widget related recommended recommendations share sharing social "
    "comment comments reply replies respond discussion disqus cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup signin login search pagination pager toolbar copyright skip".split()
)
#: Words of FURNITURE_WORDS for texts of other people or other pages, which may well be longer than the article.
APART_WORDS = frozenset("related recommended recommendations comment comments reply replies respond discussion disqus".split())
ARTICLE_WORDS = frozenset("article content main post entry story body text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/><\"']*)", re.DOTALL)
#: What follows a tag's name; a quoted value may hold the sign that ends a tag.
_REST = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_QUOTED = re.compile(r"\"[^\"]*+\"|'[^']*+'|[\"'>]")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_PART = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
#: Longest pattern of labels that is folded, longest text that a wrapper holds itself (of a longer one the hash), most items of one list before
#: their labels are reduced to tags, and deepest nesting (what lies deeper counts as part of its ancestor).
_PERIOD, _CONSTANT, _WIDEST, _DEEPEST = 4, 200, 200, 100
#: A constant is furniture if at least _NEARLY_ALL of the host's distinct pages show it; they are counted on the _SAMPLE
#: pages with the smallest content hashes, which are all pages of a host that has no more.
_SAMPLE, _NEARLY_ALL, _FEWEST = 32, 0.9, 3
#: Texts longer than this tell pages apart; counters, dates and bylines are shorter.
_TELLING = 40
#: What makes a part furniture: a name, a name in APART_WORDS, or a tag, role or style, which no wrapper overrules.
NAMED, APART, HARD = 1, 2, 3
#: A part with this share of the host's text and an article's tag, name or heading is an article.
_ENOUGH = 0.1
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


# --- pages ----------------------------------------------------------------------------------------------

class Node:
    """An element: its label, whether it is furniture by itself, and its items (nodes and strings)."""

    __slots__ = ("tag", "label", "furniture", "items")

    def __init__(self, tag: str, label: str, furniture: int):
        self.tag, self.label, self.furniture, self.items = tag, label, furniture, []


_labels: dict[tuple[str, str], tuple[str, int]] = {}


def _declared(tag: str, attributes: str) -> tuple[str, int]:
    """Label (tag with its class and role, digits aside) and how it is declared furniture, 0 if it is not."""
    known = _labels.get((tag, attributes))
    if known:
        return known
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    kinds, names = ({w.lower() for w in _PART.findall(_CAMEL.sub(" ", found.get(a, "")))} for a in ("class", "id"))
    words = kinds | names
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or bool(_HIDDEN.search(found.get("style", "")))
    furniture = 0
    if tag in FURNITURE_TAGS or role in FURNITURE_ROLES or hidden:
        furniture = HARD
    elif words & FURNITURE_WORDS and tag not in ("html", "body", "article", "main"):
        furniture = APART if words & APART_WORDS else NAMED
    # An id often belongs to one page; only its words for articles and furniture make a label.
    label = ".".join([tag, *sorted(kinds | names & (ARTICLE_WORDS | FURNITURE_WORDS))]) + (f"@{role}" if role else "")
    if len(_labels) > 50_000:
        _labels.clear()
    _labels[tag, attributes] = label, furniture
    return label, furniture


class _Tags:
    """The tokens of a page, in time that grows with its length only.

    A tag whose quotes never close is text.  What such an attempt has passed outside quotes is kept: a later one that
    gets there fails as well, so a page is gone over a few times at most, however many quotes stay open.
    """

    def __init__(self, html: str):
        self.html, self.end = html, html.rfind(">") + 1
        self.failed: list[tuple[int, list[int], list[int]]] = []

    def _hopeless(self, at: int) -> bool:
        for first, starts, ends in self.failed:
            i = bisect_left(starts, at) - 1
            if at >= first and (i < 0 or ends[i] <= at):
                return True
        return False

    def next(self, at: int) -> tuple[re.Match, int, str] | None:
        """(match, end, attributes) of the first token from ``at`` on."""
        while m := _TOKEN.search(self.html, at, self.end):
            if not m[2]:
                # An open comment takes the rest of the page.
                open_comment = m[0].startswith("<!--") and not (m[0].endswith("-->") and len(m[0]) > 6)
                return m, len(self.html) if open_comment else m.end(), ""
            if not self._hopeless(m.end()):
                rest = _REST.match(self.html, m.end(), self.end)
                if rest:
                    return m, rest.end(), rest[1]
                self._fail(m.end())
            at = m.start() + 1
        return None

    def _fail(self, at: int) -> None:
        starts, ends = [], []
        for q in _QUOTED.finditer(self.html, at, self.end):
            starts.append(q.start())
            # An open quote runs to the end.
            ends.append(q.end() if q.end() - q.start() > 1 else len(self.html) + 1)
            if q.end() - q.start() == 1:
                break
        self.failed.append((at, starts, ends))


def parse(html: str) -> Node:
    """The nested token stream of a page; tags left open are closed where their parent ends."""
    root = Node("#root", "#root", 0)
    stack, at, deeper, forms = [root], 0, 0, []
    last = html.find("<!--", html.rfind(">") + 1)
    html = html if last < 0 else html[:last]
    tags = _Tags(html)
    while found := tags.next(at):
        m, end_of, attributes = found
        if m.start() > at:
            stack[-1].items.append(html[at: m.start()])
        at = end_of
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in FORMAT:
                continue
            if deeper:
                deeper -= 1
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag == "br" or tag == "hr":
            stack[-1].items.append(Node(tag, tag, 0))
        if tag in VOID or tag in FORMAT:
            continue
        if len(stack) > _DEEPEST:
            deeper += not attributes.endswith("/")
            continue
        if tag not in WITHIN:
            while len(stack) > 1 and (stack[-1].tag in INLINE or stack[-1].tag == "p"):
                stack.pop()
        closes = CLOSES.get(tag)
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    del stack[i:]
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "div", "article", "section"):
                    break
        label, furniture = _declared(tag, attributes)
        if tag == "header" and not any(n.tag in ("article", "main") for n in stack):
            furniture = HARD
        node = Node(tag, label, furniture)
        if tag == "form":
            forms.append((node, _declared("div", attributes)[1]))
        stack[-1].items.append(node)
        if not attributes.endswith("/"):
            stack.append(node)
    if at < len(html):
        stack[-1].items.append(html[at:])
    whole = _letters(root) if forms else 0
    for form, otherwise in forms:
        # A form round the whole page is no form of the article's.
        if _holds(form) or _letters(form, "p") > max(_TELLING, whole / 2):
            form.furniture = otherwise
    return root


def _letters(node: Node, within: str | None = None) -> int:
    """Characters of text, or of that within elements of a tag."""
    inside = within is None or node.tag == within
    return sum((len(x) if inside and not x.isspace() else 0) if isinstance(x, str) else _letters(x, None if inside else within) for x in node.items)


def _holds(node: Node) -> bool:
    return any(isinstance(x, Node) and (x.tag in ("article", "main", "h1") or _holds(x)) for x in node.items)


def _constant(text: str) -> str:
    """A text as a wrapper holds it; of a long one the hash, after a character that no page has."""
    return text if len(text) <= _CONSTANT else _hashed(_squeezed(text))


def _hashed(text: str) -> str:
    return "\0" + xxhash.xxh3_128_hexdigest(text.encode("utf-8", "surrogatepass"))


def _squeezed(text: str) -> str:
    return " ".join(unescape(text).split())


# --- wrappers -------------------------------------------------------------------------------------------
# An item is [label, optional, repeated, text, mass, furniture, items, shown]; a text has the label '#text' and its
# constant (None for a slot), a repeated pattern the label '#group'.  Mass counts characters of text.  Shown has the
# smallest content hashes of the pages that show a constant, and at the root those of all pages; copies have one hash.

LABEL, OPTIONAL, REPEATED, TEXT, MASS, FURNITURE, ITEMS, SHOWN = range(8)


def _folded(items: list[list]) -> list[list]:
    """Neighbours with one label, then patterns of up to _PERIOD labels, made into repeated items."""
    out: list[list] = []
    for item in items:
        if out and out[-1][LABEL] == item[LABEL]:
            merged = merge_items(out[-1], item)
            merged[REPEATED] = True
            out[-1] = merged
        else:
            out.append(item)
    for period in range(2, _PERIOD + 1):
        i = 0
        while i + 2 * period <= len(out):
            names = [x[LABEL] for x in out[i: i + period]]
            if names == [x[LABEL] for x in out[i + period: i + 2 * period]]:
                group = out[i: i + period]
                end = i + period
                while [x[LABEL] for x in out[end: end + period]] == names:
                    group = [merge_items(a, b) for a, b in zip(group, out[end: end + period])]
                    end += period
                label = "#group:" + "|".join(names)
                out[i:end] = [[label, False, True, None, sum(x[MASS] for x in group), 0, group, []]]
            i += 1
    return out


def _smallest(a: list[int], b: list[int]) -> list[int]:
    if not b or a == b or (len(a) == _SAMPLE and b[0] > a[-1]):
        return a
    return sorted({*a, *b})[:_SAMPLE]


def merge_items(a: list, b: list) -> list:
    """One item that matches what either of two items with the same label matches."""
    text = a[TEXT] if a[TEXT] == b[TEXT] else None
    items = a[ITEMS] if not b[ITEMS] else b[ITEMS] if not a[ITEMS] and a[LABEL] == "#text" else align(a[ITEMS], b[ITEMS])
    shown = _smallest(a[SHOWN], b[SHOWN]) if text is not None or a[LABEL] == "#root" else []
    return [a[LABEL], a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], text, a[MASS] + b[MASS], min(a[FURNITURE], b[FURNITURE]), items, shown]


def _optional(item: list) -> list:
    return item if item[OPTIONAL] else [item[LABEL], True, *item[REPEATED:]]


def align(a: list[list], b: list[list]) -> list[list]:
    """Two item lists as one: equal labels merge along a longest common order, the others become optional."""
    left, right = [x[LABEL] for x in a], [x[LABEL] for x in b]
    if left == right:
        return [merge_items(x, y) for x, y in zip(a, b)]
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            length[i][j] = length[i + 1][j + 1] + 1 if left[i] == right[j] else max(length[i + 1][j], length[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if left[i] == right[j]:
            out.append(merge_items(a[i], b[j]))
            i, j = i + 1, j + 1
        elif length[i + 1][j] >= length[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    out += [_optional(x) for x in [*a[i:], *b[j:]]]
    return _folded(_general(out) if len(out) > _WIDEST else out)


def _general(items: list[list]) -> list[list]:
    """Labels reduced to tags ('!' marks furniture), so that page-bound names cannot widen a wrapper without end."""
    return [
        x if x[LABEL].startswith("#") else [re.split(r"[.@!]", x[LABEL])[0] + "!" * bool(x[FURNITURE]), *x[OPTIONAL:]] for x in items
    ]


def _shown(page: Node) -> list[int]:
    """The content hash of a page by its telling texts outside furniture, all of them if none is long; none without text."""

    def texts(node: Node, bar: int):
        for item in node.items:
            if isinstance(item, str):
                if not item.isspace():
                    yield _squeezed(item)
            elif item.furniture < bar:
                yield from texts(item, bar)

    telling = next(filter(None, ([t for t in texts(page, bar) if len(t) > _TELLING] for bar in (NAMED, HARD))), None) or [*texts(page, HARD)]
    return [xxhash.xxh64_intdigest("\n".join(telling).encode("utf-8", "surrogatepass"))] if telling else []


def wrapper_of(node: Node, shown: list[int] | None = None) -> list:
    """The wrapper of a single page: its own token stream, folded."""
    if shown is None:
        shown = _shown(node)
    items: list[list] = []
    for item in node.items:
        if isinstance(item, str):
            if item.isspace():
                continue
            if items and items[-1][LABEL] == "#text":
                last = items[-1]
                last[TEXT], last[MASS], last[SHOWN] = None, last[MASS] + len(item), []
            else:
                items.append(["#text", False, False, _constant(item), len(item), 0, [], shown])
        elif item.tag not in ("br", "hr"):
            items.append(wrapper_of(item, shown))
    items = _folded(items)
    if len(items) > _WIDEST:
        items = _folded(_general(items))
    return [node.label, False, False, None, sum(x[MASS] for x in items), node.furniture, items, shown if node.tag == "#root" else []]


def _variable(item: list) -> int:
    """Characters of variable text outside furniture."""
    if item[FURNITURE]:
        return 0
    if item[LABEL] == "#text":
        return item[MASS] if item[TEXT] is None else 0
    return sum(_variable(x) for x in item[ITEMS])


def _is_constant(item: list, pages: list[int]) -> bool:
    """Whether a text is the same on nearly all of the distinct pages, given the host's sample of them."""
    return item[TEXT] is not None and len(pages) >= _FEWEST and len({*item[SHOWN]} & {*pages}) >= _NEARLY_ALL * len(pages)


def _kept(item: list, pages: list[int], article: bool = False, bar: int = NAMED) -> int:
    """Characters of text outside furniture (from ``bar`` on) that is no constant of the host; a heading counts unless ``article``."""
    if item[FURNITURE] >= bar:
        return 0
    if item[LABEL] == "#text":
        return 0 if _is_constant(item, pages) else item[MASS]
    if not article and _tag(item) in _HEADINGS:
        return item[MASS]
    return sum(_kept(x, pages, article, bar) for x in item[ITEMS])


def _tag(item: list) -> str:
    return re.split(r"[.@!]", item[LABEL])[0]


def _article_like(label: str) -> bool:
    tag, *words = label.partition("@")[0].split(".")
    return tag in ("article", "main") or label.endswith("@main") or (tag in ("div", "section", "td") and bool(ARTICLE_WORDS & set(words)))


def _overruled(wrapper: list) -> set[str]:
    """Labels of parts that are furniture by name only, but hold the article; the wrapper is changed accordingly.

    That is a part with most of the host's text, or, if there is no article elsewhere, one with an article's tag or heading.
    """
    pages, free = wrapper[SHOWN], set()

    def declares(item: list) -> bool:
        return item[FURNITURE] < HARD and (_tag(item) in ("article", "main", "h1") or any(map(declares, item[ITEMS])))

    def named(item: list):
        if item[FURNITURE] in (NAMED, APART):
            yield item
        elif not item[FURNITURE]:
            for child in item[ITEMS]:
                yield from named(child)

    def article(item: list, least: float) -> bool:
        if item[FURNITURE] or not item[ITEMS]:
            return False
        telling = _article_like(item[LABEL]) or any(_tag(x) == "h1" for x in item[ITEMS])
        return telling and _kept(item, pages) >= least or any(article(x, least) for x in item[ITEMS])

    def settle(item: list) -> None:
        if item[LABEL] in free and item[FURNITURE] < HARD:
            item[FURNITURE] = 0
        for child in item[ITEMS]:
            settle(child)

    total = _kept(wrapper, pages, bar=HARD)
    while total:
        elsewhere = article(wrapper, _ENOUGH * total)
        found = {
            x[LABEL] for x in named(wrapper) if not x[LABEL].endswith("!") and (
                2 * _kept_inside(x, pages) > total and (x[FURNITURE] == NAMED or not elsewhere) or not elsewhere and declares(x))
        } - free
        if not found:
            break
        free |= found
        settle(wrapper)
    return free


def _kept_inside(item: list, pages: list[int]) -> int:
    return sum(_kept(x, pages, bar=HARD) for x in item[ITEMS])


def plan_of(wrapper: list, pages: int) -> dict:
    """Where the host keeps its article (a path of labels, or none), the constants in there that are furniture, and the
    labels whose names wrongly tell of furniture."""
    free = _overruled(wrapper)
    best: tuple[list, list[str]] | None = None
    total = _variable(wrapper)

    def visit(item: list, path: list[str]) -> None:
        nonlocal best
        if item[FURNITURE] or item[LABEL] == "#text":
            return
        if not item[LABEL].startswith("#group"):
            path = [*path, item[LABEL]]
        if _article_like(item[LABEL]) and 2 * _variable(item) > total:
            # The outermost article-like container, or one inside it if only furniture and constants are around that;
            # a heading around it counts as text unless the inner one is declared to be the article.
            declared = _tag(item) == "article"
            if best is None or _kept(item, wrapper[SHOWN], declared) == _kept(best[0], wrapper[SHOWN], declared):
                best = (item, path)
        for child in item[ITEMS]:
            visit(child, path)

    if total:
        visit(wrapper, [])
    root = best[1] if best else None
    constants: set[tuple[str, str]] = set()
    mass = {True: 0, False: 0}

    def gather(item: list, parent: str) -> None:
        if item[FURNITURE] or _tag(item) in _HEADINGS:
            return
        if item[LABEL] == "#text":
            constant = _is_constant(item, wrapper[SHOWN])
            mass[constant] += item[MASS]
            if constant:
                constants.add((parent, item[TEXT] if item[TEXT].startswith("\0") else _squeezed(item[TEXT])))
            return
        for child in item[ITEMS]:
            gather(child, parent if item[LABEL].startswith("#group") else item[LABEL])

    def enter(item: list, depth: int) -> None:
        if item[LABEL].startswith("#group"):
            for child in item[ITEMS]:
                enter(child, depth)
        elif root is None or (item[LABEL] == root[depth] and depth + 1 == len(root)):
            gather(item, "")
        elif item[LABEL] == root[depth]:
            for child in item[ITEMS]:
                enter(child, depth + 1)

    if total:
        enter(wrapper, 0)
    # Where the constants are most of the text, the pages are copies that differ in trifles.
    return {"root": root, "drop": sorted(constants) if mass[True] < mass[False] else [], "free": sorted(free)}


# --- extraction -----------------------------------------------------------------------------------------

def extract(html: str | None, plan: dict | None = None) -> str:
    """The blocks of the article, white space squeezed, joined by line ends; '' if there are none."""
    page = parse(html or "")
    own = plan is None
    if own:
        plan = {"root": None, "drop": [], "free": sorted(_overruled(wrapper_of(page)))}
    text = _article(page, plan)
    if not text and not own:
        text = _article(page, {"root": None, "drop": [], "free": sorted(_overruled(wrapper_of(page)))})
    # A page with text has some result: then names tell nothing.
    return text or _article(page, {"root": None, "drop": [], "free": None})


def _article(page: Node, plan: dict) -> str:
    roots: list[Node] = []
    free = plan["free"]

    def furniture(node: Node) -> bool:
        return node.furniture == HARD or (node.furniture > 0 and free is not None and node.label not in free)

    if plan["root"]:
        wanted = plan["root"]

        def find(node: Node, depth: int) -> None:
            if furniture(node) or wanted[depth] not in (node.label, node.tag):
                return
            if depth + 1 == len(wanted):
                roots.append(node)
                return
            for item in node.items:
                if isinstance(item, Node):
                    find(item, depth + 1)

        find(page, 0)
    else:
        # No variable text to go by: declared articles, if there are any.
        def declared(node: Node) -> None:
            for item in node.items:
                if isinstance(item, Node) and not furniture(item):
                    roots.append(item) if item.tag in ("article", "main") else declared(item)

        declared(page)
    drop = {tuple(x) for x in plan["drop"]}
    hashed = any(text.startswith("\0") for _, text in drop)
    blocks: list[str] = []
    parts: list[str] = []

    def flush(parent: str) -> None:
        if parts:
            text = _squeezed("".join(parts))
            parts.clear()
            if text and (parent, text) not in drop and not (hashed and (parent, _hashed(text)) in drop):
                blocks.append(text)

    def walk(node: Node) -> None:
        for item in node.items:
            if isinstance(item, str):
                parts.append(item)
            elif furniture(item):
                if item.tag not in WITHIN:
                    flush(node.label)
            elif item.tag in INLINE:
                walk(item)
            else:
                flush(node.label)
                walk(item)
                flush(item.label)

    for root in roots or [page]:
        walk(root)
        flush(root.label)
    return "\n".join(blocks)


def host_of(url):
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return host


def _rows(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            yield batch.slice(start, 200)


def infer_wrappers(pages: DataFrame, fan: int = 256) -> DataFrame:
    """``html``, ``host`` -> (host, plan).  All pages of a host are aligned: in tasks, then over ``fan`` parts, then whole."""

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], names=["host", "wrapper", "pages"]
        )

    def infer(batches):
        known: dict[str, list] = {}
        for part in _rows(batches):
            for host, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = wrapper_of(parse(html or ""))
                if host in known:
                    known[host] = [merge_items(known[host][0], own), known[host][1] + 1]
                else:
                    known[host] = [own, 1]
            if len(known) > 5_000:
                yield table([(h, json.dumps(w), n) for h, (w, n) in known.items()])
                known = {}
        yield table([(h, json.dumps(w), n) for h, (w, n) in known.items()])

    def merged(group: pa.Table) -> tuple[str, list, int]:
        whole, pages = None, 0
        for text, n in zip(group.column("wrapper"), group.column("pages").to_pylist()):
            wrapper = json.loads(text.as_py())
            whole, pages = wrapper if whole is None else merge_items(whole, wrapper), pages + n
        return group.column("host")[0].as_py(), whole, pages

    def join_parts(group: pa.Table) -> pa.Table:
        host, whole, pages = merged(group)
        return pa.Table.from_batches([table([(host, json.dumps(whole), pages)])])

    def plans(group: pa.Table) -> pa.Table:
        host, whole, pages = merged(group)
        return pa.table({"host": [host], "plan": [json.dumps(plan_of(whole, pages))]})

    partial = stored(pages.select("host", "html").mapInArrow(infer, "host string, wrapper string, pages long"))
    part = F.pmod(F.xxhash64("wrapper", "pages"), F.lit(fan))
    joined = partial.withColumn("part", part).groupBy("host", "part").applyInArrow(join_parts, "host string, wrapper string, pages long")
    return joined.groupBy("host").applyInArrow(plans, "host string, plan string")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``pages`` (``url``, ``html``) plus ``text`` ('' if none) and ``n_chars``; ``html`` itself is not returned.

    A null or empty html gives an empty text.  Pages without a host form a group of their own.  Repeated rows are pages
    like any other.  The result has one row per input row; an empty table gives an empty one.
    """
    pages = without(pages, ["text", "n_chars", "host", "plan"]).withColumn("host", host_of(F.col("url")))
    plans = stored(infer_wrappers(pages))
    kept = [c for c in pages.columns if c not in ("host", "html")]

    def run(batches):
        known: dict[str | None, dict | None] = {}
        for part in _rows(batches):
            html, plan = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("html", "plan"))
            texts = []
            for page, text in zip(html, plan):
                if text not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[text] = json.loads(text) if text else None
                texts.append(extract(page, known[text]))
            ours = [part.column(part.schema.get_field_index(c)) for c in kept]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*ours, pa.array(texts, pa.string()), sizes], names=[*kept, "text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name in kept]
    return pages.join(plans, "host", "left").mapInArrow(run, ", ".join([*fields, "text string, n_chars long"]))
