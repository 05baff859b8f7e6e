"""HTML extraction by tree scoring.

The page is read into a tree. Paragraphs pass points for length and commas to their ancestors: all to
the parent, half to the grandparent, less beyond, to ``REACH`` of them. A container's points are discounted
by its link density, and containers whose names leave it open what they hold get half. The best container
is kept, or the article or main around it, with siblings that score well or are of its kind, and the
headings before them.

Menus, headers, footers, sidebars, scripts and styles are cut out of the tree by their tags. Names (the words of class, id
and role) only doubt: what they call a notice, an advert, a menu, a form or comments is first scored with the rest, its points
lowered. A doubtful element stays if it holds the best container, or most prose of the page with little beside it: so
``overflow-hidden``, ``nav-fixed``, ``ad-free`` or a form around the whole page cost nothing. What is
left in doubt is cut. A name of nothing but layout and such a word (``comment-list``, ``cookie-bar``) is certain, and
yields only to the title or the article of a page inside it with most of the text. A name that also speaks for content in a word of its
own (``entry-content comments-open``) doubts nothing. A word inside a phrase (``share-of-market``, ``notice-of-meeting``) names nothing.
``related`` and ``share`` count only beside other words of layout (``related-posts``, not ``related-work``). What is called a discussion or
responses stays if it reads like prose: inside the best container, long, with few links. Of a header inside an article the
headings are kept. A label or button inside a sentence keeps its words.

Scale: pages are independent: one pass without a shuffle, Arrow batches cut by bytes, the tree of one
page at a time in memory, in time proportional to the page however deep it nests.

Edge cases: null or empty html gives an empty text; unclosed and truncated markup is closed at the
end; an unfinished tag at the end of the page is dropped; a page whose paragraphs are all short
falls back to its article, main or body; a page that stands in a popup, sidebar or banner as a whole is kept; a page of
nothing but notices, adverts, menus or comments is empty; repeated rows are read one by one; extra columns are ignored by the
query and kept by :func:`extract`; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textkernel as tk
from tidemark.llm.workspace import bound_batches, own_prefix

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea svg iframe object select title canvas video audio".split())
_DROPPED = frozenset("head nav header footer aside button menu dialog label input".split()) | _RAW
_DOUBTED = frozenset("form fieldset".split())
_WORDED = frozenset("label button".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark math q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p pre td blockquote li dd div section article main body".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# a block tag ends an open paragraph
_ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}}
# Words of names. What a thing is.
_KIND = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice alert alertdialog disclaimer "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer comment comments commentlist respond replies disqus "
    "newsletter subscribe subscription signup complementary contentinfo hidden".split()
)
# Of these, what readers write; and states, which a page's wrapper may be in.
_READERS = frozenset("comment comments commentlist respond replies disqus".split())
_STATES = frozenset("open closed disabled enabled fixed visible active inactive accepted loaded dark light free collapsed expanded sticky ready".split())
# Where it stands.
_PLACE = frozenset("banner popup modal overlay sidebar aside".split())
# Cut beside words of layout only.
_PARTS = frozenset("share sharing related recommended".split())
# Cut unless it reads like prose.
_OPEN = frozenset("discussion responses".split())
# These don't count for headings, nor against a name that also speaks for content.
_WEAK = frozenset("side rail foot social login search widget tags toc copyright legal skip meta byline".split())
_HEADER = frozenset("header masthead".split())
_LIKELY = frozenset("article post entry content main body story text blog page".split())
_LAYOUT = _KIND | _PLACE | _PARTS | _OPEN | _WEAK | _HEADER | _LIKELY | frozenset(
    "articles posts pages items item list lists link links button buttons icon icons box boxes wrap wrapper container inner outer block section area bar row col column grid card "
    "cards panel group region zone slot unit module component view title heading header more top bottom left right primary secondary site user users reader readers mobile desktop sticky "
    "fixed global stories news media tools tool count this us on and".split()
)
_PHRASE = frozenset("of the for in to about how why what a an".split())
_SAYS_OTHERWISE = re.compile(r"(?:has|no|with|without)[-_]\S+", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")

REACH = 6
_SENTENCES = _HEADINGS | frozenset("p td dd blockquote li".split())
_PROSE = 80  # characters of text beyond links that a part named as open needs


class Node:
    __slots__ = ("tag", "parent", "likely", "kind", "open", "in_header", "in_content", "points", "score", "chars", "links", "within", "menu", "doubt", "prose", "lead")

    def __init__(self, tag: str, parent: Node | None, likely: bool = False, kind: str = "", open_: bool = False, header: bool = False, doubt: int = 0) -> None:
        self.tag, self.parent, self.likely, self.kind, self.open = tag, parent, likely, kind, open_
        self.in_header = header or (parent is not None and parent.in_header)
        self.in_content = (parent is not None and parent.in_content) or tag in ("article", "main") or (likely and tag not in ("body", "html"))
        self.points, self.score, self.chars, self.links = 0.0, 0.0, 0, 0
        self.within: Node | None = None
        self.menu = False
        self.doubt, self.prose, self.lead = doubt, 0, False


DOUBTFUL, CERTAIN = 1, 2


@lru_cache(4096)
def _name_says(name: str) -> frozenset[str]:
    """What a class, id or role says: pure, certain, doubtful, minor (kinds of noise), content, likely, open, header."""
    says = set()
    for token in name.split():
        if _SAYS_OTHERWISE.fullmatch(token):
            continue
        words = {x for x in re.split(r"[_\W]+", _HUMP.sub("-", token).lower()) if x}
        likely = words & _LIKELY
        if likely:
            says.add("likely")
        if words & _PHRASE:
            continue
        kind, state = words & _KIND or (words & _PARTS and words <= _LAYOUT), words & _STATES
        if kind and not state and (words <= _LAYOUT or words & _READERS):
            says.add("pure" if words <= _KIND else "certain")
        elif kind or words & _PLACE:
            says.add("doubtful")
        elif words & _WEAK:
            says.add("minor")
        elif likely:
            says.add("content")
        if words & _OPEN:
            says.add("open")
        if words & _HEADER and not state:
            says.add("header")
    if ":" in name and "pure" in says:  # beside utilities like md:block
        says = says - {"pure"} | {"doubtful"}
    return frozenset(says)


@lru_cache(4096)
def _read_attributes(tag: str, attributes: str) -> tuple[str, bool, str, bool, int]:
    """What to do with the element ("cut", "open", "header" or ""), whether it speaks for content, its class, whether its role is main, and doubt."""
    says: set[str] = set()
    kind, hidden, main = "", False, False
    for name, value in _ATTRIBUTE.findall(attributes):
        value, name = value.strip("\"'"), name.lower()
        if name in ("class", "id", "role"):
            says |= _name_says(value)
            kind = value if name == "class" else kind
            main = main or (name == "role" and value.lower() == "main")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            hidden = True
    likely = "likely" in says
    if hidden:
        return "cut", likely, kind, main, 0
    if not says or main or tag in ("body", "html", "article", "main"):
        return "", likely, kind, main, 0
    content = "content" in says
    doubt = CERTAIN if "pure" in says or ("certain" in says and not content) else 0
    if not doubt and not content and ("doubtful" in says or ("minor" in says and tag not in _HEADINGS and not likely)):
        doubt = DOUBTFUL
    if "open" in says and tag not in _HEADINGS:
        return "open", likely, kind, main, doubt
    return "header" if tag not in _HEADINGS and "header" in says else "", likely, kind, main, doubt


def blocks_of(page: str) -> tuple[list[tuple[Node, str, int]], list[Node]]:
    """The blocks (their node, text, characters in links) that no tag cuts out, in page order, and all nodes, parents first."""
    root = Node("#root", None)
    stack, nodes = [root], [root]
    opened: Counter[str] = Counter()
    dropped: list[str] = []  # open tags from the one that is cut out on
    blocks: list[tuple[Node, str, int]] = []
    held: list[tuple[str, bool]] = []
    owner = root

    def flush() -> None:
        nonlocal held
        if held:
            text = " ".join(html.unescape("".join(x for x, _ in held)).split())
            if text and (owner.tag in _HEADINGS or not owner.in_header):  # of a header in an article only headings stay
                links = sum(len(x) for x, linked in held if linked)
                blocks.append((owner, text, min(links, len(text))))
            held = []

    def pop() -> None:
        opened[stack.pop().tag] -= 1

    def close_up_to(k: int) -> None:
        while len(stack) > k:
            pop()

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at and not dropped:
            block = next(x for x in reversed(stack) if x.tag not in _INLINE)
            if held and block is not owner:
                flush()
            owner = block
            held.append((page[at:stop], opened["a"] > 0))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or not m[4]:
            continue  # comment, declaration, or an unfinished tag at the end
        closing, alone = m[1], m[3].endswith("/")
        if tag in _VOID:
            if tag == "hr" and not dropped:
                flush()
            elif tag == "br" and held:
                held.append((" ", False))
            continue
        if closing:
            if dropped:
                if tag in dropped:
                    while dropped.pop() != tag:
                        pass
                continue
            if tag in _WORDED:
                continue
            if tag not in _INLINE:
                flush()
            if opened[tag]:
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in _RAW and not alone:
            if tag not in _INLINE:
                flush()
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if dropped:
            if not alone and tag not in ("p", "li", "option", "dt", "dd", "tr", "td", "th"):
                dropped.append(tag)
            continue
        act, likely, kind, main, doubt = _read_attributes(tag, m[3]) if m[3] else ("", False, "", False, 0)
        if doubt and tag in _INLINE:
            act = "cut"
        if tag in _DOUBTED:
            doubt = doubt or DOUBTFUL
        worded = tag in _WORDED and bool(held) and owner.tag in _SENTENCES and not opened["form"] and act != "cut"
        if tag == "header" and act != "cut":
            act = "header"
        if tag not in _INLINE and not worded:
            flush()
            if tag in _ENDS_P and opened["p"]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        close_up_to(k)
                        break
                    if stack[k].tag not in _INLINE:
                        break
            if tag in _CLOSES and tag != "p" and any(opened[x] for x in _CLOSES[tag]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in _CLOSES[tag]:
                        close_up_to(k)
                        break
                    if stack[k].tag in _SCOPE.get(tag, ()):
                        break
        in_header = act == "header" and stack[-1].in_content
        if in_header:
            likely, kind = False, ""
        elif worded:
            continue
        elif tag in _DROPPED or act in ("cut", "header"):
            if not alone:
                dropped.append(tag)
            continue
        if not alone:
            node = Node(tag, stack[-1], likely, "main" if main else kind, act == "open", in_header, doubt)
            stack.append(node)
            nodes.append(node)
            opened[tag] += 1
    flush()
    return blocks, nodes


def _points(blocks: list[tuple[Node, str, int]], nodes: list[Node], trust: Callable[[Node], float] = lambda x: 1.0) -> None:
    """Of each node its characters, link characters, points and score; a block gives as many points as its node is trusted."""
    for node, text, links in blocks:
        node.chars += len(text)
        node.links += links
    for x in reversed(nodes[1:]):  # children come behind their parents
        x.parent.chars += x.chars
        x.parent.links += x.links
    for node, text, _ in blocks:
        if node.tag not in _PARAGRAPHS or len(text) < 25:
            continue
        points = (1 + text.count(",") + min(len(text) // 100, 3)) * trust(node)
        # text directly in a container speaks for the container itself
        x, share, depth = (node if node.tag in ("div", "section", "article", "main", "body") else node.parent), 1.0, 0
        while x is not None and x.parent is not None and depth < REACH:
            x.points += points * share
            depth += 1
            share = 0.5 if depth == 1 else 1 / (depth * 3)
            x = x.parent
    for x in nodes:
        if x.chars:
            bonus = 25 * trust(x) if x.points and (x.tag in ("article", "main") or x.likely) else 0
            weight = (1 - x.links / x.chars) * (0.5 if x.open else 1)
            x.score, x.points = (x.points + bonus) * weight, x.points * weight


def _best(nodes: list[Node]) -> Node | None:
    """The container of the highest score, or the outermost article, or else the main, around it."""
    nodes = [x for x in nodes if x.chars]
    scored = [x for x in nodes if x.parent is not None and x.tag != "html" and x.score > 0]
    if not scored:
        return next((x for tag in ("article", "main", "body", "#root") for x in nodes if x.tag == tag), None)
    best = around = max(scored, key=lambda x: x.score)
    above = []
    while around is not None:
        above.append(around)
        around = around.parent
    articles = [x for x in above if x.tag == "article"]
    mains = [x for x in above if x.tag == "main" or x.kind == "main"]
    return articles[-1] if articles else mains[-1] if mains else best


def _is_prose(x: Node) -> bool:
    return x.chars - x.links >= _PROSE and x.links < 0.25 * x.chars


def _doubts_settled(blocks: list[tuple[Node, str, int]], nodes: list[Node]) -> list[tuple[Node, str, int]]:
    """The blocks that are in no doubt, once elements that hold the page's text are cleared of theirs."""
    if not any(x.doubt for x in nodes):
        return blocks
    for x in nodes:
        x.lead = x.tag in ("h1", "main") or (x.tag == "article" and not _name_says(x.kind) & {"pure", "certain", "doubtful"})

    def within(level: int) -> None:
        """Into ``within`` the outermost element around each node, itself included, whose doubt is of the level at least."""
        for x in nodes:  # parents first
            x.within = x.parent.within if x.parent is not None and x.parent.within is not None else x if x.doubt >= level else None

    def weigh(level: int) -> None:
        within(level)
        for x in nodes:
            x.prose = 0
        for node, text, links in blocks:
            if node.within is None and len(text) >= 25:
                node.prose += len(text) - links
        for x in reversed(nodes[1:]):
            x.parent.prose += x.prose
            x.parent.lead = x.parent.lead or x.lead

    weigh(CERTAIN + 1)
    for x in nodes:
        if x.doubt == CERTAIN and x.lead and x.prose > 0.5 * nodes[0].prose:
            x.doubt = DOUBTFUL
    weigh(CERTAIN)
    whole = nodes[0].prose
    for x in nodes:
        if x.doubt == DOUBTFUL and whole and x.prose > 0.5 * whole and (x.lead or x.prose >= 0.75 * whole):
            x.doubt = 0
    # what is still in doubt is scored with the rest, for less: it stays where the best container lies in it
    sure = [b for b in blocks if b[0].within is None]
    within(DOUBTFUL)
    _points(sure, nodes, lambda x: 1.0 if x.within is None else 0.25)
    best = _best(nodes)
    while best is not None:
        best.doubt = 0 if best.doubt < CERTAIN else best.doubt
        best = best.parent
    within(DOUBTFUL)
    left = [b for b in blocks if b[0].within is None]
    for x in nodes:
        x.points, x.score, x.chars, x.links, x.within = 0.0, 0.0, 0, 0, None
    return left


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks, nodes = blocks_of(page)
    blocks = _doubts_settled(blocks, nodes)
    _points(blocks, nodes)
    best = _best(nodes)
    if best is None:
        return ""
    chosen, siblings = {id(best)}, best.parent
    if siblings is not None and best.tag not in ("body", "html"):
        for x in nodes:
            if x.parent is not siblings or not x.chars or x.open or x.tag in ("ul", "ol", "table"):
                continue
            alike = x.tag == best.tag and x.kind == best.kind and (x.tag == "section" or (x.tag == "div" and x.kind))
            if x.points >= max(10, 0.2 * best.points) or (alike and x.links < 0.3 * x.chars):
                chosen.add(id(x))
    for x in nodes:  # parents first
        up = x.parent
        x.within = x if id(x) in chosen else up.within if up is not None else None
        own = x.tag in ("ul", "ol", "table", "div", "dl") and x.links > 0.5 * x.chars
        x.menu = x.within is not x and (own or (x.open and not _is_prose(x)) or (up is not None and up.menu))
    kept: list[tuple[str, str]] = []
    before: list[str] = []  # headings beside the chosen nodes, kept if a chosen node follows
    titled = False
    for node, text, links in blocks:
        if node.within is not None:
            if not node.menu:
                titled = titled or node.tag == "h1"
                kept += [("beside", h) for h in before] + [(node.tag, text)]
            before = []
        elif node.parent is siblings and siblings is not None and node.tag in _HEADINGS:
            before.append(text)
        else:
            before = []
            if node.parent is siblings and node.tag == "p" and siblings is not None and len(text) > 80 and links < 0.25 * len(text):
                kept.append((node.tag, text))
    if titled and kept[0][0] == "beside":  # the chosen text has its own title: the one before it is the site's
        kept = kept[next(k for k, (tag, _) in enumerate(kept) if tag != "beside") :]
    return " ".join(text for _, text in kept)


def _extracted(column: str, own: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.slices(batches, column):
            texts = [main_text(x) for x in batch.column(column).to_pylist()]
            arrays = [*batch.columns, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, f"{own}text", f"{own}n_chars"])

    return run


def extract(pages: DataFrame, column: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` with the columns ``text`` and ``n_chars``; columns that it has under these names are replaced."""
    own = own_prefix(pages)
    schema = T.StructType([*pages.schema.fields, T.StructField(f"{own}text", T.StringType()), T.StructField(f"{own}n_chars", T.LongType())])
    found = bound_batches(pages).mapInArrow(_extracted(column, own), schema)
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in (text.lower(), n_chars.lower())]
    return found.select(*kept, F.col(f"{own}text").alias(text), F.col(f"{own}n_chars").alias(n_chars))


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")).drop("html")
